import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from codelineage.operators import ordered


@pytest.fixture(scope="module")
def rows(spark):
    # Key 0 holds a third of all rows and must span several chunks.
    return spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97).alias("key"),
        F.xxhash64("id").alias("place"),
        (F.col("id") % 11).alias("size"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id")).alias("value"),
    ).cache()


@pytest.mark.parametrize("keys,chunks", [(["key"], 1), (["key"], 7), (["key"], 500), ([], 7)])
def test_chunks_equal_a_plain_window(rows, keys, chunks):
    got = ordered.with_order(
        rows, keys, ["place"], number="rn", sum_before={"before": "size"}, following={"next": F.col("value")}, chunk_rows=-(-6000 // chunks))
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("place")
    want = rows.select(
        "*", F.row_number().over(w).cast("long").alias("rn"),
        F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.lead("value").over(w).alias("next"))
    assert got.columns == want.columns
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_a_hot_key_is_spread_over_chunks_in_order(rows):
    chunked, n = ordered.with_chunk(rows, ["key", "place"], 500)
    assert n == 12
    found = chunked.select("key", "place", F.col(ordered.CHUNK).alias("chunk")).orderBy("key", "place").collect()
    assert [r.chunk for r in found] == sorted(r.chunk for r in found)
    sizes = [sum(r.chunk == c for r in found) for c in range(n)]
    assert min(sizes) > 0 and max(sizes) < 900
    assert len({r.chunk for r in found if r.key == 0}) >= 4


def test_rows_that_do_not_differ_and_no_rows(spark):
    same = spark.range(50).select(F.lit(1).alias("key"), F.lit("a").alias("place"))
    got = ordered.with_order(same, ["key"], ["place"], number="rn", chunk_rows=9)
    assert sorted(r.rn for r in got.collect()) == list(range(1, 51))
    assert ordered.with_order(same.limit(0), ["key"], ["place"], number="rn", following={"next": F.col("place")}).collect() == []


def test_nothing_but_small_tables_is_written(rows, monkeypatch):
    seen = []
    real = ordered.written
    monkeypatch.setattr(ordered, "written", lambda df, name: seen.append((name, df.columns)) or real(df, name))
    ordered.with_order(rows, ["key"], ["place"], number="rn", chunk_rows=500)
    assert dict(seen) == {"sample": ["key", "place"], "cuts": ["groups"], "carried": [ordered.CHUNK, "key", "_carry_number"]}
