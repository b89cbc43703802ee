"""Row numbers, running sums and next rows over ordered groups of any size.

A plain ``Window.partitionBy(key)`` puts a whole group in one task. Here the
order (keys, order) is cut into chunks at rows taken from a sample of bounded
size, and a row's chunk is an expression over its own columns and those cuts, so
it comes out alike wherever it is evaluated and no row is written. Windows run inside
a chunk, and what a chunk needs from its neighbours is one small row per
(chunk, key), summed in a narrow pass that combines before its shuffle. Only keys that cross a
chunk border need such a row: at most two per border, which bounds the broadcast
by the number of chunks. That number follows the number of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from codelineage.storage import written

CHUNK = "_chunk"
# Rows of a chunk as aimed at, chunks at most (chunks grow beyond), and rows sampled for each.
CHUNK_ROWS, MOST_CHUNKS, SAMPLED = 1 << 18, 4096, 32


def with_chunk(df: DataFrame, columns: list[str], chunk_rows: int | None = None) -> tuple[DataFrame, int]:
    """``df`` with the chunk of each row in the order of ``columns``, and the number of chunks.

    One narrow pass over ``columns`` counts the rows and keeps a random sample; every so-many-th row of
    it is a cut. A row's chunk is the number of cuts that do not lie above it, found in two
    steps through a list of lists. Rows equal in all columns share a chunk.
    """
    seen = Observation()
    narrow = df.select(*columns).observe(seen, F.count(F.lit(1)).alias("n"))
    sample = written(narrow.orderBy(F.rand(7)).limit(MOST_CHUNKS * SAMPLED), "sample")
    n = seen.get["n"]
    chunks = min(MOST_CHUNKS, -(-n // (chunk_rows or CHUNK_ROWS)))
    if chunks < 2:
        return df.withColumn(CHUNK, F.lit(0)), 1
    kept = min(n, MOST_CHUNKS * SAMPLED)
    row = F.struct(*columns)
    place = F.row_number().over(Window.orderBy(*columns)) - 1
    # The first row of the sample's i-th share of ``chunks`` equal ones is a cut.
    share = lambda p: F.floor(p * F.lit(chunks) / F.lit(kept))
    cuts = sample.withColumn("_place", place).filter((F.col("_place") > 0) & (share(F.col("_place")) > share(F.col("_place") - 1)))
    cuts = cuts.select(row.alias("cut")).distinct()
    width = math.isqrt(chunks) + 1
    numbered = cuts.withColumn("_group", F.floor((F.row_number().over(Window.orderBy("cut")) - 1) / F.lit(width)))
    groups = numbered.groupBy("_group").agg(F.array_sort(F.collect_list("cut")).alias("cuts"))
    table = written(groups.agg(F.array_sort(F.collect_list(F.struct("_group", "cuts"))).alias("groups")), "cuts")
    lists = F.transform("_cuts", lambda g: g["cuts"])
    # Groups that begin at or below the row; all but the last of them lie below it whole.
    begun = F.size(F.filter(lists, lambda c: c[0] <= row))
    within = F.size(F.filter(F.get(lists, begun - 1), lambda c: c <= row))
    chunk = F.when(begun > 0, (begun - 1) * width + within).otherwise(0).cast("int")
    return df.withColumn("_cuts", table.select("groups").scalar()).withColumn(CHUNK, chunk).drop("_cuts"), chunks


def with_order(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    number: str | None = None,
    sum_before: dict[str, str] | None = None,
    following: dict[str, Column] | None = None,
    chunk_rows: int | None = None,
) -> DataFrame:
    """Add columns computed over each group of ``keys`` sorted ascending by ``order``.

    number      name of a 1-based position column
    sum_before  new column -> column whose total over all earlier rows it holds
    following   new column -> expression taken from the next row, NULL on the last

    Keys must not be null, and (keys, order) should identify a row; rows that do not differ there
    are numbered in any order. ``df`` is evaluated up to three times: narrowly for the cuts
    and the sums of the chunks, and once for its rows.
    """
    sum_before, following = sum_before or {}, following or {}
    rows, chunks = with_chunk(df, [*keys, *order], chunk_rows)
    inside = Window.partitionBy(CHUNK, *keys).orderBy(*order)
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)

    local = {"_number": F.row_number().over(inside)}
    local |= {f"_sum_{c}": F.coalesce(F.sum(src).over(earlier), F.lit(0)) for c, src in sum_before.items()}
    # A struct around the value tells "no next row here" from "next value is NULL".
    local |= {f"_next_{c}": F.lead(F.struct(e.alias("v"))).over(inside) for c, e in following.items()}
    out = rows.withColumns(local)

    if chunks > 1:
        partial = [F.count(F.lit(1)).alias("_rows")]
        partial += [F.sum(src).alias(f"_total_{c}") for c, src in sum_before.items()]
        if following:
            values = F.struct(*[e.alias(c) for c, e in following.items()])
            partial.append(F.min_by(values, F.struct(*order)).alias("_first"))
        per_chunk = rows.groupBy(CHUNK, *keys).agg(*partial)

        across = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(CHUNK)
        before = across.rowsBetween(Window.unboundedPreceding, -1)
        whole = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        carry = [F.sum("_rows").over(before).alias("_carry_number")]
        carry += [F.sum(f"_total_{c}").over(before).alias(f"_carry_{c}") for c in sum_before]
        if following:
            carry.append(F.lead("_first").over(across).alias("_carry_next"))
        carried = (
            per_chunk.select(CHUNK, *keys, F.count(F.lit(1)).over(whole).alias("_chunks"), *carry)
            .filter(F.col("_chunks") > 1)
            .drop("_chunks")
        )
        # Written, so that its plan is not part of every use below.
        out = out.join(F.broadcast(written(carried, "carried")), [CHUNK, *keys], "left")

    def carried_on(value: Column, carry: str) -> Column:
        return value + F.coalesce(carry, F.lit(0)) if chunks > 1 else value

    columns = [F.col(c) for c in df.columns]
    if number:
        columns.append(carried_on(F.col("_number").cast("long"), "_carry_number").alias(number))
    for c in sum_before:
        columns.append(carried_on(F.col(f"_sum_{c}"), f"_carry_{c}").alias(c))
    for c in following:
        own = F.col(f"_next_{c}").getField("v")
        columns.append((F.when(F.col(f"_next_{c}").isNotNull(), own).otherwise(F.col("_carry_next").getField(c)) if chunks > 1 else own).alias(c))
    return out.select(*columns)
