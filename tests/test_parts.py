import hashlib
import random

from catalog.changes import digests
from codelineage.operators import joins, render


def test_texts_from_sorted_streams(spark):
    """Each side of a part in order, NULL pieces left out, parts without a piece NULL; long pieces and many parts."""
    random.seed(3)
    rows = [(f"k{k}", k % 3, side, i, None if (i + k) % 7 == 0 else "é" * random.choice([0, 1, 40, 30_000]) + str(i))
            for k in range(30) for side in (0, 1) for i in range(0 if (k, side) == (5, 1) else 12)]
    pieces = spark.createDataFrame(random.sample(rows, len(rows)), "k string, part_no int, side int, at int, piece string")
    got = {r.k: r for r in render.put_together(pieces, ["k", "part_no"], ["at"], ["a", "b"]).collect()}
    for k in range(30):
        whole = ["\n".join(r[4] for r in rows if r[0] == f"k{k}" and r[2] == side and r[4] is not None) for side in (0, 1)]
        assert (got[f"k{k}"].a, got[f"k{k}"].b) == (whole[0], None if k == 5 else whole[1])
    assert len(got) == 30


def test_many_cuts_give_the_parts_that_few_give(spark, monkeypatch):
    rows = [(f"k{k}", i // 2, f"{i}" * (i % 5)) for k in range(3) for i in range(60)]
    pieces = spark.createDataFrame(rows, "k string, at int, piece string").filter("at % 2 = 0 OR piece <> ''")
    at_once = sorted((r.k, r.part_no, r.parts, r.byte_start, len(r.text)) for r in render.text_parts(pieces, ["k"], ["at"], 10).collect())
    for module in (joins, render):
        monkeypatch.setattr(module, "BROADCAST_BYTES", 0)
    assert sorted((r.k, r.part_no, r.parts, r.byte_start, len(r.text)) for r in render.text_parts(pieces, ["k"], ["at"], 10).collect()) == at_once


def test_no_row_is_joined_with_all_cuts(spark):
    pieces = spark.createDataFrame([("k", i, "x" * (i % 7)) for i in range(900)], "k string, at int, piece string")
    placed = render.slotted(render.sized(pieces, ["k"], ["at"]), ["k"], ["at"], 10)
    index = render.part_index(placed, ["k"], ["at"])
    cuts = sorted(r.first["at"] for r in index.collect())
    found = render.with_part(pieces, placed, index, ["k"], ["at"], ("parts",))
    assert {(r.at, r.part_no, r.parts) for r in found.collect()} == {(i, sum(c <= i for c in cuts) - 1, len(cuts)) for i in range(900)}
    # Once for the group and once for the cut within it.
    assert len(cuts) > 100 and found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 2


def test_digest_of_parts(spark):
    rows = [(f"k{k}", i, f"text é {i} " * (i + k), "" if k else "x") for k in range(4) for i in range(25)]
    records = spark.createDataFrame(random.sample(rows, len(rows)), "k string, part_no int, a string, b string")
    md5 = lambda k, c: hashlib.md5("".join(r[c] for r in rows if r[0] == k).encode()).hexdigest()
    assert sorted(tuple(r) for r in digests(records, ["k"], ["a", "b"]).collect()) == [(f"k{k}", md5(f"k{k}", 2), md5(f"k{k}", 3)) for k in range(4)]


def test_hot_wide_rows_are_copied_and_others_are_not(spark):
    uses = spark.range(1000).selectExpr("id", "if(id % 2 = 0, 'hot', concat('n', id)) AS name")
    wide = uses.select("name").distinct().selectExpr("name", "concat('text of ', name) AS piece")
    got = joins.wide_lookup(uses, wide, "name", uses["id"].cast("string")).collect()
    assert len(got) == 1000 and all(r.piece == f"text of {r.name}" for r in got)
