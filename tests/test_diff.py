import difflib
import random
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from catalog import changes  # noqa: F401  registers the queries
from catalog.fixtures import Inputs
from catalog.registry import QUERIES
from codelineage.functions.text import lines_with_ends
from codelineage.operators import diff, joins, ordered, render
from codelineage.operators.releases import release_pairs
from codelineage.settings import Settings
from codelineage.storage import fresh_path
from helpers import by, files, releases


def run(spark, old, new, settings=Settings(), **options):
    rows = [("o/r", "v1", p, c) for p, c in old.items()] + [("o/r", "v2", p, c) for p, c in new.items()]
    pairs = release_pairs(releases(spark, [("o/r", "v1", "2024-01-01", 1), ("o/r", "v2", "2024-01-02", 2)]))
    return diff.file_diffs(pairs, files(spark, rows), settings, **options)


def expected(path, old, new):
    lines = list(difflib.unified_diff(
        old.splitlines(keepends=True), new.splitlines(keepends=True), fromfile=f"a/{path}", tofile=f"b/{path}", n=3))
    adds = sum(x.startswith("+") and not x.startswith("+++") for x in lines)
    dels = sum(x.startswith("-") and not x.startswith("---") for x in lines)
    return "".join(lines), adds, dels


CASES = {
    "added.py": (None, "a\nb\n"), "added_one.py": (None, "a"), "deleted.py": ("x\ny\nz", None), "added_empty.py": (None, ""),
    "modified.py": ("a\nb\nc\n", "a\nB\nc\n"), "no_newline.py": ("a", "b"), "emptied.py": ("a\n", ""), "filled.py": ("", "a\n--b\n++c\n"),
    "marks.sql": ("-- one\nkeep\n", "keep\n++ two\n"), "added_marks.sql": (None, "++a\n+b\n++"), "deleted_marks.sql": ("--a\n-b\n--\n", None),
    "separators.txt": ("a\x0cb c\r\nd\re", "a\x0cB c\r\nd\rf"), "added_separators.txt": (None, "a\x0cb c\r\nd\re\r\n\x85g"),
    "crlf_end.txt": (None, "a\r\n"), "cr_end.txt": ("a\rb\r", None),
}


def test_every_kind_of_change(spark):
    old = {p: o for p, (o, _) in CASES.items() if o is not None}
    new = {p: n for p, (_, n) in CASES.items() if n is not None}
    got = by(run(spark, old, new), "file_path")
    assert set(got) == set(CASES)
    for path, (o, n) in CASES.items():
        row = got[path]
        assert (row.diff_content, row.additions, row.deletions) == expected(path, o or "", n or ""), path
        assert row.change_type == ("added" if o is None else "deleted" if n is None else "modified")


def test_random_edits_match_and_counts_add_up(spark):
    rng, old, new = random.Random(5), {}, {}
    for i in range(40):
        lines = [rng.choice(["x", "y", "--z", "++w", "é"]) + str(rng.randrange(6)) for _ in range(rng.randrange(1, 300))]
        edited = [x for x in lines if rng.random() > 0.1]
        edited.insert(rng.randrange(len(edited) + 1), f"new{i}")
        old[f"f{i}"], new[f"f{i}"] = "\n".join(lines) + "\n", "\n".join(edited) + "\n"
    got = by(run(spark, old, new), "file_path")
    strict = by(run(spark, old, new, strict_counts=True), "file_path")
    for p in old:
        assert (got[p].diff_content, got[p].additions, got[p].deletions) == expected(p, old[p], new[p])
        assert strict[p].additions - strict[p].deletions == new[p].count("\n") - old[p].count("\n")


def test_renames(spark):
    old = {"a/x.py": "same\n", "b/y.py": "other\n", "one.txt": "twin\n", "keep.md": "k"}
    new = {"z/x.py": "same\n", "c/q.py": "other\n", "t1.txt": "twin\n", "t2.txt": "twin\n", "keep.md": "k"}
    got = {p: (r.change_type, r.old_path, r.additions, r.deletions) for p, r in by(run(spark, old, new), "file_path").items()}
    assert got == {
        "z/x.py": ("renamed", "a/x.py", 0, 0), "c/q.py": ("renamed", "b/y.py", 0, 0),
        "t1.txt": ("renamed", "one.txt", 0, 0), "t2.txt": ("added", None, 1, 0)}


def test_same_name_comes_first_in_renames(spark):
    old, new = {"a/m.py": "e", "b/n.py": "e"}, {"c/n.py": "e", "d/o.py": "e"}
    got = by(run(spark, old, new), "file_path")
    assert {p: r.old_path for p, r in got.items()} == {"c/n.py": "b/n.py", "d/o.py": "a/m.py"}


def test_truncation_leaves_counts(spark):
    row = run(spark, {}, {"a": "x\n" * 100}, Settings(max_diff_size=60)).first()
    full = expected("a", "", "x\n" * 100)[0]
    assert row.diff_content == full[:60] + "\n... [truncated, diff too large] ..." and row.additions == 100


def test_undecodable_contents_are_replaced(spark):
    row = run(spark, {"a": b"\xffa\n"}, {"a": b"\xffb\n"}).first()
    assert row.diff_content.endswith("-�a\n+�b\n")


def test_text_of_a_version_diff(spark):
    diffs = run(spark, {"a/x.py": "same\n", "m": "1\n"}, {"b/x.py": "same\n", "m": "2\n", "n": "3"})
    bar = "=" * 80
    want = "\n".join([
        "# Repository: o_r", "# From Version: v1", "# To Version: v2", "# Files Changed: 3", "# Additions: +2", "# Deletions: -1", "",
        "# Summary:", "#   Added: 1", "#   Modified: 2", "#   Deleted: 0", "",
        bar, "RENAMED: a/x.py -> b/x.py", "(+0, -0)", bar, "", "",
        bar, "MODIFIED: m", "(+1, -1)", bar, "--- a/m\n+++ b/m\n@@ -1 +1 @@\n-1\n+2\n", "",
        bar, "ADDED: n", "(+1, -0)", bar, "--- a/n\n+++ b/n\n@@ -0,0 +1 @@\n+3", ""])
    assert render.diff_texts(diffs).first().text == want
    assert not render.diff_texts(diffs, include_header=False).first().text.startswith("#")


@pytest.mark.parametrize("include,exclude,kept", [
    (["*.py"], None, {"a.py", "d/b.py"}), (None, ["b.py"], {"a.py", "c.md"}), (["d/*"], None, {"d/b.py"})])
def test_patterns_apply_to_changes(spark, include, exclude, kept):
    got = run(spark, {}, {"a.py": "1", "d/b.py": "2", "c.md": "3"}, include=include, exclude=exclude)
    assert {r.file_path for r in got.collect()} == kept


def test_near_renames(spark):
    body = "".join(f"line {i}\n" for i in range(20))
    old = {"a/x.py": body, "a/y.py": body, "a/z.py": "1\n", "p/w.py": "w\n", "q/w.py": "v\n"}
    new = {"b/x.py": body + "more\n", "b/y.py": "else\n" * 9, "b/z.py": "1\n2\n", "r/w.py": "w\nw2\n"}
    got = {p: (r.change_type, r.old_path) for p, r in by(run(spark, old, new, near_threshold=0.5), "file_path").items()}
    assert got == {
        "b/x.py": ("renamed", "a/x.py"), "a/y.py": ("deleted", None), "b/y.py": ("added", None), "b/z.py": ("renamed", "a/z.py"),
        "p/w.py": ("deleted", None), "q/w.py": ("deleted", None), "r/w.py": ("added", None)}
    row = by(run(spark, old, new, near_threshold=0.5), "file_path")["b/x.py"]
    assert row.diff_content.startswith("--- a/a/x.py\n+++ b/b/x.py\n@@ -18,3 +18,4 @@\n") and (row.additions, row.deletions) == (1, 0)
    assert {r.change_type for r in run(spark, old, new).collect()} == {"added", "deleted"}


def brute_near_renames(old, new, threshold):
    """{new path: old path}: contents of two sides compared by all their lines, the best couple first, over all couples."""
    same = set(old.items()) & set(new.items())
    gone = {p: c for p, c in old.items() if p not in new}
    came = {p: c for p, c in new.items() if p not in old}
    assert not same & set(gone.items())
    classes = lambda side: {c: sorted(p for p in side if side[p] == c) for c in set(side.values())}
    a, b = classes(gone), classes(came)
    first_a, first_b, scored = {c: p[0] for c, p in a.items()}, {c: p[0] for c, p in b.items()}, []
    for x in a:
        for y in b:
            lx, ly = Counter(x.splitlines(keepends=True)), Counter(y.splitlines(keepends=True))
            size = lambda lines: sum(len(k.encode()) * n for k, n in lines.items())
            larger = max(size(lx), size(ly))
            if larger and size(lx & ly) >= larger * threshold:
                scored.append((-size(lx & ly) / larger, first_a[x], first_b[y], x, y))
    matched = {}
    for *_, x, y in sorted(scored):
        for _ in range(min(len(a[x]), len(b[y]))):
            matched[b[y].pop(0)] = a[x].pop(0)
    return matched


@pytest.mark.parametrize("seed,threshold", [(1, 0.5), (2, 0.8), (3, 0.2)])
def test_near_renames_equal_all_couples(spark, seed, threshold, monkeypatch):
    rng = random.Random(seed)
    lines = [f"line {i} {'x' * rng.randint(0, 9)}\n" for i in range(40)] + ["\n", "import os\n", "# licence\n"]
    old, new = {}, {}
    for i in range(60):
        body = ["# licence\n", "import os\n"] + [rng.choice(lines) for _ in range(rng.randint(0, 12))]
        name = rng.choice(["__init__.py", "index.md", f"f{i}.py"])
        old[f"a{i}/{name}"] = "".join(body)
        for k in range(rng.randint(0, 2)):
            edited = [x for x in body if rng.random() > 0.2] + [rng.choice(lines) for _ in range(rng.randint(0, 4))]
            new[f"b{i}{k}/{rng.choice([name, f'g{i}.py'])}"] = "".join(edited) + "end"
    old |= {f"same{i}/x": "twin\n" * 9 for i in range(5)}
    new |= {f"other{i}/y": "twin\n" * 9 + "more" for i in range(3)} | {"empty": ""}
    new = {p: c for p, c in new.items() if c not in set(old.values())}
    monkeypatch.setattr(ordered, "CHUNK_ROWS", 100)
    got = by(run(spark, old, new, near_threshold=threshold), "file_path")
    want = brute_near_renames(old, new, threshold)
    assert {p: r.old_path for p, r in got.items() if r.change_type == "renamed"} == want and len(want) > 10
    assert {p for p, r in got.items() if r.change_type == "deleted"} == set(old) - set(want.values())
    assert {p for p, r in got.items() if r.change_type == "added"} == set(new) - set(want)


def test_lines_of_several_contents_are_indexed(spark, monkeypatch):
    """Only lines of several contents are kept, the bytes of all others stand before them; the ways of hot and of many lines agree."""
    old = {f"a{i}": f"own {i}\n" * 2 + "all\n" + ("few\n" if i < 3 else "") for i in range(8)} | {"none": ""}
    loose = spark.createDataFrame([("o/r", "v1", "v2", p, p, True) for p in old], "repo string, from_version string, to_version string, path string, sha string, is_old boolean")
    raw = files(spark, [("o/r", "v1", p, c) for p, c in old.items()])
    found = []
    for hot, limit in ((1 << 12, 32 << 20), (3, 32 << 20), (3, 0)):
        monkeypatch.setattr(diff, "HOT_CONTENTS", hot)
        monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
        totals, lines = diff.content_lines(loose, raw)
        assert {r.sha: r.total for r in totals.collect()} == {p: len(c) for p, c in old.items() if c}
        found.append(sorted((r.sha, r.n, r.bytes, r.total, r.before) for r in lines.collect()))
    want = [(f"a{i}", 1, 4, len(old[f"a{i}"]), 12 + (4 if i < 3 else 0)) for i in range(8)] + [(f"a{i}", 1, 4, len(old[f"a{i}"]), 12) for i in range(3)]
    assert found == [sorted(want)] * 3


def test_long_texts_are_split_in_linear_time(spark):
    text = "word " * 8 + "\r\n"
    n = 30_000
    rows = spark.range(8, numPartitions=4).select(lines_with_ends(F.repeat(F.concat(F.lit(text), F.col("id").cast("string")), F.lit(n))).alias("lines"))
    started = time.monotonic()
    assert rows.agg(F.sum(F.size("lines")).alias("n")).first().n == 8 * (n + 1)
    assert time.monotonic() - started < 60


def test_line_counts_write_no_diff_texts(spark, tmp_path):
    """The tables kept for line counts hold no contents and no diffs, however large these are."""
    rng = random.Random(1)
    rows = [(i, f"{rng.getrandbits(160_000):x}", "en", f"src{i % 2}", 40_000) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    kept = Path(fresh_path(spark, "x").removeprefix("file:")).parent
    size = lambda: sum(p.stat().st_size for p in kept.rglob("*.parquet"))
    for name in ("h5_line_counts", "i19_diff_stats"):
        before = size()
        assert QUERIES[name](Inputs(spark, str(tmp_path))).count() > 20
        assert size() - before < 400_000


def test_contents_that_no_change_needs_do_not_move(spark):
    """Beyond the broadcast limit, rows without a key are dropped in place; none that has one is."""
    big = spark.range(40_000).select(F.col("id").cast("string").alias("a"), (F.col("id") % 7).cast("string").alias("b"), "id")
    keys = big.filter("id % 100 = 3").select("a", "b").unionByName(spark.createDataFrame([(None, "x"), ("none", None)], "a string, b string"))
    kept = {r.id for r in joins.possible(big, keys, ["a", "b"], keys.count()).collect()}
    assert kept >= set(range(3, 40_000, 100))
    assert len(kept) < 8_000


def test_changes_beyond_the_broadcast_limit(spark, monkeypatch):
    rows = [("r", v, f"p{i}", f"{i}\n" * 3 + (f"{v}\n" if i % 3 == 0 else "")) for v in ("v1", "v2") for i in range(30) if (v, i) != ("v2", 4)]
    pairs = spark.createDataFrame([("r", "v1", "v2")], diff.PAIR)
    at_once = sorted(diff.file_diffs(pairs, files(spark, rows)).collect())
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    assert sorted(diff.file_diffs(pairs, files(spark, rows)).collect()) == at_once and len(at_once) == 11


def test_contents_are_compared_under_short_names(spark, monkeypatch):
    """Near renames carry 16 bytes a content through their shuffles and give the hashes they were given, whatever these look like."""
    held = []
    plain = diff.content_lines
    monkeypatch.setattr(diff, "content_lines", lambda loose, files_: held.append(plain(loose, files_)) or held[-1])
    text = "".join(f"line {i}\n" for i in range(40))
    rows = [("o/r", "v1", "a.py", text), ("o/r", "v1", "b.py", "other\n" * 9), ("o/r", "v2", "z.py", text + "tail\n"), ("o/r", "v2", "y.py", "none of it\n")]
    pairs = release_pairs(releases(spark, [("o/r", "v1", "2024-01-01", 1), ("o/r", "v2", "2024-01-02", 2)]))
    raw = files(spark, rows).withColumn("content_sha", F.concat(F.lit("any name: "), "content_sha"))
    changes = diff.path_changes(pairs, raw).withColumn("old_path", F.lit(None).cast("string"))
    got = {r.path: r for r in diff.near_renames(changes, raw, 0.7).collect()}
    sha = {r.path: r.content_sha for r in raw.collect()}
    assert set(got) == {"z.py", "y.py", "b.py"} and got["z.py"].old_path == "a.py" and got["z.py"].change_type == "renamed"
    assert (got["z.py"].old_sha, got["z.py"].new_sha) == (sha["a.py"], sha["z.py"]) and got["b.py"].old_sha == sha["b.py"]
    for table in held[0]:
        assert {len(r.sha) for r in table.collect()} == {16}
