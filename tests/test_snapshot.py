import pytest
from pyspark.sql import functions as F

from codelineage.functions import patterns
from codelineage.operators import render, snapshot
from codelineage.settings import Settings
from helpers import by, files

LIMIT = Settings(max_file_size=20000)
TREE = {
    "img/logo.PNG": b"x" * 45231, "a.mp3": b"1", "b.mkv": b"1", "c.docx": b"1", "d.tar.gz": b"1", "e.safetensors": b"1" * 1234567,
    "f.bin": b"1", "g.woff2": b"1", "h.whl": b"1", "i.parquet": b"1",
    "nul.txt": b"ab\x00cd", "bad.txt": b"ab\xffcd", "late_bad.txt": b"a" * 9000 + b"\xff", "cut.txt": b"a" * 8191 + "é".encode() + b"tail",
    "whole.txt": b"a" * 8190 + "é".encode(), "limit.txt": b"a" * 20000, "over.txt": b"a" * 20001, "empty.py": b"",
    "pkg/__init__.py": b"x = 1\n", "crlf.TXT": b"a\r\nb\rc\n", "Makefile": b"all:\n", "x.R": b"1\n", "noext.": b"1",
}


def classified(spark):
    return by(snapshot.classified(files(spark, [("o/r", "v1", p, c) for p, c in TREE.items()]), LIMIT), "path")


def test_stubs_and_texts(spark):
    got = classified(spark)
    stubs = {
        "img/logo.PNG": "[BINARY IMAGE: 45,231 bytes]", "a.mp3": "[BINARY AUDIO: 1 bytes]", "b.mkv": "[BINARY VIDEO: 1 bytes]",
        "c.docx": "[BINARY DOCUMENT: 1 bytes]", "d.tar.gz": "[BINARY ARCHIVE: 1 bytes]", "e.safetensors": "[BINARY MODEL/DATA: 1,234,567 bytes]",
        "f.bin": "[BINARY COMPILED: 1 bytes]", "g.woff2": "[BINARY FONT: 1 bytes]", "h.whl": "[BINARY PACKAGE: 1 bytes]",
        "i.parquet": "[BINARY FILE: 1 bytes]", "nul.txt": "[BINARY FILE: 5 bytes]", "bad.txt": "[BINARY FILE: 5 bytes]",
        "cut.txt": "[BINARY FILE: 8,197 bytes]", "over.txt": "[FILE TOO LARGE: 20,001 bytes - content omitted]",
    }
    assert {p for p, r in got.items() if r.is_binary_stub} == set(stubs)
    for path, stub in stubs.items():
        assert (got[path].content, got[path].size) == (stub, len(stub)), path
    assert got["late_bad.txt"].content == "a" * 9000 + "�" and got["late_bad.txt"].size == 9001
    assert (got["crlf.TXT"].content, got["crlf.TXT"].size, got["crlf.TXT"].language) == ("a\nb\nc\n", 7, "text")
    assert got["whole.txt"].size == 8192 and got["limit.txt"].size == 20000
    assert (got["empty.py"].content, got["empty.py"].language) == ("", "python")
    assert [got[p].language for p in ("Makefile", "x.R", "noext.", "pkg/__init__.py")] == ["unknown", "r", "unknown", "python"]


def test_binary_extensions_can_be_replaced(spark):
    rows = files(spark, [("o/r", "v1", "a.png", "text"), ("o/r", "v1", "b.dat", "text")])
    got = by(snapshot.classified(rows, binary_extensions=[".dat"]), "path")
    assert got["a.png"].content == "text" and got["b.dat"].content == "[BINARY FILE: 4 bytes]"


def test_budget_keeps_files_while_the_total_before_is_below(spark, monkeypatch):
    rows = files(spark, [("o/r", "v1", p, "x" * n) for p, n in (("a", 4), ("b", 6), ("c", 1), ("d", 1))] + [("o/s", "v1", "a", "x" * 10)])
    for limit, kept in ((10, "ab"), (11, "abc"), (9, "ab"), (4, "a"), (100, "abcd")):
        got = snapshot.snapshot_files(rows, Settings(max_codebase_size=limit)).filter("repo = 'o/r'")
        assert "".join(sorted(r.path for r in got.collect())) == kept, limit


def test_patterns(spark):
    paths = ["a.py", "src/a.py", "src/b.md", ".git/x.py", "src/.hidden", "tests/x/y.py", "weird[1].txt", "src/tests/a"]
    rows = spark.createDataFrame([(p,) for p in paths], "path string")

    def kept(rule):
        return [r.path for r in rows.filter(rule).collect()]

    p = F.col("path")
    assert kept(patterns.in_snapshot(p, ["tests/*"])) == ["tests/x/y.py"]
    assert kept(patterns.in_snapshot(p, ["?.py", "[b-c].md"])) == ["a.py", "src/a.py", "src/b.md", "tests/x/y.py"]
    assert kept(patterns.in_snapshot(p, ["weird[[]1].txt"])) == ["weird[1].txt"]
    assert kept(patterns.in_snapshot(p, [])) == [] and len(kept(patterns.in_diff(p, []))) == len(paths)
    assert kept(patterns.in_snapshot(p, ["*.py"], ["a.py"])) == ["src/a.py", "tests/x/y.py"]
    assert kept(patterns.in_diff(p, ["*.py"], ["a.py"])) == [".git/x.py", "tests/x/y.py"]


def test_patterns_per_repository(spark):
    config = spark.createDataFrame(
        [("r1", ["*"], []), ("r2", ["*.py", "docs/*"], ["*_test.py"])], "repo string, file_patterns array<string>, exclude_patterns array<string>")
    rules = patterns.with_pattern_regexes(config)
    rows = spark.createDataFrame([("a_test.py",), ("x/a.py",), ("docs/b.md",), ("c.md",), (".d/e.py",)], "path string")
    joined = rows.join(rules)
    got = joined.filter(patterns.in_snapshot_by(F.col("path"), F.col("include_regex"), F.col("exclude_regex"))).select("repo", "path").collect()
    assert sorted(map(tuple, got)) == [
        ("r1", "a_test.py"), ("r1", "c.md"), ("r1", "docs/b.md"), ("r1", "x/a.py"), ("r2", "docs/b.md"), ("r2", "x/a.py")]


def test_text_of_a_snapshot(spark):
    rows = snapshot.classified(files(spark, [("o/r", "v1", "b.md", "two\n"), ("o/r", "v1", "a.py", "one")]))
    bar = "=" * 80
    want = "\n".join([
        "# Repository: o/r", "# Version: v1", "# Total Files: 2", "# Total Size: 7 bytes", "",
        bar, "FILE: a.py", bar, "one", "", bar, "FILE: b.md", bar, "two\n", ""])
    assert render.snapshot_texts(rows).first().text == want


def test_file_tree(spark):
    rows = files(spark, [("o/r", "v1", p, "") for p in ("b.py", "a/z.py", "a/b/c.py", "a/b-d.py", "z/y")])
    want = "\n".join([
        "# File Tree for o/r@v1", "", "├── a", "│   ├── b", "│   │   └── c.py", "│   ├── b-d.py", "│   └── z.py",
        "├── b.py", "└── z", "    └── y"])
    assert render.file_trees(rows).first().tree == want


@pytest.mark.parametrize("part_bytes,separator", [(64, ""), (64, "\n"), (1, "||"), (1 << 28, "\n")])
def test_parts_make_up_the_text(spark, part_bytes, separator):
    pieces = spark.range(200).select(
        (F.col("id") % 2).alias("key"), F.col("id").alias("place"), F.concat(F.lit("é"), F.repeat(F.lit("x"), (F.col("id") % 9).cast("int"))).alias("piece"))
    pieces = pieces.unionByName(spark.createDataFrame([(7, 0, "")], pieces.schema))
    parts = render.text_parts(pieces, ["key"], ["place"], part_bytes, separator).orderBy("key", "part_no").collect()
    for key in (0, 1, 7):
        want = separator.join("é" + "x" * (i % 9) for i in range(key, 200, 2)) if key < 7 else ""
        mine = [r for r in parts if r.key == key]
        assert "".join(r.text for r in mine) == want and [r.part_no for r in mine] == list(range(len(mine)))
        for r in mine:
            assert want[r.char_start:].startswith(r.text) and want.encode()[r.byte_start:].startswith(r.text.encode()) and r.parts == len(mine)
        assert max(len(r.text.encode()) for r in mine) < part_bytes + 11 + len(separator)
        assert len(mine) == (1 if key == 7 or part_bytes > 1000 else 100 if part_bytes == 1 else len(mine)) and (part_bytes > 1000 or key == 7 or len(mine) > 5)


def test_texts_come_in_as_many_parts_as_they_need(spark):
    rows = snapshot.classified(files(spark, [("o/r", "v1", f"f{i}", "x" * 50) for i in range(20)] + [("o/s", "v1", "f", "y")]))
    for header in (True, False):
        cut = render.snapshot_texts(rows, header, max_bytes=1000).orderBy("repo", "part_no").collect()
        whole = by(render.snapshot_texts(rows, header), "repo")
        for repo in ("o/r", "o/s"):
            mine = [r for r in cut if r.repo == repo]
            assert "".join(r.text for r in mine) == whole[repo].text and {r.num_files for r in mine} == {whole[repo].num_files}
            assert len(mine) == mine[0].parts and (len(mine) > 3) == (repo == "o/r")
    tree = render.file_trees(rows, 40).orderBy("repo", "part_no").collect()
    assert "".join(r.tree for r in tree if r.repo == "o/r") == by(render.file_trees(rows), "repo")["o/r"].tree and len(tree) > 4
