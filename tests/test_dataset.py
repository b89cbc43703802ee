import datetime
import gzip
import hashlib
import io
import json
import random
import re
import tarfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from codelineage import schemas
from codelineage.operators import diff
from codelineage.operators import examples as ex
from codelineage.operators import joins
from codelineage.operators import ordered
from codelineage.plans.dataset import build_dataset, build_single
from codelineage.settings import Settings
from codelineage.sources import archives, sinks
from codelineage.sources.archives import read_release_archives
from codelineage.sources.tables import read_config, read_examples, read_records
from codelineage.streaming.incremental import catch_up, current, current_pairs, running_stats, start_examples, start_pairing
from helpers import files, releases

NOW = "2024-01-01T00:00:00"
FILES = [
    ("a/b", "v1", "x.py", "a\nb\nc\n"), ("a/b", "v1", "requirements.txt", "torch>=1\nnumpy\n"), ("a/b", "v1", "d/old.md", "same\n"),
    ("a/b", "v1", ".ci/run", "hidden\n"), ("a/b", "v2", "x.py", "a\nB\nc\nd"), ("a/b", "v2", "requirements.txt", "torch>=1\n"),
    ("a/b", "v2", "e/old.md", "same\n"), ("a/b", "v2", "new.txt", "l1\nl2"), ("a/b", "v3", "x.py", "a\n"), ("a/b", "v3", "logo.png", b"\x89"),
    ("pytorch/pytorch", "t1", "torch/__init__.py", "pass\n"), ("pytorch/pytorch", "t2rc", "torch/__init__.py", "pass2\n"),
    ("pytorch/pytorch", "t2rc", "README.md", "é\n"),
]
RELEASES = [
    ("a/b", "v1", "2024-01-01", 1), ("a/b", "v2", "2024-02-01", 2), ("a/b", "v3", "2024-03-01", 3), ("a/b", "v4", "2024-04-01", 4),
    ("pytorch/pytorch", "t1", "2024-01-01", 5), ("pytorch/pytorch", "t2rc", "2024-02-01", 6, True),
]


@pytest.fixture(scope="module")
def tables(spark):
    return releases(spark, RELEASES).cache(), files(spark, FILES).cache()


@pytest.fixture(scope="module")
def built(tables):
    return build_dataset(*tables, NOW)


@pytest.fixture(scope="module")
def rows(built):
    return {(r.repo_name, r.from_version): r for r in built.examples.collect()}


def section(path, content):
    bar = "=" * 80
    return [bar, f"FILE: {path}", bar, content, ""]


def test_example(built, rows):
    assert built.examples.columns == schemas.RECORD_COLUMNS and set(rows) == {("a/b", "v1"), ("a/b", "v2")}
    row = rows["a/b", "v1"]
    codebase = "\n".join([
        "# Repository: a/b", "# Version: v1", "# Total Files: 5", "# Total Size: 35 bytes", "",
        *section("d/old.md", "same\n"), *section("requirements.txt", "torch>=1\nnumpy\n"), *section("x.py", "a\nb\nc\n"),
        *section("__deps__/pytorch/pytorch/README.md", "é\n"), *section("__deps__/pytorch/pytorch/torch/__init__.py", "pass2\n")])
    want = ("<repository>\n<name>a/b</name>\n<version>v1</version>\n<codebase>\n" + codebase + "\n</codebase>\n</repository>\n\n"
            "Based on the codebase above, predict the changes that will be made in the next version release. "
            "Output the changes as a unified diff.")
    assert row.input_text == want
    assert row.input_tokens_approx == len(want) // 4 and row.output_tokens_approx == len(row.output_text) // 4
    assert (row.num_files_in_codebase, row.num_files_changed, row.num_dependencies, row.created_at) == (5, 5, 1, NOW)
    assert row.output_text.startswith("# Changes from v1 to v2\n\n# Repository: a_b\n# From Version: v1\n")
    assert "RENAMED: d/old.md -> e/old.md" in row.output_text and "DELETED: .ci/run" in row.output_text


def test_pairs_without_files_are_rejected_not_fatal(built):
    assert sorted((r.repo, r.from_version, r.to_version, r.error) for r in built.rejects.collect()) == [
        ("a/b", "v1", "v2", "no files for dependency numpy/numpy main"), ("a/b", "v3", "v4", "no files for v4")]


def joined(records):
    """{(repo, from_version): (input, output)} from the parts."""
    texts = {}
    for r in sorted(records, key=lambda r: r.part_no):
        a, b = texts.get((r.repo_name, r.from_version), ("", ""))
        assert r.input_text is not None and r.output_text is not None
        texts[r.repo_name, r.from_version] = (a + r.input_text, b + r.output_text)
    return texts


@pytest.mark.parametrize("large", [False, True])
def test_parts_equal_the_whole_texts(tables, rows, large, monkeypatch):
    if large:  # the ways taken beyond the counted bounds
        monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
        monkeypatch.setattr(ordered, "CHUNK_ROWS", 3)
    records = build_dataset(*tables, NOW, Settings(max_cell_bytes=700)).examples.collect()
    assert joined(records) == {k: (r.input_text, r.output_text) for k, r in rows.items()}
    for r in records:
        whole = rows[r.repo_name, r.from_version]
        assert (r.input_tokens_approx, r.output_tokens_approx, r.num_dependencies) == (whole.input_tokens_approx, whole.output_tokens_approx, whole.num_dependencies)
        assert r.parts == sum(x.repo_name == r.repo_name and x.from_version == r.from_version for x in records)
    assert len(records) > len(rows)


def test_records_are_bounded_by_default(spark):
    """Texts of 40 MB stand in several records, none of which holds more than 16 MB and a block's part and file; nothing is lost."""
    rows = [("r", v, f"f{i:02}.txt", f"{i} {v[-1]}\n" * 250_000) for v in ("v1", "v2") for i in range(28)]
    pairs = releases(spark, [("r", "v1", "2024-01-01", 1), ("r", "v2", "2024-01-02", 2)])
    records = build_dataset(pairs, files(spark, rows), NOW, Settings(include_dependencies=False)).examples.collect()
    assert len(records) > 1 and max(len(x) for r in records for x in (r.input_text, r.output_text)) < 27 << 20
    whole, changes = joined(records)["r", "v1"]
    assert (records[0].input_tokens_approx, records[0].output_tokens_approx) == (len(whole) // 4, len(changes) // 4)
    assert all("".join([f"FILE: {p}\n", "=" * 80, "\n", c]) in whole for _, v, p, c in rows if v == "v1") and changes.count("\n+27 2") == 250_000


def test_large_ways_give_the_same_examples(tables, rows, monkeypatch):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(joins, "ROWS_PER_COPY", 1)
    again = build_dataset(*tables, NOW).examples.collect()
    assert {(r.repo_name, r.from_version): r for r in again} == rows


def test_patterns_and_budget(spark, tables):
    config = spark.createDataFrame([("a/b", None, None, 1, ["*.py", "*.md"], ["d/*"])], schemas.REPO_CONFIG)
    got = build_dataset(*tables, NOW, config=config).examples.collect()
    assert len(got) == 1
    paths = [x[6:] for x in got[0].input_text.splitlines() if x.startswith("FILE: ")]
    assert paths == ["x.py", "__deps__/pytorch/pytorch/README.md", "__deps__/pytorch/pytorch/torch/__init__.py"]
    assert "new.txt" not in got[0].output_text and got[0].num_files_changed == 2
    small = build_dataset(*tables, NOW, Settings(max_codebase_size=6, include_dependencies=False)).examples.filter("from_version = 'v1'").first()
    assert [x[6:] for x in small.input_text.splitlines() if x.startswith("FILE: ")] == ["d/old.md", "requirements.txt"]
    assert small.num_dependencies == 0


def test_single_repository(tables):
    got = build_single("a/b", *tables, NOW, max_versions=1).examples.collect()
    assert [(r.repo_name, r.from_version) for r in got] == [("a/b", "v1")]
    assert build_single("no/where", *tables, NOW).examples.count() == 0


def test_split_is_an_exact_partition(spark, monkeypatch):
    rows = spark.range(103).select(
        F.lit("r").alias("repo_name"), F.col("id").cast("string").alias("from_version"), F.lit("x").alias("to_version"), "id")
    for ratio, n in ((0.9, 92), (0.0, 0), (1.0, 103)):
        train, validation = ex.split_examples(rows, ratio)
        a, b = {r.id for r in train.collect()}, {r.id for r in validation.collect()}
        assert len(a) == n and not a & b and len(a | b) == 103
    monkeypatch.setattr(ex, "RADIX", 1)  # several passes
    again = {r.id for r in ex.split_examples(rows, 0.37)[0].collect()}
    order = sorted(range(103), key=lambda i: hashlib.md5(f"42|r|{i}|x".encode()).hexdigest())
    assert again == set(order[:38])
    records = rows.withColumn("part_no", F.explode(F.array(*[F.lit(i) for i in range(3)])))
    train, validation = ex.split_examples(records, 0.37)
    assert {r.id for r in train.collect()} == again and train.count() == 3 * 38 and validation.count() == 3 * 65
    assert {r.id for r in ex.split_examples(rows, seed=1)[0].collect()} != {r.id for r in ex.split_examples(rows, seed=2)[0].collect()}


def test_written_outputs(spark, built, rows, tmp_path):
    sinks.save_dataset(built.examples, str(tmp_path / "out"), "both")
    parts = list((tmp_path / "out/dataset.jsonl").glob("*.json.gz"))
    lines = [x for p in parts for x in gzip.open(p, "rt", encoding="ascii")]
    records = [json.loads(x) for x in lines]
    assert {(r["repo_name"], r["from_version"]): r["input_text"] for r in records} == {k: r.input_text for k, r in rows.items()}
    assert all(list(r) == schemas.RECORD_COLUMNS for r in records) and all("\\u00e9" in x.lower() for x in lines if '"v1"' in x)
    chat = [json.loads(x) for p in (tmp_path / "out/dataset_chat.jsonl").glob("*.json.gz") for x in gzip.open(p, "rt")]
    assert [m["role"] for m in chat[0]["messages"]] == ["system", "user", "assistant"] and len(chat[0]["metadata"]) == 5
    assert read_examples(spark, str(tmp_path / "out/dataset.parquet")).count() == len(rows)
    report = "".join(p.read_text() for p in sorted((tmp_path / "out/stats.md").glob("part-*")))
    assert report.startswith("# SFT Dataset Statistics\n\n## Overview\n") and report.endswith("## Repositories\n- **a/b**: 2 examples\n")
    with pytest.raises(ValueError):
        sinks.save_dataset(built.examples, str(tmp_path / "no"), "csv")


def test_chat_without_system_message(built):
    assert ex.chat_examples(built.examples, None).first().messages[0].role == "user"


def test_archives(spark, tmp_path):
    folder = tmp_path / "repo=o%2Fr" / "version=v1%2F0"
    folder.mkdir(parents=True)
    with tarfile.open(folder / "release.tar.gz", "w:gz") as tar:
        for name, data in (("top/pkg/__init__.py", b"x"), ("top/.hidden", b"h"), ("top/_under", b""), ("top/bin", b"\x00\xff")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    got = {(r.repo, r.version, r.path): bytes(r.content) for r in read_release_archives(spark, str(tmp_path)).collect()}
    assert got == {("o/r", "v1/0", p): c for p, c in (("pkg/__init__.py", b"x"), (".hidden", b"h"), ("_under", b""), ("bin", b"\x00\xff"))}
    assert {r.path for r in read_release_archives(spark, str(tmp_path), ["*.py"]).collect()} == {"pkg/__init__.py"}


def test_config_source(spark, tmp_path):
    Path(tmp_path / "c.json").write_text('{"name": "a/b"}\n{"name": "c/d", "max_versions": 2, "file_patterns": ["*.py"]}\n')
    got = {r.name: r for r in read_config(spark, str(tmp_path / "c.json")).collect()}
    assert got["a/b"].file_patterns is None and got["c/d"].max_versions == 2


def landing(spark, folder, rows):
    releases(spark, rows).coalesce(1).write.mode("append").parquet(folder)


def test_texts_in_parts_are_written_and_counted(spark, tables, rows, tmp_path):
    cut = build_dataset(*tables, NOW, Settings(max_cell_bytes=700))
    sinks.save_dataset(cut, str(tmp_path / "cut"), "both")
    want = {k: (r.input_text, r.output_text) for k, r in rows.items()}
    for kind in ("parquet", "jsonl"):
        assert joined(read_records(spark, str(tmp_path / f"cut/dataset.{kind}")).collect()) == want
    chat = [json.loads(x) for p in (tmp_path / "cut/dataset_chat.jsonl").glob("*.json.gz") for x in gzip.open(p, "rt")]
    said = {}
    for r in sorted(chat, key=lambda r: r["part_no"]):
        key = (r["metadata"]["repo_name"], r["metadata"]["from_version"])
        a, b = said.get(key, ("", ""))
        said[key] = (a + r["messages"][1]["content"], b + r["messages"][2]["content"])
    assert said == want
    meta = ex.example_meta(cut.examples)
    assert {(r.repo_name, r.from_version): (r.input_size, r.output_size) for r in meta.collect()} == {
        k: (len(r.input_text), len(r.output_text)) for k, r in rows.items()}


def test_dependencies_without_files_are_rejected(spark, tables):
    releases_, files_ = tables
    built = build_dataset(releases_, files_.filter("repo <> 'pytorch/pytorch'"), NOW)
    missing = "no files for dependency pytorch/pytorch t2rc"
    assert sorted((r.from_version, r.error) for r in built.rejects.collect() if "pytorch" in r.error) == [("v1", missing), ("v2", missing)]
    assert {r.num_dependencies for r in built.examples.collect()} == {0}


def stream(spark, folder):
    schema = releases(spark, RELEASES).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_incremental_run_equals_the_batch_run(spark, tables, rows, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in (RELEASES[:1], RELEASES[1:2] + RELEASES[4:], RELEASES[2:4]):
        landing(spark, source, part)
    start_examples(stream(spark, source), lambda: tables[0], lambda: tables[1], out, NOW).awaitTermination()
    got = {(r.repo_name, r.from_version): r for r in read_records(spark, out + "/dataset.jsonl").select(*schemas.RECORD_COLUMNS).collect()}
    assert got == rows
    stats = running_stats(spark, out).first()
    assert stats.num_examples == len(rows) and stats.input_size_max == max(len(r.input_text) for r in rows.values())
    start_examples(stream(spark, source), lambda: tables[0], lambda: tables[1], out, NOW).awaitTermination()
    assert read_examples(spark, out + "/dataset.jsonl").count() == len(rows)


def test_catching_up_equals_the_batch_run(spark, tables, rows, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    # v2 arrives after v3, and the files of v1 come only after the stream.
    for part in (RELEASES[:1] + RELEASES[2:3], RELEASES[4:], RELEASES[1:2], RELEASES[3:4]):
        landing(spark, source, part)
    late = tables[1].filter("NOT (repo = 'a/b' AND version = 'v1')")
    start_examples(stream(spark, source), lambda: tables[0], lambda: late, out, NOW).awaitTermination()
    assert {(r.from_version, r.to_version) for r in spark.read.parquet(out + "/stale").collect()} == {("v1", "v3")}
    for _ in range(2):
        catch_up(*tables, out, NOW)
        got = current(read_records(spark, out + "/dataset.jsonl").select(*schemas.RECORD_COLUMNS), out).collect()
        assert len(got) == len(rows) and {(r.repo_name, r.from_version): r for r in got} == rows


def test_releases_in_any_order_split_their_pairs(spark, tmp_path):
    source, out, rng = str(tmp_path / "in"), str(tmp_path / "out"), random.Random(3)
    given = [(f"o/r{i % 3}", f"v{i}", f"2024-01-{1 + i % 17:02d}", i, i % 10 == 0) for i in range(60)]
    rng.shuffle(given)
    for k in range(0, 60, 12):  # five batches, the stream started anew before the last two
        if k == 36:
            start_pairing(stream(spark, source), out).awaitTermination()
        landing(spark, source, given[k:k + 12] + given[:k:7])
    start_pairing(stream(spark, source), out).awaitTermination()
    got = [(r.repo, r.from_version, r.to_version) for r in current_pairs(spark, out).collect()]
    want = []
    for repo in ("o/r0", "o/r1", "o/r2"):
        tags = [t for _, _, t in sorted((r[2], r[3], r[1]) for r in given if r[0] == repo and not r[4])]
        want += [(repo, a, b) for a, b in zip(tags, tags[1:], strict=False)]
    assert sorted(got) == sorted(want)
    assert len([p for p in (tmp_path / "out/events").iterdir() if p.name.startswith("batch_id")]) == 5


def test_a_batch_touches_the_state_of_its_repositories_alone(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    landing(spark, source, [(f"o/r{i}", "v1", "2024-01-01", i) for i in range(200)])
    landing(spark, source, [("o/r7", "v2", "2024-01-02", 500)])
    query = start_pairing(stream(spark, source), out)
    query.awaitTermination()
    updated = [p.stateOperators[0].numRowsUpdated for p in query.recentProgress if p.numInputRows]
    assert updated == [200, 1]


def test_releases_beyond_what_is_kept_are_set_aside(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in ([("o/r", "v1", "2024-01-01", 1), ("o/r", "v3", "2024-03-01", 3)], [("o/r", "v2", "2024-02-01", 2), ("o/r", "v4", "2024-04-01", 4)]):
        landing(spark, source, part)
        start_pairing(stream(spark, source), out, keep=1).awaitTermination()
    assert sorted((r.from_version, r.to_version) for r in current_pairs(spark, out).collect()) == [("v1", "v3"), ("v3", "v4")]
    assert [r.tag_name for r in spark.read.parquet(out + "/late_releases").collect()] == ["v2"]


def test_any_number_of_releases_is_paired(spark, tmp_path):
    source, out, rng = str(tmp_path / "in"), str(tmp_path / "out"), random.Random(5)
    start = datetime.datetime(2022, 11, 5)
    given = [("o/r", f"v{i}", str(start + datetime.timedelta(hours=i // 2)), i) for i in range(10_300)]
    first, rest = given[40:10_200], given[:40] + given[10_200:]
    rng.shuffle(rest)
    # The first batch holds more than 10,000; what comes later is older, newer, or splits a pair across a quarter.
    split = [first.pop(i) for i in (7000, 5000, 5001, 4367, 4368, 0)]
    for part in (first, rest[:70] + split, rest[70:]):
        landing(spark, source, part)
    start_pairing(stream(spark, source), out).awaitTermination()
    got = sorted((r.repo, r.from_version, r.to_version) for r in current_pairs(spark, out).collect())
    tags = [f"v{i}" for i in range(10_300)]
    assert got == sorted(("o/r", a, b) for a, b in zip(tags, tags[1:], strict=False))
    assert spark.read.parquet(out + "/late_releases").count() == 0


def tar_of(members, cut=None):
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w:gz") as tar:
        for name, data in members:
            info = tarfile.TarInfo("top/" + name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    return raw.getvalue()[:cut]


def test_failing_archive_manifest_and_diff_leave_the_rest(spark, monkeypatch):
    noise = random.Random(1).randbytes(400000)
    sound = {"v1": [("x.py", b"a\n"), ("y.py", b"1\n"), ("pyproject.toml", b"[project\n")], "v2": [("x.py", b"b\n"), ("y.py", b"2\n"), ("pyproject.toml", b"")]}
    rows = [(repo, v, tar_of(m)) for repo in ("good/one", "half/cut") for v, m in sound.items()]
    rows += [("half/cut", "v3", tar_of([("x.py", b"c\n"), ("noise", noise)], 300000)), ("no/tar", "v1", b"nothing"), ("no/tar", "v2", None)]
    archived = spark.createDataFrame(rows, "repo string, version string, content binary")
    with_error = archives.unpacked(archived)
    assert with_error.filter("version = 'v3' AND path = 'x.py'").count() == 1  # read before the end of the archive was missed
    readable, unreadable = archives.readable(with_error)
    assert readable.filter("version = 'v3' OR repo = 'no/tar'").count() == 0
    assert {(r.repo, r.version) for r in unreadable.collect()} == {("half/cut", "v3"), ("no/tar", "v1"), ("no/tar", "v2")}

    plain = diff.line_edit

    def failing(old, new, old_name, *rest):
        if old_name == "a/y.py":
            raise RecursionError("planted")
        return plain(old, new, old_name, *rest)

    monkeypatch.setattr(diff, "line_edit", failing)
    known = releases(spark, [(repo, f"v{i}", f"2024-0{i}-01", i) for repo in ("good/one", "half/cut", "no/tar") for i in (1, 2, 3)])
    built = build_dataset(known, readable, NOW, unreadable=unreadable)
    rejects = {(r.repo, r.from_version, r.path): r.error for r in built.rejects.collect()}
    assert rejects["good/one", "v1", "y.py"] == rejects["half/cut", "v1", "y.py"] == "RecursionError: planted"
    assert "TOMLDecodeError" in rejects["good/one", "v1", "pyproject.toml"]
    assert rejects["half/cut", "v2", None].startswith("no files for v3: EOFError: ")
    assert rejects["no/tar", "v1", None].startswith("no files for v1: ReadError: ") and rejects["good/one", "v2", None] == "no files for v3"
    got = {(r.repo_name, r.from_version): r.output_text for r in built.examples.collect()}
    assert set(got) == {("good/one", "v1"), ("half/cut", "v1")}
    assert all("Error generating diff: planted" in t and "-a\n+b\n" in t for t in got.values())


def test_many_broken_archives_are_no_table_of_the_driver(spark, monkeypatch):
    monkeypatch.setattr(joins, "FEW_KEYS", 50)
    rows = [(f"r{i % 7}", f"v{i}", "x" if i % 3 else None, f"t{i}".encode() if i % 3 else None, None if i % 3 else "EOFError: x") for i in range(3000)]
    rows += [("r0", "v0", "early", b"read before the end", None), (None, "v0", "p", b"no repository", None)]
    readable, unreadable = archives.readable(spark.createDataFrame(rows, "repo string, version string, path string, content binary, error string"))
    want = {(r[0], r[1], r[2]) for r in rows if r[4] is None and r[2] != "early"}
    assert {(r.repo, r.version, r.path) for r in readable.collect()} == want and readable.count() == len(want)
    assert unreadable.count() == 1000
    # Only the marks are broadcast; the rows that may be of a broken archive meet the keys in a shuffle.
    plan = readable._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and not re.search(r"LeftAnti.*rightHint=\(strategy=broadcast\)", plan)


def test_strict_reader_fails_on_a_broken_archive(spark, tmp_path):
    folder = tmp_path / "repo=o%2Fr" / "version=v1"
    folder.mkdir(parents=True)
    (folder / "x.tar.gz").write_bytes(tar_of([("a", b"1")], 40))
    with pytest.raises(Exception, match="archive of o/r v1"):
        read_release_archives(spark, str(tmp_path)).collect()
    files_, errors = archives.read_readable_archives(spark, str(tmp_path))
    assert files_.count() == 0 and errors.count() == 1
