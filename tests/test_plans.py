import gzip
import json
import random
import re
import zlib

from pyspark.sql import functions as F

from codelineage import dims
from codelineage.functions.patterns import in_snapshot
from codelineage.operators import diff, examples, releases, snapshot, stats
from codelineage.sources import sinks
from codelineage.sources.tables import read_files_table
from helpers import files
from helpers import releases as release_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return re.findall(r"ReadSchema: (\S+)", df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))


def table(spark, tmp_path):
    files(spark, [("o/r", v, f"f{i}.py", f"{v}{i}") for v in ("v1", "v2") for i in range(9)]).write.parquet(str(tmp_path / "raw"))
    return read_files_table(spark, str(tmp_path / "raw"))


def test_sizes_never_read_contents(spark, tmp_path):
    raw = table(spark, tmp_path)
    sizes = snapshot.snapshot_totals(snapshot.file_sizes(raw.filter(in_snapshot(F.col("path")))))
    assert scans(sizes) and all("content:" not in s for s in scans(sizes))
    assert plan(sizes).count("BroadcastHashJoin") >= 2


def test_changes_read_hashes_only(spark, tmp_path):
    raw = table(spark, tmp_path)
    pairs = releases.release_pairs(release_rows(spark, [("o/r", "v1", "2024-01-01", 1), ("o/r", "v2", "2024-01-02", 2)]))
    changes = diff.path_changes(pairs, raw)
    assert all("content:" not in s and "head" not in s for s in scans(changes))
    assert "CartesianProduct" not in plan(changes) and "BroadcastNestedLoopJoin" not in plan(changes)


def test_top_releases_are_cut_before_the_shuffle(spark):
    rows = release_rows(spark, [("o/r", f"v{i}", "2024-01-01", i) for i in range(50)])
    assert "WindowGroupLimit" in plan(releases.newest_releases(rows))


def test_light_statistics_read_no_texts(spark, tmp_path):
    rows = spark.createDataFrame([("r", "a", "b", "now", "in", "out", 1, 1, 1, 1, 1)], "repo_name string, from_version string, to_version string, "
                                 "created_at string, input_text string, output_text string, input_tokens_approx long, output_tokens_approx long, "
                                 "num_files_in_codebase long, num_files_changed long, num_dependencies long")
    examples.example_meta(rows).write.parquet(str(tmp_path / "meta"))
    light = stats.dataset_stats(spark.read.parquet(str(tmp_path / "meta")))
    full = stats.example_stats(rows)
    assert all("_text" not in s for s in scans(light)) and light.collect() == full.collect()
    assert stats.example_stats(rows.limit(0)).count() == 0


def test_light_rows_use_the_sizes_written_beside_the_texts(spark, tmp_path):
    rows = spark.createDataFrame(
        [("r", "a", "b", "now", "input " * (n + 1), "é" * n, 1, 1, 1, 1, 1, n, 3) for n in range(3)] + [("r", "b", "c", "now", "", "x", 2, 1, 1, 1, 1, 0, 1)],
        "repo_name string, from_version string, to_version string, created_at string, input_text string, output_text string, input_tokens_approx long, "
        "output_tokens_approx long, num_files_in_codebase long, num_files_changed long, num_dependencies long, part_no int, parts int")
    examples.with_sizes(rows).write.parquet(str(tmp_path / "sized"))
    light = examples.example_meta(spark.read.parquet(str(tmp_path / "sized")))
    assert scans(light) and all("_text" not in s for s in scans(light))
    assert sorted(light.collect()) == sorted(examples.example_meta(rows).collect()) and light.count() == 2


def test_json_lines_are_compressed_at_the_fastest_level(spark, tmp_path):
    rng = random.Random(2)
    text = " ".join(rng.choice(["def", "return", "value", "import", "self", str(rng.random())]) for _ in range(100000))
    sinks.save_jsonl(spark.createDataFrame([(text,)], "text string").coalesce(1), str(tmp_path / "j"))
    packed, = (tmp_path / "j").glob("part-*.json.gz")
    plain = gzip.decompress(packed.read_bytes())
    assert json.loads(plain) == {"text": text}
    fast, usual = (len(zlib.compress(plain, level)) for level in (1, 6))
    assert abs(packed.stat().st_size - fast) < (fast - usual) / 4


def test_filters_reach_the_scan(spark, tmp_path):
    spark.range(10).select(F.lit("org/x").alias("repo_name"), F.col("id").alias("input_tokens_approx")).write.parquet(str(tmp_path / "e"))
    kept = examples.filter_examples(spark.read.parquet(str(tmp_path / "e")), "org", 5)
    assert "StringContains(repo_name,org)" in plan(kept) and "LessThan(in" in plan(kept)


def test_lookup_tables(spark):
    assert dims.languages(spark).count() == 46 and dims.binary_types(spark).count() == 76
    assert dims.known_packages(spark).count() == 44 and dims.topics(spark).count() == 21 and dims.curated(spark).count() == 47
    listed = dims.curated_categories(spark).groupBy("category").count().collect()
    assert {r.category: r["count"] for r in listed}["HuggingFace Ecosystem"] == 8 and len(listed) == 5
