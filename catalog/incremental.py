"""Incremental mode: releases arriving in files, paired and turned into examples."""

from pyspark.sql import functions as F

from catalog.changes import CREATED, EXAMPLES_SQL, fingerprints, whole
from catalog.datasets import STATS_SQL, rounded
from catalog.registry import query
from catalog.releases import PAIRS_SQL, STABLE
from codelineage.sources.tables import read_records
from codelineage.storage import fresh_path, written
from codelineage.streaming.incremental import current, current_pairs, running_stats, start_examples, start_pairing

RELEASE = ["repo", "tag_name", "commit_sha", "published_at", "release_id", "is_prerelease"]


def arriving(x, releases, batch, batches):
    """Stream of a folder that receives the releases in several file sets, and a function that lands some of them."""
    folder, rows = fresh_path(x.spark, "landing"), written(releases.select(*RELEASE, batch.alias("batch")), "releases")

    def land(first, last):
        for i in range(first, last):
            rows.filter(F.col("batch") == i).drop("batch").coalesce(1).write.mode("append").parquet(folder)

    land(0, batches)
    return x.spark.readStream.schema(rows.drop("batch").schema).option("maxFilesPerTrigger", 1).parquet(folder), land


@query("s2_incremental_pairs", "SELECT repo, from_version, to_version FROM (" + PAIRS_SQL.format(rows=STABLE) + ") WHERE to_version IS NOT NULL")
def s2(x):
    """In five batches by hash, so out of order, the stream being started anew after three."""
    folder = fresh_path(x.spark, "pairing")
    stream, land = arriving(x, x.releases(), F.pmod(F.xxhash64("release_id"), F.lit(5)).cast("int"), 3)
    start_pairing(stream, folder).awaitTermination()
    land(3, 5)
    start_pairing(stream, folder).awaitTermination()
    return current_pairs(x.spark, folder).select("repo", "from_version", "to_version")


def streamed(x):
    folder, files = fresh_path(x.spark, "examples"), whole(x)
    start_examples(
        arriving(x, x.releases3(), F.col("release_id").cast("int"), 3)[0], x.releases3, lambda: files, folder, CREATED,
        known_packages=x.known_packages(),
    ).awaitTermination()
    return folder


@query("s1_incremental_examples", EXAMPLES_SQL)
def s1(x):
    folder = streamed(x)
    return fingerprints(current(read_records(x.spark, folder + "/dataset.jsonl"), folder))


LIGHT_SQL = EXAMPLES_SQL.replace("md5(i) AS input_md5, md5(o) AS output_md5", "length(i) AS input_size, length(o) AS output_size")


@query("s3_running_stats", STATS_SQL.replace("length(input_text)", "input_size").replace("length(output_text)", "output_size")
       .replace("FROM fx_examples", f"FROM ({LIGHT_SQL})"))
def s3(x):
    return rounded(running_stats(x.spark, streamed(x)))
