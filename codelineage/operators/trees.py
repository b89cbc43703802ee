"""Snapshots as trees of folder hashes; two of them are compared from the root down.

A folder's hash covers the names and hashes of all it holds, so equal folders are told by one comparison, and only
what lies under a difference is read. Trees can be kept: a new release adds its own entries, and pairs meet in the entries alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codelineage.operators.joins import lookup_join
from codelineage.storage import fresh_path, written

PAIR = ["repo", "from_version", "to_version"]
SNAPSHOT = ["repo", "version"]
ENTRY = [*SNAPSHOT, "folder", "name", "is_folder", "hash", "level"]
LAYOUT = "repo string, version string, folder string, name string, is_folder boolean, hash string, level int"
# Folders below this level are not hashed by themselves: a file there is an entry of its ancestor at this level, which bounds the rounds.
LEVELS = 32
_ROOT = -1


def change_type(old: Column, new: Column) -> Column:
    return F.when(old.isNull(), "added").when(new.isNull(), "deleted").otherwise("modified")


def sides(pairs: DataFrame, *columns: str) -> DataFrame:
    """(pair, columns, version, is_old): both releases of every pair."""
    both = F.explode(F.array(*[
        F.struct(F.col(c).alias("version"), F.lit(is_old).alias("is_old")) for c, is_old in (("from_version", True), ("to_version", False))]))
    return pairs.select(*PAIR, *columns, both.alias("side")).select(*PAIR, *columns, "side.version", "side.is_old")


def old_and_new(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The value of each side (the largest, where rows repeat) in one row for each key."""
    return rows.groupBy(*keys).agg(
        F.max(F.when(F.col("is_old"), F.col(value))).alias(f"old_{value}"),
        F.max(F.when(~F.col("is_old"), F.col(value))).alias(f"new_{value}"))


def _leaves(files: DataFrame) -> DataFrame:
    slashes = F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit("")))
    rows = files.filter("path IS NOT NULL AND content_sha IS NOT NULL").groupBy(*SNAPSHOT, "path").agg(F.max("content_sha").alias("hash"))
    return rows.withColumn("level", F.least(slashes, F.lit(LEVELS))).withColumn(
        "folder", F.expr("if(level > 0, concat(substring_index(path, '/', level), '/'), '')")
    ).withColumns({"name": F.substring("path", F.length("folder") + 1, F.length("path")), "is_folder": F.lit(False)}).select(*ENTRY)


def _folders(entries: DataFrame, level: int) -> DataFrame:
    """The folders that hold these entries, as entries of the level above.

    The hash is made of sums over the entries' hashes, which tasks add up before anything is shuffled: no
    folder is ever put in order or held as a whole.
    """
    kind = F.when(F.col("is_folder"), "d").otherwise("f")
    one = F.sha2(F.concat(F.length("hash").cast("string"), F.lit(":"), "hash", kind, "name"), 256)
    part = lambda i: F.conv(F.substring("one", 8 * i + 1, 8), 16, 10).cast("long")
    sums = entries.select(*SNAPSHOT, "folder", one.alias("one")).groupBy(*SNAPSHOT, "folder").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(part(i)).alias(f"s{i}") for i in range(8)])
    whole = F.sha2(F.concat_ws(",", "n", *[f"s{i}" for i in range(8)]), 256)
    above = F.concat(F.substring_index("folder", "/", level - 1), F.lit("/")) if level > 1 else F.lit("")
    return sums.select(*SNAPSHOT, F.col("folder").alias("path"), above.alias("folder"), whole.alias("hash")).select(
        *SNAPSHOT, "folder", F.substring("path", F.length("folder") + 1, F.length("path")).alias("name"),
        F.lit(True).alias("is_folder"), "hash", F.lit(level - 1).alias("level"))


def folder_trees(files: DataFrame) -> DataFrame:
    """(repo, version, folder, name, is_folder, hash, level): the entries of all folders of all snapshots, hashed from the deepest level up.

    ``folder`` ends with a slash (the top is empty), and so does the name of a folder. The whole snapshot is the entry of level -1. Of a path that stands
    in several rows the largest hash counts; rows without a path or hash do not. Contents are not read.
    """
    path = fresh_path(files.sparkSession, "leaves")
    _leaves(files).write.partitionBy("level").parquet(path)
    leaves = files.sparkSession.read.schema(LAYOUT).parquet(path).select(*ENTRY)
    deepest = leaves.agg(F.max("level")).first()[0]
    tree, above = leaves, None
    for level in range(-1 if deepest is None else deepest, _ROOT, -1):
        held = leaves.filter(F.col("level") == level)
        above = written(_folders(held if above is None else held.unionByName(above), level), "folders")
        tree = tree.unionByName(above)
    return tree


def save_trees(trees: DataFrame, path: str, mode: str = "append") -> None:
    """Keep trees by level; those of further releases are appended."""
    trees.write.mode(mode).partitionBy("level").parquet(path)


def read_trees(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LAYOUT).parquet(path)


def compared(open_: DataFrame, entries: DataFrame) -> DataFrame:
    """Entries of both releases under the folders of ``open_(pair, folder)``, side by side."""
    roles = sides(open_, "folder")
    return old_and_new(
        lookup_join(entries, roles, [*SNAPSHOT, "folder"], F.col("name")), [*PAIR, "folder", "name", "is_folder"], "hash")


def tree_changes(pairs: DataFrame, trees: DataFrame) -> DataFrame:
    """Changed paths of every pair with the hashes before and after, from :func:`folder_trees` of their releases.

    One round a level: folders that differ are opened, equal ones never are. A release without a tree has no files.
    """
    deepest = trees.agg(F.max("level")).first()[0]
    open_, found = pairs.select(*PAIR, F.lit("").alias("folder")).distinct(), []
    for level in range(_ROOT, _ROOT if deepest is None else deepest + 1):
        entries = trees.filter(F.col("level") == level).drop("level")
        met = written(compared(open_, entries).filter(~F.col("old_hash").eqNullSafe(F.col("new_hash"))), "met")
        found.append(met.filter(~F.col("is_folder")))
        open_ = met.filter("is_folder").select(*PAIR, F.concat("folder", "name").alias("folder"))
        if open_.isEmpty():
            break
    if not found:
        none = F.lit(None).cast("string")
        found = [open_.limit(0).select(*PAIR, "folder", none.alias("name"), none.alias("old_hash"), none.alias("new_hash"))]
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    return rows.select(
        *PAIR, F.concat("folder", "name").alias("path"), F.col("old_hash").alias("old_sha"), F.col("new_hash").alias("new_sha"),
        change_type(F.col("old_hash"), F.col("new_hash")).alias("change_type"))
