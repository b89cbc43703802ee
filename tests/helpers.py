from pyspark.sql import functions as F

from codelineage.operators.snapshot import raw_files


def files(spark, rows):
    """raw_files from (repo, version, path, bytes or str)."""
    data = [(r, v, p, c.encode() if isinstance(c, str) else c) for r, v, p, c in rows]
    return raw_files(spark.createDataFrame(data, "repo string, version string, path string, content binary"))


def releases(spark, rows):
    """releases from (repo, tag, day, release_id[, is_prerelease])."""
    data = [(r[0], r[1], f"{r[0]}@{r[1]}", r[2], r[3], bool(r[4]) if len(r) > 4 else False) for r in rows]
    schema = "repo string, tag_name string, commit_sha string, day string, release_id long, is_prerelease boolean"
    return spark.createDataFrame(data, schema).withColumn("published_at", F.to_timestamp("day")).drop("day")


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}
