"""Tables the jobs read and keep: raw files, releases, configuration, examples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from codelineage import schemas


def read_files_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RAW_FILES).parquet(path)


def save_files_table(files: DataFrame, table: str, buckets: int) -> None:
    """Keep raw files bucketed by file, so that looking contents up moves only the requests."""
    key = ["repo", "version", "path"]
    files.write.bucketBy(buckets, *key).sortBy(*key).mode("overwrite").saveAsTable(table)


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """repo_config from JSON lines, one repository per line; missing keys are NULL."""
    return spark.read.schema(schemas.REPO_CONFIG).json(path)


def _by_layout(spark: SparkSession, path: str, schema) -> DataFrame:
    reader = spark.read.schema(schema)
    return reader.parquet(path) if path.rstrip("/").endswith(".parquet") else reader.json(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Examples written by the JSON or the Parquet sink, by the layout of the folder: a row for each part of their texts."""
    return _by_layout(spark, path, schemas.RECORDS)


def read_examples(spark: SparkSession, path: str) -> DataFrame:
    """The columns of an example alone. An example of several parts has as many rows; see :func:`read_records`."""
    return _by_layout(spark, path, schemas.EXAMPLES)
