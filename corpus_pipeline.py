"""Raw documents to packed training sequences, one operator a stage.

A stage takes the documents its predecessor kept and returns them with the columns of ``documents``; the last
returns the pieces of the packed sequences. What a stage returns is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codelineage.llm import contamination, queries, secrets, simhash
from codelineage.llm.names import free_name
from codelineage.storage import written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; without any labels all of them."""
    score = free_name(docs.columns, "quality")
    return queries.scored(docs, sf_dir, score).filter(F.col(score) >= 0.5).select(*docs.columns)


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the smallest doc_id; documents without one all stay."""
    return simhash.first_of_each(docs, simhash.near_duplicates(docs))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words, or none, stand in a benchmark window."""
    name = free_name(docs.columns, "found")
    found = contamination.scan(docs, queries.table(spark, sf_dir, "benchmark"), into=name)
    return found.filter(~contamination.contaminated(F.col(name))).select(*docs.columns)


def secrets_redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the name of its kind in place of every secret; n_chars follows the text."""
    name = free_name(docs.columns, "secrets")
    found = secrets.scan(docs, into=name)
    clean = found.withColumn("text", secrets.redacted(F.col("text"), F.col(name)))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.size(name) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return clean.select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 2048 ids, as query op1_packing returns them."""
    return queries.packed(docs)


STAGES = [
    ("quality", good_quality),
    ("simhash", no_near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", secrets_redacted),
    ("packing", packed),
]

# Fingerprints, kernel scores and tokenizers are beyond SQL; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
