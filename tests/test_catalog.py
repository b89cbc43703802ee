"""Every quick catalog query beside its SQL counterpart on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from catalog.registry import ORACLES, QUERIES
from check import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"
# Whole jobs; they have tests of their own and run in check.py.
JOBS = {"i3_pair_texts", "i4_isolated_failures", "i4_single_repository", "i5_dataset", "s1_incremental_examples", "s3_running_stats", "s2_incremental_pairs",
        "c4_merged_files", "g2_merged_totals", "d2_diff_totals", "d8_unified_text", "i19_diff_stats", "h5_line_counts", "f2_diffs_by_path"}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - JOBS))
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())
