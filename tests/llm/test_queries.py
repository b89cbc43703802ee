"""The registered queries and the pipeline on the smallest tables."""

import zlib

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
from brute import contamination, fingerprint, personal, reachable, sha
from brute import secrets as plain_secrets
from conftest import plain
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from check import TABLES, rows_of
from codelineage.llm import queries, secrets

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def docs(db):
    return db.execute("SELECT doc_id, text FROM documents").fetchall()


def rows(spark, name):
    return queries.QUERIES[name](spark, FOLDER).collect()


def test_all_are_bound():
    bound = entry.queries()
    assert set(queries.QUERIES) | {"pipeline"} <= set(bound)
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, db, name):
    df = queries.QUERIES[name](spark, FOLDER)
    cursor = db.execute(queries.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


def test_packing(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for d, t in docs}
    got, seen, used = rows(spark, "op1_packing"), {d: 0 for d in ids}, {}
    for r in sorted(got, key=lambda r: (r.doc_id, r.start)):
        assert r.start == seen[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())
        seen[r.doc_id] += r.length
    assert seen == {d: len(x) for d, x in ids.items()}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used.get(r.sequence_id, 0)
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 2048 and sum(used.values()) > 0.97 * 2048 * len(used)


def test_simhash(spark, docs):
    prints = np.array([fingerprint(t) for _, t in docs], np.uint64)
    roots = reachable(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3, [d for d, _ in docs])
    assert plain(map(tuple, rows(spark, "op9_simhash"))) == plain(
        (d, format(int(p), "016x"), r) for (d, _), p, r in zip(docs, prints, roots, strict=True))


def spans_digest(spans, kinds):
    return sha(",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans))


def test_secrets_and_personal_data(spark, docs):
    texts = dict(docs)
    for r in rows(spark, "op8_secrets"):
        base = plain_secrets(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert r.base_sha256 == spans_digest(base, ("assign", "access", "hex"))
    for r in rows(spark, "op10_privacy"):
        base = personal(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert r.base_sha256 == spans_digest(base, ("email", "ip", "card", "phone"))


def test_quality(spark, docs):
    got = rows(spark, "op7_quality")
    assert sorted(r.doc_id for r in got) == sorted(d for d, _ in docs)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def test_pages(spark, db):
    got = rows(spark, "op5_html_text")
    assert len(got) == db.execute("SELECT count(*) FROM pages").fetchall()[0][0]
    assert all(r.n_chars == len(r.text) for r in got) and sum(r.n_chars for r in got) > 10_000


def test_pipeline_equals_plain_steps(spark, docs, db):
    kept = {r.doc_id for r in rows(spark, "op7_quality") if r.predicted}
    left = [(d, t) for d, t in docs if d in kept]
    prints = np.array([fingerprint(t) for _, t in left], np.uint64)
    roots = reachable(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3, [d for d, _ in left])
    left = [x for x, r in zip(left, roots, strict=True) if x[0] == r]
    hit = {d: (n, h) for d, n, h, _ in contamination(left, db.execute("SELECT item_id, text FROM benchmark").fetchall())}
    left = [(d, t) for d, t in left if not (hit[d][1] and 20 * hit[d][1] >= hit[d][0])]

    def redacted(text):
        out, at = "", 0
        for start, kind, end in secrets.find(text, secrets.standard_grammar()):
            if start >= at:
                out += text[at:start] + f"[{kind}]"
            at = max(at, end)
        return out + text[at:]

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {d: np.array([*tokenizer.encode(redacted(t or ""), add_special_tokens=False).ids, 1], "<u4") for d, t in left}
    got = corpus_pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in got} == set(want) and 0 < len(want) < len(docs)
    for r in got:
        assert r.ids_crc32 == zlib.crc32(want[r.doc_id][r.start:r.start + r.length].tobytes())
    assert sum(r.length for r in got) == sum(map(len, want.values()))


def test_stages_on_odd_rows(spark, given, documents, nothing):
    """Nulls, repeated rows, long texts, no rows and clashing columns pass every stage."""
    for table in (documents.withColumn("n_chars", F.length("text").cast("long")), nothing):
        docs = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, FOLDER)
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), out.schema)
        pieces = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
        assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()}
