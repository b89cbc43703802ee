"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codelineage.llm import contamination, embeddings, neighbours, oracles, pages, passages, privacy, quality, repair, secrets, simhash, substrings, trie
from codelineage.llm.packing import pack
from codelineage.operators.joins import lookup_join
from codelineage.operators.ordered import with_order
from codelineage.storage import written

QUERIES = {}
ORACLES = {}


def query(name: str, oracle: str | None = None):
    def register(build):
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_packing")
def op1(spark, sf_dir):
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    pieces = pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op9_simhash")
def op9(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


@query("op4_decontamination", oracles.CONTAMINATION)
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination.scan(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "found.n_words", "found.n_hit", F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("found.items", ","), 256).alias("items_sha256"),
        contamination.contaminated(F.col("found")).alias("contaminated"))


@query("op7_quality")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(quality.fold_of("doc_id") == 1, F.lit(False))
    return scored(docs, sf_dir).select(
        "doc_id", held_out.alias("held_out"), F.col("quality").alias("score"),
        (F.col("quality") >= 0.5).cast("int").alias("predicted"))


def scored(docs: DataFrame, sf_dir: str, into: str = "quality") -> DataFrame:
    """The documents with their score by a model that never sees the labels of fold 1."""
    labels = table(docs.sparkSession, sf_dir, "labels").filter(quality.fold_of("doc_id") != 1)
    return quality.score(docs, quality.fit(docs, labels.select("doc_id", F.col("quality").alias("label"))), into=into)


def counted(spans: str, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


@query("op8_secrets")
def op8(spark, sf_dir):
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["kind"] != "grammar")
    return found.select(
        "doc_id",
        *[counted("secrets", kind) for kind in secrets.KINDS[:3]],
        F.sha2(secrets.joined(base), 256).alias("base_sha256"), secrets.joined(F.col("secrets")).alias("spans"))


@query("op3_embeddings", oracles.EMBEDDINGS)
def op3(spark, sf_dir):
    found = embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), every_length=True)
    return found.select(
        "vec_id", "n_links", F.col("component").alias("component_id"), F.col("vec_id").eqNullSafe(F.col("component")).alias("kept"))


@query("op2_substrings", oracles.SUBSTRINGS)
def op2(spark, sf_dir):
    found = substrings.without_repeated_substrings(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_passages", oracles.PASSAGES)
def op6(spark, sf_dir):
    found = passages.without_repeated_passages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_html_text")
def op5(spark, sf_dir):
    found = pages.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op10_privacy")
def op10(spark, sf_dir):
    found = privacy.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] != "term")
    return found.select(
        "doc_id", *[counted("spans", kind) for kind in privacy.KINDS[:4]],
        F.sha2(privacy.listed(base), 256).alias("base_sha256"), privacy.listed(F.col("spans")).alias("spans"))


def crc32_of(text):
    return F.crc32(text.cast("binary"))


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with the faults that the contract plants; nulls in its key, role and text stand for one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = crc32_of(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), fate.alias("fate")).filter("fate <> 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


@query("op11_repair", oracles.REPAIR)
def op11(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    found = repair.audited(damaged(rows))
    ids = rows.select(F.col("conv_id").alias("given")).distinct()
    none = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit(""), 256)}
    return ids.join(found, F.col("given").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("given").alias("conv_id"), *[F.coalesce(c, none.get(c, F.lit(0).cast("long"))).alias(c)
                                           for c in (*repair.FAULTS, "audit", "repaired_sha256")])


@query("op12_neighbours")
def op12(spark, sf_dir):
    found = neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
    return found.select(F.col("query").alias("query_id"), "rank", "vec_id", "score")


# Turns that a rebuilt conversation takes from another, and conversations that take them from one, at most.
HEAD, SHARED = 8, 5


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(items, keys) for the trie: conversations whose first turns are those of the first of every five.

    Turns in the order of ``turn`` (null first), then MD5 of role and text; rows without conv_id take no part.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    content = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    rows = rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").alias("key"), F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("at"),
        content.alias("content"), F.octet_length(text).cast("long").alias("size"))
    # Read twice below, so that its numbers are settled first.
    numbered = written(
        with_order(rows, ["key"], ["known", "at", "content"], number="place").select("key", "content", "size", F.col("place").cast("long").alias("place")), "turns")
    base, head = F.col("key") - F.col("key") % SHARED, crc32_of(F.col("key").cast("string")) % (HEAD + 1)
    keys = numbered.select("key").distinct()
    tops = numbered.filter((F.col("place") <= HEAD) & (F.col("key") == base)).withColumnRenamed("key", "base")
    theirs = keys.select("key", base.alias("base"), head.alias("head")).join(tops, "base").filter("place <= head")
    lengths = tops.groupBy("base").agg(F.count(F.lit(1)).alias("length"))
    own = numbered.withColumns({"base": base, "head": head}).filter("place > head")
    own = lookup_join(own, lengths, ["base"], F.col("place"), "left")
    taken = F.least("head", F.coalesce("length", F.lit(0)))
    items = theirs.select("key", F.col("place").alias("position"), "content", "size").unionByName(
        own.select("key", (F.col("place") - F.col("head") + taken).alias("position"), "content", "size"))
    return items, keys


@query("op13_trie", oracles.TRIE)
def op13(spark, sf_dir):
    found = trie.prefix_trie(*rebuilt(table(spark, sf_dir, "conversations")))
    return found.select(
        F.col("key").alias("conv_id"), "depth", F.col("parent_key").alias("parent_conv_id"), F.col("n_keys").alias("n_convs"), "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), "ends_sha256")
