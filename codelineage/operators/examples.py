"""Finished examples: construction, chat form, exact split, name filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelineage.functions.text import approx_tokens
from codelineage.operators.joins import lookup_join
from codelineage.operators.render import input_text, output_text
from codelineage.schemas import EXAMPLE_COLUMNS, EXAMPLE_META, RECORD_COLUMNS

# Fixed value: the default system message of the chat form.
DEFAULT_SYSTEM_PROMPT = """You are an expert software engineer. Given a complete codebase (including dependencies), predict the changes that will be made in the next version release. Output the changes as a unified diff format.

The input contains:
1. The complete source code of the main repository
2. Source code of key dependencies (under __deps__/)

Your task is to predict what changes, improvements, or bug fixes will be made to transform this codebase into the next release version."""

CHAT_METADATA = ["repo_name", "from_version", "to_version", "input_tokens_approx", "output_tokens_approx"]


def create_examples(rows: DataFrame, created_at: str) -> DataFrame:
    """Examples from rows holding repo, versions, codebase and diff texts, and counts.

    ``created_at`` is the ISO time of the run, one value for the whole job.
    """
    codebase, diff = F.col("codebase_text"), F.col("diff_text")
    return rows.withColumns({
        "repo_name": F.col("repo"),
        "created_at": F.lit(created_at),
        "input_text": input_text(F.col("repo"), F.col("from_version"), codebase),
        "output_text": output_text(F.col("from_version"), F.col("to_version"), diff),
    }).withColumns({
        "input_tokens_approx": approx_tokens(F.col("input_text")),
        "output_tokens_approx": approx_tokens(F.col("output_text")),
    }).select(*EXAMPLE_COLUMNS)


def example_records(counts: DataFrame, texts: DataFrame, created_at: str) -> DataFrame:
    """Examples as records, from the parts (pair, part_no, input_text, output_text; NULL without a part) of their texts.

    ``counts`` has one row a pair: numbers of files and dependencies, and parts and characters of both texts, from which the
    tokens come.
    """
    pair = ["repo", "from_version", "to_version"]
    return lookup_join(texts, counts, pair, F.col("part_no")).select(
        F.col("repo").alias("repo_name"), *pair[1:], F.lit(created_at).alias("created_at"),
        *[F.coalesce(f"{side}_text", F.lit("")).alias(f"{side}_text") for side in ("input", "output")],
        *[F.floor(F.col(f"{side}_chars") / 4).cast("long").alias(f"{side}_tokens_approx") for side in ("input", "output")],
        "num_files_in_codebase", "num_files_changed", "num_dependencies", "part_no", F.greatest("input_parts", "output_parts").alias("parts"))


def as_records(examples: DataFrame) -> DataFrame:
    """Whole examples become records of one part."""
    if "part_no" in examples.columns:
        return examples.select(*RECORD_COLUMNS)
    return examples.select(*EXAMPLE_COLUMNS, F.lit(0).alias("part_no"), F.lit(1).alias("parts"))


def with_sizes(examples: DataFrame) -> DataFrame:
    """Add the lengths of the texts; written beside the texts, they spare :func:`example_meta` reading them."""
    return examples.withColumns({f"{side}_size": F.length(f"{side}_text").cast("long") for side in ("input", "output")})


def example_meta(examples: DataFrame) -> DataFrame:
    """Light rows for statistics, one an example: text lengths (those of :func:`with_sizes`, if there) instead of texts."""
    sizes = ["input_size", "output_size"]
    if not set(sizes) <= set(examples.columns):
        examples = with_sizes(examples)
    if "part_no" not in examples.columns:
        return examples.select(*EXAMPLE_META.fieldNames())
    key = ["repo_name", "from_version", "to_version"]
    others = [c for c in EXAMPLE_META.fieldNames() if c not in (*key, *sizes)]
    return examples.groupBy(*key).agg(
        *[F.sum(name).alias(name) for name in sizes], *[F.max(c).alias(c) for c in others]).select(*EXAMPLE_META.fieldNames())


def chat_messages(input_: Column, output: Column, system_prompt: str | None) -> Column:
    def message(role, content):
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    messages = [message("user", input_), message("assistant", output)]
    if system_prompt:
        messages.insert(0, message("system", F.lit(system_prompt)))
    return F.array(*messages)


def chat_examples(examples: DataFrame, system_prompt: str | None = DEFAULT_SYSTEM_PROMPT) -> DataFrame:
    """Chat records: messages and a metadata struct, and of records the part. A falsy prompt leaves the system message out."""
    return examples.select(
        chat_messages(F.col("input_text"), F.col("output_text"), system_prompt).alias("messages"),
        F.struct(*CHAT_METADATA).alias("metadata"), *[c for c in ("part_no", "parts") if c in examples.columns],
    )


def filter_examples(examples: DataFrame, repo_contains: str | None = None, max_input_tokens: int | None = None) -> DataFrame:
    """Examples of matching repositories below a token bound; both reach a Parquet scan."""
    kept = examples
    if repo_contains is not None:
        kept = kept.filter(F.contains("repo_name", F.lit(repo_contains)))
    if max_input_tokens is not None:
        kept = kept.filter(F.col("input_tokens_approx") < max_input_tokens)
    return kept


SPLIT_KEY = ["split_hash", "repo_name", "from_version", "to_version"]
# Hexadecimal digits of the hash that a counting pass looks at beyond those known.
RADIX = 3


def with_split(examples: DataFrame, train_ratio: float = 0.9, seed: int = 42) -> DataFrame:
    """Add ``split``: exactly int(n * ratio) examples are ``train``, the rest ``validation``.

    Examples are ordered by a seeded hash, then their key, and cut there by radix selection: a pass counts the examples for
    each of the first digits of the hash, and further passes count within the one prefix that the cut falls into, until
    no more than a prefix of counts (16 ** RADIX) of them are left; the key of the last training example among those splits all in
    place. No key is sorted or moved. Records of one example share its split.
    """
    identity = F.concat_ws("|", F.lit(str(seed)), "repo_name", "from_version", "to_version")
    hashed = examples.withColumn("split_hash", F.md5(identity))
    keys = hashed.filter("part_no = 0") if "part_no" in examples.columns else hashed
    prefix, wanted = "", None
    while True:
        at = len(prefix) + RADIX
        counts = keys.filter(F.startswith("split_hash", F.lit(prefix))).groupBy(F.left("split_hash", F.lit(at)).alias("digits")).agg(
            F.count(F.lit(1)).alias("n")).orderBy("digits").collect()
        if wanted is None:
            wanted = int(sum(r.n for r in counts) * train_ratio)
        if wanted == 0:
            in_train = F.col("split_hash") < prefix
            break
        for r in counts:
            if r.n >= wanted:
                prefix, size = r.digits, r.n
                break
            wanted -= r.n
        if size <= 16 ** RADIX or at + RADIX > 32:
            few = keys.filter(F.startswith("split_hash", F.lit(prefix))).select(*SPLIT_KEY).orderBy(*SPLIT_KEY).limit(wanted)
            last = few.agg(F.max(F.struct(*SPLIT_KEY)).alias("last")).first()["last"]
            in_train = F.struct(*SPLIT_KEY) <= F.struct(*[F.lit(last[c]).alias(c) for c in SPLIT_KEY])
            break
    return hashed.withColumn("split", F.when(in_train, "train").otherwise("validation")).drop("split_hash")


def split_examples(examples: DataFrame, train_ratio: float = 0.9, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    marked = with_split(examples, train_ratio, seed)
    return tuple(marked.filter(F.col("split") == name).drop("split") for name in ("train", "validation"))
