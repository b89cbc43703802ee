"""Statistics, reports, chat form, split and the written outputs."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog.registry import query
from codelineage.functions import text
from codelineage.operators import examples as ops
from codelineage.operators import stats
from codelineage.operators.render import joined, text_parts
from codelineage.schemas import EXAMPLE_COLUMNS
from codelineage.sources import sinks
from codelineage.sources.tables import read_records
from codelineage.storage import fresh_path

EX = "fx_examples"


@query("a7_filtered_dataset", f"SELECT repo_name, from_version, input_tokens_approx FROM {EX} WHERE contains(repo_name, 'src1') AND input_tokens_approx < 600")
def a7(x):
    return ops.filter_examples(x.examples(), "src1", 600).select("repo_name", "from_version", "input_tokens_approx")


@query("h1_approx_tokens", "SELECT doc_id, length(text) // 4 AS tokens FROM documents")
def h1(x):
    return x.table("documents").select("doc_id", text.approx_tokens(F.col("text")).alias("tokens"))


def size_sql(c, unit="bytes"):
    return f"""CASE WHEN {c} >= 1000000000 THEN concat(printf('%.2f', {c} / 1e9), ' GB') WHEN {c} >= 1000000 THEN concat(printf('%.2f', {c} / 1e6), ' MB')
        WHEN {c} >= 1000 THEN concat(printf('%.2f', {c} / 1e3), ' KB') ELSE concat(printf('%.0f', CAST({c} AS DOUBLE)), ' {unit}') END"""


@query("h14_human_size", f"SELECT doc_id, {size_sql('n')} AS long_unit, {size_sql('n', 'B')} AS short_unit FROM (SELECT doc_id, n_chars * (doc_id % 10) * (doc_id % 997) * 125 AS n FROM documents)")
def h14(x):
    n = F.col("n_chars") * (F.col("doc_id") % 10) * (F.col("doc_id") % 997) * 125
    return x.table("documents").select("doc_id", text.human_size(n).alias("long_unit"), text.human_size(n, "B").alias("short_unit"))


CATEGORY_SQL = "CASE WHEN {n} < 1000 THEN 'n<1K' WHEN {n} < 10000 THEN '1K<n<10K' WHEN {n} < 100000 THEN '10K<n<100K' WHEN {n} < 1000000 THEN '100K<n<1M' ELSE 'n>1M' END"


@query("h16_size_category", "SELECT doc_id, " + CATEGORY_SQL.format(n="doc_id * doc_id * 10") + " AS category FROM documents")
def h16(x):
    return x.table("documents").select("doc_id", text.size_category(F.col("doc_id") * F.col("doc_id") * 10).alias("category"))


COLUMNS = {"input_size": "length(input_text)", "output_size": "length(output_text)", "input_tokens": "input_tokens_approx",
           "output_tokens": "output_tokens_approx", "files_in_codebase": "num_files_in_codebase", "files_changed": "num_files_changed"}
STATS_SQL = "SELECT count(*) AS num_examples, count(DISTINCT repo_name) AS num_repos, " + ", ".join(
    f"round(avg({e}), 6) AS {n}_mean, min({e}) AS {n}_min, max({e}) AS {n}_max"
    + (f", CAST(sum({e}) AS BIGINT) AS {n}_total" if n in stats.SIZED else "") for n, e in COLUMNS.items()) + f" FROM {EX}"


def rounded(rows):
    return rows.withColumns({f"{n}_mean": F.round(f"{n}_mean", 6) for n in COLUMNS})


@query("d3_dataset_stats", STATS_SQL)
def d3(x):
    return rounded(stats.example_stats(x.examples()))


@query("d5_light_stats", STATS_SQL)
def d5(x):
    path = fresh_path(x.spark, "meta")
    ops.example_meta(x.examples()).write.parquet(path)
    return rounded(stats.dataset_stats(x.spark.read.parquet(path)))


@query("d4_examples_per_repo", f"SELECT repo_name, count(*) AS n FROM {EX} GROUP BY repo_name")
def d4(x):
    return stats.repo_counts(x.examples())


@query("f6_repos_by_name", f"SELECT repo_name, count(*) AS n FROM {EX} GROUP BY repo_name ORDER BY repo_name")
def f6(x):
    return stats.repo_counts(x.examples()).orderBy("repo_name")


@query("g4_split", f"""
    SELECT repo_name, from_version, CASE WHEN row_number() OVER (ORDER BY md5(concat_ws('|', '42', repo_name, from_version, to_version)), repo_name, from_version, to_version)
           <= CAST(floor(count(*) OVER () * 0.9) AS BIGINT) THEN 'train' ELSE 'validation' END AS split FROM {EX}""")
def g4(x):
    return ops.with_split(x.examples().drop("input_text", "output_text")).select("repo_name", "from_version", "split")


PROMPT = ops.DEFAULT_SYSTEM_PROMPT.replace("'", "''")


@query("i6_chat_format", f"""
    SELECT repo_name, from_version, CAST(m.pos AS INT) AS pos, m.role, md5(CASE m.pos WHEN 0 THEN '{PROMPT}' WHEN 1 THEN input_text ELSE output_text END) AS content_md5
    FROM {EX} CROSS JOIN (VALUES (0, 'system'), (1, 'user'), (2, 'assistant')) AS m(pos, role)""")
def i6(x):
    chat = ops.chat_examples(x.examples())
    return chat.select("metadata", F.posexplode("messages").alias("pos", "m")).select(
        "metadata.repo_name", "metadata.from_version", "pos", "m.role", F.md5("m.content").alias("content_md5"))


@query("i6_conversations", """
    SELECT conv_id, count(*) AS turns, string_agg(concat(role, ':', md5(text)), '|' ORDER BY turn) AS messages FROM conversations GROUP BY conv_id""")
def i6_conversations(x):
    message = F.concat("role", F.lit(":"), F.md5("text"))
    turns = x.table("conversations")
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    texts = text_parts(turns.withColumn("piece", message), ["conv_id"], ["turn"], separator="|")
    return counts.join(texts.select("conv_id", F.col("text").alias("messages")), "conv_id")


@query("i7_column_order", f"SELECT from_version, '{','.join(EXAMPLE_COLUMNS)}' AS column_names FROM {EX}")
def i7(x):
    rows = x.examples().select(*EXAMPLE_COLUMNS)
    return rows.select("from_version", F.lit(",".join(rows.columns)).alias("column_names"))


EXAMPLE = ["repo_name", "from_version", "to_version"]


def whole_texts(records):
    """Examples of the records that a sink has written."""
    return records.groupBy(*EXAMPLE).agg(
        *[joined(c, "part_no", "").alias(c) for c in ("input_text", "output_text")],
        *[F.max(c).alias(c) for c in ("input_tokens_approx", "num_dependencies")])


def chat_texts(x, path):
    """(example, roles, input_text, output_text, output_tokens_approx) of the chat records under ``path``."""
    rows = x.spark.read.schema(ops.chat_examples(x.records()).schema).json(path)
    text_of = lambda i: F.col("messages")[i]["content"]
    rows = rows.select("metadata.*", "part_no", F.size("messages").alias("roles"), text_of(1).alias("input_text"), text_of(2).alias("output_text"))
    return rows.groupBy(*EXAMPLE).agg(
        *[joined(c, "part_no", "").alias(c) for c in ("input_text", "output_text")], F.max("roles").alias("messages"), F.max("output_tokens_approx").alias("output_tokens_approx"))


READ_BACK = f"SELECT repo_name, from_version, to_version, md5(input_text) AS input_md5, md5(output_text) AS output_md5, input_tokens_approx, num_dependencies FROM {EX}"


def read_back(rows):
    return whole_texts(rows).select("repo_name", "from_version", "to_version", F.md5("input_text").alias("input_md5"),
                       F.md5("output_text").alias("output_md5"), "input_tokens_approx", "num_dependencies")


@query("i8_jsonl_sink", READ_BACK)
def i8(x):
    path = fresh_path(x.spark, "jsonl") + ".jsonl"
    sinks.save_examples_jsonl(x.records(), path)
    return read_back(read_records(x.spark, path))


@query("i9_chat_sink", f"SELECT repo_name, from_version, 3 AS messages, md5(input_text) AS user_md5, md5(output_text) AS assistant_md5, output_tokens_approx FROM {EX}")
def i9(x):
    path = fresh_path(x.spark, "chat")
    sinks.save_examples_chat_jsonl(x.records(), path)
    return chat_texts(x, path).select(
        "repo_name", "from_version", "messages", F.md5("input_text").alias("user_md5"), F.md5("output_text").alias("assistant_md5"), "output_tokens_approx")


@query("i10_parquet_sink", READ_BACK)
def i10(x):
    path = fresh_path(x.spark, "out") + ".parquet"
    sinks.save_examples_parquet(x.records(), path)
    return read_back(read_records(x.spark, path))


MEAN = "CAST({c}_mean AS DOUBLE)"


def commas_sql(c):
    return f"format('{{:,}}', CAST({c} AS BIGINT))"


def mean_sql(c):
    return f"format('{{:,}}', CAST(round_even({c}_mean, 0) AS BIGINT))"


def table_sql(size, tokens, mark=""):
    """Values of the mean, min and max rows of one side."""
    rows = [(f"{size}_mean", mean_sql(tokens)), (f"{size}_min", commas_sql(f"{tokens}_min")), (f"{size}_max", commas_sql(f"{tokens}_max"))]
    return [(size_sql(s), f"concat('{mark}', {t})") for s, t in rows]


def line_sql(label, *cells):
    return f"concat('| {label}', " + ", ".join(f"' | ', {c}" for c in cells) + ", ' |')"


UNROUNDED = STATS_SQL.replace("round(", "(").replace(", 6)", ")")
REPORT = [
    "'# SFT Dataset Statistics'", "''", "'## Overview'", "'| Metric | Value |'", "'|--------|-------|'",
    line_sql("Total Examples", commas_sql("num_examples")), line_sql("Unique Repositories", "num_repos"),
    line_sql("Total Input Size", size_sql("input_size_total")), line_sql("Total Output Size", size_sql("output_size_total")),
    line_sql("Total Tokens (approx)", commas_sql("input_tokens_total + output_tokens_total")), "''",
]
for heading, side in (("Input Statistics (Codebase)", "input"), ("Output Statistics (Diff)", "output")):
    REPORT += [f"'## {heading}'", "'| Metric | Characters | Tokens (approx) |'", "'|--------|------------|-----------------|'"]
    REPORT += [line_sql(label, *cells) for label, cells in zip(("Mean", "Min", "Max"), table_sql(f"{side}_size", f"{side}_tokens"))]
    REPORT.append("''")
REPORT += ["'## File Statistics'", "'| Metric | Files in Codebase | Files Changed |'", "'|--------|-------------------|---------------|'"]
REPORT += [line_sql("Mean", mean_sql("files_in_codebase"), mean_sql("files_changed"))]
REPORT += [line_sql(n.title(), commas_sql(f"files_in_codebase_{n}"), commas_sql(f"files_changed_{n}")) for n in ("min", "max")]
REPORT += ["''", "'## Repositories'"]


def light(x):
    meta = ops.example_meta(x.examples())
    return stats.dataset_stats(meta), stats.repo_counts(meta)


REPORT_SQL = "SELECT line_no, repo_name, line FROM (" + " UNION ALL ".join(
    f"SELECT {i} AS line_no, '' AS repo_name, {line} AS line FROM ({UNROUNDED})" for i, line in enumerate(REPORT)) + f"""
    UNION ALL SELECT {len(REPORT)}, repo_name, concat('- **', repo_name, '**: ', count(*), ' examples') FROM {EX} GROUP BY repo_name)"""


@query("i12_stats_report", REPORT_SQL)
def i12(x):
    return stats.stats_report(*light(x))


CARD = [("overview", "size_category", CATEGORY_SQL.format(n="num_examples"), "''"), ("overview", "total_examples", commas_sql("num_examples"), "''"),
        ("overview", "repositories", "CAST(num_repos AS VARCHAR)", "''"), ("overview", "total_size", size_sql("(input_size_total + output_size_total)"), "''")]
for side in ("input", "output"):
    CARD += [(side, n, *cells) for n, cells in zip(("mean", "min", "max"), table_sql(f"{side}_size", f"{side}_tokens", "~"))]


CARD_SQL = " UNION ALL ".join(
    f"SELECT '{s}' AS section, '{i}' AS item, {size} AS size, {tokens} AS tokens FROM ({UNROUNDED})" for s, i, size, tokens in CARD
) + f" UNION ALL SELECT DISTINCT 'sources', repo_name, '', '' FROM {EX}"


@query("i13_card_stats", CARD_SQL)
def i13(x):
    return stats.card_stats(*light(x))


SUMMARY = [("complete", "examples", "CAST(num_examples AS VARCHAR)", "''"), ("complete", "repositories", "CAST(num_repos AS VARCHAR)", "''"),
           ("complete", "total_size", size_sql("(input_size_total + output_size_total)", "B"), "''")]
SUMMARY += [("table", f"{n.title()} Size", size_sql(f"input_size_{n}", "B"), size_sql(f"output_size_{n}", "B")) for n in ("mean", "min", "max")]
SUMMARY.append(("table", "Mean Tokens", mean_sql("input_tokens"), mean_sql("output_tokens")))


@query("i14_summary_view", " UNION ALL ".join(
    f"SELECT '{s}' AS section, '{m}' AS metric, {a} AS input, {b} AS output FROM ({UNROUNDED})" for s, m, a, b in SUMMARY)
    + f" UNION ALL SELECT 'breakdown', repo_name, concat(count(*), ' examples'), '' FROM {EX} GROUP BY repo_name")
def i14(x):
    return stats.summary_view(*light(x))


WRITTEN_SQL = f"SELECT '{{kind}}' AS kind, concat(repo_name, '|', from_version) AS item, md5(concat(input_text, output_text)) AS content_md5 FROM {EX}"


@query("i11_save_dataset", " UNION ALL ".join(WRITTEN_SQL.format(kind=k) for k in ("jsonl", "chat", "parquet")) + f"""
    UNION ALL SELECT 'stats', '', md5(line) FROM ({REPORT_SQL})
    UNION ALL SELECT 'card', concat(section, '|', item), md5(concat(size, tokens)) FROM ({CARD_SQL})""")
def i11(x):
    folder, spark = fresh_path(x.spark, "dataset"), x.spark
    sinks.save_dataset(x.records(), folder, "both")
    item = F.concat_ws("|", "repo_name", "from_version")
    both = F.md5(F.concat("input_text", "output_text"))
    outputs = [
        ("jsonl", whole_texts(read_records(spark, f"{folder}/dataset.jsonl")), item, both),
        ("parquet", whole_texts(read_records(spark, f"{folder}/dataset.parquet")), item, both),
        ("chat", chat_texts(x, f"{folder}/dataset_chat.jsonl"), item, both),
        ("stats", spark.read.text(f"{folder}/stats.md"), F.lit(""), F.md5("value")),
        ("card", spark.read.schema("section string, item string, size string, tokens string").json(f"{folder}/card"),
         F.concat_ws("|", "section", "item"), F.md5(F.concat("size", "tokens"))),
    ]
    rows = [table.select(F.lit(kind).alias("kind"), name.alias("item"), digest.alias("content_md5")) for kind, table, name, digest in outputs]
    return reduce(DataFrame.unionByName, rows)
