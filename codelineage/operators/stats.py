"""Dataset statistics and the reports made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelineage.functions.text import commas, human_size, size_category
from codelineage.operators.examples import example_meta

SIZED = ["input_size", "output_size", "input_tokens", "output_tokens"]
COUNTED = ["files_in_codebase", "files_changed"]
SOURCE_COLUMN = {
    "input_size": "input_size", "output_size": "output_size",
    "input_tokens": "input_tokens_approx", "output_tokens": "output_tokens_approx",
    "files_in_codebase": "num_files_in_codebase", "files_changed": "num_files_changed",
}


def dataset_stats(meta: DataFrame) -> DataFrame:
    """One row of statistics from light rows; no row for an empty dataset."""
    aggregates = [F.count(F.lit(1)).alias("num_examples"), F.count_distinct("repo_name").alias("num_repos")]
    for name, source in SOURCE_COLUMN.items():
        aggregates += [
            F.avg(source).alias(f"{name}_mean"), F.min(source).alias(f"{name}_min"), F.max(source).alias(f"{name}_max"),
        ]
        if name in SIZED:
            aggregates.append(F.sum(source).alias(f"{name}_total"))
    return meta.agg(*aggregates).filter(F.col("num_examples") > 0)


def example_stats(examples: DataFrame) -> DataFrame:
    """The same statistics from full examples."""
    return dataset_stats(example_meta(examples))


def repo_counts(examples: DataFrame) -> DataFrame:
    return examples.groupBy("repo_name").agg(F.count(F.lit(1)).alias("n"))


def _row(*cells: Column | str) -> Column:
    """One line of a Markdown table."""
    values = [F.lit(c) if isinstance(c, str) else c for c in cells]
    return F.concat(F.lit("| "), F.concat_ws(" | ", *values), F.lit(" |"))


def _numbered(stats: DataFrame, lines: list[Column | str]) -> DataFrame:
    texts = F.array(*[F.lit(x) if isinstance(x, str) else x for x in lines])
    return stats.select(F.posexplode(texts).alias("line_no", "line"))


def _three_rows(*columns) -> list[Column]:
    """Mean, min and max lines; each column gives a formatter per row."""
    return [_row(label, *[c(which) for c in columns]) for label, which in
            (("Mean", "mean"), ("Min", "min"), ("Max", "max"))]


def _size(name, unit="bytes"):
    return lambda which: human_size(F.col(f"{name}_{which}"), unit)


def _number(name, prefix=""):
    return lambda which: F.concat(F.lit(prefix), commas(F.col(f"{name}_{which}")))


def stats_report(stats: DataFrame, counts: DataFrame) -> DataFrame:
    """Lines of the Markdown report as (line_no, repo_name, line); sort by the first two.

    Repository lines share the last line_no and are told apart by their name. No
    rows for an empty dataset.
    """
    two, three = "|--------|-------|", "|--------|------------|-----------------|"
    both_tokens = F.col("input_tokens_total") + F.col("output_tokens_total")
    fixed = [
        # The headings and labels of the report.
        "# SFT Dataset Statistics", "",
        "## Overview", _row("Metric", "Value"), two,
        _row("Total Examples", commas(F.col("num_examples"))),
        _row("Unique Repositories", F.col("num_repos").cast("string")),
        _row("Total Input Size", human_size(F.col("input_size_total"))),
        _row("Total Output Size", human_size(F.col("output_size_total"))),
        _row("Total Tokens (approx)", commas(both_tokens)), "",
        "## Input Statistics (Codebase)", _row("Metric", "Characters", "Tokens (approx)"), three,
        *_three_rows(_size("input_size"), _number("input_tokens")), "",
        "## Output Statistics (Diff)", _row("Metric", "Characters", "Tokens (approx)"), three,
        *_three_rows(_size("output_size"), _number("output_tokens")), "",
        "## File Statistics", _row("Metric", "Files in Codebase", "Files Changed"),
        "|--------|-------------------|---------------|",
        *_three_rows(_number("files_in_codebase"), _number("files_changed")), "",
        "## Repositories",
    ]
    head = _numbered(stats, fixed).select("line_no", F.lit("").alias("repo_name"), "line")
    per_repo = counts.select(
        F.lit(len(fixed)).alias("line_no"), "repo_name",
        F.concat(F.lit("- **"), F.col("repo_name"), F.lit("**: "), F.col("n").cast("string"), F.lit(" examples")).alias("line"),
    )
    return head.unionByName(per_repo)


def card_stats(stats: DataFrame, counts: DataFrame) -> DataFrame:
    """Figures of the dataset card as (section, item, size, tokens), plus its source repositories."""
    none = F.lit("")
    total = human_size(F.col("input_size_total") + F.col("output_size_total"))

    def entry(section, item, size, tokens=none):
        return F.struct(F.lit(section).alias("section"), F.lit(item).alias("item"), size.alias("size"), tokens.alias("tokens"))

    entries = [
        entry("overview", "size_category", size_category(F.col("num_examples"))),
        entry("overview", "total_examples", commas(F.col("num_examples"))),
        entry("overview", "repositories", F.col("num_repos").cast("string")),
        entry("overview", "total_size", total),
    ]
    for side in ("input", "output"):
        size, tokens = _size(f"{side}_size"), _number(f"{side}_tokens", "~")
        entries += [entry(side, which, size(which), tokens(which)) for which in ("mean", "min", "max")]
    figures = stats.select(F.inline(F.array(*entries)))
    sources = counts.select(F.lit("sources").alias("section"), F.col("repo_name").alias("item"), none.alias("size"), none.alias("tokens"))
    return figures.unionByName(sources)


def summary_view(stats: DataFrame, counts: DataFrame) -> DataFrame:
    """Summary shown after a run: (section, metric, input, output)."""
    def entry(section, metric, left, right=F.lit("")):
        return F.struct(F.lit(section).alias("section"), F.lit(metric).alias("metric"), left.alias("input"), right.alias("output"))

    left, right = _size("input_size", "B"), _size("output_size", "B")
    total = human_size(F.col("input_size_total") + F.col("output_size_total"), "B")
    entries = [
        entry("complete", "examples", F.col("num_examples").cast("string")),
        entry("complete", "repositories", F.col("num_repos").cast("string")),
        entry("complete", "total_size", total),
    ]
    entries += [entry("table", f"{which.title()} Size", left(which), right(which)) for which in ("mean", "min", "max")]
    entries.append(entry("table", "Mean Tokens", _number("input_tokens")("mean"), _number("output_tokens")("mean")))
    per_repo = counts.select(
        F.lit("breakdown").alias("section"), F.col("repo_name").alias("metric"),
        F.concat(F.col("n").cast("string"), F.lit(" examples")).alias("input"), F.lit("").alias("output"))
    return stats.select(F.inline(F.array(*entries))).unionByName(per_repo)
