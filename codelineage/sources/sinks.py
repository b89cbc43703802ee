"""Outputs of a run: JSON lines, chat JSON lines, Parquet, statistics, card figures."""

from __future__ import annotations

from pyspark.sql import DataFrame

from codelineage.operators.discover import config_from
from codelineage.operators.examples import DEFAULT_SYSTEM_PROMPT, as_records, chat_examples, example_meta
from codelineage.operators.stats import card_stats, dataset_stats, repo_counts, stats_report
from codelineage.plans.dataset import Dataset
from codelineage.settings import Settings
from codelineage.sources.tables import read_records
from codelineage.storage import written


def save_jsonl(rows: DataFrame, path: str, compress: bool = True, mode: str = "errorifexists") -> None:
    """ASCII-only JSON lines with every field present, one part file per task.

    Compressed at the fastest level: the usual one takes four times as long as all else in writing them, for files a seventh smaller.
    """
    writer = rows.write.mode(mode).option("writeNonAsciiCharacterAsCodePoint", "true").option("zlib.compress.level", "BEST_SPEED")
    writer.json(path, compression="gzip" if compress else "none", ignoreNullFields=False)


def save_examples_jsonl(examples: DataFrame, path: str, compress: bool = True, mode: str = "errorifexists") -> None:
    save_jsonl(as_records(examples), path, compress, mode)


def save_examples_chat_jsonl(
    examples: DataFrame, path: str, system_prompt: str | None = DEFAULT_SYSTEM_PROMPT,
    compress: bool = True, mode: str = "errorifexists",
) -> None:
    save_jsonl(chat_examples(as_records(examples), system_prompt), path, compress, mode)


def save_examples_parquet(examples: DataFrame, path: str, mode: str = "errorifexists") -> None:
    as_records(examples).write.mode(mode).parquet(path, compression="snappy")


def save_report(examples_or_meta: DataFrame, folder: str, mode: str = "errorifexists") -> None:
    """stats.md (sorted text parts) and the figures of the dataset card."""
    is_meta = "input_size" in examples_or_meta.columns
    meta = written(examples_or_meta if is_meta else example_meta(examples_or_meta), "meta")
    stats, counts = dataset_stats(meta), repo_counts(meta)
    report = stats_report(stats, counts).orderBy("line_no", "repo_name").select("line")
    report.write.mode(mode).text(f"{folder}/stats.md")
    card_stats(stats, counts).orderBy("section", "item").write.mode(mode).json(f"{folder}/card")


def save_dataset(
    built: Dataset | DataFrame,
    folder: str,
    output_format: str = "jsonl",
    system_prompt: str | None = DEFAULT_SYSTEM_PROMPT,
    compress: bool = True,
    mode: str = "errorifexists",
) -> None:
    """Write the examples in the asked formats, then statistics and card figures.

    All formats hold records, a line or row for each part of an example's texts. They are computed once: the Parquet output
    (or, without one, a table in the shared folder) feeds every other output.
    """
    Settings(output_format=output_format)
    examples = built if isinstance(built, DataFrame) else built.examples
    if output_format == "jsonl":
        rows = written(as_records(examples), "examples")
    else:
        save_examples_parquet(examples, f"{folder}/dataset.parquet", mode)
        rows = read_records(examples.sparkSession, f"{folder}/dataset.parquet")
    if output_format in ("jsonl", "both"):
        save_examples_jsonl(rows, f"{folder}/dataset.jsonl", compress, mode)
        save_examples_chat_jsonl(rows, f"{folder}/dataset_chat.jsonl", system_prompt, compress, mode)
    save_report(example_meta(rows), folder, mode)


def save_config(repos: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Configuration rows of discovered repositories, readable by the config source."""
    config_from(repos).write.mode(mode).json(path)
