"""Files of a release: classification, size budget, totals, single-file lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelineage import dims
from codelineage.functions.text import commas, decoded, extension, text_mode
from codelineage.operators.joins import lookup_join, salted_join
from codelineage.operators.ordered import with_order
from codelineage.settings import Settings
from codelineage.storage import written

HEAD_BYTES = 8192
FILE_KEY = ["repo", "version", "path"]


def raw_files(files: DataFrame) -> DataFrame:
    """Complete (repo, version, path, content BINARY) to the raw file layout.

    ``head`` and ``content_sha`` are stored beside the content so that
    classification and change detection never read the large column.
    """
    return files.select(
        *FILE_KEY,
        "content",
        F.octet_length("content").cast("long").alias("size"),
        F.substring("content", 1, HEAD_BYTES).alias("head"),
        F.sha2("content", 256).alias("content_sha"),
    )


def looks_binary(head: Column) -> Column:
    """NUL byte in the head, or a head that is not valid UTF-8."""
    has_nul = F.position(F.lit(b"\x00"), head) > 0
    return has_nul | ~F.is_valid_utf8(head.cast("string"))


def binary_stub(kind: Column, size: Column) -> Column:
    return F.concat(F.lit("[BINARY "), kind, F.lit(": "), commas(size), F.lit(" bytes]"))


def oversize_stub(size: Column) -> Column:
    return F.concat(F.lit("[FILE TOO LARGE: "), commas(size), F.lit(" bytes - content omitted]"))


def with_language(files: DataFrame) -> DataFrame:
    known = F.broadcast(dims.languages(files.sparkSession))
    return (
        files.withColumn("ext", extension(F.col("path")))
        .join(known, "ext", "left")
        .withColumn("language", F.coalesce("language", F.lit("unknown")))
    )


def with_stub(files: DataFrame, settings: Settings = Settings(), binary_extensions: list[str] | None = None) -> DataFrame:
    """Add language and ``stub``: the placeholder text, NULL where the content is kept.

    Needs path, size and head only. Order of the rules: known binary extension,
    too large, binary by content.
    """
    kinds = F.broadcast(dims.binary_types(files.sparkSession, binary_extensions))
    oversize = F.lit(False) if settings.max_file_size is None else F.col("size") > settings.max_file_size
    by_content = F.coalesce(F.col("kind"), F.lit("FILE"))
    return (
        with_language(files)
        .join(kinds, "ext", "left")
        .withColumn(
            "stub",
            F.when(F.col("kind").isNotNull(), binary_stub(F.col("kind"), F.col("size")))
            .when(oversize, oversize_stub(F.col("size")))
            .when(looks_binary(F.col("head")), binary_stub(by_content, F.col("size"))),
        )
        .drop("ext", "kind")
    )


def classified(files: DataFrame, settings: Settings = Settings(), binary_extensions: list[str] | None = None) -> DataFrame:
    """snapshot_files without a size budget: text or stub for every file."""
    text = F.coalesce("stub", text_mode(decoded(F.col("content"))))
    carried = [c for c in files.columns if c not in (*FILE_KEY, "content", "size", "head", "content_sha")]
    return with_stub(files, settings, binary_extensions).select(
        *carried,
        *FILE_KEY,
        text.alias("content"),
        shown_size().alias("size"),
        "language",
        F.col("stub").isNotNull().alias("is_binary_stub"),
    )


def shown_size() -> Column:
    """Size counted for a file: the stub's length, or the bytes on disk."""
    return F.coalesce(F.length("stub").cast("long"), F.col("size"))


def file_sizes(files: DataFrame, settings: Settings = Settings(), binary_extensions: list[str] | None = None) -> DataFrame:
    """Every file with the size the budget counts; no file content is read."""
    carried = [c for c in files.columns if c not in (*FILE_KEY, "content", "size", "head", "content_sha")]
    return with_stub(files, settings, binary_extensions).select(*carried, *FILE_KEY, shown_size().alias("size"))


def budget_cutoffs(
    sizes: DataFrame, max_codebase_size: int | None, key: tuple[str, ...] = ("repo", "version")
) -> DataFrame | None:
    """First path left out per snapshot, for the snapshots that exceed the budget; None without a budget.

    A file stays while the total before it (in path order) is below the budget.
    Totals are pre-aggregated, so only snapshots above the budget are ordered.
    """
    if max_codebase_size is None:
        return None
    over = sizes.groupBy(*key).agg(F.sum("size").alias("_total")).filter(F.col("_total") > max_codebase_size)
    over = written(over.select(*key), "over_budget")
    crowded = lookup_join(sizes, over, list(key), F.col("path"), "left_semi")
    ordered = with_order(crowded.select(*key, "path", "size"), list(key), ["path"], sum_before={"before": "size"})
    cutoffs = ordered.filter(F.col("before") >= max_codebase_size).groupBy(*key).agg(F.min("path").alias("cutoff_path"))
    return written(cutoffs, "cutoffs")


def within_budget(files: DataFrame, cutoffs: DataFrame | None, key: tuple[str, ...] = ("repo", "version")) -> DataFrame:
    if cutoffs is None:
        return files
    kept = lookup_join(files, cutoffs, list(key), F.col("path"), "left")
    return kept.filter(F.col("cutoff_path").isNull() | (F.col("path") < F.col("cutoff_path"))).drop("cutoff_path")


def snapshot_files(files: DataFrame, settings: Settings = Settings(), binary_extensions: list[str] | None = None) -> DataFrame:
    """Classified files of every snapshot, cut at the size budget.

    Only the cut-off path per over-budget snapshot is joined back, so file
    contents are filtered in place and never ordered.
    """
    sizes = file_sizes(files.select(*FILE_KEY, "size", "head"), settings, binary_extensions)
    cutoffs = budget_cutoffs(sizes, settings.max_codebase_size)
    return classified(within_budget(files, cutoffs), settings, binary_extensions)


def snapshot_totals(sizes: DataFrame) -> DataFrame:
    return sizes.groupBy("repo", "version").agg(
        F.count(F.lit(1)).alias("num_files"), F.sum("size").alias("total_size")
    )


def files_at(requests: DataFrame, files: DataFrame) -> DataFrame:
    """Text of each requested (repo, version, path), NULL where there is no such file.

    The keys are looked up first, so that only requested contents are moved.
    """
    wanted = requests.select(*FILE_KEY).distinct()
    found = lookup_join(files.select(*FILE_KEY, "content"), wanted, FILE_KEY, None, "left_semi")
    return requests.join(found.select(*FILE_KEY, decoded(F.col("content")).alias("text")), FILE_KEY, "left")
