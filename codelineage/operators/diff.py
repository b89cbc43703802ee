"""Differences between the two releases of a pair, as joins on content hashes."""

from __future__ import annotations

import difflib
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codelineage.functions.patterns import in_diff, in_diff_by
from codelineage.functions.text import (
    basename, decoded, line_count, lines_marked, lines_starting, lines_with_ends,
)
from codelineage.operators.joins import lookup_join, salted_join
from codelineage.operators.ordered import with_order
from codelineage.operators.trees import PAIR, change_type, old_and_new, sides, tree_changes
from codelineage.settings import Settings
from codelineage.storage import written

# Workers get the diff function by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TRUNCATED = "\n... [truncated, diff too large] ..."


def path_changes(pairs: DataFrame, files: DataFrame) -> DataFrame:
    """Changed paths of every pair with the hashes before and after.

    A full outer join of the two trees on path, written as one grouping: each
    file is read once, tagged with the pairs it belongs to, and the two sides
    meet under (pair, path). Unchanged contents drop out. No content is read.
    """
    tagged = lookup_join(
        files.select("repo", "version", "path", F.col("content_sha").alias("sha")), sides(pairs), ["repo", "version"], F.col("path"))
    return (
        old_and_new(tagged, [*PAIR, "path"], "sha")
        .filter(~F.col("old_sha").eqNullSafe(F.col("new_sha")))
        .withColumn("change_type", change_type(F.col("old_sha"), F.col("new_sha")))
    )


def pair_renames(changes: DataFrame) -> DataFrame:
    """Turn deleted + added paths with equal content into one renamed row.

    Sources and targets are matched one to one: first those that keep their file
    name, then the rest, each time in path order. Both sides are numbered within
    their hash, so the join is on equal keys and yields at most one row per file.
    """
    one_sided = changes.filter("change_type <> 'modified'").select(
        *PAIR, F.coalesce("old_sha", "new_sha").alias("sha"), "path", basename(F.col("path")).alias("name"),
        F.col("old_sha").isNotNull().alias("is_old"))
    same_name, rest = _matched(_on_both_sides(one_sided), [*PAIR, "sha", "name"])
    renames = same_name.unionByName(_matched(_on_both_sides(rest), [*PAIR, "sha"])[0])

    renamed = renames.select(
        *PAIR, F.col("new_path").alias("path"), "old_path", F.lit("renamed").alias("change_type"),
        F.col("sha").alias("old_sha"), F.col("sha").alias("new_sha"),
    )
    return _with_renamed(changes.withColumn("old_path", F.lit(None).cast("string")), renamed)


def _with_renamed(changes: DataFrame, renamed: DataFrame) -> DataFrame:
    """Replace the deleted and the added row of each rename by the renamed row."""
    columns = [*PAIR, "path", "old_path", "change_type", "old_sha", "new_sha"]
    used = renamed.select(*PAIR, F.explode(F.array(
        F.struct(F.col("old_path").alias("path"), F.lit("deleted").alias("change_type")),
        F.struct(F.col("path"), F.lit("added").alias("change_type")),
    )).alias("use")).select(*PAIR, "use.*")
    kept = changes.join(used, [*PAIR, "path", "change_type"], "left_anti")
    return kept.select(columns).unionByName(renamed.select(columns))


def _on_both_sides(rows: DataFrame) -> DataFrame:
    """Rows whose hash was both deleted and added in the pair."""
    hashes = (
        rows.groupBy(*PAIR, "sha")
        .agg(F.bool_or("is_old").alias("some_old"), F.bool_and("is_old").alias("all_old"))
        .filter("some_old AND NOT all_old")
        .select(*PAIR, "sha")
    )
    return salted_join(rows, hashes, [*PAIR, "sha"], F.col("path"), "left_semi")


def _matched(rows: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """n-th deleted path with the n-th added path under the same keys, and the rows left over.

    Paths are put in order only under keys with several on a side; the others meet in the grouping that tells them apart.
    """
    old, new = F.when(F.col("is_old"), F.col("path")), F.when(~F.col("is_old"), F.col("path"))
    groups = written(rows.groupBy(*keys).agg(
        F.count(old).alias("gone"), F.count(new).alias("came"), F.max(old).alias("old_path"), F.max(new).alias("new_path")), "groups")
    single = (F.col("gone") <= 1) & (F.col("came") <= 1)
    few = groups.filter(single).drop("gone", "came")
    crowded = groups.filter(~single).select(*keys)
    many = written(salted_join(rows, crowded, keys, F.col("path"), "left_semi"), "crowded")
    numbered = with_order(many, [*keys, "is_old"], ["path"], number="place")
    couples = few.unionByName(numbered.groupBy(*keys, "place").agg(F.max(old).alias("old_path"), F.max(new).alias("new_path")).drop("place"))
    complete = F.col("old_path").isNotNull() & F.col("new_path").isNotNull()
    left = couples.filter(~complete).select(
        *PAIR, "sha", F.coalesce("old_path", "new_path").alias("path"), F.col("old_path").isNotNull().alias("is_old"))
    left = left.withColumn("name", basename(F.col("path")))
    return couples.filter(complete).select(*PAIR, "sha", "old_path", "new_path"), left


def near_renames(changes: DataFrame, files: DataFrame, threshold: float) -> DataFrame:
    """Turn deleted + added files of similar content into renamed rows, whatever their names.

    The score of two contents is the bytes of the lines both have (a line as often as in the content that has it
    less often), as a share of the larger content. Those of ``threshold`` (above 0, at most 1) or more are matched one to one,
    the best score of a pair first; ties go to the content with the smallest deleted path, then added path. Files of
    one content are matched in path order. Contents without a line match nothing.
    """
    if not 0 < threshold <= 1:
        raise ValueError("near_threshold: must lie above 0, at most 1")
    is_old = F.col("old_sha").isNotNull()
    loose = changes.filter("change_type IN ('added', 'deleted')").select(
        *PAIR, "path", F.coalesce("old_sha", "new_sha").alias("sha"), is_old.alias("is_old"))
    both = loose.groupBy(*PAIR).agg(F.bool_or("is_old").alias("some_old"), F.bool_and("is_old").alias("all_old")).filter("some_old AND NOT all_old")
    loose = salted_join(loose, both.select(*PAIR), PAIR, F.col("path"), "left_semi")
    # Contents go by 16 bytes, as their lines do: every line of every content carries them through the shuffles.
    loose = written(loose.withColumn("name", F.col("sha")).withColumn("sha", F.unhex(F.md5("sha"))), "loose")
    named = written(loose.select("sha", "name").distinct(), "names")
    loose = loose.drop("name")
    couples = similar_contents(loose, *content_lines(loose, files), threshold)
    renamed = _best_first(loose, couples).select(
        *PAIR, F.col("new_path").alias("path"), "old_path", F.lit("renamed").alias("change_type"), "old_sha", "new_sha")
    for side in ("old_sha", "new_sha"):
        renamed = renamed.join(named.select(F.col("sha").alias(side), "name"), side).drop(side).withColumnRenamed("name", side)
    return _with_renamed(changes, written(renamed, "near_renames"))


# Lines of more contents than this are looked up in a broadcast table, so that no task receives all rows of one line.
HOT_CONTENTS = 1 << 12


def content_lines(loose: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(sha, total) of the contents of ``loose`` that have lines, and their lines that stand in several contents, by rarity.

    The lines are (sha, line, n, bytes, total, before): ``line`` is a hash of 128 bits, n its count, bytes the size of all its copies;
    ``total`` is the size of the content and ``before`` that of its rarer lines, those of no other content among them. Each content
    is read once, however many pairs and paths have it. Its lines, which are no more than one file, are put in order by one window.
    """
    version = F.when(F.col("is_old"), F.col("from_version")).otherwise(F.col("to_version"))
    place = loose.groupBy("sha").agg(F.min(F.struct("repo", version.alias("version"), "path")).alias("place")).select("sha", "place.*")
    texts = lookup_join(files.select("repo", "version", "path", "content"), place, ["repo", "version", "path"], None).select(
        "sha", F.explode_outer(lines_with_ends(decoded(F.col("content")))).alias("text")).filter("text IS NOT NULL")
    lines = written(
        texts.select("sha", F.unhex(F.md5("text")).alias("line"), F.octet_length("text").cast("long").alias("size")).groupBy("sha", "line").agg(
            F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")), "lines")
    several = written(lines.groupBy("line").agg(F.count(F.lit(1)).alias("contents")).filter("contents > 1"), "frequency")
    hot = several.filter(F.col("contents") > HOT_CONTENTS)
    rare, rows = several.filter(F.col("contents") <= HOT_CONTENTS), lines.join(F.broadcast(hot.select("line")), "line", "left_anti")
    shared = lookup_join(rows, rare, ["line"], None).unionByName(lines.join(F.broadcast(hot), "line"))
    totals = written(lines.groupBy("sha").agg(F.sum("bytes").alias("total")), "totals")
    whole = Window.partitionBy("sha")
    earlier = whole.orderBy("contents", "line").rowsBetween(Window.unboundedPreceding, -1)
    ordered = shared.join(totals, "sha").withColumn(
        "before", F.col("total") - F.sum("bytes").over(whole) + F.coalesce(F.sum("bytes").over(earlier), F.lit(0)))
    return totals, written(ordered.select("sha", "line", "n", "bytes", "total", "before"), "content_lines")


def similar_contents(loose: DataFrame, totals: DataFrame, lines: DataFrame, threshold: float) -> DataFrame:
    """(pair, old_sha, new_sha, score) of the contents of each pair that score ``threshold`` or more; none is missed.

    A content that stands on both sides scores 1. For two different ones an inverted index of rare lines proposes them: such contents share a line that stands, in the order of
    rarity, before the last ``threshold`` share of both, since all they share stands at or behind the first of them.
    What stands behind that line also bounds the score. Only contents proposed are compared by all their lines.
    """
    classes = loose.select(*PAIR, "sha", "is_old").distinct()
    same = classes.groupBy(*PAIR, "sha").agg(F.count(F.lit(1)).alias("sides")).filter("sides = 2").join(totals, "sha", "left_semi").select(
        *PAIR, F.col("sha").alias("old_sha"), F.col("sha").alias("new_sha"), F.lit(1.0).alias("score"))
    rest = F.col("total") - F.col("before")
    rare = lines.filter(rest >= F.col("total") * threshold).select("sha", "line", "total", rest.alias("rest"))
    postings = written(classes.join(rare, "sha"), "postings")
    side = lambda is_old, name: postings.filter(F.col("is_old") == is_old).select(
        *PAIR, "line", *[F.col(c).alias(f"{name}_{c}") for c in ("sha", "total", "rest")])
    larger = F.greatest("old_total", "new_total")
    proposed = side(True, "old").join(side(False, "new"), [*PAIR, "line"]).filter(
        (F.col("old_sha") != F.col("new_sha")) & (F.least("old_total", "new_total") >= larger * threshold) & (F.least("old_rest", "new_rest") >= larger * threshold))
    proposed = written(proposed.select("old_sha", "new_sha", larger.alias("larger"), *PAIR).distinct(), "proposed")
    couples = proposed.select("old_sha", "new_sha", "larger").distinct()
    counts = lambda name: lines.select(F.col("sha").alias(f"{name}_sha"), "line", F.col("n").alias(f"{name}_n"), (F.col("bytes") / F.col("n")).cast("long").alias("size"))
    shared = (
        couples.join(counts("old"), "old_sha").join(counts("new").drop("size"), ["new_sha", "line"])
        .groupBy("old_sha", "new_sha", "larger").agg(F.sum(F.least("old_n", "new_n") * F.col("size")).alias("shared"))
        .filter(F.col("shared") >= F.col("larger") * threshold)
        .select("old_sha", "new_sha", (F.col("shared") / F.col("larger")).alias("score")))
    return proposed.drop("larger").join(shared, ["old_sha", "new_sha"]).select(*PAIR, "old_sha", "new_sha", "score").unionByName(same)


def _best_first(loose: DataFrame, couples: DataFrame) -> DataFrame:
    """(pair, old_sha, new_sha, old_path, new_path): files matched one to one, the best couple of contents of each pair first.

    In every round the couples that are the best of both their contents are settled at once, which gives what taking
    one after the other would. A couple takes as many files as the content with fewer has left; contents
    without files left leave, and the rounds end when no couple is left.
    """
    contents = written(loose.groupBy(*PAIR, "sha", "is_old").agg(F.min("path").alias("first"), F.count(F.lit(1)).alias("left")), "contents")
    side = lambda is_old, name: contents.filter(F.col("is_old") == is_old).select(
        *PAIR, *[F.col(c).alias(f"{name}_{c}") for c in ("sha", "first", "left")], F.lit(0).cast("long").alias(f"{name}_used"))
    open_ = written(couples.join(side(True, "old"), [*PAIR, "old_sha"]).join(side(False, "new"), [*PAIR, "new_sha"]), "couples")
    order = [F.desc("score"), "old_first", "new_first"]
    best_of = lambda name: F.row_number().over(Window.partitionBy(*PAIR, f"{name}_sha").orderBy(*order)) == 1
    settled = []
    while not open_.isEmpty():
        best = open_.withColumns({"best_old": best_of("old"), "best_new": best_of("new")}).filter("best_old AND best_new")
        best = written(best.withColumn("taken", F.least("old_left", "new_left")), "best")
        settled.append(best)
        for name in ("old", "new"):
            key = [*PAIR, f"{name}_sha"]
            open_ = open_.join(best.select(*key, F.col("taken").alias(f"{name}_taken")), key, "left").withColumn(f"{name}_taken", F.coalesce(f"{name}_taken", F.lit(0)))
        open_ = written(open_.withColumns({
            f"{name}_{c}": F.col(f"{name}_{c}") + sign * F.col(f"{name}_taken") for name in ("old", "new") for c, sign in (("left", -1), ("used", 1))
        }).filter("old_left > 0 AND new_left > 0").drop("old_taken", "new_taken"), "couples")
    none = open_.withColumn("taken", F.lit(0).cast("long"))
    matched = none
    for best in settled:
        matched = matched.unionByName(best.drop("best_old", "best_new"))
    places = matched.select(*PAIR, "old_sha", "new_sha", "old_used", "new_used", F.explode(F.sequence(F.lit(1), F.col("taken").cast("int"))).alias("i")).select(
        *PAIR, "old_sha", "new_sha", (F.col("old_used") + F.col("i")).alias("old_place"), (F.col("new_used") + F.col("i")).alias("new_place"))
    # Paths are put in order only under contents with several; the others have their place from the grouping above.
    key = [*PAIR, "is_old", "sha"]
    crowded = written(lookup_join(loose, contents.filter("left > 1").select(*key), key, F.col("path"), "left_semi"), "crowded")
    numbered = with_order(crowded, key, ["path"], number="place").select(*key, "path", "place").unionByName(
        contents.filter("left = 1").select(*key, F.col("first").alias("path"), F.lit(1).cast("long").alias("place")))
    numbered = written(numbered, "numbered")
    for is_old, name in ((True, "old"), (False, "new")):
        of_side = numbered.filter(F.col("is_old") == is_old).select(
            *PAIR, F.col("sha").alias(f"{name}_sha"), F.col("place").alias(f"{name}_place"), F.col("path").alias(f"{name}_path"))
        places = places.join(of_side, [*PAIR, f"{name}_sha", f"{name}_place"])
    return places.select(*PAIR, "old_sha", "new_sha", "old_path", "new_path")


def changed_files(
    pairs: DataFrame,
    files: DataFrame,
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    detect_renames: bool = True,
    near_threshold: float | None = None,
    trees: DataFrame | None = None,
) -> DataFrame:
    """Changed paths with their change type, renames resolved and patterns applied.

    Renames need equal content unless ``near_threshold`` (above 0, at most 1) admits similar files.

    Pairs that carry ``include_regex`` / ``exclude_regex`` use them instead of the
    two lists. Patterns look at the path after the change.

    With ``trees`` (the folder trees of ``files``) only folders that differ are compared.
    """
    changes = path_changes(pairs, files) if trees is None else tree_changes(pairs, trees)
    if detect_renames:
        # Written once (paths and hashes only): the matching reads it several times.
        changes = pair_renames(written(changes, "changes"))
        if near_threshold is not None:
            changes = near_renames(written(changes, "changes"), files, near_threshold)
    else:
        changes = changes.withColumn("old_path", F.lit(None).cast("string"))
    if "include_regex" in pairs.columns:
        rules = pairs.select(*PAIR, "include_regex", "exclude_regex")
        changes = salted_join(changes, rules, PAIR, F.col("path")).filter(
            in_diff_by(F.col("path"), F.col("include_regex"), F.col("exclude_regex"))
        ).drop("include_regex", "exclude_regex")
    else:
        changes = changes.filter(in_diff(F.col("path"), include or (), exclude or ()))
    return changes


def with_texts(changes: DataFrame, files: DataFrame) -> DataFrame:
    """Add ``old_text`` and ``new_text`` for the rows whose content is compared.

    Contents are scanned once: every needed (repo, version, path) is looked up
    with the side it serves, then both sides of a change are put on one row.
    Few changes are broadcast and contents filtered in place; for many, a files
    table bucketed by its key keeps the contents from being shuffled. A rename
    with equal content needs no text.
    """
    differs = ~F.col("old_sha").eqNullSafe(F.col("new_sha"))
    old_path = F.coalesce("old_path", "path")
    wanted = (
        changes.filter(differs)
        .select(*PAIR, "path", F.explode(F.array(
            F.struct(F.col("from_version").alias("version"), old_path.alias("file"),
                     F.lit(True).alias("is_old"), F.col("old_sha").isNotNull().alias("exists")),
            F.struct(F.col("to_version").alias("version"), F.col("path").alias("file"),
                     F.lit(False).alias("is_old"), F.col("new_sha").isNotNull().alias("exists")),
        )).alias("side"))
        .select(*PAIR, "path", "side.*").filter("exists").drop("exists")
    )
    contents = files.select("repo", "version", F.col("path").alias("file"), "content")
    # A fixed number of partitions: comparing lines costs far more than the bytes
    # suggest, so these partitions must not be merged because they look small.
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (
        lookup_join(contents, wanted, ["repo", "version", "file"], None)
        .repartition(tasks, *PAIR, "path")
        .groupBy(*PAIR, "path")
        .agg(
            F.max(F.when(F.col("is_old"), F.col("content"))).alias("old_content"),
            F.max(F.when(~F.col("is_old"), F.col("content"))).alias("new_content"),
        )
    )
    return (
        changes.join(found, [*PAIR, "path"], "left")
        .withColumns({
            "old_text": F.coalesce(decoded(F.col("old_content")), F.lit("")),
            "new_text": F.coalesce(decoded(F.col("new_content")), F.lit("")),
        })
        .drop("old_content", "new_content")
    )


EDIT = T.StructType([
    T.StructField("diff", T.StringType()),
    T.StructField("additions", T.LongType()),
    T.StructField("deletions", T.LongType()),
    T.StructField("error", T.StringType()),
])
# Fixed value: what stands for a diff that could not be made.
FAILED = "Error generating diff: "


def line_edit(old: str, new: str, old_name: str, new_name: str, context: int, strict: bool):
    """Unified diff of two texts with its added and removed line counts.

    By default a marked line that looks like a file header (``+++``, ``---``) is
    not counted; ``strict`` counts by position after the two header lines.
    """
    lines = list(difflib.unified_diff(
        old.splitlines(keepends=True), new.splitlines(keepends=True),
        fromfile=old_name, tofile=new_name, n=context,
    ))

    def marked(sign):
        if strict:
            return sum(line[0] == sign for line in lines[2:])
        return sum(line[0] == sign and line[:3] != sign * 3 for line in lines)

    return "".join(lines), marked("+"), marked("-")


def _line_edit_udf(context: int, strict: bool):
    def edit(old, new, old_name, new_name):
        if old is None:
            return None, None, None, None
        try:
            return *line_edit(old, new, old_name, new_name, context, strict), None
        except Exception as problem:  # one file must not fail the others
            return f"{FAILED}{problem}", 0, 0, f"{type(problem).__name__}: {problem}"

    @F.pandas_udf(EDIT)
    def edits(old: pd.Series, new: pd.Series, old_name: pd.Series, new_name: pd.Series) -> pd.DataFrame:
        rows = [edit(*row) for row in zip(old, new, old_name, new_name)]
        return pd.DataFrame(rows, columns=EDIT.fieldNames()).astype({"additions": "Int64", "deletions": "Int64"})

    return edits


def unified_diffs(
    changes: DataFrame, settings: Settings = Settings(), strict_counts: bool = False
) -> DataFrame:
    """file_diffs from rows of :func:`with_texts`, with the reason (``error``) where the lines of a file could not be compared.

    Whole-file additions and deletions need no line matching and stay in
    built-in expressions; only texts present on both sides go to Python.
    """
    path, old, new = F.col("path"), F.col("old_text"), F.col("new_text")
    old_name = F.concat(F.lit("a/"), F.coalesce("old_path", "path"))
    new_name = F.concat(F.lit("b/"), path)
    two_sided = (F.length(old) > 0) & (F.length(new) > 0)
    line_edits = _line_edit_udf(settings.context_lines, strict_counts)
    rows = changes.withColumns({
        "edit": line_edits(F.when(two_sided, old), F.when(two_sided, new), old_name, new_name),
        # The only text of a change that adds or removes everything.
        "text": F.when(~two_sided & (F.length(new) + F.length(old) > 0), F.concat(new, old)),
        "adds": F.length(new) > 0,
    })
    text, adds = F.col("text"), F.col("adds")
    rows = rows.withColumns({
        "lines": line_count(text),
        "marked": F.when(adds, lines_marked(text, "+")).otherwise(lines_marked(text, "-")),
        "uncounted": F.lit(0) if strict_counts else F.when(adds, lines_starting(text, "++")).otherwise(
            lines_starting(text, "--")),
    })

    lines = F.col("lines")
    span = F.when(lines == 1, F.lit("1")).otherwise(F.concat(F.lit("1,"), lines.cast("string")))
    ranges = F.when(adds, F.concat(F.lit("-0,0 +"), span)).otherwise(F.concat(F.lit("-"), span, F.lit(" +0,0")))
    one_sided = F.concat(F.lit("--- "), old_name, F.lit("\n+++ "), new_name, F.lit("\n@@ "), ranges,
                         F.lit(" @@\n"), F.col("marked"))
    full_diff = F.when(text.isNotNull(), one_sided).otherwise(F.coalesce("edit.diff", F.lit("")))
    counted = lines - F.col("uncounted")

    def count(side, edited):
        return F.when(text.isNotNull(), F.when(side, counted).otherwise(F.lit(0))).otherwise(
            F.coalesce(edited, F.lit(0)))

    return rows.select(
        *PAIR,
        path.alias("file_path"),
        "change_type",
        "old_path",
        truncated(full_diff, settings.max_diff_size).alias("diff_content"),
        count(adds, "edit.additions").alias("additions"),
        count(~adds, "edit.deletions").alias("deletions"),
        F.when(two_sided, F.col("edit.error")).alias("error"),
    )


def truncated(diff: Column, limit: int | None) -> Column:
    if limit is None:
        return diff
    return F.when(F.length(diff) > limit, F.concat(F.left(diff, F.lit(limit)), F.lit(TRUNCATED))).otherwise(diff)


def file_diffs(
    pairs: DataFrame,
    files: DataFrame,
    settings: Settings = Settings(),
    include: list[str] | None = None,
    exclude: list[str] | None = None,
    detect_renames: bool = True,
    strict_counts: bool = False,
    near_threshold: float | None = None,
    trees: DataFrame | None = None,
) -> DataFrame:
    """Unified diff of every changed file of every pair."""
    # Written once (paths and hashes only): the lookup of contents reads it several times.
    changes = written(changed_files(pairs, files, include, exclude, detect_renames, near_threshold, trees), "changed_files")
    return unified_diffs(with_texts(changes, files), settings, strict_counts)


def version_diffs(diffs: DataFrame) -> DataFrame:
    """Totals per pair; renamed files count as modified."""
    def files_of(*types):
        return F.count_if(F.col("change_type").isin(*types))

    return diffs.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("files_changed"),
        F.sum("additions").alias("total_additions"),
        F.sum("deletions").alias("total_deletions"),
        files_of("added").alias("files_added"),
        files_of("modified", "renamed").alias("files_modified"),
        files_of("deleted").alias("files_deleted"),
    )


def diff_stats(diffs: DataFrame) -> DataFrame:
    """Per-file line statistics of a pair beside the totals of the pair."""
    totals = version_diffs(diffs).select(*PAIR, "files_changed", "total_additions", "total_deletions")
    per_file = diffs.select(*PAIR, "file_path", "change_type", "additions", "deletions")
    return salted_join(per_file, totals, PAIR, F.col("file_path"))
