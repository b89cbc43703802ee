"""Dependencies named in Python manifests and the snapshots they lead to."""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codelineage.functions.requirements import (
    bare_name, bare_requirement, bare_spec, is_manifest_line, is_requirement,
)
from codelineage.functions.text import basename, text_mode
from codelineage.operators.joins import lookup_join, salted_join
from codelineage.operators.ordered import with_order
from codelineage.operators.releases import latest_release
from codelineage.operators.render import lines, text_parts
from codelineage.settings import Settings

# Workers get the TOML reader by value and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SNAPSHOT = ["repo", "version"]
PLACE = ["source_rank", "path", "position"]
PARSED = [*SNAPSHOT, *PLACE, "name", "version_spec"]

TOML_ENTRIES = "entries array<struct<path: array<string>, kind: string, value: string>>, error string"


def manifest_rank(path: Column) -> Column:
    """Reading order of manifest files, NULL for other files.

    1 pyproject.toml, 2 setup.py, 3 requirements.txt at the root; 4 any
    requirements*.txt whose path names neither test nor dev. A root
    requirements.txt counts as 3 only: its second reading adds nothing new.
    """
    nested = basename(path).rlike(r"(?s)\Arequirements.*\.txt\z") & ~F.lower(path).rlike("test|dev")
    return (
        F.when(path == "pyproject.toml", 1)
        .when(path == "setup.py", 2)
        .when(path == "requirements.txt", 3)
        .when(nested, 4)
    )


def manifests(files: DataFrame) -> DataFrame:
    """Manifest files with their rank and text; undecodable files carry an error instead."""
    text = F.col("content").cast("string")
    valid = F.is_valid_utf8(text)
    return (
        files.withColumn("source_rank", manifest_rank(F.col("path")))
        .filter(F.col("source_rank").isNotNull())
        .select(
            *SNAPSHOT, "path", "source_rank",
            F.when(valid, text_mode(text)).alias("text"),
            F.when(~valid, F.lit("not valid UTF-8")).alias("error"),
        )
    )


def parse_requirements(texts: DataFrame) -> DataFrame:
    """Requirements lines of each manifest text, in line order."""
    line = F.posexplode(F.split("text", "\n")).alias("position", "line")
    rows = texts.select(*SNAPSHOT, "source_rank", "path", line)
    return _parsed(rows.filter(is_manifest_line(F.col("line"))), F.col("line"))


def parse_setup_py(texts: DataFrame) -> DataFrame:
    """Quoted strings of the first ``install_requires`` list, up to its first bracket."""
    block = F.regexp_extract("text", r"(?Us)install_requires[\s\x1C-\x1F]*=[\s\x1C-\x1F]*\[(.*?)\]", 1)
    quoted = F.regexp_extract_all(block, F.lit("""['"]([^'"]+)['"]"""), F.lit(1))
    rows = texts.select(*SNAPSHOT, "source_rank", "path", F.posexplode(quoted).alias("position", "line"))
    return _parsed(rows, F.col("line"))


def _parsed(rows: DataFrame, text: Column) -> DataFrame:
    bare = F.col("bare")
    return rows.filter(is_requirement(text)).withColumn("bare", bare_requirement(text)).select(
        *SNAPSHOT, *PLACE, bare_name(bare).alias("name"), bare_spec(bare).alias("version_spec"))


def toml_entries(text: str) -> list[tuple[list[str], str, str | None]]:
    """Every value of a TOML text in order as (path, kind, value): tables, lists, the items of lists (at the path of theirs) and plain values."""
    import tomllib

    kinds = {dict: "table", list: "list", str: "text"}
    waiting, found = [([], None, tomllib.loads(text))], []
    while waiting:
        path, kind, value = waiting.pop()
        kind = kind or kinds.get(type(value), "other")
        found.append((path, kind, None if kind in ("table", "list") else str(value)))
        inner = [([*path, k], None, v) for k, v in value.items()] if kind == "table" else [(path, "item", v) for v in value] if kind == "list" else []
        waiting += reversed(inner)
    return found


def _read_all(texts: pd.Series) -> pd.DataFrame:
    entries, errors = [], []
    for text in texts:
        error = None
        try:
            rows = [] if text is None else toml_entries(text)
        except ValueError as problem:  # a bad manifest must not fail the other rows
            rows, error = [], f"{type(problem).__name__}: {problem}"
        entries.append([dict(zip(("path", "kind", "value"), row, strict=True)) for row in rows])
        errors.append(error)
    return pd.DataFrame({"entries": entries, "error": errors})


def pyproject_tables(texts: DataFrame) -> DataFrame:
    """Add ``toml``: dependencies listed by a pyproject text as (text) of [project] or (name, version) of the Poetry table, and an error.

    The text is only taken apart into its values in Python; which of them are dependencies is said here. A Poetry
    dependency is a version or a table that may hold one; anything else makes the manifest an error.
    """
    def under(*names):
        return lambda e: F.slice(e["path"], 1, len(names)) == F.array(*[F.lit(n) for n in names])

    of = lambda keep: F.filter("_toml.entries", keep)
    none = F.lit(None).cast("string")
    listed = of(lambda e: under("project", "dependencies")(e) & (F.size(e["path"]) == 2) & (e["kind"] == "item"))
    named = of(lambda e: under("tool", "poetry", "dependencies")(e) & (F.size(e["path"]) == 4) & (e["kind"] != "item") & (F.lower(e["path"][3]) != "python"))
    versions = of(lambda e: under("tool", "poetry", "dependencies")(e) & (F.size(e["path"]) == 5) & (e["path"][4] == "version"))
    odd = F.exists("_named", lambda e: ~e["kind"].isin("text", "table"))

    def version(e):
        inner = F.filter("_versions", lambda v: F.slice(v["path"], 1, 4) == e["path"])
        return F.when(e["kind"] == "text", e["value"]).otherwise(F.coalesce(F.get(inner, F.lit(0))["value"], F.lit("")))

    deps = F.concat(
        F.transform("_listed", lambda e: F.struct(e["value"].alias("text"), none.alias("name"), none.alias("version"))),
        F.transform("_named", lambda e: F.struct(none.alias("text"), e["path"][3].alias("name"), version(e).alias("version"))))
    rows = texts.withColumn("_toml", F.pandas_udf(_read_all, TOML_ENTRIES)("text")).withColumns({"_listed": listed, "_named": named, "_versions": versions})
    error = F.coalesce("_toml.error", F.when(odd, F.lit("a dependency that is neither a version nor a table")))
    return rows.withColumn("toml", F.struct(
        F.when(error.isNull(), deps).otherwise(F.filter(deps, lambda d: F.lit(False))).alias("deps"), error.alias("error"))
    ).drop("_toml", "_listed", "_named", "_versions")


def parse_pyproject(tables: DataFrame) -> DataFrame:
    """Dependencies of rows made by :func:`pyproject_tables`."""
    rows = tables.select(
        *SNAPSHOT, "source_rank", "path", F.posexplode("toml.deps").alias("position", "dep"))
    text = F.col("dep.text")
    strings = rows.filter(text.isNotNull())
    named = rows.filter(text.isNull()).select(
        *SNAPSHOT, *PLACE, F.col("dep.name").alias("name"), F.col("dep.version").alias("version_spec"))
    return _parsed(strings, text).unionByName(named)


def manifest_errors(files: DataFrame) -> DataFrame:
    """Manifests that could not be read, with the reason."""
    rows = manifests(files)
    tables = pyproject_tables(rows.filter("source_rank = 1"))
    columns = [*SNAPSHOT, "path"]
    unread = rows.filter(F.col("error").isNotNull()).select(*columns, "error")
    broken = tables.filter(F.col("toml.error").isNotNull()).select(*columns, F.col("toml.error").alias("error"))
    return unread.unionByName(broken)


def parsed_dependencies(files: DataFrame) -> DataFrame:
    """Dependencies of all manifests of each snapshot with their place of mention."""
    rows = manifests(files)
    def of(rank):
        return rows.filter(F.col("source_rank") == rank)

    return (
        parse_pyproject(pyproject_tables(of(1)))
        .unionByName(parse_setup_py(of(2)))
        .unionByName(parse_requirements(rows.filter(F.col("source_rank") >= 3)))
    )


def first_mentions(parsed: DataFrame) -> DataFrame:
    """First dependency of each lower-cased name, in place order (a min per group)."""
    first = F.min_by(F.struct(*PLACE, "name", "version_spec"), F.struct(*PLACE)).alias("first")
    return (
        parsed.groupBy(*SNAPSHOT, F.lower("name").alias("key")).agg(first)
        .select(*SNAPSHOT, "key", "first.*")
    )


def with_repositories(deps: DataFrame, known_packages: DataFrame) -> DataFrame:
    """Look up the repository and the priority of each package name."""
    known = known_packages.withColumnRenamed("package", "key")
    return lookup_join(deps, known, ["key"], F.concat_ws("\n", *SNAPSHOT), "left").withColumn("is_python", F.lit(True))


def dependencies(files: DataFrame, known_packages: DataFrame) -> DataFrame:
    """All dependencies of every snapshot: manifests, first mentions, repository lookup."""
    return with_repositories(first_mentions(parsed_dependencies(files)), known_packages)


def fetchable(deps: DataFrame) -> DataFrame:
    return deps.filter(F.col("github_repo").isNotNull())


def selected(deps: DataFrame, max_deps: int | None = None, dedupe_repo: bool = False) -> DataFrame:
    """The fetchable dependencies per snapshot, ``max_deps`` at most, as (…, dep_rank, github_repo).

    With more than max_deps the known-package priority decides, else the order of
    mention. Taking max_deps + 1 rows by priority tells the two cases apart and
    is a constant-size cut in every task.
    """
    rows = fetchable(deps)
    if dedupe_repo:
        rows = (
            rows.groupBy(*SNAPSHOT, "github_repo")
            .agg(F.min_by(F.struct("key", "name", "priority", *PLACE), F.struct(*PLACE)).alias("first"))
            .select(*SNAPSHOT, "github_repo", "first.*")
        )
    if max_deps is None:
        ranked = with_order(rows, SNAPSHOT, PLACE, number="dep_rank")
        return ranked.select(*SNAPSHOT, F.col("dep_rank").cast("int").alias("dep_rank"), "name", "github_repo")
    by_priority = Window.partitionBy(*SNAPSHOT).orderBy("priority", *PLACE)
    snapshot = Window.partitionBy(*SNAPSHOT)
    top = rows.withColumn("by_priority", F.row_number().over(by_priority)).filter(F.col("by_priority") <= max_deps + 1)
    crowded = F.count(F.lit(1)).over(snapshot) > max_deps
    by_mention = F.row_number().over(snapshot.orderBy(*PLACE))
    return (
        top.withColumns({"crowded": crowded, "by_mention": by_mention})
        .withColumn("dep_rank", F.when(F.col("crowded"), F.col("by_priority")).otherwise(F.col("by_mention")))
        .filter(F.col("dep_rank") <= max_deps)
        .select(*SNAPSHOT, "dep_rank", "name", "github_repo")
    )


def dependency_versions(deps: DataFrame, releases: DataFrame) -> DataFrame:
    """Add the newest release of each dependency repository, ``main`` without one."""
    latest = latest_release(releases).select(
        F.col("repo").alias("github_repo"), F.col("version").alias("dep_version"))
    wanted = deps.select("github_repo").distinct().join(latest, "github_repo", "left")
    wanted = wanted.withColumn("dep_version", F.coalesce("dep_version", F.lit("main")))
    return salted_join(deps, wanted, ["github_repo"], F.concat_ws("\n", *SNAPSHOT))


def merged_files(pairs: DataFrame, snapshot: DataFrame, deps: DataFrame) -> DataFrame:
    """Files of each pair's older release followed by those of its dependencies.

    ``deps`` comes from :func:`dependency_versions`; dep_rank 0 is the repository
    itself. A popular dependency is split over many tasks by file path.
    """
    key = ["repo", "from_version", "to_version"]
    body = ["path", "content", "size", "language", "is_binary_stub"]
    older = pairs.select(*key, F.col("from_version").alias("version"))
    own = lookup_join(snapshot, older, SNAPSHOT, F.col("path")).select(
        *key, F.lit(0).alias("dep_rank"), F.lit(None).cast("string").alias("github_repo"), *body)
    uses = older.join(deps, SNAPSHOT).select(
        *key, "dep_rank", "github_repo", F.col("dep_version").alias("version"))
    sources = snapshot.withColumnRenamed("repo", "github_repo")
    theirs = salted_join(sources, uses, ["github_repo", "version"], F.col("path")).withColumn(
        "path", F.concat(F.lit("__deps__/"), F.col("github_repo"), F.lit("/"), F.col("path")))
    return own.unionByName(theirs.select(*key, "dep_rank", "github_repo", *body))


def dependency_counts(pairs: DataFrame, deps: DataFrame) -> DataFrame:
    """Number of merged dependency snapshots per pair."""
    counts = deps.groupBy(*SNAPSHOT).agg(F.count(F.lit(1)).alias("num_dependencies"))
    older = pairs.select("repo", "from_version", "to_version", F.col("from_version").alias("version"))
    return older.join(counts, SNAPSHOT, "left").select(
        "repo", "from_version", "to_version",
        F.coalesce("num_dependencies", F.lit(0)).alias("num_dependencies"))


def dependency_lines(deps: DataFrame) -> DataFrame:
    """Summary entry of each dependency, in place order columns."""
    known = F.col("github_repo").isNotNull()
    spec = F.coalesce(F.nullif(F.col("version_spec"), F.lit("")), F.lit("any"))
    head = F.concat(F.when(known, "✓ ").otherwise("? "), F.col("name"), F.lit(": "), spec)
    entry = F.when(known, lines(head, F.concat(F.lit("   GitHub: "), F.col("github_repo")))).otherwise(head)
    return deps.select(*SNAPSHOT, *PLACE, entry.alias("entry"))


def dependency_summaries(deps: DataFrame, max_bytes: int = Settings().max_cell_bytes) -> DataFrame:
    """(repo, version, part_no, parts, byte_start, char_start, summary): the summary text of each snapshot with dependencies, in parts."""
    entries = dependency_lines(deps).withColumnRenamed("entry", "piece")
    title = entries.select(*SNAPSHOT).distinct().withColumn("piece", lines("# Dependencies", ""))
    first = dict(entries.dtypes)
    titles = title.select(*SNAPSHOT, F.lit(0).alias("place"), *[F.lit(None).cast(first[c]).alias(c) for c in PLACE], "piece")
    pieces = titles.unionByName(entries.select(*SNAPSHOT, F.lit(1).alias("place"), *PLACE, "piece"))
    return text_parts(pieces, SNAPSHOT, ["place", *PLACE], max_bytes).withColumnRenamed("text", "summary")
