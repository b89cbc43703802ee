"""Releases: tag resolution, version pairs, newest-first views."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codelineage.functions.text import shortened, version_matches
from codelineage.operators.joins import salted_join
from codelineage.operators.ordered import with_order

ORDER = ["published_at", "release_id"]


def resolve_releases(releases_raw: DataFrame, tag_refs: DataFrame, tag_objects: DataFrame) -> DataFrame:
    """Releases whose tag resolves to a commit; annotated tags are peeled.

    tag_refs(repo, tag_name, ref_type, ref_sha); tag_objects(repo, tag_sha, commit_sha).
    """
    commits = tag_commits(tag_refs, tag_objects).filter(F.col("commit_sha").isNotNull())
    return releases_raw.join(commits, ["repo", "tag_name"]).select(
        "repo",
        "tag_name",
        F.coalesce(F.nullif(F.col("title"), F.lit("")), F.col("tag_name")).alias("name"),
        "published_at",
        "tarball_url",
        "commit_sha",
        "is_prerelease",
        "release_id",
    )


def tag_commits(tag_refs: DataFrame, tag_objects: DataFrame) -> DataFrame:
    """Commit of every tag. NULL where an annotated tag has no object."""
    objects = tag_objects.select("repo", F.col("tag_sha").alias("ref_sha"), F.col("commit_sha").alias("peeled_sha"))
    commit = F.when(F.col("ref_type") == "tag", F.col("peeled_sha")).otherwise(F.col("ref_sha"))
    return tag_refs.join(objects, ["repo", "ref_sha"], "left").select("repo", "tag_name", commit.alias("commit_sha"))


def stable_releases(releases: DataFrame) -> DataFrame:
    return releases.filter(~F.col("is_prerelease"))


def release_pairs(
    releases: DataFrame, config: DataFrame | None = None, skip_prereleases: bool = True
) -> DataFrame:
    """Consecutive releases of each repository.

    ``config`` (one row per repository) may give min_version and max_versions;
    its other columns are carried along, and repositories it lacks are left out.
    """
    rows = stable_releases(releases) if skip_prereleases else releases
    rows = rows.select("repo", "tag_name", "commit_sha", *ORDER)
    extra: list[str] = []
    if config is not None:
        config = config.withColumnRenamed("name", "repo") if "repo" not in config.columns else config
        extra = [c for c in config.columns if c != "repo"]
        rows = _from_min_version(rows, config, extra)

    pairs = with_order(
        rows, ["repo"], ORDER, number="pair_no",
        following={"to_version": F.col("tag_name"), "to_sha": F.col("commit_sha")},
    ).filter(F.col("to_version").isNotNull())
    if "max_versions" in extra:
        limit = F.coalesce(F.col("max_versions"), F.lit(0))
        pairs = pairs.filter((limit == 0) | (F.col("pair_no") <= limit))
    carried = [c for c in extra if c not in ("min_version", "max_versions", "description")]
    return pairs.select(
        "repo", F.col("tag_name").alias("from_version"), "to_version",
        F.col("commit_sha").alias("from_sha"), "to_sha", "pair_no", *carried,
    )


def _from_min_version(rows: DataFrame, config: DataFrame, extra: list[str]) -> DataFrame:
    """Keep releases from the first one matching min_version on; no match keeps all."""
    position = F.struct(*ORDER)
    if "min_version" in extra:
        wanted = config.select("repo", "min_version").filter(F.length("min_version") > 0)
        starts = (
            salted_join(rows, wanted, ["repo"], F.col("release_id"))
            .filter(version_matches(F.col("tag_name"), F.col("min_version")))
            .groupBy("repo")
            .agg(F.min(position).alias("_start"))
        )
        config = config.join(starts, "repo", "left")
    joined = salted_join(rows, config, ["repo"], F.col("release_id"))
    if "min_version" in extra:
        joined = joined.filter(F.col("_start").isNull() | (position >= F.col("_start"))).drop("_start")
    return joined


def newest_releases(releases: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` newest releases per repository with their position.

    The constant limit lets Spark cut to k rows per repository in every task
    before the shuffle, so a repository with very many releases is harmless.
    """
    newest_first = Window.partitionBy("repo").orderBy(*[F.desc(c) for c in ORDER])
    return releases.withColumn("recency", F.row_number().over(newest_first)).filter(F.col("recency") <= k)


def latest_release(releases: DataFrame) -> DataFrame:
    """Newest tag per repository, prereleases included."""
    return releases.groupBy("repo").agg(F.max_by("tag_name", F.struct(*ORDER)).alias("version"))


def release_listing(releases: DataFrame, k: int = 20) -> DataFrame:
    """The last ``k`` releases as shown to a user, with the full count per repository."""
    shown = newest_releases(releases, k).select(
        "repo",
        "recency",
        "tag_name",
        shortened(F.col("name"), 40).alias("name"),
        F.date_format("published_at", "yyyy-MM-dd").alias("date"),
        F.when(F.col("is_prerelease"), "Yes").otherwise("No").alias("prerelease"),
    )
    totals = releases.groupBy("repo").agg(F.count(F.lit(1)).alias("total_releases"))
    return shown.join(totals, "repo")
