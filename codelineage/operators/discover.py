"""Repository metadata, filters, topic and curated discovery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codelineage import dims
from codelineage.functions.text import commas, shortened
from codelineage.operators.joins import lookup_join
from codelineage.operators.releases import ORDER

FIELDS = ["name", "description", "stars", "language", "topics", "last_release", "release_count", "last_updated", "url"]


def repo_metadata(
    repos: DataFrame, releases: DataFrame, names: DataFrame | None = None, release_probe: int | None = 10
) -> DataFrame:
    """discovered rows with defaults for missing texts; ``names(name, …)`` limits them.

    ``release_count`` stops at ``release_probe`` (None = count all); wanted names
    without metadata drop out.
    """
    counted = releases.groupBy("repo").agg(
        F.count(F.lit(1)).alias("release_count"), F.max_by("tag_name", F.struct(*ORDER)).alias("last_release"))
    wanted = repos.withColumnRenamed("full_name", "name") if "full_name" in repos.columns else repos
    wanted = wanted.join(names.select("name"), "name", "left_semi") if names is not None else wanted
    count = F.coalesce("release_count", F.lit(0))
    count = F.least(count, F.lit(release_probe)) if release_probe is not None else count
    return wanted.join(counted.withColumnRenamed("repo", "name"), "name", "left").select(
        "name",
        F.coalesce("description", F.lit("")).alias("description"),
        "stars",
        F.coalesce(F.nullif(F.col("language"), F.lit("")), F.lit("Unknown")).alias("language"),
        F.coalesce("topics", F.array().cast("array<string>")).alias("topics"),
        "last_release",
        count.cast("int").alias("release_count"),
        F.col("updated_at").alias("last_updated"),
        "url",
    )


def filter_repos(
    repos: DataFrame,
    as_of: Column | None = None,
    min_stars: int = 0,
    min_releases: int = 0,
    max_age_days: int | None = None,
    languages: list[str] | None = None,
    required_topics: list[str] | None = None,
) -> DataFrame:
    """Repositories passing every given condition; a zero age or empty list sets none."""
    kept = repos.filter((F.col("stars") >= min_stars) & (F.col("release_count") >= min_releases))
    if max_age_days:
        if as_of is None:
            raise ValueError("filter_repos: max_age_days needs the as_of time")
        kept = kept.filter(as_of - F.col("last_updated") <= F.expr(f"INTERVAL {int(max_age_days)} DAYS"))
    if languages:
        kept = kept.filter(F.col("language").isin(list(languages)))
    if required_topics:
        kept = kept.filter(F.arrays_overlap("topics", F.array(*[F.lit(t) for t in required_topics])))
    return kept


def enough_releases(repos: DataFrame, min_releases: int) -> DataFrame:
    return repos.filter(F.col("release_count") >= min_releases)


def by_stars(repos: DataFrame) -> DataFrame:
    return repos.orderBy(F.desc("stars"), "name")


def search_repos(
    repos: DataFrame, query: str = "machine learning", language: str = "Python", min_stars: int = 1000, max_results: int = 10
) -> DataFrame:
    """Most starred repositories whose name or description holds every query word."""
    text = F.lower(F.concat_ws(" ", "name", "description"))
    kept = repos.filter((F.col("language") == language) & (F.col("stars") >= min_stars))
    for word in query.lower().split():
        kept = kept.filter(F.contains(text, F.lit(word)))
    return by_stars(kept).limit(max_results).select("name", "stars")


def topic_candidates(repos: DataFrame, topics: DataFrame) -> DataFrame:
    """Every (topic, repository carrying it); ``topics(topic, topic_rank)`` is a literal list."""
    exploded = repos.withColumn("topic", F.explode(F.array_distinct("topics")))
    return lookup_join(exploded, topics, ["topic"], F.col("name"))


def top_by_topic(
    repos: DataFrame,
    topics: DataFrame,
    min_stars: int = 500,
    min_releases: int = 1,
    max_results: int = 20,
    language: str | None = None,
) -> DataFrame:
    """At most ``max_results`` repositories per topic by stars, after the release filter.

    The constant limit is applied in every task before the shuffle.
    """
    kept = repos.filter((F.col("stars") >= min_stars) & (F.col("release_count") >= min_releases))
    if language:
        kept = kept.filter(F.col("language") == language)
    by_topic = Window.partitionBy("topic").orderBy(F.desc("stars"), "name")
    ranked = topic_candidates(kept, topics).withColumn("place", F.row_number().over(by_topic))
    return ranked.filter(F.col("place") <= max_results)


def first_wins(rows: DataFrame, order: list[str]) -> DataFrame:
    """One row per name: the first in ``order`` (an aggregate, not a window)."""
    others = [c for c in rows.columns if c != "name"]
    return rows.groupBy("name").agg(F.min_by(F.struct(*others), F.struct(*order)).alias("first")).select("name", "first.*")


def discover_topics(
    repos: DataFrame, topics: DataFrame, min_stars: int = 1000, min_releases: int = 2, max_per_topic: int = 10
) -> DataFrame:
    """Repositories found under any topic, each once, under its first topic in list order."""
    found = top_by_topic(repos, topics, min_stars, min_releases, max_per_topic)
    return first_wins(found, ["topic_rank", "place"])


def curated_repos(repos: DataFrame, curated: DataFrame) -> DataFrame:
    """Known metadata of the curated names; ``curated(name, curated_rank)`` is a literal list."""
    return lookup_join(repos, curated, ["name"], None)


def all_discovered(
    repos: DataFrame,
    curated: DataFrame | None,
    topics: DataFrame | None,
    min_stars: int = 1000,
    min_releases: int = 2,
    max_per_topic: int = 10,
) -> DataFrame:
    """Curated and topic repositories, curated first, with at least ``min_releases``."""
    sources = []
    fields = [c for c in FIELDS if c in repos.columns]
    if curated is not None:
        sources.append(curated_repos(repos, curated).select(
            *fields, F.lit(0).alias("source_rank"), F.col("curated_rank").alias("rank_in_source")))
    if topics is not None:
        sources.append(discover_topics(repos, topics, min_stars, min_releases, max_per_topic).select(
            *fields, F.lit(1).alias("source_rank"), F.col("topic_rank").alias("rank_in_source")))
    if not sources:
        return repos.select(*fields).limit(0)
    rows = sources[0] if len(sources) == 1 else sources[0].unionByName(sources[1])
    return enough_releases(first_wins(rows, ["source_rank", "rank_in_source"]), min_releases)


def top_repos_view(repos: DataFrame, rows: int = 50) -> DataFrame:
    """The table shown to a user: the most starred repositories."""
    return by_stars(repos).limit(rows).select(
        "name",
        commas(F.col("stars")).alias("stars"),
        F.col("release_count").cast("string").alias("releases"),
        "language",
        F.coalesce(F.nullif(F.col("last_release"), F.lit("")), F.lit("N/A")).alias("last_release"),
    )


def with_defaults(config: DataFrame) -> DataFrame:
    """repo_config with the default of every missing key."""
    strings = "array<string>"
    columns = {
        "description": F.coalesce("description", F.lit("")),
        "file_patterns": F.coalesce("file_patterns", F.array(F.lit("*"))),
        "exclude_patterns": F.coalesce("exclude_patterns", F.array().cast(strings)),
    }
    # An empty include list would select nothing in one half of the job and everything in the other.
    checked = F.when(F.size("file_patterns") > 0, F.col("file_patterns")).otherwise(
        F.raise_error(F.lit("repo_config: file_patterns must not be empty")).cast(strings))
    return config.withColumns(columns).withColumn("file_patterns", checked).select(
        "name", "description", "min_version", "max_versions", "file_patterns", "exclude_patterns")


def configured_view(config: DataFrame) -> DataFrame:
    """Configured repositories as shown to a user."""
    return config.select(
        "name",
        shortened(F.col("description"), 50).alias("description"),
        F.array_join(F.slice("file_patterns", 1, 3), ", ").alias("patterns"),
    )


def config_from(repos: DataFrame) -> DataFrame:
    """repo_config rows for discovered repositories."""
    none = F.lit(None)
    return repos.select(
        "name",
        F.left(F.coalesce("description", F.lit("")), F.lit(100)).alias("description"),
        none.cast("string").alias("min_version"),
        none.cast("int").alias("max_versions"),
        none.cast("array<string>").alias("file_patterns"),
        none.cast("array<string>").alias("exclude_patterns"),
    )


def curated_listing(categories: DataFrame, curated: DataFrame) -> DataFrame:
    """Category lists reduced to names that are on the curated list."""
    return lookup_join(categories, curated.select("name"), ["name"], F.col("category"), "left_semi")


def browse_topics(repos: DataFrame, names: list[str] | None = None, min_stars: int = 500, max_results: int = 20) -> DataFrame:
    """Top repositories of each given topic (the first five default topics without any)."""
    topics = dims.topics(repos.sparkSession, names or dims.DEFAULT_TOPICS[:5])
    return top_by_topic(repos, topics, min_stars=min_stars, max_results=max_results)
