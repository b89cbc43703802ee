"""Discovery jobs: from repository metadata to a written configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame

from codelineage import dims
from codelineage.operators.discover import all_discovered, by_stars, config_from, top_repos_view
from codelineage.sources.sinks import save_config
from codelineage.storage import written


def discover(
    repos: DataFrame,
    use_curated: bool = True,
    use_topics: bool = True,
    min_stars: int = 1000,
    min_releases: int = 2,
    curated: DataFrame | None = None,
    topics: DataFrame | None = None,
) -> DataFrame:
    """Curated and topic repositories with enough releases, most starred first."""
    spark = repos.sparkSession
    if use_curated and curated is None:
        curated = dims.curated(spark)
    if use_topics and topics is None:
        topics = dims.topics(spark)
    return by_stars(all_discovered(
        repos, curated if use_curated else None, topics if use_topics else None, min_stars, min_releases))


def discover_and_save(repos: DataFrame, path: str, **options) -> tuple[DataFrame, DataFrame]:
    """Write the configuration of the discovered repositories; returns (config, table view)."""
    found = written(discover(repos, **options), "discovered")
    save_config(found, path)
    return config_from(found), top_repos_view(found)
