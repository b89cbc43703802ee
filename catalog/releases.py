"""Releases, tags and version pairs."""

from pyspark.sql import functions as F

from catalog.registry import query
from codelineage.functions.text import version_matches
from codelineage.operators import releases
from codelineage.operators.ordered import with_order


@query("a4_resolve_releases", """
    SELECT r.repo, r.tag_name, CASE WHEN r.release_id % 4 IN (0, 1) THEN r.tag_name ELSE concat('Release ', r.release_id) END AS name,
           strftime(r.published_at, '%Y-%m-%d') AS published, c.commit_sha, r.is_prerelease, r.release_id
    FROM fx_releases r JOIN fx_tag_commits c ON c.repo = r.repo AND c.tag_name = r.tag_name AND c.commit_sha IS NOT NULL""")
def a4(x):
    return releases.resolve_releases(*x.tag_tables()).select(
        "repo", "tag_name", "name", F.date_format("published_at", "yyyy-MM-dd").alias("published"),
        "commit_sha", "is_prerelease", "release_id")


@query("a6_tag_commits", "SELECT repo, tag_name, commit_sha FROM fx_tag_commits")
def a6(x):
    _, refs, objects = x.tag_tables()
    return releases.tag_commits(refs, objects)


@query("b12_stable_releases", "SELECT repo, tag_name FROM fx_releases WHERE NOT is_prerelease")
def b12(x):
    return releases.stable_releases(x.releases()).select("repo", "tag_name")


@query("b13_version_match", "SELECT repo, tag_name FROM fx_releases WHERE starts_with(tag_name, 'v12')")
def b13(x):
    return x.releases().select("repo", "tag_name").filter(version_matches(F.upper("tag_name"), F.lit("V12")))


PAIRS_SQL = """
    SELECT repo, tag_name AS from_version, commit_sha AS from_sha,
           lead(tag_name) OVER w AS to_version, lead(commit_sha) OVER w AS to_sha, row_number() OVER w AS pair_no
    FROM {rows} WINDOW w AS (PARTITION BY repo ORDER BY published_at, release_id)"""
STABLE = "(SELECT * FROM fx_releases WHERE NOT is_prerelease)"


@query("e1_release_pairs", "SELECT * FROM (" + PAIRS_SQL.format(rows=STABLE) + ") WHERE to_version IS NOT NULL")
def e1(x):
    return releases.release_pairs(x.releases()).withColumn("pair_no", F.col("pair_no").cast("long"))


def limits(x):
    """One configuration row per repository: a first version, a limit, both or neither."""
    number = F.regexp_extract("repo", "([0-9]+)$", 1).cast("int")
    return x.releases().select("repo").distinct().select(
        "repo",
        F.when(number % 3 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("V1"), (number % 10).cast("string"))).alias("min_version"),
        F.when(number % 4 == 0, F.lit(None).cast("int")).when(number % 4 == 1, F.lit(0)).otherwise(number).alias("max_versions"))


LIMITS_SQL = r"""
    SELECT repo, n, CASE WHEN n % 3 = 0 THEN NULL ELSE concat('v1', n % 10) END AS min_version,
           CASE WHEN n % 4 = 0 THEN NULL WHEN n % 4 = 1 THEN 0 ELSE n END AS max_versions
    FROM (SELECT DISTINCT repo, CAST(regexp_extract(repo, '([0-9]+)$', 1) AS INT) AS n FROM fx_releases)"""


@query("e2_first_pairs", f"""
    SELECT repo, from_version, to_version, pair_no FROM ({PAIRS_SQL.format(rows=STABLE)}) JOIN ({LIMITS_SQL}) USING (repo)
    WHERE to_version IS NOT NULL AND (coalesce(max_versions, 0) = 0 OR pair_no <= max_versions)""")
def e2(x):
    rows = releases.release_pairs(x.releases(), limits(x).drop("min_version"))
    return rows.select("repo", "from_version", "to_version", F.col("pair_no").cast("long").alias("pair_no"))


@query("e3_min_version", f"""
    SELECT repo, from_version, to_version FROM (
        SELECT repo, tag_name AS from_version, lead(tag_name) OVER (PARTITION BY repo ORDER BY published_at, release_id) AS to_version FROM (
            SELECT *, min(CASE WHEN starts_with(tag_name, min_version) THEN rn END) OVER (PARTITION BY repo) AS first_rn FROM (
                SELECT r.*, l.min_version, row_number() OVER (PARTITION BY repo ORDER BY published_at, release_id) AS rn
                FROM {STABLE} r JOIN ({LIMITS_SQL}) l USING (repo)))
        WHERE rn >= coalesce(first_rn, 1))
    WHERE to_version IS NOT NULL""")
def e3(x):
    return releases.release_pairs(x.releases(), limits(x).drop("max_versions")).select("repo", "from_version", "to_version")


@query("e7_newest_releases", """
    SELECT repo, tag_name, recency FROM (
        SELECT *, row_number() OVER (PARTITION BY repo ORDER BY published_at DESC, release_id DESC) AS recency FROM fx_releases)
    WHERE recency <= 10""")
def e7(x):
    return releases.newest_releases(x.releases()).select("repo", "tag_name", F.col("recency").cast("long").alias("recency"))


@query("e8_release_listing", """
    SELECT repo, recency, tag_name, CASE WHEN length(name) > 40 THEN concat(left(name, 40), '...') ELSE name END AS name,
           strftime(published_at, '%Y-%m-%d') AS date, CASE WHEN is_prerelease THEN 'Yes' ELSE 'No' END AS prerelease, total_releases
    FROM (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY published_at DESC, release_id DESC) AS recency,
                 count(*) OVER (PARTITION BY repo) AS total_releases FROM fx_releases) WHERE recency <= 20""")
def e8(x):
    return releases.release_listing(x.releases()).withColumn("recency", F.col("recency").cast("long"))


@query("f3_releases_by_date", """
    SELECT repo, tag_name, row_number() OVER (PARTITION BY repo ORDER BY published_at, release_id) AS place FROM fx_releases""")
def f3(x):
    rows = with_order(x.releases().select("repo", "tag_name", *releases.ORDER), ["repo"], releases.ORDER, number="place")
    return rows.select("repo", "tag_name", F.col("place").cast("long").alias("place"))
