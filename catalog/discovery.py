"""Repository metadata, discovery and configuration."""

from pyspark.sql import functions as F

from catalog.fixtures import AS_OF
from catalog.registry import query
from codelineage import dims
from codelineage.functions import text
from codelineage.operators import discover as ops
from codelineage.plans.discovery import discover, discover_and_save
from codelineage.sources.tables import read_config
from codelineage.storage import fresh_path

TOPICS = ["brand7", "promo", "large", "brand12", "unknown-topic"]
TOPICS_SQL = "(VALUES ('brand7', 0), ('promo', 1), ('large', 2), ('brand12', 3), ('unknown-topic', 4)) AS t(topic, topic_rank)"
CURATED = [f"Brand#{i % 25 + 1}/{i}" for i in range(0, 400, 3)]
CURATED_SQL = "(VALUES " + ", ".join(f"('{n}', {i})" for i, n in enumerate(CURATED)) + ") AS c(name, curated_rank)"


@query("a5_repo_metadata", """
    SELECT p.name, CASE WHEN age_days % 5 = 0 THEN '' ELSE description END AS description, stars, language,
           CASE WHEN age_days % 6 = 0 THEN '' ELSE concat(topic1, ',', topic2) END AS topics, r.last_release,
           CAST(least(coalesce(r.n, 0), 10) AS INT) AS release_count
    FROM fx_repos p LEFT JOIN (SELECT repo, count(*) AS n, arg_max(tag_name, (published_at, release_id)) AS last_release
                               FROM fx_part_releases GROUP BY repo) r ON r.repo = p.name
    WHERE age_days % 2 = 0""")
def a5(x):
    names = x.repos().filter("age_days % 2 = 0").select("name").unionByName(
        x.table("part").select(F.concat(F.lit("missing/"), F.col("p_partkey").cast("string")).alias("name")))
    rows = ops.repo_metadata(x.repo_records(), x.part_releases(), names)
    return rows.select("name", "description", "stars", "language", F.array_join("topics", ",").alias("topics"), "last_release", "release_count")


@query("a3_config_defaults", """
    SELECT name, coalesce(description, '') AS description, CAST(NULL AS VARCHAR) AS min_version, max_versions,
           coalesce(file_patterns, '*') AS file_patterns, coalesce(exclude_patterns, '') AS exclude_patterns FROM fx_config""")
def a3(x):
    return ops.with_defaults(x.config()).withColumns({
        c: F.array_join(c, ",") for c in ("file_patterns", "exclude_patterns")})


@query("b9_filter_repos", """
    SELECT name, stars FROM fx_repos WHERE stars >= 1000 AND release_count >= 2 AND age_days <= 40
    AND language IN ('Python', 'Rust') AND (topic1 IN ('promo', 'brand7') OR topic2 IN ('promo', 'brand7'))""")
def b9(x):
    as_of = F.to_timestamp(F.lit(AS_OF))
    return ops.filter_repos(x.repos(), as_of, 1000, 2, 40, ["Python", "Rust"], ["promo", "brand7"]).select("name", "stars")


@query("b10_topic_search", """
    SELECT name, stars, release_count FROM fx_repos WHERE topic1 = 'promo' AND stars >= 500 AND release_count >= 3 AND language = 'Rust'
    ORDER BY stars DESC, name LIMIT 20""")
def b10(x):
    found = ops.top_by_topic(x.repos(), dims.topics(x.spark, ["promo"]), 500, 3, 20, "Rust")
    return found.select("name", "stars", "release_count")


@query("b11_keyword_search", """
    SELECT name, stars FROM fx_repos WHERE language = 'Python' AND stars >= 1000
    AND contains(lower(concat_ws(' ', name, description)), 'red') AND contains(lower(concat_ws(' ', name, description)), 'brand')
    ORDER BY stars DESC, name LIMIT 10""")
def b11(x):
    return ops.search_repos(x.repos(), "Red brand")


@query("b15_release_floor", "SELECT name, release_count FROM fx_repos WHERE release_count >= 5")
def b15(x):
    return ops.enough_releases(x.repos(), 5).select("name", "release_count")


@query("c6_topic_candidates", f"""
    SELECT topic, topic_rank, name FROM (SELECT name, topic1 AS topic FROM fx_repos UNION SELECT name, topic2 FROM fx_repos) JOIN {TOPICS_SQL} USING (topic)""")
def c6(x):
    return ops.topic_candidates(x.repos(), dims.topics(x.spark, TOPICS)).select("topic", "topic_rank", "name")


@query("c7_curated_semi_join", f"SELECT name, stars FROM fx_repos WHERE name IN (SELECT name FROM {CURATED_SQL})")
def c7(x):
    return ops.curated_repos(x.repos(), dims.curated(x.spark, CURATED)).select("name", "stars")


TOP_SQL = f"""
    SELECT * FROM (
        SELECT topic, topic_rank, name, stars, release_count, row_number() OVER (PARTITION BY topic ORDER BY stars DESC, name) AS place
        FROM (SELECT *, topic1 AS topic FROM fx_repos UNION ALL SELECT *, topic2 FROM fx_repos) JOIN {TOPICS_SQL} USING (topic)
        WHERE stars >= {{stars}} AND release_count >= {{releases}}) WHERE place <= {{k}}"""


@query("e6_top_by_topic", "SELECT topic, name, stars, place FROM (" + TOP_SQL.format(stars=500, releases=1, k=20) + ")")
def e6(x):
    return ops.top_by_topic(x.repos(), dims.topics(x.spark, TOPICS)).select(
        "topic", "name", "stars", F.col("place").cast("long").alias("place"))


TOPIC_REPOS_SQL = "SELECT name, arg_min(topic, topic_rank) AS topic, min(topic_rank) AS topic_rank, any_value(stars) AS stars, any_value(release_count) AS release_count FROM (" + TOP_SQL.format(stars=1000, releases=2, k=10) + ") GROUP BY name"


@query("d10_first_topic_wins", f"SELECT name, topic, stars FROM ({TOPIC_REPOS_SQL})")
def d10(x):
    return ops.discover_topics(x.repos(), dims.topics(x.spark, TOPICS)).select("name", "topic", "stars")


FOUND_SQL = f"""
    SELECT name, any_value(stars) AS stars, any_value(release_count) AS release_count, min(source_rank) AS source_rank FROM (
        SELECT p.name, p.stars, p.release_count, 0 AS source_rank FROM fx_repos p JOIN {CURATED_SQL} USING (name)
        UNION ALL SELECT name, stars, release_count, 1 FROM ({TOPIC_REPOS_SQL}))
    GROUP BY name HAVING any_value(release_count) >= 2"""


def found(x):
    return ops.all_discovered(x.repos(), dims.curated(x.spark, CURATED), dims.topics(x.spark, TOPICS))


@query("g3_curated_and_topics", f"SELECT name, stars, source_rank FROM ({FOUND_SQL})")
def g3(x):
    return found(x).select("name", "stars", "source_rank")


@query("i16_discovery", f"SELECT name, stars, release_count FROM ({FOUND_SQL})")
def i16(x):
    rows = discover(x.repos(), curated=dims.curated(x.spark, CURATED), topics=dims.topics(x.spark, TOPICS))
    return rows.select("name", "stars", "release_count")


VIEW_SQL = """name, format('{:,}', stars) AS stars, CAST(release_count AS VARCHAR) AS releases, language, coalesce(last_release, 'N/A') AS last_release"""


@query("f4_repos_by_stars", "SELECT name, stars FROM fx_repos ORDER BY stars DESC, name")
def f4(x):
    return ops.by_stars(x.repos()).select("name", "stars")


@query("f5_top_repos_view", f"SELECT {VIEW_SQL} FROM (SELECT * FROM fx_repos ORDER BY fx_repos.stars DESC, name LIMIT 50)")
def f5(x):
    return ops.top_repos_view(x.repos())


@query("f7_configured_view", """
    SELECT name, CASE WHEN length(d) > 50 THEN concat(left(d, 50), '...') ELSE d END AS description,
           array_to_string(string_split(coalesce(file_patterns, '*'), ',')[1:3], ', ') AS patterns
    FROM (SELECT *, coalesce(description, '') AS d FROM fx_config)""")
def f7(x):
    return ops.configured_view(ops.with_defaults(x.config()))


@query("h17_output_name", """
    SELECT name, concat('me/sft-', lower(replace(name, '/', '-'))) AS per_repo, 'me/base' AS combined FROM fx_repos""")
def h17(x):
    return x.repos().select(
        "name", text.dataset_name("per_repo", "base", "me", F.col("name")).alias("per_repo"),
        text.dataset_name("combined", "base", "me", F.col("name")).alias("combined"))


@query("h18_owner_and_repo", "SELECT name, split_part(name, '/', 1) AS owner, split_part(name, '/', 2) AS repo FROM fx_repos")
def h18(x):
    return x.repos().select("name", text.repo_owner(F.col("name")).alias("owner"), text.repo_short_name(F.col("name")).alias("repo"))


@query("i15_config_sink", f"SELECT f.name, left(p.description, 100) AS description FROM ({FOUND_SQL}) f JOIN fx_repos p USING (name)")
def i15(x):
    path = fresh_path(x.spark, "config")
    discover_and_save(x.repos(), path, curated=dims.curated(x.spark, CURATED), topics=dims.topics(x.spark, TOPICS))
    return read_config(x.spark, path).select("name", "description")


@query("i17_browse_topics", "SELECT topic, name, place FROM (" + TOP_SQL.format(stars=2000, releases=1, k=7) + ")")
def i17(x):
    rows = ops.browse_topics(x.repos(), TOPICS, min_stars=2000, max_results=7)
    return rows.select("topic", "name", F.col("place").cast("long").alias("place"))


@query("i18_curated_listing", f"""
    SELECT lower(p_type) AS category, concat(p_brand, '/', p_partkey) AS name FROM part
    WHERE concat(p_brand, '/', p_partkey) IN (SELECT name FROM {CURATED_SQL})""")
def i18(x):
    categories = x.table("part").select(
        F.lower("p_type").alias("category"), F.concat("p_brand", F.lit("/"), F.col("p_partkey").cast("string")).alias("name"))
    return ops.curated_listing(categories, dims.curated(x.spark, CURATED)).select("category", "name")
