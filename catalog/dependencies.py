"""Manifests, package lookup, dependency snapshots."""

from pyspark.sql import functions as F

from catalog.changes import pairs3, rejoined, whole
from catalog.registry import query
from codelineage.functions.patterns import in_snapshot
from codelineage.functions.requirements import (
    is_manifest_line, is_requirement, requirement_name, requirement_spec,
)
from codelineage.operators import deps, snapshot
from codelineage.operators.releases import latest_release

PARSED_COLUMNS = ["repo", "line_no", "name", "version_spec"]


def line_no():
    return F.col("path").cast("bigint").alias("line_no")


def parsed(x):
    return deps.parse_requirements(x.requirement_texts())


def resolved(x):
    return deps.with_repositories(deps.first_mentions(parsed(x)), x.known_packages())


@query("b16_manifest_lines", r"""
    SELECT repo, line_no, trim(line) AS line FROM fx_requirements
    WHERE trim(line) <> '' AND NOT regexp_matches(trim(line), '^[#-]')
      AND NOT regexp_matches(trim(split_part(line, '#', 1)), '^(https?://|git\+|\.|/)')""")
def b16(x):
    line = F.col("line")
    return x.requirements().filter(is_manifest_line(line) & is_requirement(line)).select(
        "repo", "line_no", F.trim(line).alias("line"))


PATHS = """concat(CASE p_partkey % 8 WHEN 0 THEN 'pyproject.toml' WHEN 1 THEN 'setup.py' WHEN 2 THEN 'requirements.txt'
    WHEN 3 THEN 'sub/requirements.txt' WHEN 4 THEN '.ci/requirements-extra.txt' WHEN 5 THEN 'Tests/requirements.txt'
    WHEN 6 THEN 'requirements-DEV.txt' ELSE 'docs/setup.py' END, CASE WHEN p_size % 10 = 0 THEN '.bak' ELSE '' END)"""


@query("b17_manifest_files", f"""
    SELECT p_partkey, path, CASE path WHEN 'pyproject.toml' THEN 1 WHEN 'setup.py' THEN 2 WHEN 'requirements.txt' THEN 3 ELSE 4 END AS source_rank
    FROM (SELECT p_partkey, {PATHS} AS path FROM part)
    WHERE path IN ('pyproject.toml', 'setup.py', 'requirements.txt', 'sub/requirements.txt', '.ci/requirements-extra.txt')""")
def b17(x):
    rows = x.table("part").select("p_partkey", F.expr(PATHS).alias("path"))
    return rows.withColumn("source_rank", deps.manifest_rank(F.col("path"))).filter("source_rank IS NOT NULL")


@query("h8_requirement_string", "SELECT repo, line_no, name, version_spec FROM fx_parsed")
def h8(x):
    line = F.trim("line")
    rows = x.requirements().filter(is_manifest_line(F.col("line")) & is_requirement(line))
    return rows.select("repo", "line_no", requirement_name(line).alias("name"), requirement_spec(line).alias("version_spec"))


@query("h9_requirements_text", "SELECT repo, line_no, name, version_spec FROM fx_parsed")
def h9(x):
    return parsed(x).select("repo", line_no(), "name", "version_spec")


SETUP_SQL = """
    SELECT repo, file_id, position, name, version_spec FROM (
        SELECT repo, file_id, 0 AS position, 'torch' AS name, concat('>=', p_size) AS version_spec FROM fx_setup
        UNION ALL SELECT repo, file_id, 1, 'numpy', NULL FROM fx_setup
        UNION ALL SELECT repo, file_id, 2, 'ray', NULL FROM fx_setup WHERE p_size % 4 <> 0
        UNION ALL SELECT repo, file_id, 3, 'pandas', '<3' FROM fx_setup WHERE p_size % 4 <> 0)"""


@query("h10_setup_py", r"""
    SELECT repo, file_id, CAST(position - 1 AS INT) AS position, regexp_extract(item, '^([a-zA-Z0-9_-]+)', 1) AS name,
           nullif(trim(regexp_extract(item, '^[a-zA-Z0-9_-]+\s*(.*)', 1)), '') AS version_spec
    FROM (SELECT repo, file_id, unnest(items) AS item, generate_subscripts(items, 1) AS position
          FROM (SELECT repo, file_id, regexp_extract_all(regexp_extract(content, '(?s)install_requires\s*=\s*\[(.*?)\]', 1),
                                                         '[''"]([^''"]+)[''"]', 1) AS items FROM fx_setup))""")
def h10(x):
    return deps.parse_setup_py(x.setup_texts()).select(
        "repo", F.col("path").cast("bigint").alias("file_id"), "position", "name", "version_spec")


@query("h11_pyproject", """
    SELECT repo, file_id, CAST(CASE WHEN name IN ('torch', 'numpy') THEN position ELSE position + 1 END AS INT) AS position, name, version_spec
    FROM (SELECT concat('org', p_partkey % 50) AS repo, p_partkey AS file_id, d.position, d.name,
                 CASE d.name WHEN 'torch' THEN concat('>=', p_size) WHEN 'ray' THEN concat('^', p_size) WHEN 'dask' THEN '' END AS version_spec
          FROM part CROSS JOIN (VALUES (0, 'torch'), (1, 'numpy'), (1, 'ray'), (2, 'dask')) AS d(position, name) WHERE p_partkey % 10 <> 9)""")
def h11(x):
    toml = F.concat(
        F.lit('[project]\ndependencies = ["torch>='), F.col("p_size").cast("string"),
        F.lit('", "numpy[all]"]\n[tool.poetry.dependencies]\npython = "^3.9"\nray = "^'), F.col("p_size").cast("string"),
        F.lit('"\ndask = {extras = ["x"]}\n'), F.when(F.col("p_partkey") % 10 == 9, "= broken").otherwise(""))
    texts = x.table("part").select(
        F.concat(F.lit("org"), (F.col("p_partkey") % 50).cast("string")).alias("repo"), F.lit("v1").alias("version"),
        F.lit(1).alias("source_rank"), F.col("p_partkey").cast("string").alias("path"), toml.alias("text"))
    rows = deps.parse_pyproject(deps.pyproject_tables(texts))
    # The python entry is skipped and takes no position.
    return rows.select("repo", F.col("path").cast("bigint").alias("file_id"), "position", "name", "version_spec")


@query("d9_first_mentions", "SELECT repo, line_no, name, version_spec FROM fx_deps")
def d9(x):
    return deps.first_mentions(parsed(x)).select("repo", line_no(), "name", "version_spec")


@query("c1_package_lookup", "SELECT repo, line_no, name, version_spec, github_repo FROM fx_deps")
def c1(x):
    return resolved(x).select("repo", line_no(), "name", "version_spec", "github_repo")


@query("b14_fetchable", "SELECT repo, line_no, name, github_repo FROM fx_deps WHERE github_repo IS NOT NULL")
def b14(x):
    return deps.fetchable(resolved(x)).select("repo", line_no(), "name", "github_repo")


MANY = "concat('org', p_partkey % 20)"


@query("e5_top_dependencies", """
    SELECT repo, name, dep_rank FROM (
        SELECT repo, name, CASE WHEN n > 3 THEN row_number() OVER (PARTITION BY repo ORDER BY priority)
                           ELSE row_number() OVER (PARTITION BY repo ORDER BY line_no) END AS dep_rank
        FROM (SELECT repo, name, priority, line_no, count(*) OVER (PARTITION BY repo) AS n FROM fx_deps WHERE github_repo IS NOT NULL))
    WHERE dep_rank <= 3""")
def e5(x):
    return deps.selected(resolved(x), max_deps=3).select("repo", "name", F.col("dep_rank").cast("long").alias("dep_rank"))


@query("e5_few_dependencies", """
    SELECT repo, name, row_number() OVER (PARTITION BY repo ORDER BY line_no) AS dep_rank FROM fx_deps WHERE github_repo IS NOT NULL""")
def e5_few(x):
    return deps.selected(resolved(x), max_deps=10).select("repo", "name", F.col("dep_rank").cast("long").alias("dep_rank"))


@query("g1_manifest_union", f"""
    SELECT repo, file_id, kind, name FROM (
        SELECT repo, file_id, 2 AS kind, name FROM ({SETUP_SQL})
        UNION ALL SELECT repo, line_no, 3, name FROM fx_parsed)""")
def g1(x):
    setup, lines = x.setup_texts(), x.requirement_texts()
    rows = deps.parse_setup_py(setup).unionByName(deps.parse_requirements(lines))
    return rows.select("repo", F.col("path").cast("bigint").alias("file_id"), F.col("source_rank").alias("kind"), "name")


@query("i4b_extract_dependencies", """
    SELECT d.repo, v.version, d.name, d.version_spec, d.github_repo, d.path
    FROM fx_manifest_deps d CROSS JOIN (SELECT DISTINCT tag_name AS version FROM fx_releases3) v""")
def i4b(x):
    return deps.dependencies(x.manifest_files(), x.known_packages()).select(
        "repo", "version", "name", "version_spec", "github_repo", "path")


@query("d13_dependency_summary", """
    SELECT repo, concat('# Dependencies', chr(10), chr(10), string_agg(
        concat(CASE WHEN github_repo IS NULL THEN '? ' ELSE '✓ ' END, name, ': ', coalesce(version_spec, 'any'),
               CASE WHEN github_repo IS NULL THEN '' ELSE concat(chr(10), '   GitHub: ', github_repo) END), chr(10) ORDER BY line_no)) AS summary
    FROM fx_deps GROUP BY repo""")
def d13(x):
    return rejoined(deps.dependency_summaries(resolved(x), 1024), ["repo", "version"], "summary").select("repo", "summary")


@query("c5_latest_release", """
    SELECT name AS github_repo, coalesce(r.tag_name, 'main') AS dep_version FROM fx_repos p
    LEFT JOIN (SELECT repo, arg_max(tag_name, (published_at, release_id)) AS tag_name FROM fx_part_releases GROUP BY repo) r ON r.repo = p.name""")
def c5(x):
    wanted = x.repos().select(
        F.lit("app").alias("repo"), F.lit("v1").alias("version"), F.col("name").alias("github_repo"))
    return deps.dependency_versions(wanted, x.part_releases()).select("github_repo", "dep_version")


def uses(x):
    found = deps.selected(deps.dependencies(x.manifest_files(), x.known_packages()))
    return deps.dependency_versions(found, x.releases3())


@query("c4_merged_files", """
    SELECT p.repo, p.from_version, p.to_version, 0 AS dep_rank, f.path, f.shown_size AS size, f.is_binary_stub
    FROM fx_pairs3 p JOIN fx_visible f ON f.repo = p.repo AND f.version = p.from_version
    UNION ALL
    SELECT p.repo, p.from_version, p.to_version, u.dep_rank, concat('__deps__/', f.repo, '/', f.path), f.shown_size, f.is_binary_stub
    FROM fx_pairs3 p JOIN fx_uses u ON u.repo = p.repo JOIN fx_visible f ON f.repo = u.github_repo AND f.version = 'v2.0.0'""")
def c4(x):
    files = snapshot.classified(x.raw().filter(in_snapshot(F.col("path"))))
    return deps.merged_files(pairs3(x), files, uses(x)).select(
        "repo", "from_version", "to_version", F.col("dep_rank").cast("long").alias("dep_rank"), "path", "size", "is_binary_stub")


@query("g2_merged_totals", """
    SELECT repo, from_version, to_version, count(*) AS num_files, CAST(sum(size) AS BIGINT) AS total_size FROM (
        SELECT p.repo, p.from_version, p.to_version, f.shown_size AS size FROM fx_pairs3 p JOIN fx_visible f ON f.repo = p.repo AND f.version = p.from_version
        UNION ALL
        SELECT p.repo, p.from_version, p.to_version, f.shown_size FROM fx_pairs3 p JOIN fx_uses u ON u.repo = p.repo
        JOIN fx_visible f ON f.repo = u.github_repo AND f.version = 'v2.0.0')
    GROUP BY ALL""")
def g2(x):
    files = snapshot.classified(x.raw().filter(in_snapshot(F.col("path"))))
    return deps.merged_files(pairs3(x), files, uses(x)).groupBy("repo", "from_version", "to_version").agg(
        F.count(F.lit(1)).alias("num_files"), F.sum("size").alias("total_size"))


@query("d12_dependency_counts", """
    SELECT p.repo, p.from_version, p.to_version, count(u.github_repo) AS num_dependencies
    FROM fx_pairs3 p LEFT JOIN fx_uses u ON u.repo = p.repo GROUP BY ALL""")
def d12(x):
    return deps.dependency_counts(pairs3(x), uses(x))
