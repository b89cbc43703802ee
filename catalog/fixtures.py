"""Inputs of the catalog queries, derived from the given tables.

Each input exists twice: as a DataFrame and as a DuckDB view (``VIEWS``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from codelineage import dims
from codelineage.operators.snapshot import raw_files

AS_OF = "2024-06-01 00:00:00"
KNOWN = [("torch", "src0", 0), ("numpy", "src1", 1), ("flash_attn", "src2", 2), ("ray", "src3", 3), ("ruamel", "src4", 4)]
EXTENSIONS = [".py", ".md", ".png", ".cpp", ".TXT", ".tar.gz", "", ".json"]
VERSIONS = [("v1.0.0", "2024-01-01"), ("v1.1.0", "2024-02-01"), ("v2.0.0", "2024-03-01")]


# One text for both engines; the lines of a file are the sentences of a document.
MOVED = """
    SELECT source AS repo, version,
           CASE doc_id % 3 WHEN 0 THEN concat('pkg', CAST(doc_id + k * 5000 AS STRING), '/__init__.py')
                           WHEN 1 THEN concat('src/n', CAST(doc_id * 31 + k AS STRING), '.py')
                           ELSE concat('keep/', CAST(doc_id AS STRING), '.md') END AS path,
           concat('import os\n\n', replace(text, '. ', '.\n'), '\n',
                  CASE WHEN doc_id % 4 < 3 THEN concat('tail ', CAST(k AS STRING), '\nmore ', CAST(doc_id AS STRING), '\n') ELSE '' END) AS content
    FROM {documents} CROSS JOIN LATERAL {versions}
    WHERE doc_id % 7 <> k + 1"""


class Inputs:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _sql(self, text: str, **tables: DataFrame) -> DataFrame:
        return self.spark.sql(text, **tables)

    def files(self) -> DataFrame:
        """(repo, version, path, content STRING): 20 repositories in three versions."""
        return self._sql(
            """
            SELECT source AS repo, version,
                   CASE WHEN doc_id % 11 = k THEN concat('moved/doc_', doc_id, ext)
                        WHEN doc_id % 10 = 9 THEN concat('.ci/doc_', doc_id, ext)
                        ELSE concat('src/', lang, '/doc_', doc_id, ext) END AS path,
                   CASE WHEN k >= 1 AND doc_id % 5 = k
                        THEN concat(text, '\n', 'appended ', k, '\n', 'tail ', k) ELSE text END AS content
            FROM (SELECT *, element_at(array('.py', '.md', '.png', '.cpp', '.TXT', '.tar.gz', '', '.json'),
                                       CAST(doc_id % 8 AS INT) + 1) AS ext FROM {documents})
            LATERAL VIEW posexplode(array('v1.0.0', 'v1.1.0', 'v2.0.0')) v AS k, version
            WHERE doc_id % 7 <> k + 1
            """, documents=self.table("documents"))

    def raw(self) -> DataFrame:
        return raw_files(self.files().withColumn("content", F.encode("content", "UTF-8")))

    def moved(self) -> DataFrame:
        """Raw files that change their folder or name in every version, most of them with edits; many share one file name."""
        return raw_files(self._sql(MOVED.format(documents="{documents}", versions="posexplode(array('v1.0.0', 'v1.1.0', 'v2.0.0')) AS v(k, version)"),
                                   documents=self.table("documents")).withColumn("content", F.encode("content", "UTF-8")))

    def records(self) -> DataFrame:
        """The examples in parts of 500 characters."""
        parts = F.greatest(F.ceil(F.length("input_text") / 500), F.ceil(F.length("output_text") / 500), F.lit(1)).cast("int")
        rows = self.examples().withColumn("parts", parts).withColumn("part_no", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        return rows.withColumns({
            c: F.substring(c, F.col("part_no") * 500 + 1, F.lit(500)) for c in ("input_text", "output_text")})

    def manifest_files(self) -> DataFrame:
        """One small requirements file per part, the same in every version."""
        rows = self.requirements().select(
            F.concat(F.lit("src"), (F.substring("repo", 4, 9).cast("int") % 20).cast("string")).alias("repo"),
            F.concat(F.lit("requirements/requirements_"), F.col("line_no").cast("string"), F.lit(".txt")).alias("path"),
            F.explode(F.array(*[F.lit(v) for v, _ in VERSIONS])).alias("version"),
            F.encode("line", "UTF-8").alias("content"))
        return raw_files(rows)

    def releases3(self) -> DataFrame:
        rows = [(v, day, i) for i, (v, day) in enumerate(VERSIONS)]
        versions = F.array(*[F.struct(
            F.lit(v).alias("tag_name"), F.lit(day).cast("timestamp").alias("published_at"), F.lit(i).alias("release_id"),
            F.lit(False).alias("is_prerelease"), F.lit(f"sha{i}").alias("commit_sha")) for v, day, i in rows])
        return self.table("documents").select(F.col("source").alias("repo")).distinct().select("repo", F.inline(versions))

    def releases(self) -> DataFrame:
        return self._sql(
            """
            SELECT concat('org', o_custkey % 50, '/repo', o_custkey % 50) AS repo, concat('v', o_orderkey) AS tag_name,
                   concat('Release ', o_orderkey, ' of ', o_orderpriority, ' for customer ', o_custkey) AS name,
                   CAST(o_orderdate AS TIMESTAMP) AS published_at, md5(concat('c', o_orderkey)) AS commit_sha,
                   o_orderstatus = 'P' AS is_prerelease, o_orderkey AS release_id
            FROM {orders}
            """, orders=self.table("orders"))

    def tag_tables(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(releases_raw, tag_refs, tag_objects): unresolved, light and annotated tags."""
        orders = self.table("orders")
        raw = self.releases().select(
            "repo", "tag_name",
            F.expr("CASE release_id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE concat('Release ', release_id) END").alias("title"),
            "published_at", F.concat(F.lit("https://x/"), "tag_name").alias("tarball_url"), "is_prerelease", "release_id")
        refs = self._sql(
            """
            SELECT concat('org', o_custkey % 50, '/repo', o_custkey % 50) AS repo, concat('v', o_orderkey) AS tag_name,
                   CASE WHEN o_orderkey % 3 = 0 THEN 'tag' ELSE 'commit' END AS ref_type, md5(concat('c', o_orderkey)) AS ref_sha
            FROM {orders}
            """, orders=orders)
        objects = self._sql(
            """
            SELECT concat('org', o_custkey % 50, '/repo', o_custkey % 50) AS repo,
                   md5(concat('c', o_orderkey)) AS tag_sha,
                   CASE WHEN o_orderkey % 7 <> 0 THEN md5(concat('p', o_orderkey)) END AS commit_sha
            FROM {orders}
            """, orders=orders)
        return raw, refs, objects

    def repos(self) -> DataFrame:
        """Discovered repositories; last_updated lies age_days before AS_OF."""
        return self._sql(
            f"""
            SELECT concat(p_brand, '/', p_partkey) AS name, p_name AS description, CAST(p_size AS BIGINT) * 100 AS stars,
                   CASE p_size % 4 WHEN 0 THEN 'Python' WHEN 1 THEN 'C++' WHEN 2 THEN 'Rust' ELSE 'Unknown' END AS language,
                   array(lower(p_type), lower(replace(p_brand, '#', ''))) AS topics,
                   CAST(p_size % 12 AS INT) AS release_count,
                   CASE WHEN p_size % 12 = 0 THEN NULL ELSE concat('v', p_size) END AS last_release,
                   TIMESTAMP '{AS_OF}' - make_dt_interval(p_size) AS last_updated, p_size AS age_days,
                   concat('https://x/', p_partkey) AS url
            FROM {{part}}
            """, part=self.table("part"))

    def repo_records(self) -> DataFrame:
        """Repository records with missing texts, as a hosting service returns them."""
        return self.repos().select(
            F.col("name").alias("full_name"),
            F.expr("CASE WHEN age_days % 5 = 0 THEN NULL ELSE description END").alias("description"),
            "stars", F.nullif("language", F.lit("Unknown")).alias("language"),
            F.expr("CASE WHEN age_days % 6 = 0 THEN NULL ELSE topics END").alias("topics"),
            F.col("last_updated").alias("updated_at"), "url")

    def part_releases(self) -> DataFrame:
        """Releases of the repositories made from parts, one per line item."""
        return self._sql(
            """
            SELECT concat(p_brand, '/', p_partkey) AS repo, concat('r', l_orderkey, '.', l_linenumber) AS tag_name,
                   CAST(l_shipdate AS TIMESTAMP) AS published_at, l_orderkey * 10 + l_linenumber AS release_id
            FROM {lineitem} JOIN {part} ON l_partkey = p_partkey
            """, lineitem=self.table("lineitem"), part=self.table("part"))

    def config(self) -> DataFrame:
        return self._sql(
            """
            SELECT concat(p_brand, '/', p_partkey) AS name,
                   CASE WHEN p_size % 4 = 0 THEN NULL ELSE concat_ws(' ', p_name, p_type, p_name, p_brand, p_name, p_name) END AS description,
                   CAST(NULL AS STRING) AS min_version, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size END AS max_versions,
                   CASE WHEN p_size % 5 = 0 THEN array('*.py', '*.md', 'src/*', 'docs/*') END AS file_patterns,
                   CASE WHEN p_size % 7 = 0 THEN array('*.png') END AS exclude_patterns
            FROM {part}
            """, part=self.table("part"))

    def requirements(self) -> DataFrame:
        return self._sql(
            """
            SELECT concat('org', p_partkey % 50) AS repo, CAST(p_partkey AS BIGINT) AS line_no,
                   concat(CASE p_partkey % 9 WHEN 0 THEN 'torch' WHEN 1 THEN 'NumPy' WHEN 2 THEN 'flash_attn'
                          WHEN 3 THEN 'requests' WHEN 4 THEN '# note' WHEN 5 THEN '-r base.txt' WHEN 6 THEN 'git+https://x/y'
                          WHEN 7 THEN 'ray[default]' ELSE 'ruamel.yaml' END,
                          CASE WHEN p_size % 3 = 0 THEN concat('>=', p_size) WHEN p_size % 3 = 1 THEN ' # pinned later' ELSE '' END) AS line
            FROM {part}
            """, part=self.table("part"))

    def requirement_texts(self) -> DataFrame:
        """Requirement lines as one-line manifest texts of (repo, version v1)."""
        return self.requirements().select(
            "repo", F.lit("v1").alias("version"), F.lit(3).alias("source_rank"),
            F.lpad(F.col("line_no").cast("string"), 12, "0").alias("path"), F.col("line").alias("text"))

    def setup_texts(self) -> DataFrame:
        return self._sql(
            """
            SELECT concat('org', p_partkey % 50) AS repo, 'v1' AS version, 2 AS source_rank,
                   lpad(CAST(p_partkey AS STRING), 12, '0') AS path,
                   concat('from setuptools import setup', '\n', 'setup(name="x", install_requires=[', '\n', '  "torch>=', p_size,
                          '", ''numpy'', "ray', CASE WHEN p_size % 4 = 0 THEN '[tune]' ELSE '' END, '", "pandas<3"])') AS text
            FROM {part}
            """, part=self.table("part"))

    def known_packages(self) -> DataFrame:
        return dims.inline_table(self.spark, KNOWN, ["package", "github_repo", "priority"])

    def examples(self) -> DataFrame:
        return self._sql(
            """
            SELECT source AS repo_name, concat('v', doc_id) AS from_version, concat('v', doc_id + 1) AS to_version,
                   '2024-01-01T00:00:00' AS created_at, text AS input_text, text AS output_text,
                   CAST(length(text) DIV 4 AS BIGINT) AS input_tokens_approx,
                   CAST(length(text) DIV 4 AS BIGINT) AS output_tokens_approx,
                   doc_id % 50 + 1 AS num_files_in_codebase, doc_id % 7 AS num_files_changed, doc_id % 3 AS num_dependencies
            FROM {documents}
            """, documents=self.table("documents"))


def _values(rows) -> str:
    def cell(v):
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)


_KINDS = [(e, k) for k, es in dims.BINARY_KINDS.items() for e in es]
_UTF8_BYTES = "octet_length(encode(content))"
BAR = "=" * 80

VIEWS = {
    "fx_files": f"""
        SELECT d.doc_id, r.k, d.source AS repo, r.version AS version,
               CASE WHEN d.doc_id % 11 = r.k THEN concat('moved/doc_', d.doc_id, e.ext)
                    WHEN d.doc_id % 10 = 9 THEN concat('.ci/doc_', d.doc_id, e.ext)
                    ELSE concat('src/', d.lang, '/doc_', d.doc_id, e.ext) END AS path,
               CASE WHEN r.k >= 1 AND d.doc_id % 5 = r.k THEN concat(d.text, chr(10), 'appended ', r.k, chr(10), 'tail ', r.k)
                    ELSE d.text END AS content
        FROM documents d CROSS JOIN (VALUES {_values((i, v) for i, (v, _) in enumerate(VERSIONS))}) AS r(k, version)
        JOIN (VALUES {_values(enumerate(EXTENSIONS))}) AS e(i, ext) ON d.doc_id % 8 = e.i
        WHERE d.doc_id % 7 <> r.k + 1""",
    "fx_releases3": f"""
        SELECT DISTINCT d.source AS repo, r.tag_name, CAST(r.day AS DATE) AS published_at, r.k AS release_id
        FROM documents d CROSS JOIN (VALUES {_values((i, v, day) for i, (v, day) in enumerate(VERSIONS))}) AS r(k, tag_name, day)""",
    "fx_pairs3": """
        SELECT repo, from_version, to_version, k FROM (
            SELECT repo, tag_name AS from_version, release_id AS k,
                   lead(tag_name) OVER (PARTITION BY repo ORDER BY published_at, release_id) AS to_version
            FROM fx_releases3) WHERE to_version IS NOT NULL""",
    "fx_releases": """
        SELECT concat('org', o_custkey % 50, '/repo', o_custkey % 50) AS repo, concat('v', o_orderkey) AS tag_name,
               concat('Release ', o_orderkey, ' of ', o_orderpriority, ' for customer ', o_custkey) AS name,
               o_orderdate AS published_at, md5(concat('c', o_orderkey)) AS commit_sha,
               o_orderstatus = 'P' AS is_prerelease, o_orderkey AS release_id
        FROM orders""",
    "fx_tag_commits": """
        SELECT repo, tag_name, CASE WHEN release_id % 3 <> 0 THEN commit_sha
               WHEN release_id % 7 <> 0 THEN md5(concat('p', release_id)) END AS commit_sha
        FROM fx_releases""",
    "fx_repos": f"""
        SELECT concat(p_brand, '/', p_partkey) AS name, p_name AS description, CAST(p_size AS BIGINT) * 100 AS stars,
               CASE p_size % 4 WHEN 0 THEN 'Python' WHEN 1 THEN 'C++' WHEN 2 THEN 'Rust' ELSE 'Unknown' END AS language,
               lower(p_type) AS topic1, lower(replace(p_brand, '#', '')) AS topic2,
               CAST(p_size % 12 AS INT) AS release_count,
               CASE WHEN p_size % 12 = 0 THEN NULL ELSE concat('v', p_size) END AS last_release,
               p_size AS age_days, p_partkey AS id
        FROM part""",
    "fx_part_releases": """
        SELECT concat(p_brand, '/', p_partkey) AS repo, concat('r', l_orderkey, '.', l_linenumber) AS tag_name,
               l_shipdate AS published_at, l_orderkey * 10 + l_linenumber AS release_id
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "fx_config": """
        SELECT concat(p_brand, '/', p_partkey) AS name,
               CASE WHEN p_size % 4 = 0 THEN NULL ELSE concat_ws(' ', p_name, p_type, p_name, p_brand, p_name, p_name) END AS description,
               CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size END AS max_versions,
               CASE WHEN p_size % 5 = 0 THEN '*.py,*.md,src/*,docs/*' END AS file_patterns,
               CASE WHEN p_size % 7 = 0 THEN '*.png' END AS exclude_patterns
        FROM part""",
    "fx_requirements": """
        SELECT concat('org', p_partkey % 50) AS repo, CAST(p_partkey AS BIGINT) AS line_no,
               concat(CASE p_partkey % 9 WHEN 0 THEN 'torch' WHEN 1 THEN 'NumPy' WHEN 2 THEN 'flash_attn'
                      WHEN 3 THEN 'requests' WHEN 4 THEN '# note' WHEN 5 THEN '-r base.txt' WHEN 6 THEN 'git+https://x/y'
                      WHEN 7 THEN 'ray[default]' ELSE 'ruamel.yaml' END,
                      CASE WHEN p_size % 3 = 0 THEN concat('>=', p_size) WHEN p_size % 3 = 1 THEN ' # pinned later' ELSE '' END) AS line
        FROM part""",
    "fx_setup": """
        SELECT concat('org', p_partkey % 50) AS repo, p_partkey AS file_id, p_size,
               concat('from setuptools import setup', chr(10), 'setup(name="x", install_requires=[', chr(10), '  "torch>=', p_size,
                      '", ''numpy'', "ray', CASE WHEN p_size % 4 = 0 THEN '[tune]' ELSE '' END, '", "pandas<3"])') AS content
        FROM part""",
    "fx_known": f"SELECT * FROM (VALUES {_values(KNOWN)}) AS t(package, github_repo, priority)",
    "fx_examples": """
        SELECT source AS repo_name, concat('v', doc_id) AS from_version, concat('v', doc_id + 1) AS to_version,
               text AS input_text, text AS output_text, length(text) // 4 AS input_tokens_approx,
               length(text) // 4 AS output_tokens_approx, doc_id % 50 + 1 AS num_files_in_codebase,
               doc_id % 7 AS num_files_changed, doc_id % 3 AS num_dependencies
        FROM documents""",
    # Requirement lines parsed with regular expressions.
    "fx_parsed": r"""
        SELECT repo, line_no, regexp_extract(bare, '^([a-zA-Z0-9_-]+)\s*(.*)', 1) AS name,
               nullif(trim(regexp_extract(bare, '^([a-zA-Z0-9_-]+)\s*(.*)', 2)), '') AS version_spec
        FROM (SELECT repo, line_no, plain, regexp_replace(plain, '\[.*?\]', '', 'g') AS bare
              FROM (SELECT repo, line_no, trim(split_part(line, '#', 1)) AS plain FROM fx_requirements
                    WHERE trim(line) <> '' AND NOT regexp_matches(trim(line), '^[#-]'))
              WHERE NOT regexp_matches(plain, '^(https?://|git\+|\.|/)'))
        WHERE regexp_matches(bare, '^[a-zA-Z0-9_-]')""",
    "fx_deps": """
        SELECT p.repo, p.line_no, p.name, p.version_spec, k.github_repo, k.priority
        FROM (SELECT *, row_number() OVER (PARTITION BY repo, lower(name) ORDER BY line_no) AS rn FROM fx_parsed) p
        LEFT JOIN fx_known k ON k.package = lower(p.name) WHERE rn = 1""",
    "fx_languages": f"SELECT * FROM (VALUES {_values(dims.LANGUAGES.items())}) AS t(ext, language)",
    "fx_binary": f"SELECT * FROM (VALUES {_values(_KINDS)}) AS t(ext, kind)",
    # Classification of every fixture file. The last test finds a character cut at byte 8,192.
    "fx_class": rf"""
        SELECT doc_id, k, repo, version, path, content, size, language, stub, stub IS NOT NULL AS is_binary_stub,
               coalesce(stub, content) AS shown, coalesce(CAST(length(stub) AS BIGINT), size) AS shown_size
        FROM (SELECT f.*, coalesce(l.language, 'unknown') AS language,
                     CASE WHEN b.kind IS NOT NULL THEN concat('[BINARY ', b.kind, ': ', format('{{:,}}', f.size), ' bytes]')
                          WHEN cut THEN concat('[BINARY FILE: ', format('{{:,}}', f.size), ' bytes]') END AS stub
              FROM (SELECT *, CAST({_UTF8_BYTES} AS BIGINT) AS size,
                           lower(regexp_extract(split_part(path, '/', -1), '^.+(\.[^.]+)$', 1)) AS ext,
                           {_UTF8_BYTES} > 8192 AND substring(hex(encode(content)), 16385, 2) BETWEEN '80' AND 'BF' AS cut
                    FROM fx_files) f
              LEFT JOIN fx_languages l ON l.ext = f.ext LEFT JOIN fx_binary b ON b.ext = f.ext)""",
    "fx_visible": r"SELECT * FROM fx_class WHERE NOT regexp_matches(path, '(^|/)\.')",
    # Tree nodes; fixture paths have at most three parts.
    "fx_nodes": """
        SELECT *, lead(name) OVER (PARTITION BY repo, version, parent ORDER BY name) IS NULL AS is_last FROM (
            SELECT DISTINCT repo, version, array_to_string(p[1:i], '/') AS node, p[i] AS name, array_to_string(p[1:i - 1], '/') AS parent, i AS depth,
                   CASE WHEN i > 1 THEN p[1] END AS up1, CASE WHEN i > 2 THEN array_to_string(p[1:2], '/') END AS up2
            FROM (SELECT repo, version, string_split(path, '/') AS p, unnest(range(1, len(string_split(path, '/')) + 1)) AS i FROM fx_files))""",
    "fx_tree_lines": """
        SELECT n.repo, n.version, n.node, concat(coalesce(a.prefix, ''), CASE WHEN n.is_last THEN '└── ' ELSE '├── ' END, n.name) AS line
        FROM fx_nodes n LEFT JOIN (
            SELECT d.repo, d.version, d.node, string_agg(CASE WHEN u.is_last THEN '    ' ELSE '│   ' END, '' ORDER BY u.depth) AS prefix
            FROM fx_nodes d JOIN fx_nodes u ON u.repo = d.repo AND u.version = d.version AND u.node = d.up1
                                            OR u.repo = d.repo AND u.version = d.version AND u.node = d.up2
            GROUP BY ALL) a ON a.repo = n.repo AND a.version = n.version AND a.node = n.node""",
    # Path-level changes: both sides of every pair under (pair, path).
    "fx_changes": """
        SELECT repo, from_version, to_version, k, path, old_content, new_content, doc_id,
               CASE WHEN old_content IS NULL THEN 'added' WHEN new_content IS NULL THEN 'deleted' ELSE 'modified' END AS change_type
        FROM (SELECT coalesce(a.repo, b.repo) AS repo, coalesce(a.from_version, b.from_version) AS from_version,
                     coalesce(a.to_version, b.to_version) AS to_version, coalesce(a.k, b.k) AS k,
                     coalesce(a.path, b.path) AS path, coalesce(a.doc_id, b.doc_id) AS doc_id,
                     a.content AS old_content, b.content AS new_content
              FROM (SELECT p.*, f.path, f.content, f.doc_id FROM fx_pairs3 p JOIN fx_files f ON f.repo = p.repo AND f.version = p.from_version) a
              FULL OUTER JOIN (SELECT p.*, f.path, f.content, f.doc_id FROM fx_pairs3 p JOIN fx_files f ON f.repo = p.repo AND f.version = p.to_version) b
              ON a.repo = b.repo AND a.from_version = b.from_version AND a.path = b.path)
        WHERE old_content IS DISTINCT FROM new_content""",
    # Exact renames: same content, first under the same file name, then any, by path order.
    "fx_sides": """
        SELECT repo, from_version, to_version, path, change_type, split_part(path, '/', -1) AS name,
               sha256(coalesce(old_content, new_content)) AS sha FROM fx_changes WHERE change_type <> 'modified'""",
    "fx_numbered1": """
        SELECT *, row_number() OVER (PARTITION BY repo, from_version, sha, name, change_type ORDER BY path) AS rn FROM fx_sides""",
    "fx_renames1": """
        SELECT d.repo, d.from_version, d.to_version, d.path AS old_path, a.path
        FROM fx_numbered1 d JOIN fx_numbered1 a ON d.change_type = 'deleted' AND a.change_type = 'added' AND d.repo = a.repo
         AND d.from_version = a.from_version AND d.sha = a.sha AND d.name = a.name AND d.rn = a.rn""",
    "fx_numbered2": """
        SELECT s.*, row_number() OVER (PARTITION BY s.repo, s.from_version, sha, change_type ORDER BY s.path) AS rn
        FROM fx_sides s
        WHERE NOT EXISTS (SELECT 1 FROM fx_renames1 r WHERE r.repo = s.repo AND r.from_version = s.from_version
                          AND ((s.change_type = 'deleted' AND r.old_path = s.path) OR (s.change_type = 'added' AND r.path = s.path)))""",
    "fx_renames": """
        SELECT * FROM fx_renames1 UNION ALL
        SELECT d.repo, d.from_version, d.to_version, d.path AS old_path, a.path
        FROM fx_numbered2 d JOIN fx_numbered2 a ON d.change_type = 'deleted' AND a.change_type = 'added' AND d.repo = a.repo
         AND d.from_version = a.from_version AND d.sha = a.sha AND d.rn = a.rn""",
    "fx_changes_r": """
        SELECT c.repo, c.from_version, c.to_version, c.k, c.path, r.old_path, c.doc_id,
               CASE WHEN r.path IS NOT NULL THEN c.new_content ELSE c.old_content END AS old_content, c.new_content,
               CASE WHEN r.path IS NOT NULL THEN 'renamed' ELSE c.change_type END AS change_type
        FROM fx_changes c
        LEFT JOIN fx_renames r ON r.repo = c.repo AND r.from_version = c.from_version AND r.path = c.path AND c.change_type = 'added'
        WHERE NOT (c.change_type = 'deleted' AND EXISTS (
            SELECT 1 FROM fx_renames x WHERE x.repo = c.repo AND x.from_version = c.from_version AND x.old_path = c.path))""",
    "fx_loose": """
        SELECT repo, from_version, to_version, path, change_type = 'deleted' AS is_old, coalesce(old_content, new_content) AS content
        FROM fx_changes_r WHERE change_type IN ('added', 'deleted')""",
    "fx_moved": MOVED.format(documents="documents", versions="""
        (SELECT unnest([0, 1, 2]) AS k, unnest(['v1.0.0', 'v1.1.0', 'v2.0.0']) AS version)"""),
    "fx_moved_changes": """
        SELECT p.repo, p.from_version, p.to_version, p.path, o.content AS old_content, n.content AS new_content
        FROM (SELECT DISTINCT p.*, f.path FROM fx_pairs3 p JOIN fx_moved f ON f.repo = p.repo AND f.version IN (p.from_version, p.to_version)) p
        LEFT JOIN fx_moved o ON o.repo = p.repo AND o.version = p.from_version AND o.path = p.path
        LEFT JOIN fx_moved n ON n.repo = p.repo AND n.version = p.to_version AND n.path = p.path
        WHERE o.content IS DISTINCT FROM n.content""",
    "fx_moved_loose": """
        SELECT repo, from_version, to_version, path, new_content IS NULL AS is_old, coalesce(old_content, new_content) AS content
        FROM fx_moved_changes WHERE old_content IS NULL OR new_content IS NULL""",
    # Diffs in closed form: whole files, or a two-line tail put on or taken off.
    "fx_diffs": r"""
        SELECT repo, from_version, to_version, path AS file_path, change_type, old_path,
               CASE change_type
                    WHEN 'renamed' THEN ''
                    WHEN 'added' THEN concat('--- a/', path, chr(10), '+++ b/', path, chr(10), '@@ -0,0 +1',
                        CASE WHEN new_n = 1 THEN '' ELSE concat(',', new_n) END, ' @@', chr(10), '+', replace(new_content, chr(10), concat(chr(10), '+')))
                    WHEN 'deleted' THEN concat('--- a/', path, chr(10), '+++ b/', path, chr(10), '@@ -1',
                        CASE WHEN old_n = 1 THEN '' ELSE concat(',', old_n) END, ' +0,0 @@', chr(10), '-', replace(old_content, chr(10), concat(chr(10), '-')))
                    ELSE concat('--- a/', path, chr(10), '+++ b/', path, chr(10), '@@ -', first,
                        CASE WHEN old_n - first = 0 THEN '' ELSE concat(',', old_n - first + 1) END, ' +', first,
                        CASE WHEN new_n - first = 0 THEN '' ELSE concat(',', new_n - first + 1) END, ' @@', chr(10),
                        list_aggregate([concat(' ', x, chr(10)) for x in lines[first:base_n - 1]], 'string_agg', ''),
                        CASE WHEN new_n > old_n
                             THEN concat('-', lines[base_n], '+', lines[base_n], chr(10), '+appended ', tail_k, chr(10), '+tail ', tail_k)
                             ELSE concat('-', lines[base_n], chr(10), '-appended ', tail_k, chr(10), '-tail ', tail_k, '+', lines[base_n]) END)
               END AS diff_content,
               CASE change_type WHEN 'renamed' THEN 0 WHEN 'added' THEN new_n WHEN 'deleted' THEN 0
                    ELSE CASE WHEN new_n > old_n THEN 3 ELSE 1 END END AS additions,
               CASE change_type WHEN 'renamed' THEN 0 WHEN 'added' THEN 0 WHEN 'deleted' THEN old_n
                    ELSE CASE WHEN new_n > old_n THEN 1 ELSE 3 END END AS deletions
        FROM (SELECT *, greatest(base_n - 3, 1) AS first
              FROM (SELECT *, len(string_split(old_content, chr(10))) AS old_n, len(string_split(new_content, chr(10))) AS new_n,
                           CASE WHEN length(new_content) > length(old_content) THEN string_split(old_content, chr(10))
                                ELSE string_split(new_content, chr(10)) END AS lines,
                           CASE WHEN length(new_content) > length(old_content) THEN len(string_split(old_content, chr(10)))
                                ELSE len(string_split(new_content, chr(10))) END AS base_n,
                           CASE WHEN length(new_content) > length(old_content) THEN k + 1 ELSE k END AS tail_k
                    FROM fx_changes_r))""",
    "fx_diff_totals": """
        SELECT repo, from_version, to_version, count(*) AS files_changed, CAST(sum(additions) AS BIGINT) AS total_additions,
               CAST(sum(deletions) AS BIGINT) AS total_deletions, count(*) FILTER (change_type = 'added') AS files_added,
               count(*) FILTER (change_type IN ('modified', 'renamed')) AS files_modified,
               count(*) FILTER (change_type = 'deleted') AS files_deleted
        FROM fx_diffs GROUP BY ALL""",
    "fx_diff_texts": f"""
        SELECT t.repo, t.from_version, t.to_version, t.files_changed,
               concat_ws(chr(10), concat('# Repository: ', replace(t.repo, '/', '_')), concat('# From Version: ', t.from_version),
                   concat('# To Version: ', t.to_version), concat('# Files Changed: ', files_changed),
                   concat('# Additions: +', total_additions), concat('# Deletions: -', total_deletions), '', '# Summary:',
                   concat('#   Added: ', files_added), concat('#   Modified: ', files_modified),
                   concat('#   Deleted: ', files_deleted), '', b.body) AS text
        FROM fx_diff_totals t JOIN (
            SELECT repo, from_version, string_agg(concat_ws(chr(10), '{BAR}',
                       CASE WHEN change_type = 'renamed' THEN concat('RENAMED: ', old_path, ' -> ', file_path)
                            ELSE concat(upper(change_type), ': ', file_path) END,
                       concat('(+', additions, ', -', deletions, ')'), '{BAR}', diff_content, ''), chr(10) ORDER BY file_path) AS body
            FROM fx_diffs GROUP BY ALL) b ON b.repo = t.repo AND b.from_version = t.from_version""",
    "fx_all_diff_texts": "SELECT * FROM fx_diff_texts",
    # Manifest files: one requirement each; the path order is the order of mention.
    "fx_manifest_deps": """
        SELECT repo, name, version_spec, github_repo, priority, path FROM (
            SELECT concat('src', CAST(substr(p.repo, 4) AS INT) % 20) AS repo, p.name, p.version_spec, k.github_repo, k.priority,
                   concat('requirements/requirements_', p.line_no, '.txt') AS path,
                   row_number() OVER (PARTITION BY CAST(substr(p.repo, 4) AS INT) % 20, lower(p.name)
                                      ORDER BY concat('requirements/requirements_', p.line_no, '.txt')) AS rn
            FROM fx_parsed p LEFT JOIN fx_known k ON k.package = lower(p.name)) WHERE rn = 1""",
    "fx_uses": """
        SELECT repo, github_repo, row_number() OVER (PARTITION BY repo ORDER BY path) AS dep_rank
        FROM fx_manifest_deps WHERE github_repo IS NOT NULL""",
    "fx_own_files": """
        SELECT repo, version, path, shown, shown_size FROM fx_visible""",
    "fx_block_files": """
        SELECT repo, version, path, shown, shown_size FROM fx_visible
        UNION ALL
        SELECT concat('src', CAST(substr(q.repo, 4) AS INT) % 20), v.version, concat('requirements/requirements_', q.line_no, '.txt'), q.line,
               CAST(octet_length(encode(q.line)) AS BIGINT)
        FROM fx_requirements q CROSS JOIN (SELECT DISTINCT tag_name AS version FROM fx_releases3) v""",
    "fx_blocks": f"""
        SELECT repo, version, is_dep, count(*) AS n, CAST(sum(shown_size) AS BIGINT) AS size,
               string_agg(concat_ws(chr(10), '{BAR}', concat('FILE: ', CASE WHEN is_dep THEN concat('__deps__/', repo, '/') ELSE '' END, path), '{BAR}', shown, ''),
                          chr(10) ORDER BY path) AS body
        FROM fx_block_files CROSS JOIN (VALUES (true), (false)) AS d(is_dep) GROUP BY repo, version, is_dep""",
    "fx_own_blocks": f"""
        SELECT repo, version, false AS is_dep, count(*) AS n, CAST(sum(shown_size) AS BIGINT) AS size,
               string_agg(concat_ws(chr(10), '{BAR}', concat('FILE: ', path), '{BAR}', shown, ''), chr(10) ORDER BY path) AS body
        FROM fx_own_files GROUP BY repo, version""",
}


def with_views(sql: str) -> str:
    """Prefix a query with the views it needs, in the order they are defined."""
    import re

    needed: set[str] = set()
    pending = [sql]
    while pending:
        for name in set(re.findall(r"\bfx_\w+", pending.pop())) - needed:
            needed.add(name)
            pending.append(VIEWS[name])
    parts = [f"{name} AS ({VIEWS[name]})" for name in VIEWS if name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + sql
