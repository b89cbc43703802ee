"""Differences between versions and finished examples."""

from pyspark.sql import functions as F

from catalog.registry import query
from codelineage.operators import diff, render, trees
from codelineage.operators.examples import create_examples
from codelineage.operators.ordered import with_order
from codelineage.operators.releases import release_pairs
from codelineage.plans.dataset import build_dataset, build_single
from codelineage.settings import Settings
from codelineage.sources import archives
from codelineage.storage import fresh_path, written

PAIR = diff.PAIR
CREATED = "2024-01-01T00:00:00"


def pairs3(x):
    return release_pairs(x.releases3())


def table3(x):
    """Raw files as the jobs expect them: a table."""
    return written(x.raw(), "raw_files")


def contents3(x):
    """What diffs read of the raw files, made again for each of the few scans instead of being written."""
    return x.raw().select("repo", "version", "path", "content", "content_sha")


def diffs3(x):
    return written(diff.file_diffs(pairs3(x), contents3(x)), "file_diffs")


def counts3(x):
    """Line counts of the diffs, without their texts: (pair, file_path, change_type, additions, deletions)."""
    return diff.file_diffs(pairs3(x), contents3(x)).select(*PAIR, "file_path", "change_type", "additions", "deletions")


def tar_archives(files, path, content, broken):
    """Rows of ``files`` with an archive of one file as their content: cut in the middle where ``broken`` is 1, no archive at all where it is 2."""
    @F.pandas_udf("binary")
    def packed(paths, contents, faults):
        import io
        import tarfile

        import pandas as pd

        def one(path, content, fault):
            raw = io.BytesIO()
            with tarfile.open(fileobj=raw, mode="w:gz") as tar:
                info = tarfile.TarInfo(f"top/{path}")
                info.size = len(content)
                tar.addfile(info, io.BytesIO(content))
            return [raw.getvalue(), raw.getvalue()[:len(raw.getvalue()) // 2], b"no archive"][fault]

        return pd.Series([one(*row) for row in zip(paths, contents, faults)])

    return files.withColumn("content", packed(path, content, broken))


@query("c2_version_diff", """
    SELECT repo, from_version, to_version, path, change_type, sha256(old_content) AS old_sha, sha256(new_content) AS new_sha FROM fx_changes""")
def c2(x):
    return diff.path_changes(pairs3(x), x.raw()).select(*PAIR, "path", "change_type", "old_sha", "new_sha")


@query("c2_tree_diff", """
    SELECT repo, from_version, to_version, path, change_type, sha256(old_content) AS old_sha, sha256(new_content) AS new_sha FROM fx_changes""")
def c2_tree(x):
    """From trees of folder hashes that are kept, each release's appended when it comes."""
    kept, files = fresh_path(x.spark, "trees"), table3(x)
    for of_release in ("version = 'v1.0.0'", "version = 'v1.1.0'", "version NOT IN ('v1.0.0', 'v1.1.0')"):
        trees.save_trees(trees.folder_trees(files.filter(of_release)), kept)
    return trees.tree_changes(pairs3(x), trees.read_trees(x.spark, kept)).select(*PAIR, "path", "change_type", "old_sha", "new_sha")


@query("c3_renames", "SELECT repo, from_version, to_version, path, old_path, change_type FROM fx_changes_r")
def c3(x):
    return diff.changed_files(pairs3(x), x.raw()).select(*PAIR, "path", "old_path", "change_type")


def near_sql(loose: str, threshold: float, rounds: int = 8) -> str:
    """CTEs up to ``near`` (pair, old_path, new_path): all contents of a pair compared by all lines, the best couples first."""
    pair = "repo, from_version, to_version"
    ctes = [f"""
    loose AS MATERIALIZED (SELECT {pair}, path, is_old, md5(content) AS sha, content,
        row_number() OVER (PARTITION BY {pair}, is_old, md5(content) ORDER BY path) AS place FROM {loose}),
    pieces AS (SELECT sha, string_split(content, chr(10)) AS parts FROM (SELECT DISTINCT sha, content FROM loose)),
    lines AS MATERIALIZED (
        SELECT sha, line, count(*) AS n, strlen(line) AS size FROM (
            SELECT sha, unnest(list_transform(parts[:-2], lambda x: x || chr(10)) || CASE WHEN parts[-1] = '' THEN [] ELSE [parts[-1]] END) AS line FROM pieces)
        GROUP BY sha, line),
    totals AS (SELECT sha, sum(n * size) AS total FROM lines GROUP BY sha),
    contents AS MATERIALIZED (SELECT {pair}, is_old, sha, min(path) AS first, count(*) AS n FROM loose GROUP BY ALL),
    shared AS (
        SELECT a.repo, a.from_version, a.to_version, a.sha AS a, b.sha AS b, sum(least(x.n, y.n) * x.size) AS shared
        FROM contents a JOIN contents b ON a.is_old AND NOT b.is_old AND a.repo = b.repo AND a.from_version = b.from_version
        JOIN lines x ON x.sha = a.sha JOIN lines y ON y.sha = b.sha AND y.line = x.line GROUP BY ALL),
    open0 AS MATERIALIZED (
        SELECT s.repo, s.from_version, s.to_version, s.a, s.b, shared / greatest(t.total, u.total) AS score, a.first AS fa, b.first AS fb,
               a.n AS la, b.n AS lb, 0 AS ua, 0 AS ub
        FROM shared s JOIN totals t ON t.sha = s.a JOIN totals u ON u.sha = s.b
        JOIN contents a ON a.is_old AND a.sha = s.a AND a.repo = s.repo AND a.from_version = s.from_version
        JOIN contents b ON NOT b.is_old AND b.sha = s.b AND b.repo = s.repo AND b.from_version = s.from_version
        WHERE shared >= greatest(t.total, u.total) * {threshold})"""]
    for i in range(rounds):
        ctes.append(f"""
    best{i} AS MATERIALIZED (
        SELECT *, least(la, lb) AS taken FROM open{i}
        QUALIFY row_number() OVER (PARTITION BY {pair}, a ORDER BY score DESC, fa, fb) = 1 AND row_number() OVER (PARTITION BY {pair}, b ORDER BY score DESC, fa, fb) = 1),
    open{i + 1} AS MATERIALIZED (
        SELECT o.repo, o.from_version, o.to_version, o.a, o.b, o.score, o.fa, o.fb, o.la - coalesce(x.taken, 0) AS la, o.lb - coalesce(y.taken, 0) AS lb,
               o.ua + coalesce(x.taken, 0) AS ua, o.ub + coalesce(y.taken, 0) AS ub
        FROM open{i} o LEFT JOIN best{i} x ON x.repo = o.repo AND x.from_version = o.from_version AND x.a = o.a
        LEFT JOIN best{i} y ON y.repo = o.repo AND y.from_version = o.from_version AND y.b = o.b
        WHERE o.la > coalesce(x.taken, 0) AND o.lb > coalesce(y.taken, 0))""")
    best = " UNION ALL ".join(f"SELECT * FROM best{i}" for i in range(rounds))
    ctes.append(f"""
    near AS MATERIALIZED (
        SELECT m.repo, m.from_version, m.to_version, o.path AS old_path, n.path AS new_path FROM ({best}) m
        JOIN loose o ON o.is_old AND o.repo = m.repo AND o.from_version = m.from_version AND o.sha = m.a AND o.place > ua AND o.place <= ua + taken
        JOIN loose n ON NOT n.is_old AND n.repo = m.repo AND n.from_version = m.from_version AND n.sha = m.b AND n.place = o.place - ua + ub)""")
    return "WITH " + ",".join(ctes)


NEAR_ROWS = """
    SELECT repo, from_version, to_version, path, NULL AS old_path, CASE WHEN is_old THEN 'deleted' ELSE 'added' END AS change_type FROM loose l
    WHERE NOT EXISTS (SELECT 1 FROM near m WHERE m.repo = l.repo AND m.from_version = l.from_version AND (CASE WHEN l.is_old THEN m.old_path ELSE m.new_path END) = l.path)
    UNION ALL SELECT repo, from_version, to_version, new_path, old_path, 'renamed' FROM near"""


@query("c3_near_renames", "SELECT * FROM (" + near_sql("fx_loose", 0.5) + NEAR_ROWS + """
    UNION ALL SELECT repo, from_version, to_version, path, old_path, change_type FROM fx_changes_r WHERE change_type IN ('modified', 'renamed'))""")
def c3_near(x):
    rows = diff.changed_files(pairs3(x), contents3(x), near_threshold=0.5)
    return rows.select(*PAIR, "path", "old_path", "change_type")


@query("c3_moved_and_edited", "SELECT * FROM (" + near_sql("fx_moved_loose", 0.7) + NEAR_ROWS + """
    UNION ALL SELECT repo, from_version, to_version, path, NULL, 'modified' FROM fx_moved_changes WHERE old_content IS NOT NULL AND new_content IS NOT NULL)""")
def c3_moved(x):
    """Every file moved, renamed or edited, many of one name; exact and near renames in one matching."""
    files = x.moved().select("repo", "version", "path", "content", "content_sha")
    changes = written(diff.path_changes(pairs3(x), files).withColumn("old_path", F.lit(None).cast("string")), "changes")
    return diff.near_renames(changes, files, 0.7).select(*PAIR, "path", "old_path", "change_type")


@query("c8_changed_files", """
    SELECT p.repo, p.from_version, p.to_version, f.path, 'added' AS change_type FROM fx_pairs3 p JOIN fx_files f ON f.repo = p.repo AND f.version = p.to_version
    WHERE NOT EXISTS (SELECT 1 FROM fx_files o WHERE o.repo = p.repo AND o.version = p.from_version AND o.path = f.path)
    UNION ALL
    SELECT p.repo, p.from_version, p.to_version, f.path, 'deleted' FROM fx_pairs3 p JOIN fx_files f ON f.repo = p.repo AND f.version = p.from_version
    WHERE NOT EXISTS (SELECT 1 FROM fx_files o WHERE o.repo = p.repo AND o.version = p.to_version AND o.path = f.path)
    UNION ALL
    SELECT p.repo, p.from_version, p.to_version, a.path, 'modified' FROM fx_pairs3 p JOIN fx_files a ON a.repo = p.repo AND a.version = p.from_version
    JOIN fx_files b ON b.repo = p.repo AND b.version = p.to_version AND b.path = a.path WHERE a.content <> b.content""")
def c8(x):
    return diff.changed_files(pairs3(x), x.raw(), detect_renames=False).select(*PAIR, "path", "change_type")


@query("b3_diff_patterns", r"""
    SELECT repo, from_version, to_version, path, change_type FROM fx_changes
    WHERE (regexp_matches(path, '^(.*\.py|moved/.*)$') OR regexp_matches(split_part(path, '/', -1), '^(.*\.py|moved/.*)$'))
      AND NOT (regexp_matches(path, '^doc_1.*$') OR regexp_matches(split_part(path, '/', -1), '^doc_1.*$'))""")
def b3_patterns(x):
    rows = diff.changed_files(pairs3(x), x.raw(), ["*.py", "moved/*"], ["doc_1*"], detect_renames=False)
    return rows.select(*PAIR, "path", "change_type")


@query("h4_unified_diff", """
    SELECT repo, from_version, to_version, file_path, md5(diff_content) AS diff_md5, length(diff_content) AS diff_chars FROM fx_diffs""")
def h4(x):
    return diff.file_diffs(pairs3(x), contents3(x)).select(
        *PAIR, "file_path", F.md5("diff_content").alias("diff_md5"), F.length("diff_content").cast("long").alias("diff_chars"))


@query("h5_line_counts", "SELECT repo, from_version, to_version, file_path, change_type, additions, deletions FROM fx_diffs")
def h5(x):
    return counts3(x)


@query("h7_diff_truncation", """
    SELECT repo, from_version, to_version, file_path, additions, md5(CASE WHEN length(diff_content) > 500
           THEN concat(left(diff_content, 500), chr(10), '... [truncated, diff too large] ...') ELSE diff_content END) AS diff_md5
    FROM fx_diffs""")
def h7(x):
    rows = diff.file_diffs(pairs3(x), contents3(x), Settings(max_diff_size=500))
    return rows.select(*PAIR, "file_path", "additions", F.md5("diff_content").alias("diff_md5"))


@query("d2_diff_totals", "SELECT * FROM fx_diff_totals")
def d2(x):
    return diff.version_diffs(counts3(x))


@query("d7_diff_text", "SELECT repo, from_version, to_version, md5(text) AS text_md5 FROM fx_diff_texts")
def d7(x):
    return render.diff_texts(diffs3(x)).select(*PAIR, F.md5("text").alias("text_md5"))


@query("d8_unified_text", """
    SELECT repo, from_version, to_version, md5(string_agg(diff_content, chr(10) ORDER BY file_path)) AS text_md5 FROM fx_diffs GROUP BY ALL""")
def d8(x):
    parts = render.unified_text(diffs3(x), 1024)
    return rejoined(parts, PAIR, "unified_diff").select(*PAIR, F.md5("unified_diff").alias("text_md5"))


@query("f2_diffs_by_path", """
    SELECT repo, from_version, to_version, file_path, row_number() OVER (PARTITION BY repo, from_version ORDER BY file_path) AS place FROM fx_diffs""")
def f2(x):
    rows = diff.changed_files(pairs3(x), x.raw()).select(*PAIR, F.col("path").alias("file_path"))
    return with_order(rows, PAIR, ["file_path"], number="place")


@query("i19_diff_stats", """
    SELECT d.repo, d.from_version, d.to_version, d.file_path, d.change_type, d.additions, d.deletions,
           t.files_changed, t.total_additions, t.total_deletions
    FROM fx_diffs d JOIN fx_diff_totals t ON t.repo = d.repo AND t.from_version = d.from_version""")
def i19(x):
    return diff.diff_stats(written(counts3(x), "line_counts"))


INPUT_SQL = """
    concat_ws(chr(10), '<repository>', concat('<name>', {repo}, '</name>'), concat('<version>', {version}, '</version>'), '<codebase>',
        {codebase}, '</codebase>', '</repository>', '',
        'Based on the codebase above, predict the changes that will be made in the next version release. Output the changes as a unified diff.')"""


@query("h12_input_text", "SELECT doc_id, md5(" + INPUT_SQL.format(repo="source", version="lang", codebase="text") + ") AS text_md5 FROM documents")
def h12(x):
    wrapped = render.input_text(F.col("source"), F.col("lang"), F.col("text"))
    return x.table("documents").select("doc_id", F.md5(wrapped).alias("text_md5"))


@query("h13_output_text", """
    SELECT doc_id, md5(concat('# Changes from ', source, ' to ', lang, chr(10), chr(10), text)) AS text_md5 FROM documents""")
def h13(x):
    wrapped = render.output_text(F.col("source"), F.col("lang"), F.col("text"))
    return x.table("documents").select("doc_id", F.md5(wrapped).alias("text_md5"))


@query("i2_create_example", """
    SELECT doc_id, source AS repo_name, md5(i) AS input_md5, md5(o) AS output_md5, length(i) // 4 AS input_tokens_approx, length(o) // 4 AS output_tokens_approx
    FROM (SELECT doc_id, source, """ + INPUT_SQL.format(repo="source", version="concat('v', doc_id)", codebase="text") + """ AS i,
                 concat('# Changes from v', doc_id, ' to v', doc_id + 1, chr(10), chr(10), text) AS o FROM documents)""")
def i2(x):
    version = F.concat(F.lit("v"), F.col("doc_id").cast("string"))
    rows = x.table("documents").select(
        F.col("source").alias("repo"), version.alias("from_version"),
        F.concat(F.lit("v"), (F.col("doc_id") + 1).cast("string")).alias("to_version"),
        F.col("text").alias("codebase_text"), F.col("text").alias("diff_text"),
        F.lit(1).alias("num_files_in_codebase"), F.lit(1).alias("num_files_changed"), F.lit(0).alias("num_dependencies"))
    return create_examples(rows, CREATED).select(
        F.expr("CAST(substring(from_version, 2) AS BIGINT)").alias("doc_id"), "repo_name",
        F.md5("input_text").alias("input_md5"), F.md5("output_text").alias("output_md5"),
        "input_tokens_approx", "output_tokens_approx")


def rejoined(rows, keys, text, *others):
    """Whole texts of rows in parts."""
    return rows.groupBy(*keys).agg(render.joined(text, "part_no", "").alias(text), *[F.max(c).alias(c) for c in others])


def digests(records, key, names):
    """(key, MD5 of each whole text of ``names``) of rows in parts.

    A digest is sequential: the parts of a key are sorted and streamed through one task, which holds a batch of parts and no whole text.
    """
    rows = records.repartition(*key).sortWithinPartitions(*key, "part_no").select(*key, *names)
    schema = ", ".join([f"{c} {records.schema[c].dataType.simpleString()}" for c in key] + [f"{n}_md5 string" for n in names])
    width = len(key)

    def hashed(batches):
        import hashlib
        import itertools

        import pyarrow as pa

        current, sums = None, []

        def row():
            columns = [pa.array([v], t) for v, t in zip(current, types)] + [pa.array([s.hexdigest()]) for s in sums]
            return pa.RecordBatch.from_arrays(columns, [*key, *[f"{n}_md5" for n in names]])

        for batch in batches:
            types = [batch.schema.field(i).type for i in range(width)]
            for k, places in itertools.groupby(enumerate(zip(*[batch.column(c).to_pylist() for c in range(width)])), lambda x: x[1]):
                if k != current:
                    if current is not None:
                        yield row()
                    current, sums = k, [hashlib.md5() for _ in names]
                places = [i for i, _ in places]
                for s, column in zip(sums, range(width, width + len(names))):
                    for text in batch.column(column).slice(places[0], len(places)):
                        s.update(text.as_buffer() or b"")
        if current is not None:
            yield row()

    return rows.mapInArrow(hashed, schema)


def fingerprints(records):
    key = ["repo_name", "from_version", "to_version"]
    numbers = ["input_tokens_approx", "output_tokens_approx", "num_files_in_codebase", "num_files_changed", "num_dependencies"]
    found = digests(records, [*key, *numbers], ["input_text", "output_text"])
    return found.select(*key, F.col("input_text_md5").alias("input_md5"), F.col("output_text_md5").alias("output_md5"), *numbers)


# Blocks of text and their totals: every version of a repository, and the newest one as a dependency.
EXAMPLES_SQL = """
    SELECT repo AS repo_name, from_version, to_version, md5(i) AS input_md5, md5(o) AS output_md5,
           length(i) // 4 AS input_tokens_approx, length(o) // 4 AS output_tokens_approx,
           num_files AS num_files_in_codebase, files_changed AS num_files_changed, deps AS num_dependencies
    FROM (SELECT c.*, t.files_changed, concat('# Changes from ', c.from_version, ' to ', c.to_version, chr(10), chr(10), t.text) AS o, """ + INPUT_SQL.format(
    repo="c.repo", version="c.from_version", codebase="""
        concat_ws(chr(10), concat('# Repository: ', c.repo), concat('# Version: ', c.from_version), concat('# Total Files: ', num_files),
                  concat('# Total Size: ', format('{:,}', total_size), ' bytes'), '', body)""") + """ AS i
          FROM (SELECT repo, from_version, to_version, CAST(sum(n) AS BIGINT) AS num_files, CAST(sum(size) AS BIGINT) AS total_size,
                       count(*) - 1 AS deps, string_agg(body, chr(10) ORDER BY dep_rank) AS body
                FROM (SELECT p.repo, p.from_version, p.to_version, 0 AS dep_rank, b.* EXCLUDE (repo, version)
                      FROM fx_pairs3 p JOIN fx_blocks b ON b.repo = p.repo AND b.version = p.from_version AND NOT b.is_dep
                      UNION ALL
                      SELECT p.repo, p.from_version, p.to_version, u.dep_rank, b.* EXCLUDE (repo, version)
                      FROM fx_pairs3 p JOIN fx_uses u ON u.repo = p.repo JOIN fx_blocks b ON b.repo = u.github_repo AND b.version = 'v2.0.0' AND b.is_dep)
                GROUP BY repo, from_version, to_version) c
          JOIN fx_all_diff_texts t ON t.repo = c.repo AND t.from_version = c.from_version)"""


def whole(x):
    """Source files and manifests of the fixture repositories, kept as the jobs expect them: a table."""
    return written(x.raw().unionByName(x.manifest_files()), "raw_files")


@query("i5_dataset", EXAMPLES_SQL)
def i5(x):
    built = build_dataset(x.releases3(), whole(x), CREATED, Settings(max_cell_bytes=1024), known_packages=x.known_packages())
    return fingerprints(built.examples)


OWN_EXAMPLES_SQL = (EXAMPLES_SQL.replace("""
                      UNION ALL
                      SELECT p.repo, p.from_version, p.to_version, u.dep_rank, b.* EXCLUDE (repo, version)
                      FROM fx_pairs3 p JOIN fx_uses u ON u.repo = p.repo JOIN fx_blocks b ON b.repo = u.github_repo AND b.version = 'v2.0.0' AND b.is_dep""", "")
       .replace("fx_blocks", "fx_own_blocks"))


@query("i3_pair_texts", OWN_EXAMPLES_SQL)
def i3(x):
    built = build_dataset(x.releases3(), table3(x), CREATED, Settings(include_dependencies=False))
    return fingerprints(built.examples)


@query("i4_single_repository", "SELECT * FROM (" + EXAMPLES_SQL + ") WHERE repo_name = 'src7'")
def i4(x):
    built = build_single("src7", x.releases3(), whole(x), CREATED, known_packages=x.known_packages())
    return fingerprints(built.examples)


@query("i4_isolated_failures", "SELECT * FROM (" + OWN_EXAMPLES_SQL + ") WHERE NOT (repo_name = 'src3' OR repo_name = 'src5' AND to_version = 'v2.0.0')")
def i4_failures(x):
    """From archives, those of two releases broken: only the pairs of these releases are missing."""
    files = x.raw().select("repo", "version", "path", "content").withColumn("fault", F.expr(
        "CASE WHEN repo = 'src3' AND version = 'v1.1.0' THEN 1 WHEN repo = 'src5' AND version = 'v2.0.0' THEN 2 ELSE 0 END"))
    readable, unreadable = archives.readable(archives.unpacked(tar_archives(files, F.col("path"), F.col("content"), F.col("fault"))))
    built = build_dataset(
        x.releases3(), written(readable, "raw_files"), CREATED, Settings(include_dependencies=False), unreadable=unreadable)
    return fingerprints(built.examples)
