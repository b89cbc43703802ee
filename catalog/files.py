"""Snapshots: scans, patterns, classification, budget, text, tree."""

from pyspark.sql import functions as F

from catalog.changes import rejoined, tar_archives
from catalog.fixtures import BAR
from catalog.registry import query
from codelineage.functions import patterns, text
from codelineage.operators import render, snapshot
from codelineage.settings import Settings
from codelineage.sources import archives

FILE = ["repo", "version", "path"]


@query("a1_snapshot_scan", """
    SELECT repo, version, path, CAST(octet_length(encode(content)) AS BIGINT) AS size, sha256(content) AS content_sha FROM fx_files""")
def a1(x):
    return x.raw().select(*FILE, "size", "content_sha")


@query("a1_archives", """
    SELECT source AS repo, concat('v', doc_id) AS version, CASE WHEN doc_id % 7 > 1 THEN concat('d/', lang, '.txt') END AS path,
           CASE WHEN doc_id % 7 > 1 THEN sha256(text) END AS content_sha, doc_id % 7 <= 1 AS failed FROM documents""")
def a1_archives(x):
    """Every document in an archive of its own; the broken ones are listed and leave the others."""
    docs = x.table("documents").select(
        F.col("source").alias("repo"), F.concat(F.lit("v"), F.col("doc_id").cast("string")).alias("version"), "lang", "text",
        F.when(F.col("doc_id") % 7 <= 1, F.col("doc_id") % 7 + 1).otherwise(0).cast("int").alias("fault"))
    rows = tar_archives(docs, F.concat(F.lit("d/"), "lang", F.lit(".txt")), F.encode("text", "UTF-8"), F.col("fault"))
    good, errors = archives.readable(archives.unpacked(rows))
    none = F.lit(None).cast("string")
    return good.select(*FILE, "content_sha", F.lit(False).alias("failed")).unionByName(
        errors.select("repo", "version", none.alias("path"), none.alias("content_sha"), F.lit(True).alias("failed")))


@query("a2_file_at_version", """
    SELECT a.repo, 'v1.1.0' AS version, a.path, md5(b.content) AS text_md5
    FROM fx_files a LEFT JOIN fx_files b ON b.repo = a.repo AND b.path = a.path AND b.version = 'v1.1.0'
    WHERE a.version = 'v1.0.0'""")
def a2(x):
    files = x.raw()
    requests = files.filter("version = 'v1.0.0'").select("repo", F.lit("v1.1.0").alias("version"), "path")
    return snapshot.files_at(requests, files).select(*FILE, F.md5("text").alias("text_md5"))


INCLUDE = ["*.py", "src/en/*", "doc_[0-4]*.m?", "moved/doc_[!1-8]*"]
EXCLUDE = ["doc_1*", "*.json"]


@query("b1_include_globs", r"""
    SELECT repo, version, path FROM fx_files
    WHERE regexp_matches(path, '^(.*\.py|src/en/.*|doc_[0-4].*\.m.|moved/doc_[^1-8].*)$')
       OR regexp_matches(split_part(path, '/', -1), '^(.*\.py|src/en/.*|doc_[0-4].*\.m.|moved/doc_[^1-8].*)$')""")
def b1(x):
    return x.files().select(*FILE).filter(patterns.name_or_path_matches(F.col("path"), INCLUDE))


@query("b2_exclude_snapshot", r"""
    SELECT repo, version, path FROM fx_files
    WHERE NOT regexp_matches(path, '^(doc_1.*|.*\.json)$') AND NOT regexp_matches(path, '(^|/)\.')""")
def b2(x):
    return x.files().select(*FILE).filter(patterns.in_snapshot(F.col("path"), exclude=EXCLUDE))


@query("b3_exclude_diff", r"""
    SELECT repo, version, path FROM fx_files
    WHERE NOT regexp_matches(path, '^(doc_1.*|.*\.json)$')
      AND NOT regexp_matches(split_part(path, '/', -1), '^(doc_1.*|.*\.json)$')""")
def b3(x):
    return x.files().select(*FILE).filter(patterns.in_diff(F.col("path"), exclude=EXCLUDE))


@query("b4_hidden_skip", r"SELECT repo, version, path FROM fx_files WHERE NOT regexp_matches(path, '(^|/)\.')")
def b4(x):
    return x.files().select(*FILE).filter(~patterns.is_hidden(F.col("path")))


@query("b5_oversize_stub", """
    SELECT repo, version, path, CASE WHEN stub LIKE '[BINARY %' AND stub NOT LIKE '[BINARY FILE%' THEN stub
                                     WHEN size > 3000 THEN concat('[FILE TOO LARGE: ', format('{:,}', size), ' bytes - content omitted]')
                                     ELSE stub END AS stub
    FROM fx_class""")
def b5(x):
    return snapshot.with_stub(x.raw().select(*FILE, "size", "head"), Settings(max_file_size=3000)).select(*FILE, "stub")


@query("b6_binary_stub", """
    SELECT repo, version, path, stub, CAST(length(stub) AS BIGINT) AS stub_size FROM fx_class""")
def b6(x):
    rows = snapshot.with_stub(x.raw().select(*FILE, "size", "head"))
    return rows.select(*FILE, "stub", F.length("stub").cast("long").alias("stub_size"))


@query("b7_content_sniff", """
    SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN true
                   ELSE (doc_id % 4 IN (1, 2) AND n < 8192)
                        OR (n > 8192 AND substring(hex(encode(text)), 16385, 2) BETWEEN '80' AND 'BF') END AS is_binary
    FROM (SELECT doc_id, text, octet_length(encode(text)) AS n FROM documents)""")
def b7(x):
    raw = F.encode("text", "UTF-8")
    nul, bad = F.lit(b"\x00"), F.lit(b"\xff")
    content = (
        F.when(F.col("doc_id") % 4 == 0, F.concat(nul, raw))
        .when(F.col("doc_id") % 4 == 1, F.concat(raw, bad))
        .when(F.col("doc_id") % 4 == 2, F.concat(raw, nul))
        .otherwise(raw)
    )
    head = F.substring(content, 1, snapshot.HEAD_BYTES)
    return x.table("documents").select("doc_id", snapshot.looks_binary(head).alias("is_binary"))


@query("b8_language", "SELECT repo, version, path, language FROM fx_class")
def b8(x):
    return snapshot.with_language(x.raw().select(*FILE)).select(*FILE, "language")


@query("h2_utf8_replaced", """
    SELECT doc_id, md5(CASE doc_id % 3 WHEN 0 THEN concat(text, chr(65533)) WHEN 1 THEN concat(chr(65533), text) ELSE text END) AS text_md5
    FROM documents""")
def h2(x):
    raw, bad = F.encode("text", "UTF-8"), F.lit(b"\xff")
    content = F.when(F.col("doc_id") % 3 == 0, F.concat(raw, bad)).when(F.col("doc_id") % 3 == 1, F.concat(bad, raw)).otherwise(raw)
    return x.table("documents").select("doc_id", F.md5(text.decoded(content)).alias("text_md5"))


@query("h3_newlines", "SELECT doc_id, md5(text) AS text_md5 FROM documents")
def h3(x):
    old_style = F.when(F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit("\r\n"))).otherwise(
        F.replace("text", F.lit("\n"), F.lit("\r")))
    return x.table("documents").select("doc_id", F.md5(text.text_mode(old_style)).alias("text_md5"))


@query("h6_split_lines", """
    SELECT doc_id, CAST(n AS BIGINT) AS n_lines, CAST(n AS BIGINT) AS n_counted, md5(text) AS joined_md5
    FROM (SELECT doc_id, text, CASE WHEN text = '' THEN 0 ELSE len(string_split(text, chr(10))) - CAST(right(text, 1) = chr(10) AS INT) END AS n
          FROM documents)""")
def h6(x):
    lines = text.lines_with_ends(F.col("text"))
    return x.table("documents").select(
        "doc_id", F.size(lines).cast("long").alias("n_lines"), text.line_count(F.col("text")).alias("n_counted"),
        F.md5(F.array_join(lines, "")).alias("joined_md5"))


@query("h15_thousands", "SELECT doc_id, format('{:,}', n_chars * 1013) AS shown FROM documents")
def h15(x):
    return x.table("documents").select("doc_id", text.commas(F.col("n_chars") * 1013).alias("shown"))


@query("i1_classified_files", """
    SELECT repo, version, path, md5(shown) AS content_md5, shown_size AS size, language, is_binary_stub FROM fx_class""")
def i1(x):
    return snapshot.classified(x.raw()).select(
        *FILE, F.md5("content").alias("content_md5"), "size", "language", "is_binary_stub")


@query("d1_snapshot_totals", """
    SELECT repo, version, count(*) AS num_files, CAST(sum(shown_size) AS BIGINT) AS total_size FROM fx_visible GROUP BY ALL""")
def d1(x):
    files = x.raw().select(*FILE, "size", "head").filter(patterns.in_snapshot(F.col("path")))
    return snapshot.snapshot_totals(snapshot.file_sizes(files))


BUDGET = 20000


@query("e4_size_budget", f"""
    SELECT repo, version, path, shown_size AS size FROM (
        SELECT *, coalesce(sum(shown_size) OVER (PARTITION BY repo, version ORDER BY path
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM fx_visible)
    WHERE before < {BUDGET}""")
def e4(x):
    files = x.raw().filter(patterns.in_snapshot(F.col("path")))
    return snapshot.snapshot_files(files, Settings(max_codebase_size=BUDGET)).select(*FILE, "size")


@query("d6_snapshot_text", f"""
    SELECT repo, version, count(*) AS num_files, CAST(sum(shown_size) AS BIGINT) AS total_size,
           md5(concat_ws(chr(10), concat('# Repository: ', repo), concat('# Version: ', version),
               concat('# Total Files: ', count(*)), concat('# Total Size: ', format('{{:,}}', CAST(sum(shown_size) AS BIGINT)), ' bytes'), '',
               string_agg(concat_ws(chr(10), '{BAR}', concat('FILE: ', path), '{BAR}', shown, ''), chr(10) ORDER BY path))) AS text_md5
    FROM fx_visible GROUP BY repo, version""")
def d6(x):
    files = snapshot.classified(x.raw().filter(patterns.in_snapshot(F.col("path"))))
    whole = rejoined(render.snapshot_texts(files, max_bytes=1024), ["repo", "version"], "text", "num_files", "total_size")
    return whole.select("repo", "version", "num_files", "total_size", F.md5("text").alias("text_md5"))


@query("f1_files_by_path", """
    SELECT repo, version, path, row_number() OVER (PARTITION BY repo, version ORDER BY path) AS place FROM fx_files""")
def f1(x):
    from codelineage.operators.ordered import with_order

    place = with_order(x.files().select(*FILE), ["repo", "version"], ["path"], number="place")
    return place.select(*FILE, F.col("place").cast("long").alias("place"))


@query("d11_file_tree_lines", "SELECT repo, version, node, line FROM fx_tree_lines")
def d11_lines(x):
    tree = render.tree_lines(x.files().select(*FILE))
    return tree.select("repo", "version", F.array_join("node", "/").alias("node"), "line")


@query("d11_file_tree", """
    SELECT repo, version, concat('# File Tree for ', repo, '@', version, chr(10), chr(10),
                                 string_agg(line, chr(10) ORDER BY string_split(node, '/'))) AS tree
    FROM fx_tree_lines GROUP BY repo, version""")
def d11(x):
    return rejoined(render.file_trees(x.files().select(*FILE), 1024), ["repo", "version"], "tree")
