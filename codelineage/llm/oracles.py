"""DuckDB counterparts of the queries that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SUBSTRINGS = """
    WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
    blocks AS (SELECT doc_id, s, n, substr(h, 2 * s + 1, 698) AS h FROM (SELECT *, unnest(range(0, n - 49, 300)) AS s FROM docs WHERE n >= 50)),
    places AS (SELECT doc_id, s + i AS i, substr(h, 2 * i - 1, 100) AS w FROM (SELECT *, unnest(range(1, least(300, n - 49 - s) + 1)) AS i FROM blocks)),
    firsts AS (SELECT w, min(doc_id) AS first FROM places GROUP BY w HAVING min(doc_id) < max(doc_id)),
    hits AS (SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 50, true) AS begins FROM places JOIN firsts USING (w) WHERE first < doc_id),
    numbered AS (SELECT doc_id, i, sum(CAST(begins AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hits),
    runs AS (SELECT doc_id, run, min(i) AS a, max(i) + 49 AS b FROM numbered GROUP BY doc_id, run),
    gaps AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY run), 0) AS last FROM runs),
    cut AS (SELECT doc_id, sum(b - a + 1) AS n_removed, count(*) AS n_spans,
                   string_agg(substr(h, 2 * last + 1, 2 * (a - 1 - last)), '' ORDER BY run) || substr(any_value(h), 2 * max(b) + 1) AS left_over
            FROM gaps JOIN docs USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
           sha256(unhex(coalesce(left_over, h))) AS kept_sha256
    FROM docs LEFT JOIN cut USING (doc_id)"""

PASSAGES = r"""
    WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    places AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS w FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM docs WHERE len(words) >= 20)),
    later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS place FROM places) WHERE place > 1),
    gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM later),
    kept AS (SELECT doc_id, words[i] AS word, i, g.i IS NOT NULL AS gone FROM (SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM docs) LEFT JOIN gone g USING (doc_id, i)),
    done AS (SELECT doc_id, count(*) AS n_words, count_if(gone) AS n_removed, coalesce(string_agg(CASE WHEN NOT gone THEN word END, ' ' ORDER BY i), '') AS left_over FROM kept GROUP BY doc_id)
    SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(left_over, '')) AS kept_sha256
    FROM docs LEFT JOIN done USING (doc_id)"""

CONTAMINATION = f"""
    WITH docs AS (SELECT doc_id, {_ITEM_WORDS} AS words FROM documents),
    items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS words FROM benchmark WHERE item_id IS NOT NULL),
    windows AS (SELECT DISTINCT item, least(13, len(words)) AS size, array_to_string(words[i:i + 12], ' ') AS w
                FROM (SELECT item, words, unnest(range(1, greatest(1, len(words) - 12) + 1)) AS i FROM items WHERE len(words) > 0)),
    places AS (SELECT doc_id, i, size, array_to_string(words[i:i + size - 1], ' ') AS w
               FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size)),
    found AS (SELECT doc_id, i, size, item FROM places JOIN windows USING (size, w)),
    hit AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS i FROM found) GROUP BY doc_id),
    named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
           sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(words) AS contaminated
    FROM docs LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

EMBEDDINGS = """
    WITH RECURSIVE good AS (
        SELECT vec_id, x FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)
        WHERE x IS NOT NULL AND len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND list_sum(list_transform(x, lambda c: abs(c))) > 0),
    links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.9),
    reach(u, v) AS (SELECT u, v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v),
    least AS (SELECT u, min(v) AS v FROM reach GROUP BY u),
    counted AS (SELECT u, count(*) AS n FROM links GROUP BY u)
    SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(v, vec_id)) AS component_id, least(vec_id, coalesce(v, vec_id)) = vec_id AS kept
    FROM embeddings e LEFT JOIN counted c ON c.u = e.vec_id LEFT JOIN least m ON m.u = e.vec_id"""


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bytes_ = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    bits = "list_reduce([xor(s, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, CAST(3988292384 AS BIGINT) * (x & 1)))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}), lambda s, b: {bits}), CAST(4294967295 AS BIGINT))"


# Costs and edits of the rest of a conversation from its last row to its first, for the four places in the role pattern
# (0 nothing yet, 1 after system, 2 after user, 3 after assistant): structs of cost, audit and repaired turns.
_WAY = "{{'cost': {}, 'audit': {}, 'said': {}}}"
_NONE = _WAY.format("CAST(1000000000 AS BIGINT)", "''", "CAST([] AS VARCHAR[])")


def _way(cost: str, letter: str, then: str, said: str = "") -> str:
    rest = f"list_prepend({said}, {then}.said)" if said else f"{then}.said"
    return _WAY.format(f"{then}.cost + {cost}", f"'{letter}' || {then}.audit", rest)


def _consumed(place: int) -> str:
    extra = "CASE WHEN fault = 3 THEN 3 ELSE 0 END"
    after, name = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}[place]
    keeps = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}[place]
    kept = " ".join(f"WHEN initial = '{i}' THEN {_way(extra, 'K', f'g{p}', 'own')}" for i, p in keeps.items())
    return f"""least({_way('4', 'D', f'g{place}')},
        CASE WHEN fault IN (1, 2) THEN {_NONE} ELSE {_way(f'3 + {extra}', 'R', f'g{after}', f"'{name}:' || text")} END,
        CASE WHEN fault IN (1, 2) THEN {_NONE} {kept} ELSE {_NONE} END)"""


_USER, _ASSISTANT = "'user:'", "'assistant:'"
REPAIR = rf"""
    WITH RECURSIVE given AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
               {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fate FROM conversations),
    damaged AS (
        SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
               CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
        FROM given, range(CASE WHEN fate = 3 THEN 2 ELSE 1 END) WHERE fate <> 0),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM damaged),
    judged AS (
        SELECT conv_id, turn, role, text, i, left(role, 1) AS initial, role || ':' || text AS own,
               lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS two, lead(i) OVER (PARTITION BY conv_id ORDER BY i) IS NULL AS last,
               CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 1
                    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                    WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 3 ELSE 0 END AS fault
        FROM placed),
    rest(conv_id, i, g0, g1, g2, g3) AS (
        SELECT conv_id, max(i) + 1, {_WAY.format('CAST(0 AS BIGINT)', "''", 'CAST([] AS VARCHAR[])')}, {_WAY.format('CAST(6 AS BIGINT)', "'II'", f'[{_USER}, {_ASSISTANT}]')},
               {_WAY.format('CAST(3 AS BIGINT)', "'I'", f'[{_ASSISTANT}]')}, {_WAY.format('CAST(0 AS BIGINT)', "''", 'CAST([] AS VARCHAR[])')}
        FROM judged GROUP BY conv_id
        UNION ALL
        SELECT conv_id, i, least(c0, {_way('3', 'I', 'd2', _USER)}), least(c1, {_way('3', 'I', 'd2', _USER)}), d2, d3
        FROM (SELECT *, least(c2, {_way('3', 'I', 'c3', _ASSISTANT)}) AS d2, least(c3, {_way('3', 'I', 'c2', _USER)}) AS d3
              FROM (SELECT r.conv_id, j.i, {_consumed(0)} AS c0, {_consumed(1)} AS c1, {_consumed(2)} AS c2, {_consumed(3)} AS c3
                    FROM rest r JOIN judged j ON j.conv_id IS NOT DISTINCT FROM r.conv_id AND j.i = r.i - 1))),
    counted AS (
        SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps,
               count_if(fault = 1) AS blank, count_if(fault = 2) AS duplicate, count_if(fault = 3) AS truncated,
               count_if(two NOT IN ('su', 'ua', 'au')) AS illegal
        FROM judged GROUP BY conv_id),
    done AS (SELECT conv_id, g0.cost AS cost, g0.audit AS audit, array_to_string(g0.said, chr(10)) AS said FROM rest WHERE i = 1)
    SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
           CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
           coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) a
    LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM a.conv_id"""

TRIE = f"""
    WITH numbered AS (
        SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
        FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32("CAST(conv_id AS VARCHAR)")} % 9 AS head FROM (SELECT DISTINCT conv_id FROM numbered)),
    lengths AS (SELECT conv_id, count(*) AS n FROM numbered GROUP BY conv_id),
    rebuilt AS (
        SELECT c.conv_id, place, said FROM convs c JOIN numbered n ON n.conv_id = c.base AND place <= head
        UNION ALL
        SELECT c.conv_id, place - head + least(head, coalesce(l.n, 0)), said FROM convs c JOIN numbered n USING (conv_id) LEFT JOIN lengths l ON l.conv_id = c.base WHERE place > head),
    prefixes AS (
        SELECT conv_id, 0 AS depth, [] AS prefix, '' AS last_text FROM convs
        UNION ALL
        SELECT conv_id, place, list(said) OVER (PARTITION BY conv_id ORDER BY place), said.text FROM rebuilt),
    members AS (SELECT conv_id, depth, last_text, min(conv_id) OVER (PARTITION BY depth, prefix) AS node, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM prefixes),
    nodes AS (
        SELECT node, depth, count(*) AS n_convs, (count(*) - 1) * max(strlen(last_text)) AS saved,
               sha256(coalesce(string_agg(CASE WHEN ends THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256
        FROM members GROUP BY node, depth),
    children AS (SELECT p.node, p.depth, count(*) AS n FROM nodes n JOIN members p ON p.conv_id = n.node AND p.depth = n.depth - 1 GROUP BY ALL),
    totals AS (
        SELECT m.node, m.depth, count_if(c.n IS NULL) AS n_leaves, sum(n.saved) AS saved
        FROM nodes n LEFT JOIN children c USING (node, depth) JOIN members m ON m.conv_id = n.node AND m.depth <= n.depth GROUP BY ALL)
    SELECT n.node AS conv_id, CAST(n.depth AS BIGINT) AS depth, p.node AS parent_conv_id, n.n_convs, CAST(coalesce(c.n, 0) AS BIGINT) AS n_children,
           CAST(t.n_leaves AS BIGINT) AS n_leaves, CAST(t.saved AS BIGINT) AS saved_tokens, ends_sha256
    FROM nodes n JOIN totals t USING (node, depth) LEFT JOIN children c USING (node, depth)
    LEFT JOIN members p ON p.conv_id = n.node AND p.depth = n.depth - 1"""
