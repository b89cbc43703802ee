"""Structure repair and prefix trie against plain versions."""

import hashlib
import itertools
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from codelineage.llm import queries, repair, trie

WHITE = re.compile(r"[^\x20\x09-\x0D]")


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).digest()))


def judged(rows):
    """[(turn, role, text, fault)] in order; fault 0 to 3: none, blank, duplicate, truncated."""
    out, seen = [], set()
    for turn, role, text in in_order([(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]):
        shown = WHITE.findall(text)
        fault = 1 if not shown else 2 if (role, text) in seen else 3 if shown[-1] not in ".!?" else 0
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def all_scripts(rows):
    """Cheapest (cost, audit, repaired) of every edit script with up to two insertions in a place."""
    added = [[("I", 3, r, "") for r in x] for x in ((), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user"))]

    def ways(row):
        _, role, text, fault = row
        yield [("D", 4, None, None)]
        if fault not in (1, 2):
            extra = 3 if fault == 3 else 0
            yield [("K", extra, role, text)]
            for new in ("user", "assistant"):
                yield [("R", 3 + extra, new, text)]

    best = None
    for picks in itertools.product(*itertools.chain.from_iterable((added, list(ways(r))) for r in rows), added):
        edits = [e for part in picks for e in part]
        roles = "".join("x" if e[2][:1] not in ("s", "u", "a") else e[2][0] for e in edits if e[2] is not None)
        if re.fullmatch("(s?(ua)+)?", roles):
            way = (sum(e[1] for e in edits), "".join(e[0] for e in edits), [(e[2], e[3]) for e in edits if e[2] is not None])
            best = min(best, way) if best else way
    return best


def programmed(rows):
    """The same by dynamic programming over whole scripts."""
    added, none = {0: 2, 1: 2, 2: 3, 3: 2}, (float("inf"), "", [])
    keeps = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    names = {2: "user", 3: "assistant"}
    put = lambda way, cost, letter, *turn: (way[0] + cost, letter + way[1], list(turn) + way[2])

    def filled(ways):
        ways = list(ways)
        for _ in range(2):
            ways = [min(ways[p], put(ways[added[p]], 3, "I", (names[added[p]], ""))) for p in range(4)]
        return ways

    rest = filled([(0, "", []), none, none, (0, "", [])])
    for _, role, text, fault in reversed(rows):
        now, extra = [], 3 if fault == 3 else 0
        for p in range(4):
            ways = [put(rest[p], 4, "D")]
            if fault not in (1, 2):
                ways.append(put(rest[added[p]], 3 + extra, "R", (names[added[p]], text)))
                if (p, role[:1]) in keeps:
                    ways.append(put(rest[keeps[p, role[:1]]], extra, "K", (role, text)))
            now.append(min(ways, key=lambda w: w[:2]))
        rest = filled(now)
    return rest[0]


def report(rows, solve):
    cost, audit, said = solve(judged(rows))
    rows = judged(rows)
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    first = [r[1][:1] for r in rows]
    return (gaps, *[sum(r[3] == k for r in rows) for k in (1, 2, 3)], sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False)),
            cost, audit, len(said), hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()), said


def made(seed, n, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut", "", " \t", "Why?", "Yes.", None, "né…"]
    roles = ["user", "assistant", "system", "tool", "", None, "user", "assistant"]
    return {c: [(rng.choice([None, *range(9)]), rng.choice(roles), rng.choice(texts)) for _ in range(rng.randint(1, longest))] for c in range(n)}


def check_repair(spark, conversations, solve):
    rows = [(c, t, r, x, "x") for c, turns in conversations.items() for t, r, x in turns]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv string").repartition(3)
    got = {r.conv_id: r for r in repair.audited(df).collect()}
    assert set(got) == set(conversations)
    turns = defaultdict(list)
    for r in repair.repaired(df).collect():
        turns[r.conv_id].append((r.position, r.edit, r.role, r.text))
    for c, given in conversations.items():
        want, said = report(given, solve)
        assert tuple(got[c][x] for x in (*repair.FAULTS, "audit", "n_turns", "repaired_sha256")) == want, (c, given)
        kept = sorted(turns[c])
        assert [k[0] for k in kept] == list(range(1, len(said) + 1)) and [k[2:] for k in kept] == said
        assert "".join(k[1] for k in kept) == want[6].replace("D", "")


def test_short_conversations_equal_every_script(spark):
    check_repair(spark, made(3, 150, 3) | {None: [(0, "user", "Hi."), (1, "user", "cut")]}, all_scripts)


def test_longer_conversations_equal_whole_scripts(spark):
    check_repair(spark, made(4, 60, 40), programmed)


def test_a_giant_conversation_is_streamed_in_blocks(spark):
    n = repair.BLOCK + 5000
    turns = spark.range(n).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.concat(F.lit("Turn "), (F.col("id") % (n - 4)).cast("string"), F.lit(".")).alias("text"))
    got = repair.audited(turns.repartition(5)).first()
    assert (got.cost, got.duplicate, got.audit) == (16, 4, "K" * (n - 4) + "DDDD")
    said = "\n".join(f"{'assistant' if i % 2 else 'user'}:Turn {i}." for i in range(n - 4))
    assert got.repaired_sha256 == hashlib.sha256(said.encode()).hexdigest()


def test_copies_of_a_row_are_duplicates_of_the_first(spark):
    rows = [(7, None, "user", "Hi.")] * 5 + [(7, 2, "assistant", "x" * 200_000 + ".")]
    got = repair.audited(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert (got.duplicate, got.cost, got.audit) == (4, 16, "KDDDDK")


def test_no_turns_at_all(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.audited(none).collect() == [] and repair.repaired(none).collect() == []


def nodes_of(sequences):
    """The trie rows by their definition; sequences: {key: [content]} with content (digest, size)."""
    members = defaultdict(list)
    for key, s in sequences.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(key)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    totals = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * (p[-1][1] if p else 0)
        below = [totals[c] for c in children[p]]
        totals[p] = (sum(x for x, _ in below) or 1, own + sum(x for _, x in below))
    ends = lambda p: ",".join(str(k) for k in sorted(members[p]) if len(sequences[k]) == len(p))
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children[p]), *totals[p], hashlib.sha256(ends(p).encode()).hexdigest())
        for p, m in members.items()), len(members)


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_its_definition(spark, seed):
    rng, sequences = random.Random(seed), {}
    for key in range(200):
        base = list(rng.choice(list(sequences.values()))) if sequences and rng.random() < 0.7 else []
        new = [(rng.choice("abc"), 3) for _ in range(rng.randint(0, 6))]
        sequences[key * 7 - 300] = base[:rng.randint(0, len(base))] + [(c, ord(c) - 90) for c, _ in new]
    sequences |= {5000 + i: [("a", 7), ("b", 8)] for i in range(150)}
    sequences[9999] = [("z", 32)] * 700
    items = [(k, i, c.encode(), n) for k, s in sequences.items() for i, (c, n) in enumerate(s, 1)]
    df = spark.createDataFrame(items, "key long, position long, content binary, size long").repartition(4)
    keys = spark.createDataFrame([(k,) for k in sequences], "key long")
    got = trie.prefix_trie(df, keys.unionByName(keys)).collect()
    want, n = nodes_of(sequences)
    assert len(got) == n and sorted(map(tuple, got), key=lambda r: r[:2]) == want


def test_trie_without_items_or_keys(spark):
    none = spark.createDataFrame([], "key long, position long, content binary, size long")
    got = trie.prefix_trie(none, spark.createDataFrame([(4,), (2,)], "key long")).collect()
    assert list(map(tuple, got)) == [(2, 0, None, 2, 0, 1, 0, hashlib.sha256(b"2,4").hexdigest())]
    assert trie.prefix_trie(none, none.select("key")).collect() == []


def test_rebuilt_conversations_on_odd_rows(spark):
    rows = [(c, t, "user", f"{c} {t}", "k") for c in (0, 1, 3, 7, 12) for t in range(11)]
    rows += [(3, None, None, None, "k"), (3, 4, "user", "3 4", "k"), (3, 4, "user", "3 4", "k"), (None, 1, "user", "lost", "k"), (8, 0, "user", "", "k")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, key string")
    items, keys = queries.rebuilt(df)
    assert sorted(r.key for r in keys.collect()) == [0, 1, 3, 7, 8, 12]
    from zlib import crc32
    own = {c: in_order([(t, r or "", x or "") for c2, t, r, x, _ in rows if c2 == c]) for c in (0, 1, 3, 7, 8, 12)}
    got = defaultdict(dict)
    for r in items.collect():
        got[r.key][r.position] = r["size"]
    for c in own:
        h = crc32(str(c).encode()) % 9
        want = [len(x[2]) for x in own.get(c - c % 5, [])[:h] + own[c][h:]]
        assert [got[c][i] for i in sorted(got[c])] == want and sorted(got[c]) == list(range(1, len(want) + 1))
