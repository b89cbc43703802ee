"""Prefix trie of sequences, with subtree totals by parallel tree contraction.

A prefix is named by its depth and two sums of 64-bit hashes of (position, content), which running sums over
range-partitioned rows give for sequences of any length. Totals of subtrees come from rounds of joins that shrink the
tree from both ends of its chains: leaves are raked into their parents, and nodes with one child left are taken out of
their chain, their share kept on the link that replaces them. Then the rounds are undone in reverse, and every node
taken out gets the total of the node below it plus what the link held. Each round joins tables by the nodes' own names,
which are unique; only sums that combine before the shuffle are grouped by parents, however many children one has.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelineage.operators.ordered import with_order
from codelineage.storage import written

WIDE = "decimal(38,0)"
ROOT = "0"
LARGEST = (1 << 63) - 1
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
# Tables of expanded rounds are written once in so many rounds.
ROUNDS_AT_ONCE = 4


def _hash(seed: int, *columns: str) -> Column:
    return F.xxhash64(F.lit(seed), *columns).cast(WIDE)


def _ends_digests(batches):
    """(node, sha256) of the keys that end in each node, comma-joined; rows come sorted by node and key."""
    node, digest = None, None
    for batch in batches:
        out = []
        for name, keys in batch.groupby("node", sort=False)["key"]:
            joined = ",".join(map(str, keys)).encode()
            if name == node:
                digest.update(b"," + joined)
                continue
            if node is not None:
                out.append((node, digest.hexdigest()))
            node, digest = name, hashlib.sha256(joined)
        yield pd.DataFrame(out, columns=["node", "ends_sha256"])
    if node is not None:
        yield pd.DataFrame([(node, digest.hexdigest())], columns=["node", "ends_sha256"])


def _rank(c: Column, d: Column, number: int) -> Column:
    """Which of two neighbours in a chain goes first: by the lowest set bit of the depth, so that every other node of a chain goes; the root never."""
    low = F.when(d == 0, F.lit(LARGEST)).otherwise(d.bitwiseAND(-d))
    return F.struct(low.alias("low"), F.xxhash64(F.lit(number), c, d).alias("coin"))


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """(c, d, values): sums of each of the long columns ``values`` over the subtree of every node, itself included.

    ``nodes`` holds trees: (c, d) names a node and is unique, c and d are longs, d is 0 at roots alone
    and greater than that of the parent elsewhere; (pc, pd) names the parent, null at roots. The number of rounds grows with the
    logarithm of the longest chain and the number of branchings on a path. An empty table gives none.
    """
    parent = [F.col("pc").alias("c"), F.col("pd").alias("d")]
    counts = nodes.filter("pc IS NOT NULL").groupBy(*parent).agg(F.count(F.lit(1)).alias("n"))
    alive = written(
        nodes.join(counts, ["c", "d"], "left").select(
            "c", "d", "pc", "pd", F.coalesce("n", F.lit(0)).alias("n"), *values, *[F.lit(0).cast("long").alias(f"link_{v}") for v in values]), "trie")
    rounds = []
    while not alive.isEmpty():
        leaf = F.col("n") == 0
        below = alive.filter("pc IS NOT NULL").groupBy(*parent).agg(
            F.count_if(~leaf).alias("left"), F.min(F.when(~leaf, F.struct("c", "d"))).alias("only"),
            *[F.coalesce(F.sum(F.when(leaf, F.col(v) + F.col(f"link_{v}"))), F.lit(0)).alias(f"raked_{v}") for v in values])
        inner = alive.filter(~leaf).join(below, ["c", "d"]).select(
            "c", "d", "pc", "pd", F.col("left").alias("n"), "only", *[(F.col(v) + F.col(f"raked_{v}")).alias(v) for v in values],
            *[f"link_{v}" for v in values])
        number = len(rounds)
        own, above, beneath = (_rank(F.col(x), F.col(y), number) for x, y in (("c", "d"), ("pc", "pd"), ("only.c", "only.d")))
        goes = (F.col("n") == 1) & F.col("pc").isNotNull() & (own < above) & (own < beneath)
        inner = inner.withColumn("goes", F.coalesce(goes, F.lit(False)))
        taken = inner.filter("goes").select(
            F.col("only.c").alias("c"), F.col("only.d").alias("d"),
            F.struct("c", "d", "pc", "pd", *values, *[f"link_{v}" for v in values]).alias("out"))
        met = inner.filter("NOT goes").join(taken, ["c", "d"], "left")
        fields = ["fate", "c", "d", "pc", "pd", "n", *values, *[f"link_{v}" for v in values]]
        kinds = ["int", "long", "long", "long", "long", "long", *["long"] * 2 * len(values)]
        row = lambda *x: F.struct(*[e.cast(k).alias(f) for e, f, k in zip(x, fields, kinds, strict=True)])
        has, out = F.col("out").isNotNull(), lambda f: F.col("out").getField(f)
        stays = row(
            F.lit(1), F.col("c"), F.col("d"), F.when(has, out("pc")).otherwise(F.col("pc")), F.when(has, out("pd")).otherwise(F.col("pd")), F.col("n"),
            *[F.col(v) for v in values],
            *[F.col(f"link_{v}") + F.when(has, out(v) + out(f"link_{v}")).otherwise(0) for v in values])
        # A node taken out: its name as (pc, pd), the node below as (c, d), and what it has beyond that node's total.
        gone = row(
            F.lit(2), F.col("c"), F.col("d"), out("c"), out("d"), F.lit(0), *[F.col(f"link_{v}") + out(v) for v in values], *[F.lit(0)] * len(values))
        met = met.select(F.explode(F.when(has, F.array(stays, gone)).otherwise(F.array(stays))).alias("row")).select("row.*")
        raked = alive.filter(leaf).select(F.lit(0).alias("fate"), *fields[1:])
        done = written(raked.unionByName(met), "trie")
        rounds.append(done)
        alive = done.filter("fate = 1").drop("fate")

    known = None
    for number, done in reversed(list(enumerate(rounds))):
        raked = done.filter("fate = 0").select("c", "d", *values)
        if known is not None:
            gone = done.filter("fate = 2").select("c", "d", F.struct("pc", "pd", *values).alias("out"))
            out = lambda f: F.col("out").getField(f)
            own = F.struct("c", "d", *values)
            above = F.struct(out("pc").alias("c"), out("pd").alias("d"), *[(F.col(v) + out(v)).alias(v) for v in values])
            both = F.when(F.col("out").isNotNull(), F.array(own, above)).otherwise(F.array(own))
            known = known.join(gone, ["c", "d"], "left").select(F.explode(both).alias("row")).select("row.*").unionByName(raked)
        else:
            known = raked
        if number % ROUNDS_AT_ONCE == 0:
            known = written(known, "totals")
    return known if known is not None else nodes.select("c", "d", *values)


def prefix_trie(items: DataFrame, keys: DataFrame) -> DataFrame:
    """The nodes of the trie of all sequences, one row each.

    ``items`` (key long, position long, content binary, size long) holds each sequence's members, numbered from 1 without gaps;
    ``keys`` (key long) all sequences, those without members too; both without nulls. Equal contents have
    equal sizes. Result: (key, depth, parent_key, n_keys, n_children, n_leaves, saved, ends_sha256). key is the smallest of the
    sequences that begin with the node's prefix and with depth names the node; parent_key is null at the root, whose depth is 0 and which all sequences share;
    n_leaves counts the nodes without children in its subtree, and saved sums (n_keys - 1) * size of a node's last member over it, what
    storing the node once saves; a leaf counts as its own. ends_sha256 is the digest of the keys of the sequences that end in the node, ascending, comma-joined. Two
    prefixes count as equal when 128 bits of hash sums agree. Repeated keys in ``keys`` count once; without keys there are no nodes.
    """
    hashed = items.withColumns({"h1": _hash(1, "position", "content"), "h2": _hash(2, "content", "position")})
    running = with_order(
        hashed.select("key", "position", "size", "h1", "h2"), ["key"], ["position"], sum_before={"s1": "h1", "s2": "h2"})
    name = lambda depth, a, b: F.concat_ws(":", depth, a.cast(WIDE), b.cast(WIDE))
    before, here = F.col("position") - 1, F.col("position")
    places = written(running.select(
        "key", F.col("position").alias("depth"), "size",
        name(here, F.col("s1") + F.col("h1"), F.col("s2") + F.col("h2")).alias("node"),
        F.when(before == 0, F.lit(ROOT)).otherwise(name(before, F.col("s1"), F.col("s2"))).alias("parent")), "places")
    ids = keys.select("key").distinct()
    top = ids.agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("n_keys")).filter("n_keys > 0").select(
        F.lit(ROOT).alias("node"), F.lit(0).cast("long").alias("depth"), "key", "n_keys", F.lit(None).cast("string").alias("parent"), F.lit(0).cast("long").alias("size"))
    nodes = places.groupBy("node").agg(
        F.min("depth").alias("depth"), F.min("key").alias("key"), F.count(F.lit(1)).alias("n_keys"), F.min("parent").alias("parent"), F.min("size").alias("size"))
    nodes = nodes.unionByName(top)
    parents = nodes.select(F.col("node").alias("parent"), F.col("key").alias("parent_key"))
    nodes = written(nodes.join(parents, "parent", "left"), "nodes")

    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    totals = subtree_totals(
        nodes.select(
            F.col("key").alias("c"), F.col("depth").alias("d"), F.col("parent_key").alias("pc"), F.when(F.col("depth") > 0, F.col("depth") - 1).alias("pd"),
            (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_keys") - 1) * F.col("size")).alias("saved")),
        ["n_leaves", "saved"]).select(F.col("c").alias("key"), F.col("d").alias("depth"), "n_leaves", "saved")

    last = places.groupBy("key").agg(F.max(F.struct("depth", "node")).alias("last")).select("key", "last.node")
    ends = ids.join(last, "key", "left").select("key", F.coalesce("node", F.lit(ROOT)).alias("node"))
    digests = ends.repartition("node").sortWithinPartitions("node", "key").mapInPandas(_ends_digests, "node string, ends_sha256 string")
    return nodes.join(totals, ["key", "depth"]).join(digests, "node", "left").select(
        "key", "depth", "parent_key", "n_keys", "n_children", "n_leaves", "saved", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))
