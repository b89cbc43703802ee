"""Connected components of links found by the near-duplicate operators."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from codelineage.storage import written

# Links that one task contracts at a time.
LINKS_AT_ONCE = 200_000


def joined_labels(labels: np.ndarray, members: np.ndarray) -> None:
    """Give all nodes that share a label with one of ``members`` the smallest of those labels."""
    own = np.unique(labels[members])
    if len(own) > 1:
        labels[np.isin(labels, own)] = own[0]


def forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node linked to it) for the links given; at most one row a node."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[:len(left)], at[len(left):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        new = np.minimum(new, new[label])
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def contracted(batches):
    """Fewer links (u, v) that join the same nodes, for a task's batches of them."""
    waiting, n = [], 0
    for batch in batches:
        waiting.append(batch)
        n += len(batch)
        if n >= LINKS_AT_ONCE:
            node, root = forest(*(pd.concat(waiting)[c].to_numpy(np.int64) for c in ("u", "v")))
            waiting, n = [pd.DataFrame({"u": node, "v": root})], len(node)
            if n > LINKS_AT_ONCE // 2:
                yield waiting.pop()
                n = 0
    if waiting:
        node, root = forest(*(pd.concat(waiting)[c].to_numpy(np.int64) for c in ("u", "v")))
        yield pd.DataFrame({"u": node, "v": root})


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(u, v)`` of 64-bit integers that reaches a smaller one.

    ``component`` is the smallest node reachable; nodes that are the smallest of
    their component are left out. Tasks that find links should contract them first; they go through
    alternating rounds that point every node at the smallest neighbour of its
    neighbours, until a round changes nothing. A node of very many links is met by
    combining minima before the shuffle and by joins that can be split.
    """
    edges = written(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct(), "links")
    before = None
    while True:
        # u > v in every row: a node points at a smaller one.
        reach = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = reach.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("v"), F.least("u", "m").alias("m"))
        large = edges.join(least, "v").select("u", F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(low.select("u", F.col("m").alias("v")).unionByName(small).distinct(), "links")
        # A star keeps its rows; any other shape loses some or points lower.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.col("v").cast("decimal(38,0)")), F.count_distinct("u")).first()
        if now[0] == now[2] and before == now:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
