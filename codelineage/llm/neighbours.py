"""Approximate nearest neighbours by inner product over robust-pruned directed graphs.

Different vectors are dealt by hash to shards of bounded size, and each shard is indexed in one task: vectors are
inserted in batches that double, a greedy search from the entry point proposes neighbours, and relaxed distance pruning keeps
those that no kept neighbour already stands for, so that some edges are long. An extra coordinate gives all vectors of a
shard one norm, which turns the largest inner product into the least distance. The index is a table with one row a
shard. Blocks of queries meet every shard of their length and walk its graph with a beam; what they find is scored with the
original vectors in double precision, and the best of all shards are kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from codelineage.storage import written

SHARD_ROWS, BLOCK_ROWS = 8192, 512
# Edges of a node, width of the beam while building and searching, relaxation of the pruning (on squared distances).
DEGREE, BUILD_WIDTH, SEARCH_WIDTH, RELAXED = 32, 64, 128, 1.2
# Open nodes of a beam that are expanded together.
EXPANDED = 4
FIRST_ROWS, BATCH_ROWS, INCOMING = 32, 512, 32
# Nodes pruned at a time; bounds the products of their candidates.
PRUNED_AT_ONCE = 128


def lifted(x: np.ndarray) -> np.ndarray:
    """The rows of ``x`` as unit vectors with one more coordinate, scaled by one factor."""
    x = x / np.abs(x).max()
    x = x / np.sqrt((x * x).sum(1).max())
    rest = np.sqrt(np.maximum(0, 1 - (x * x).sum(1, keepdims=True)))
    return np.ascontiguousarray(np.hstack([x, rest]), dtype=np.float32)


def as_queries(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    x = x / np.sqrt((x * x).sum(1, keepdims=True))
    return np.hstack([x, np.zeros((len(x), 1))]).astype(np.float32)


def beam_search(points, graph, entries, queries, width):
    """(ids, distances, trace): the ``width`` nearest nodes found for each query, nearest first, and all nodes expanded; -1 fills."""
    n, rows = len(queries), np.arange(len(queries))[:, None]
    stamp = np.zeros((n, len(points)), np.int16)
    ids = np.full((n, width), -1)
    far = np.full((n, width), np.inf, np.float32)
    is_open = np.zeros((n, width), bool)
    start = 1 - queries @ points[entries].T
    if len(entries) > width:
        near = np.argpartition(start, width, 1)[:, :width]
    else:
        near = np.broadcast_to(np.arange(len(entries)), start.shape)
    m = near.shape[1]
    ids[:, :m], far[:, :m], is_open[:, :m] = entries[near], np.take_along_axis(start, near, 1), True
    stamp[rows, ids[:, :m]] = 1
    trace = []
    live = np.arange(n)
    while True:
        cost = np.where(is_open[live], far[live], np.inf)
        at = np.argpartition(cost, EXPANDED - 1, 1)[:, :EXPANDED]
        can = np.isfinite(np.take_along_axis(cost, at, 1))
        some = can.any(1)
        live, at, can = live[some], at[some], can[some]
        if not len(live):
            break
        here = live[:, None]
        nodes = ids[here, at]
        is_open[here, at] = False
        seen = np.full((n, EXPANDED), -1)
        seen[live] = np.where(can, nodes, -1)
        trace.append(seen)
        # A node's missing edges lead to itself, and nodes that are not to be expanded stand for the first of their row.
        nodes = np.where(can, nodes, nodes[np.arange(len(live)), can.argmax(1)][:, None])
        to = graph[nodes].reshape(len(live), -1)
        old, place = stamp[here, to], np.arange(1, to.shape[1] + 1, dtype=np.int16)
        stamp[here, to] = np.where(old == 0, place, old)
        new = (old == 0) & (stamp[here, to] == place)
        away = 1 - np.matmul(points[to], queries[live][:, :, None])[:, :, 0]
        all_far = np.hstack([far[live], np.where(new, away, np.inf)])
        best = np.argpartition(all_far, width - 1, 1)[:, :width]
        far[live] = np.take_along_axis(all_far, best, 1)
        ids[live] = np.take_along_axis(np.hstack([ids[live], to]), best, 1)
        is_open[live] = np.take_along_axis(np.hstack([is_open[live], new]), best, 1)
    order = np.argsort(far, 1, kind="stable")
    ids, far = np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)
    return np.where(np.isfinite(far), ids, -1), far, np.hstack(trace)


def pruned(points, nodes, candidates, degree, relaxed):
    """The edges of ``nodes`` out of their candidates (-1 fills): the nearest first, without those that a kept one stands for."""
    out = np.repeat(nodes[:, None], degree, 1)
    for top in range(0, len(nodes), PRUNED_AT_ONCE):
        some = slice(top, top + PRUNED_AT_ONCE)
        c, own = np.sort(candidates[some], 1), nodes[some]
        valid = (c >= 0) & (c != own[:, None])
        valid[:, 1:] &= c[:, 1:] != c[:, :-1]
        x = points[np.where(valid, c, own[:, None])]
        away = np.where(valid, 1 - np.matmul(x, points[own][:, :, None])[:, :, 0], np.inf)
        between = 1 - np.matmul(x, x.transpose(0, 2, 1))
        rows = np.arange(len(own))
        for edge in range(degree):
            at = away.argmin(1)
            has = np.isfinite(away[rows, at])
            if not has.any():
                break
            out[top + rows[has], edge] = c[rows, at][has]
            away[has[:, None] & (relaxed * between[rows, at] <= away)] = np.inf
            away[rows, at] = np.inf
    return out


def build_graph(points: np.ndarray, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(graph, entries): at most DEGREE edges a node, own numbers filling up, and nodes from which all others are reached."""
    n = len(points)
    order = np.random.default_rng(seed).permutation(n)
    middle = points.mean(0)
    entry = int((points @ middle).argmax())
    order = np.concatenate([[entry], order[order != entry]])
    graph = np.repeat(np.arange(n)[:, None], DEGREE, 1).astype(np.int32)
    entries = np.array([entry])
    first = order[:FIRST_ROWS]
    graph[first] = pruned(points, first, np.broadcast_to(first, (len(first), len(first))), DEGREE, RELAXED)
    done = len(first)
    while done < n:
        batch = order[done:done + min(done, BATCH_ROWS)]
        _, _, trace = beam_search(points, graph, entries, points[batch], BUILD_WIDTH)
        edges = pruned(points, batch, trace, DEGREE, RELAXED)
        graph[batch] = edges
        _add_incoming(points, graph, np.repeat(batch, DEGREE), edges.ravel())
        done += len(batch)
    return graph, _reaching(graph, entries)


def _add_incoming(points, graph, tails, heads):
    """Edges back from ``heads`` to ``tails``, pruned with those that the heads have."""
    real = tails != heads
    tails, heads = tails[real], heads[real]
    near = (points[tails] * points[heads]).sum(1)
    order = np.lexsort((-near, heads))
    tails, heads = tails[order], heads[order]
    nodes, starts, counts = np.unique(heads, return_index=True, return_counts=True)
    place = np.arange(len(heads)) - np.repeat(starts, counts)
    some = place < INCOMING
    incoming = np.full((len(nodes), INCOMING), -1)
    incoming[np.repeat(np.arange(len(nodes)), counts)[some], place[some]] = tails[some]
    free = (graph[nodes] == nodes[:, None]).sum(1)
    fits = np.minimum(counts, INCOMING) <= free
    candidates = np.hstack([graph[nodes], incoming])
    for i in np.nonzero(fits)[0]:
        own = candidates[i]
        own = np.unique(own[(own >= 0) & (own != nodes[i])])
        graph[nodes[i]] = nodes[i]
        graph[nodes[i], :len(own)] = own
    full = ~fits
    if full.any():
        graph[nodes[full]] = pruned(points, nodes[full], candidates[full], DEGREE, RELAXED)


def _reaching(graph, entries):
    reached = np.zeros(len(graph), bool)
    front = entries
    while True:
        reached[front] = True
        while len(front):
            to = np.unique(graph[front])
            front = to[~reached[to]]
            reached[front] = True
        left = np.nonzero(~reached)[0]
        if not len(left):
            return entries
        front = left[:1]
        entries = np.concatenate([entries, front])


INDEX = "size int, shard int, vectors binary, ids binary, counts binary, graph binary, entries binary"


def _indexed(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("class")
    x = np.stack(rows["x"].to_numpy()).astype(np.float64)
    graph, entries = build_graph(lifted(x))
    ids = rows["ids"].to_numpy()
    return pd.DataFrame({
        "size": rows["size"].iloc[:1], "shard": rows["shard"].iloc[:1], "vectors": [x.tobytes()],
        "ids": [np.concatenate(ids).astype(np.int64).tobytes()], "counts": [np.array([len(i) for i in ids], np.int64).tobytes()],
        "graph": [graph.tobytes()], "entries": [entries.astype(np.int64).tobytes()]})


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    x = np.stack(rows["x"].to_numpy()).astype(np.float64)
    return pd.DataFrame({
        "size": rows["size"].iloc[:1], "block": rows["block"].iloc[:1], "queries": [x.tobytes()],
        "classes": [rows["class"].to_numpy(np.int64).tobytes()]})


FOUND = "class long, other long, score double"


def _searched(k: int, width: int):
    def run(pairs: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in pairs.itertuples():
            size = row.size_
            x, queries = (np.frombuffer(v).reshape(-1, size) for v in (row.vectors, row.queries))
            ids, counts, entries, classes = (np.frombuffer(v, np.int64) for v in (row.ids, row.counts, row.entries, row.classes))
            graph = np.frombuffer(row.graph, np.int32).reshape(len(x), -1)
            near, _, _ = beam_search(lifted(x), graph, entries, as_queries(queries), width)
            firsts = np.cumsum(counts) - counts
            for q, found in enumerate(near):
                found = found[found >= 0]
                scores = (x[found] * queries[q]).sum(1)
                # Classes of the best scores hold at least k rows besides the query's own.
                best = np.lexsort((ids[firsts[found]], -scores))[:k + 1]
                found, scores = found[best], scores[best]
                members = np.concatenate([ids[firsts[f]:firsts[f] + counts[f]] for f in found])
                scores = np.repeat(scores, counts[found])
                best = np.lexsort((members, -scores))[:k + 1]
                out.append(pd.DataFrame({"class": classes[q], "other": members[best], "score": scores[best]}))
        return pd.concat(out)

    return run


def _of_hash(x: str, n: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(3), x), n).cast("int")


def nearest(
    rows: DataFrame, queries: Column, *, key: str = "vec_id", vector: str = "embedding", k: int = 20,
    shard_rows: int = SHARD_ROWS, width: int = SEARCH_WIDTH,
) -> DataFrame:
    """(query, rank, key, score): the ``k`` rows found nearest to each row for which ``queries`` holds, nearest first.

    Nearest is the largest inner product, in double precision of the vectors given; ties go to the smaller key. A row is
    not its own neighbour, others with an equal vector are. Fewer than k others of its length are all
    found if they fit the beam (``width``, at least 2 * k). Vectors that are null, empty or zero or hold null or non-finite components, and rows
    with a null key, take no part; vectors of another length than the query's are no candidates. Rows repeated with
    key and vector count once; a key with several vectors is several queries. Keys are integers. Equal vectors are indexed once, with their k + 1 smallest keys, so
    that a hot vector costs one node; shards hold about ``shard_rows`` different vectors. Every query searches every shard, so the work grows with the product of
    both, at a cost a shard that grows far slower than its rows. An empty table gives no rows. Other columns are not read.
    """
    x = F.transform(vector, lambda c: c.cast("double"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    usable = F.col("id").isNotNull() & F.coalesce(finite & F.exists("x", lambda c: c != 0), F.lit(False))
    given = rows.select(F.col(key).cast("long").alias("id"), x.alias("x"), F.coalesce(queries, F.lit(False)).alias("asks")).filter(usable)
    firsts = given.select("x", "id").distinct().withColumn("n", F.row_number().over(Window.partitionBy("x").orderBy("id"))).filter(F.col("n") <= k + 1)
    classes = written(
        firsts.groupBy("x").agg(F.array_sort(F.collect_list("id")).alias("ids"))
        .select("x", "ids", F.col("ids")[0].alias("class"), F.size("x").alias("size")), "classes")
    asking = written(given.filter("asks").select("id", "x").distinct().join(classes.select("x", "class", "size"), "x").select(
        F.col("id").alias("query"), "class", "size"), "asking")
    asked = asking.select("class").distinct()

    lengths = written(
        classes.groupBy("size").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards")).join(
            asking.groupBy("size").agg(F.ceil(F.count_distinct("class") / BLOCK_ROWS).cast("int").alias("blocks")), "size"), "lengths")
    # Tasks are few and long, so that their number follows the shards and not the bytes.
    shards, searches = lengths.agg(F.sum("shards"), F.sum(F.col("shards").cast("long") * F.col("blocks"))).first()
    if not shards:
        return rows.sparkSession.createDataFrame([], "query long, rank int, key long, score double").withColumnRenamed("key", key)
    index = written(
        classes.join(lengths, "size").withColumn("shard", _of_hash("x", F.col("shards"))).repartition(2 * shards, "size", "shard")
        .groupBy("size", "shard").applyInPandas(_indexed, INDEX), "index")
    blocks = written(
        classes.join(asked, "class").join(lengths, "size").withColumn("block", _of_hash("class", F.col("blocks")))
        .groupBy("size", "block").applyInPandas(_block, "size int, block int, queries binary, classes binary"), "blocks")

    # (length, shard, block) alone; then the blocks travel to the shards.
    pairs = lengths.select(
        "size", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"), "blocks").select(
        "size", "shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    met = pairs.join(blocks, ["size", "block"]).join(index, ["size", "shard"]).withColumnRenamed("size", "size_")
    found = met.repartition(min(2 * searches, 1 << 14), "size_", "shard", "block").groupBy("size_", "shard", "block").applyInPandas(_searched(k, max(width, 2 * k)), FOUND)
    order = [F.desc("score"), "other"]
    best = found.withColumn("n", F.row_number().over(Window.partitionBy("class").orderBy(*order))).filter(F.col("n") <= k + 1).drop("n")
    each = asking.join(best, "class").filter(F.col("other") != F.col("query"))
    ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy("query", "class").orderBy(*order))).filter(F.col("rank") <= k)
    return ranked.select("query", "rank", F.col("other").alias(key), "score")
