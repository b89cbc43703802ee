"""Near-duplicate vectors by PCA-ordered tiled comparison.

Unit vectors are rotated to the principal axes of all vectors of their length and laid in tiles along the first.
Every pair of tiles whose first coordinates can belong to near vectors is compared: products of the leading
coordinates first, with the product of the remaining norms as a bound on the rest, and only pairs that can still
reach the threshold go on to more coordinates. What passes is decided by the cosine of the original
vectors in double precision, so the rotation never decides a link.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codelineage.llm.components import components, forest
from codelineage.storage import written

TILE = 2048
# Rows of a tile compared at a time, and pairs carried on to further coordinates at a time.
ROWS_AT_ONCE, PAIRS_AT_ONCE = 256, 1 << 16
LEADING = 16
SUMMING_TASKS = 16
# Rounding of products of unit vectors stays far below this.
SLACK = 1e-9


def _matrix(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    # By the largest component first, so that squares neither vanish nor overflow.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def principal_axes(vectors: DataFrame, size: int) -> np.ndarray:
    """Orthonormal axes of ``vectors(x)``, by falling share of the squared lengths of the unit vectors."""
    def moments(batches):
        total = np.zeros((size, size))
        for batch in batches:
            if len(batch):
                unit = _unit(_matrix(batch["x"]))
                total += unit.T @ unit
        yield pd.DataFrame({"m": [total.tobytes()]})

    def added(batches):
        total = np.zeros((size, size))
        for batch in batches:
            for m in batch["m"]:
                total += np.frombuffer(m).reshape(size, size)
        yield pd.DataFrame({"m": [total.tobytes()]})

    few = vectors.mapInPandas(moments, "m binary").repartition(SUMMING_TASKS).mapInPandas(added, "m binary")
    total = sum(np.frombuffer(row["m"]).reshape(size, size) for row in few.toLocalIterator())
    return np.linalg.eigh(total)[1][:, ::-1].copy()


def _scaled(x: np.ndarray) -> np.ndarray:
    # By a power of two, which rounds nothing, so that products and squares do not overflow.
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, keepdims=True))[1])


def near_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool):
    """Chunks (i, j) of rows of ``a`` and ``b`` with cosine at the threshold or above; i < j within one tile."""
    a64, b64 = _scaled(a.astype(np.float64)), _scaled(b.astype(np.float64))
    norms = [np.sqrt((x * x).sum(1)) for x in (a64, b64)]
    ra, rb = _unit(a64) @ axes, _unit(b64) @ axes
    size = ra.shape[1]
    cuts = [*range(LEADING, size, LEADING), size] if size > LEADING else [size]

    def rest(r):
        tail = np.cumsum((r * r)[:, ::-1], axis=1)[:, ::-1]
        return [np.sqrt(tail[:, c]) if c < size else np.zeros(len(r)) for c in cuts]

    rest_a, rest_b = rest(ra), rest(rb)
    for top in range(0, len(a), ROWS_AT_ONCE):
        rows = slice(top, top + ROWS_AT_ONCE)
        products = ra[rows, :cuts[0]] @ rb[:, :cuts[0]].T
        i, j = np.nonzero(products + rest_a[0][rows, None] * rest_b[0][None, :] >= threshold - SLACK)
        known = products[i, j]
        i = i + top
        if same:
            known, i, j = known[i < j], i[i < j], j[i < j]
        for first in range(0, len(i), PAIRS_AT_ONCE):
            some = slice(first, first + PAIRS_AT_ONCE)
            p, q, so_far = i[some], j[some], known[some]
            for k, (start, end) in enumerate(zip(cuts, cuts[1:], strict=False), 1):
                so_far = so_far + (ra[p, start:end] * rb[q, start:end]).sum(1)
                can = so_far + rest_a[k][p] * rest_b[k][q] >= threshold - SLACK
                p, q, so_far = p[can], q[can], so_far[can]
            exact = (a64[p] * b64[q]).sum(1) / (norms[0][p] * norms[1][q])
            yield p[exact >= threshold], q[exact >= threshold]


def _tile_rows(batches, kind):
    """The vectors of one task in tiles along the first axis; a task's vectors come sorted."""
    waiting, n, number = [], 0, 0

    def tile(rows):
        x = np.stack(rows["x"].to_numpy()).astype(kind)
        return pd.DataFrame({
            "number": [number], "low": [rows["first"].iloc[0]], "high": [rows["first"].iloc[-1]],
            "ids": [rows["id"].to_numpy(np.int64).tobytes()], "copies": [rows["copies"].to_numpy(np.int64).tobytes()],
            "vectors": [x.tobytes()]})

    for batch in batches:
        waiting.append(batch)
        n += len(batch)
        while n >= TILE:
            rows = pd.concat(waiting)
            yield tile(rows.iloc[:TILE])
            number += 1
            waiting, n = [rows.iloc[TILE:]], n - TILE
    if n:
        yield tile(pd.concat(waiting))


def _tiles(classes: DataFrame, axes: np.ndarray, n: int, kind) -> DataFrame:
    first_axis = axes[:, 0]

    @F.pandas_udf("double")
    def first(x: pd.Series) -> pd.Series:
        return pd.Series(_unit(_matrix(x)) @ first_axis) if len(x) else pd.Series([], dtype=float)

    parts = -(-n // (4 * TILE))
    ordered = classes.withColumn("first", first("x")).repartitionByRange(parts, "first").sortWithinPartitions("first", "id")
    tiles = ordered.mapInPandas(
        lambda batches: _tile_rows(batches, kind), "number int, low double, high double, ids binary, copies binary, vectors binary")
    return written(tiles, "tiles")


def _compared(axes: np.ndarray, threshold: float, kind):
    size = len(axes)

    def run(pairs: pd.DataFrame) -> pd.DataFrame:
        out = []
        for row in pairs.itertuples():
            (a, a_ids, a_copies), (b, b_ids, b_copies) = (
                (np.frombuffer(v, kind).reshape(-1, size), np.frombuffer(i, np.int64), np.frombuffer(c, np.int64))
                for v, i, c in ((row.a_vectors, row.a_ids, row.a_copies), (row.b_vectors, row.b_ids, row.b_copies)))
            same = row.a == row.b
            links_a, links_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
            u = v = np.empty(0, np.int64)
            for p, q in near_pairs(a, b, axes, threshold, same):
                links_a += np.bincount(p, b_copies[q], len(a)).astype(np.int64)
                links_b += np.bincount(q, a_copies[p], len(b)).astype(np.int64)
                if len(p):
                    u, v = forest(np.concatenate([u, a_ids[p]]), np.concatenate([v, b_ids[q]]))
            for ids, links in ((a_ids, links_a), (b_ids, links_b)):
                some = links > 0
                out.append(pd.DataFrame({"id": ids[some], "other": -1, "links": links[some]}))
            out.append(pd.DataFrame({"id": u, "other": v, "links": 0}))
        return pd.concat(out).astype(np.int64)

    return run


def _near(classes: DataFrame, size: int, n: int, threshold: float, kind) -> DataFrame:
    """(id, other, links) of the near vectors among ``classes(x, id, copies)`` of one length, which stand for ``n`` rows."""
    axes = principal_axes(classes.select("x"), size)
    tiles = _tiles(classes, axes, n, kind)

    # One narrow row a tile goes through the window that numbers them.
    tiles = tiles.withColumn("name", F.md5("ids"))
    order = Window.orderBy("low", "high", "name")
    numbered = written(tiles.select("low", "high", "name", F.row_number().over(order).alias("tile")), "numbers")
    total = numbered.count()
    reach = float(np.sqrt(2 - 2 * threshold)) + 1e-6  # near unit vectors differ by less in any coordinate
    ends = numbered.select("tile", "low", "high")
    pairs = (
        ends.select(F.col("tile").alias("a"), F.col("high").alias("a_high"), F.explode(F.sequence("tile", F.lit(total))).alias("b"))
        .join(ends.select(F.col("tile").alias("b"), F.col("low").alias("b_low")), "b")
        .filter(F.col("b_low") - F.col("a_high") <= reach).select("a", "b")
    )
    whole = tiles.join(numbered.select("name", "tile"), "name")
    side = lambda s: whole.select(F.col("tile").alias(s), *[F.col(c).alias(f"{s}_{c}") for c in ("ids", "copies", "vectors")])
    return written(
        pairs.join(side("a"), "a").join(side("b"), "b").groupBy("a", "b")
        .applyInPandas(_compared(axes, threshold, kind), "id long, other long, links long"), "near")


def near_duplicates(
    rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", threshold: float = 0.9, every_length: bool = False
) -> DataFrame:
    """(key, n_links, component) of every row: how many other rows it links with, and the smallest key reachable.

    Two rows link if the cosine of their vectors in double precision is ``threshold`` or more; no link is
    left out. Vectors of different lengths never link, and those of another length than the commonest link with each other
    only with ``every_length``. Vectors that are null, empty or zero, or that hold null or
    non-finite components link with nothing, nor do rows with a null key; their component is their own
    key. Equal vectors are compared once and counted as often as they occur. Other columns are
    not read. The number of tile pairs grows with the square of the tiles that the first axis cannot part.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold: must lie above 0, at most 1")
    # Components keep their precision: float as it is, all others as double.
    single = rows.select(F.col(vector).alias("x")).schema["x"].dataType.elementType.simpleString() == "float"
    x = F.transform(vector, lambda c: c.cast("float" if single else "double"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    nonzero = F.exists("x", lambda c: c != 0)
    usable = F.col(key).isNotNull() & F.col("x").isNotNull() & F.coalesce(finite & nonzero, F.lit(False))
    given = rows.select(F.col(key).alias("id"), x.alias("x"))
    good = given.filter(usable)
    classes = written(
        good.groupBy("x").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")), "classes")
    length = F.size("x")
    sizes = classes.groupBy(length.alias("size")).agg(F.count(F.lit(1)).alias("different"), F.sum("copies").alias("n")).orderBy("size").collect()
    if not sizes:
        return given.select(F.col("id").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    if not every_length:
        sizes = [max(sizes, key=lambda row: (row["n"], -row["size"]))]
        usable &= length == sizes[0]["size"]
        classes = classes.filter(length == sizes[0]["size"])
    # A length with one vector has nothing to compare.
    found = classes.sparkSession.createDataFrame([], "id long, other long, links long")
    for row in sizes:
        if row["different"] > 1:
            of_size = classes.filter(length == row["size"])
            found = found.unionByName(_near(of_size, row["size"], row["n"], threshold, np.float32 if single else np.float64))

    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.filter("links = 0").select(F.col("id").alias("u"), F.col("other").alias("v")))
    of_class = (
        classes.join(links, "id", "left").join(roots.withColumnRenamed("node", "id"), "id", "left")
        .select("x", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component"))
    )
    linked = given.filter(usable).join(of_class, "x").select("id", "n_links", "component")
    alone = given.filter(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return linked.unionByName(alone).select(F.col("id").alias(key), "n_links", "component")
