"""SimHash near-duplicates by exact tiled comparison.

A fingerprint's tile is given by the population counts of its four 16-bit lanes. Two
fingerprints that differ in r bits have lane counts that differ by r in sum at most,
so tiles whose counts differ by more are never paired. All pairs of the other
tiles are compared with exclusive-or and bit counts.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from codelineage.llm.components import components, contracted, joined_labels
from codelineage.llm.names import free_name
from codelineage.storage import written

LANES = 4
# Fixed value: the hash seed of the fingerprint's definition.
SEED = 42
# Fingerprints of a tile, on average, once its lane counts hold more.
TILE = 1024

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash: a bit is set if it is in more than half of the shingles' hashes."""
    words = text.encode().lower().split() if text else []  # bytes: only A-Z change, only ASCII blanks part
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    line, ends, at = b" ".join(words), [], -1
    for n in map(len, words):
        at += n + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-shingle])]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:], strict=True)], ">u8")
    bytes_ = hashes.view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
    counts = (np.bincount(bytes_.ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 3) -> DataFrame:
    """(key, fingerprint long) of every row; the long holds the 64 bits as they are."""
    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        return pd.Series(np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts)).view(np.int64))

    return docs.select(key, prints(text).alias("fingerprint"))


def _lane(i: int):
    return F.bit_count(F.shiftrightunsigned("fingerprint", 16 * i).bitwiseAND(F.lit(0xFFFF))).cast("int")


def _links(radius: int):
    def run(batches):
        for batch in batches:
            found = []
            for a, b, same in zip(batch["a"], batch["b"], batch["same"], strict=True):
                a, b = np.asarray(a, np.int64), np.asarray(b, np.int64)
                near = np.bitwise_count(a.view(np.uint64)[:, None] ^ b.view(np.uint64)[None, :]) <= radius
                if same:
                    np.fill_diagonal(near, False)
                rows = np.flatnonzero(near.any(1))
                if not len(rows):
                    continue
                label = np.arange(len(a) + len(b))
                if same:
                    label[len(a):] = np.arange(len(a))
                for i in rows:
                    joined_labels(label, np.append(np.flatnonzero(near[i]) + len(a), i))
                both = np.concatenate([a, b])
                # Members of a label form a tree around its smallest fingerprint.
                used = np.flatnonzero((np.bincount(label, minlength=len(both))[label] > 1))
                frame = pd.DataFrame({"u": both[used], "l": label[used]})
                frame["v"] = frame.groupby("l")["u"].transform("min")
                found.append(frame.loc[frame["u"] > frame["v"], ["u", "v"]])
            yield pd.concat(found) if found else pd.DataFrame({"u": [], "v": []}, dtype=np.int64)

    return run


def near_links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Links (u, v) that join all fingerprints of ``prints(fingerprint)`` within ``radius`` bits.

    Every link found is between fingerprints within the radius or joined by a chain of such within one
    pair of tiles. At most one row a fingerprint and tile pair is returned; a chain stands for its pairs.
    """
    lanes = [f"l{i}" for i in range(LANES)]
    prints = prints.select("fingerprint").distinct().withColumns({c: _lane(i) for i, c in enumerate(lanes)})
    # At most 17^4 = 83,521 rows whatever the input, so they may be broadcast.
    sizes = prints.groupBy(*lanes).agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("n"))
    tiles = (
        prints.join(F.broadcast(sizes), lanes)
        .withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("n")).cast("int"))
        .groupBy(*lanes, "part").agg(F.collect_list("fingerprint").alias("prints"))
    )
    tiles = written(tiles, "tiles")
    steps = [s for s in product(range(-radius, radius + 1), repeat=LANES) if sum(map(abs, s)) <= radius and s >= (0,) * LANES]
    step = F.explode(F.array(*[F.struct(*[F.lit(x).alias(c) for x, c in zip(s, lanes, strict=True)]) for s in steps]))
    there = tiles.select(*[F.col(c).alias(f"t_{c}") for c in lanes]).distinct()
    pairs = (
        tiles.select(*lanes, "part").withColumn("step", step)
        .select(*lanes, "part", *[(F.col(c) + F.col(f"step.{c}")).alias(f"t_{c}") for c in lanes])
        .join(there, [f"t_{c}" for c in lanes])
    )
    other = tiles.select(
        *[F.col(c).alias(f"t_{c}") for c in lanes], F.col("part").alias("t_part"), F.col("prints").alias("b"))
    same_lanes = F.struct(*lanes) == F.struct(*[f"t_{c}" for c in lanes])
    paired = (
        pairs.join(other, [f"t_{c}" for c in lanes])
        .filter(~same_lanes | (F.col("part") <= F.col("t_part")))
        .join(tiles.withColumnRenamed("prints", "a"), [*lanes, "part"])
        .select("a", "b", (same_lanes & (F.col("part") == F.col("t_part"))).alias("same"))
    )
    return paired.mapInPandas(lambda batches: contracted(_links(radius)(batches)), "u long, v long")


def near_duplicates(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3
) -> DataFrame:
    """(key, fingerprint, component) of every row of ``docs``.

    Rows whose fingerprints differ in at most ``radius`` bits are linked; component is the
    smallest key that links reach, the row's own included. A null or empty text has fingerprint zero and is
    linked like any other; equal rows share a component; a null key is kept and never the
    smallest (a component of null keys alone is null). Other columns are not read.
    """
    rows = written(fingerprints(docs, key=key, text=text, shingle=shingle), "fingerprints")
    classes = rows.groupBy("fingerprint").agg(F.min(key).alias("first"))
    roots = components(near_links(classes, radius)).select(
        F.col("node").alias("fingerprint"), F.col("component").alias("root"))
    rooted = classes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(least, "root").select("fingerprint", "component")
    return rows.join(named, "fingerprint").select(key, "fingerprint", "component")


def first_of_each(docs: DataFrame, found: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose key is their component's; of rows with one key a single one stays.

    Rows with a null key stay: nothing tells them apart from others by key.
    """
    kept = found.filter(F.col(key) == F.col("component")).select(key).distinct()
    ordered = [c for c, kind in docs.dtypes if c != key and "map<" not in kind and "variant" not in kind]
    same = Window.partitionBy(key).orderBy(*ordered or [key])
    copy = free_name(docs.columns, "copy")
    named = docs.filter(F.col(key).isNotNull()).join(kept, key, "left_semi")
    one = named.withColumn(copy, F.row_number().over(same)).filter(F.col(copy) == 1).drop(copy)
    return one.select(*docs.columns).unionByName(docs.filter(F.col(key).isNull()))
