"""Join helpers for keys that may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelineage.storage import written

SALTS = 32
# Key tables of up to this many bytes are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 32 << 20
ROWS_PER_COPY = 64
# Keys of so many rows at most are held as a table by the driver and every executor, for a few hundred bytes each, when rows without one are wanted.
FEW_KEYS = 1 << 16
# Marks that tell which keys may be looked up: bits for each key, bits of one row, and powers of two of all bits at least and at most.
MARK_BITS, ROW_BITS, FEWEST_MARKS, MOST_MARKS = 16, 15, 15, 28


def salted_join(big: DataFrame, small: DataFrame, on: list[str], spread: Column, how: str = "inner") -> DataFrame:
    """Join where ``big`` may hold very many rows for one key and ``small`` few.

    Each key is split into a fixed number of sub-keys by the hash of ``spread``
    (a stable row identity), and ``small`` is repeated once per sub-key, so that
    no task receives a whole hot key. ``how`` keeps or drops rows of ``big`` only.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("salted_join: rows of the repeated side must not be kept")
    salt = F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")
    repeated = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.withColumn("_salt", salt).join(repeated, [*on, "_salt"], how).drop("_salt")


def size_of(df: DataFrame) -> tuple[int, int]:
    """Bytes and number of the rows of ``df``: text lengths, and sixteen bytes for any other value."""
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")).cast("long"), F.lit(0)) + 16 for c in df.columns]
    size, rows = df.agg(F.sum(sum(sizes[1:], sizes[0])), F.count(F.lit(1))).first()
    return size or 0, rows


def _marked(big: DataFrame, keys: DataFrame, on: list[str], n: int, how: str) -> DataFrame:
    """``big`` with ``_possible``: whether a row may have one of the ``n`` ``keys``; joined ``how`` with the marks."""
    power = min(MOST_MARKS, max(FEWEST_MARKS, (MARK_BITS * max(n, 1) - 1).bit_length()))
    at = F.pmod(F.xxhash64(*on), F.lit(1 << power))
    row, bit = F.shiftright(at, ROW_BITS).alias("_row"), at.bitwiseAND((1 << ROW_BITS) - 1).alias("_bit")
    marks = written(keys.select(row, bit).distinct().repartition("_row").groupBy("_row").agg(F.bitmap_construct_agg("_bit").alias("_marks")), "marks")
    found = big.select(*big.columns, row, bit).join(F.broadcast(marks), "_row", how)
    byte = F.conv(F.hex(F.substring("_marks", (F.shiftright("_bit", 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return found.select(*big.columns, (F.getbit(byte, F.col("_bit").bitwiseAND(7).cast("int")) == 1).alias("_possible"))


def possible(big: DataFrame, keys: DataFrame, on: list[str], n: int) -> DataFrame:
    """Rows of ``big`` that may have one of the ``n`` ``keys`` (of equal types), told in place, before any of them moves.

    Each key sets one of 16 bits a key by its hash, at most 2^28 in all (32 MB, broadcast); a row whose bit is not set has no such key.
    About one other row in sixteen passes, more from 2^24 keys on, so the join itself must follow.
    """
    return _marked(big, keys, on, n, "inner").filter("_possible").drop("_possible")


def without(big: DataFrame, keys: DataFrame, on: list[str], spread: Column) -> DataFrame:
    """Rows of ``big`` that have none of the ``keys``, which may be too many for the driver to hold as a table.

    Beyond FEW_KEYS, rows that cannot have one stay in place; the few that may (see :func:`possible`) are joined. ``big`` is read twice then.
    """
    n = keys.count()
    if n <= FEW_KEYS:
        return lookup_join(big, keys, on, spread, "left_anti")
    rows = _marked(big, keys, on, n, "left").withColumn("_possible", F.coalesce("_possible", F.lit(False)))
    here, there = (rows.filter(F.col("_possible") == maybe).drop("_possible") for maybe in (False, True))
    return here.unionByName(salted_join(there, keys, on, spread, "left_anti"))


def lookup_join(
    big: DataFrame, small: DataFrame, on: list[str], spread: Column | None, how: str = "inner"
) -> DataFrame:
    """Join file-sized rows with a narrow table of keys without moving the files.

    The bytes of the key table are summed; within the limit it is broadcast and
    ``big`` is joined in place. A larger one falls back to :func:`salted_join`,
    or to a plain join where ``spread`` is None because no key of ``big`` repeats;
    rows that cannot be in it are dropped before they move.
    """
    size, rows = size_of(small)
    if size <= BROADCAST_BYTES:
        return big.join(F.broadcast(small), on, how)
    if how in ("inner", "left_semi"):
        big = possible(big, small, on, rows)
    return big.join(small, on, how) if spread is None else salted_join(big, small, on, spread, how)


def wide_lookup(uses: DataFrame, wide: DataFrame, on: str, spread: Column) -> DataFrame:
    """Join many narrow ``uses`` with few wide rows of ``wide`` (unique in ``on``).

    A wide row is copied once per ROWS_PER_COPY uses, so a row used by very many
    others is served by as many tasks as it needs, and rarely used rows are not
    copied at all.
    """
    hot = F.ceil(F.count(F.lit(1)) / ROWS_PER_COPY).cast("int")
    copies = written(uses.groupBy(on).agg(hot.alias("_copies")).filter("_copies > 1"), "copies")
    number = F.coalesce("_copies", F.lit(1))
    spread_uses = lookup_join(uses, copies, [on], spread, "left").withColumn("_copy", F.pmod(F.xxhash64(spread), number).cast("int"))
    copied = lookup_join(wide, copies, [on], None, "left").withColumn("_copy", F.explode(F.sequence(F.lit(0), number - 1)))
    # The output is far larger than either input, so the partitions are fixed in
    # number and not merged for their small size.
    tasks = int(uses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = spread_uses.drop("_copies").repartition(tasks, on, "_copy")
    right = copied.drop("_copies").repartition(tasks, on, "_copy")
    return left.join(right, [on, "_copy"]).drop("_copy")
