"""Conversation structure repair by secondary-sorted streaming.

The rows of a conversation reach one task in order, a batch at a time, and only a few numbers are carried from batch
to batch. Edits are chosen by dynamic programming over the roles that a well-formed conversation may have. A first
stream runs from the last turn to the first over narrow rows without texts; its state is the cost of what follows for each
of four places in the pattern, and it leaves one byte a turn: the best edit for each of the four. These bytes are spilled to
the shared folder in blocks. A second stream meets each block just before the turns it is for and walks
them forward. Memory is a block and a batch, however long a conversation is; only its audit, one letter an
edit, is kept whole, as it is a cell of the result.
"""

from __future__ import annotations

import hashlib
from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelineage.storage import written

WHITE = " \t\n\x0b\f\r"
# Backpointers spilled together, a byte each.
BLOCK = 1 << 16
LARGEST = (1 << 63) - 1

# Places in the pattern (s?(ua)+)?: nothing yet, after a system turn, after a user turn, after an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
# The place after adding a turn, or giving one the role that the place asks for.
ADDED = (USER, USER, ASSISTANT, USER)
# The place after keeping a turn, by the initial of its role: s, u, a, any other.
KEPT = ((SYSTEM, USER, None, None), (None, USER, None, None), (None, None, ASSISTANT, None), (None, USER, None, None))
ROLES = {USER: "user", ASSISTANT: "assistant"}
# Edits in ASCII order, and their costs.
EDITS = "DIKR"
DELETE, INSERT, KEEP, REROLE = range(4)
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 4, 3, 3, 3
# Cost of the rest at the end of a conversation, by place: it may end empty or after an assistant turn.
AT_END = (0, 2 * INSERT_COST, INSERT_COST, 0)
LEGAL = {(0, 1), (1, 2), (2, 1)}

FAULTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PLACE = ("known", "at", "role", "digest")

_steps: dict[tuple, tuple] = {}
_walks: dict[tuple, tuple] = {}


def backward(rest: tuple, kind: int) -> tuple:
    """(rest, added, byte): costs by place before a turn of ``kind``, less their minimum, which is ``added``.

    ``rest`` are the costs after it. The byte holds the best edit of each place, the first in ASCII order of those that cost the least.
    """
    found = _steps.get((rest, kind))
    if found is None:
        initial, truncated, must_go = kind & 3, kind >> 2 & 1, kind >> 3
        best = []
        for place in range(4):
            ways = [(DELETE_COST + rest[place], DELETE)]
            if not must_go:
                ways.append((REROLE_COST + TRUNCATED_COST * truncated + rest[ADDED[place]], REROLE))
                if KEPT[place][initial] is not None:
                    ways.append((TRUNCATED_COST * truncated + rest[KEPT[place][initial]], KEEP))
            best.append(min(ways))
        # Turns are added at this point at most in a row of two: two more lead back to the same place.
        best[USER], best[ASSISTANT] = (
            min(best[USER], (INSERT_COST + best[ASSISTANT][0], INSERT)), min(best[ASSISTANT], (INSERT_COST + best[USER][0], INSERT)))
        for place in (EMPTY, SYSTEM):
            best[place] = min(best[place], (INSERT_COST + best[USER][0], INSERT))
        least = min(cost for cost, _ in best)
        found = (tuple(cost - least for cost, _ in best), least, sum(edit << 2 * place for place, (_, edit) in enumerate(best)))
        _steps[rest, kind] = found
    return found


def forward(place: int, byte: int, initial: int) -> tuple:
    """(edits, place, added roles, role): the edits up to and with that of one turn; role is None if it goes, '' if it keeps its own."""
    found = _walks.get((place, byte, initial))
    if found is None:
        edits, added, now = "", [], place
        while byte >> 2 * now & 3 == INSERT:
            now = ADDED[now]
            edits += EDITS[INSERT]
            added.append(ROLES[now])
        edit = byte >> 2 * now & 3
        role = None
        if edit == KEEP:
            now, role = KEPT[now][initial], ""
        elif edit == REROLE:
            now = ADDED[now]
            role = ROLES[now]
        found = (edits + EDITS[edit], now, tuple(added), role)
        _walks[place, byte, initial] = found
    return found


NOBODY = object()
SPILLED = (
    "conv string, lead int, known boolean, at long, role string, digest binary, part long, pointers binary, "
    + ", ".join(f"{c} long" for c in FAULTS))


def _backpointers(batches):
    """Blocks of backpointers and one row of counts for each conversation, whose turns come last first."""
    conv, out = NOBODY, []

    def spill():
        nonlocal part
        if pointers:
            out.append((conv, 1, *place, part, bytes(reversed(pointers)), *[0] * len(FAULTS)))
            part -= 1
            pointers.clear()

    def close():
        if conv is not NOBODY:
            spill()
            gaps = min(LARGEST, high - low + 1 - turns) if turns else 0
            out.append((conv, 0, False, 0, "", b"", 0, b"", gaps, blank, duplicate, truncated, illegal, total + rest[EMPTY]))

    for batch in batches:
        for c, known, at, role, digest, kind, fault in zip(*(batch[n] for n in ("conv", *PLACE, "kind", "fault")), strict=True):
            if c != conv:
                close()
                conv, rest, total, part, pointers, after = c, AT_END, 0, 0, bytearray(), None
                turns = blank = duplicate = truncated = illegal = high = low = 0
            if known:
                if not turns:
                    high = low = at
                    turns = 1
                elif at != low:
                    low = at
                    turns += 1
            blank += fault == 1
            duplicate += fault == 2
            truncated += fault == 3
            illegal += after is not None and (kind & 3, after) not in LEGAL
            after = kind & 3
            rest, added, byte = backward(rest, kind)
            total += added
            pointers.append(byte)
            place = (known, at, role, digest)
            if len(pointers) == BLOCK:
                spill()
        if len(out) >= 1000 or sum(len(row[7]) for row in out[-64:]) > 1 << 20:
            yield pd.DataFrame(out, columns=_names(SPILLED))
            out.clear()
    close()
    yield pd.DataFrame(out, columns=_names(SPILLED))


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


AUDITED = "conv string, audit string, n_turns long, repaired_sha256 string, " + ", ".join(f"{c} long" for c in FAULTS)
REPAIRED = "conv string, position long, edit string, role string, text string"


def _walked(batches, turns: bool):
    """The repaired turns, or one row of audit, digest and counts for each conversation."""
    conv, out = NOBODY, []

    def put(edit, role, text):
        nonlocal n
        n += 1
        if turns:
            out.append((conv, n, edit, role, text))
        else:
            digest.update(f"{'' if n == 1 else chr(10)}{role}:{text}".encode())

    def close():
        nonlocal place
        if conv is not NOBODY:
            while place in (SYSTEM, USER):
                place = ADDED[place]
                letters.append(EDITS[INSERT])
                put(EDITS[INSERT], ROLES[place], "")
            if not turns:
                out.append((conv, "".join(letters), n, digest.hexdigest(), *counts))

    columns = _names(REPAIRED if turns else AUDITED)
    for batch in batches:
        for c, role, text, initial, pointers, *numbers in zip(
                *(batch[x] for x in ("conv", "role", "text", "initial", "pointers", *FAULTS)), strict=True):
            if c != conv:
                close()
                conv, place, n, letters, waiting, digest, counts = c, EMPTY, 0, [], deque(), hashlib.sha256(), numbers
                continue
            if pointers is not None:
                waiting.append(iter(pointers))
                continue
            while (byte := next(waiting[0], None)) is None:
                waiting.popleft()
            edits, place, added, new = forward(place, byte, initial)
            letters.append(edits)
            for r in added:
                put(EDITS[INSERT], r, "")
            if new is not None:
                put(edits[-1], new or role, text)
            if len(letters) > BLOCK:
                letters = ["".join(letters)]
        if out:
            yield pd.DataFrame(out, columns=columns)
            out = []
    close()
    yield pd.DataFrame(out, columns=columns)


def _last(text: Column) -> Column:
    return F.right(F.rtrim(text, F.lit(WHITE)), F.lit(1))


def _rows(turns: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """Every turn with what its place in the order and its faults follow from."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(
        F.col(key).cast("string").alias("conv"), F.col(turn).isNotNull().alias("known"),
        F.coalesce(F.col(turn).cast("long"), F.lit(0)).alias("at"), space(role).alias("role"), space(text).alias("text"))
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    return rows.select("*", F.unhex(F.md5("text")).alias("digest"), initial.alias("initial"))


def _streamed(rows: DataFrame, key: str, turn: str, role: str, text: str, repaired: bool) -> DataFrame:
    full = _rows(rows, key, turn, role, text)
    last = _last(F.col("text"))
    flags = F.when(last == "", 1).when(~last.isin(".", "!", "?"), 3).otherwise(0)
    # Equal rows of one turn are counted, so that their copies need no order among them.
    counted = full.groupBy("conv", *PLACE, "initial", flags.alias("flag")).agg(F.count(F.lit(1)).alias("copies"))
    firsts = (
        counted.groupBy("conv", "role", "digest").agg(F.min(F.struct("known", "at")).alias("first"), F.count(F.lit(1)).alias("times"))
        .filter("times > 1").select(F.col("conv").alias("conv_"), F.col("role").alias("role_"), F.col("digest").alias("digest_"), "first"))
    same = F.col("conv").eqNullSafe(F.col("conv_")) & (F.col("role") == F.col("role_")) & (F.col("digest") == F.col("digest_"))
    again = (F.col("copy") > 1) | F.coalesce(F.struct("known", "at") > F.col("first"), F.lit(False))
    fault = F.when(F.col("flag") == 1, 1).when(again, 2).otherwise(F.col("flag"))
    narrow = (
        counted.join(firsts, same, "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .select("conv", *PLACE, "copy", "initial", fault.alias("fault"))
        .withColumn("kind", F.col("initial") + F.when(F.col("fault") == 3, 4).when(F.col("fault") > 0, 8).otherwise(0)))
    reverse = narrow.repartition("conv").sortWithinPartitions("conv", *[F.desc(c) for c in (*PLACE, "copy")])
    spilled = written(reverse.mapInPandas(_backpointers, SPILLED), "backpointers")

    none = {"text": "string", "initial": "int"}
    blocks = spilled.withColumns({c: F.lit(None).cast(t) for c, t in none.items()})
    numbers = {c: F.lit(0).cast("long") for c in ("part", *FAULTS)}
    given = full.withColumns({"lead": F.lit(2), "pointers": F.lit(None).cast("binary"), **numbers})
    # The counts come first, then each block before the turn it begins with.
    joined = blocks.unionByName(given).withColumn("initial", F.coalesce("initial", F.lit(3)))
    in_order = joined.repartition("conv").sortWithinPartitions("conv", F.col("lead") > 0, *PLACE, "lead", "part")
    done = in_order.mapInPandas(lambda batches: _walked(batches, repaired), REPAIRED if repaired else AUDITED)
    return done.withColumn("conv", F.col("conv").cast(rows.schema[key].dataType)).withColumnRenamed("conv", key)


def audited(turns: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: faults, the cheapest repair and a digest of what it gives.

    (key, audit, n_turns, repaired_sha256, gaps, blank, duplicate, truncated, illegal, cost). Turns are taken in the order of
    ``turn`` (null first), then role, then MD5 of the text; rows equal in all of them are copies, all but the
    first duplicates. A null role or text counts as one space, a null key is a key of its own. The first of these faults of a
    turn counts: blank (only white space), duplicate (role and text stood earlier), truncated (its last
    character that is no white space is none of .!?). ``illegal`` counts neighbours whose roles do not begin with su, ua or au, ``gaps`` the
    turn numbers missing between the least and the greatest. The audit lists the edits of the cheapest repair to roles
    (s?(ua)+)?, of several the first in ASCII order: K keeps a turn (0), R makes it a user or assistant turn (3), D deletes
    it (4; a must for blank and duplicate turns), I adds an empty user or assistant turn (3); a truncated turn
    that stays costs 3 more. The digest is the SHA-256 of ``role:text`` of the repaired turns, joined by newlines.
    Keys of any type that survives a cast to string and back; turn numbers must fit 64 bits. An empty table gives no rows. Very long
    texts and conversations are streamed. Other columns are not read.
    """
    return _streamed(turns, key, turn, role, text, False)


def repaired(turns: DataFrame, *, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The turns that :func:`audited` arrives at: (key, position from 1, edit K, R or I, role, text)."""
    return _streamed(turns, key, turn, role, text, True).withColumnsRenamed({"role": role, "text": text})
