"""Where the windows of many documents repeat: routing of shared passages to tasks by content.

A window is ``length`` consecutive symbols of one document. Every window holds an anchor: the run of
``width`` symbols whose hash is least in it, chosen alike wherever the window stands. So

1. chunks of documents send the distinct hashes of their anchors, with a hash of the surroundings, to
   buckets, which answer which of them occur again, and whether in one form of surroundings or several;
2. chunks send where those anchors stand to buckets by content, and the distinct surroundings
   themselves if they have several forms; an exact index there tells for each window where it
   starts first. Surroundings of one form need no index: every window starts first where they do;
3. chunks apply the answers to their texts.

A passage that very many documents share is sent once a chunk, whatever its number of copies.
Anchors that many chunks hold are sent window by window, each to a bucket of its own, so that a common
phrase in ever new surroundings spreads over all buckets. The texts are shuffled once,
by chunk; the three steps share that exchange.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 21
BUCKET_BYTES = 1 << 23
# An anchor that more chunks hold is sent window by window.
HOT_CHUNKS = 64
# Of the hash that tells one form of surroundings from another, sent with every anchor.
NAME_BYTES = 5
NO_KEY = np.iinfo(np.int64).max

_MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(BASE, -1, 1 << 64)
_U = np.uint64


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & _MASK, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1), modulo 2^64."""
    return _powers(base, 1 << max(1, (n - 1).bit_length()))[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> _U(29))) * _U(0xFF51AFD7ED558CCD)
    return h ^ (h >> _U(32))


def prefix_hashes(symbols: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes: P[i] = sum of symbol j times BASE^j over j < i."""
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum((symbols + _U(1)) * powers(BASE, len(symbols)), out=out[1:])
    return out


def run_hashes(prefix: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of ``width`` symbols, the same wherever the run stands."""
    n = len(prefix) - width
    if n <= 0:
        return np.empty(0, np.uint64)
    return mixed((prefix[width:] - prefix[:n]) * powers(_INVERSE, n))


def _sliding(x: np.ndarray, width: int, best) -> np.ndarray:
    """best(x[i], ..., x[i + width - 1]) for every i, by doubling."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = best(out[:-step], out[step:])
        have += step
    return out


def anchors(symbols: np.ndarray, ends: np.ndarray, length: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors of all windows, and the hashes of all runs; ``ends`` are the documents' ends in ``symbols``."""
    hashes = run_hashes(prefix_hashes(symbols), width)
    inside = length - width + 1
    if len(hashes) < inside:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    least = _sliding(hashes, inside, np.minimum)
    # A window that crosses a document's end chooses nothing.
    crossing = np.zeros(len(symbols) + 1, np.int32)
    starts = np.concatenate([[0], ends[:-1]])
    np.add.at(crossing, np.maximum(ends - length + 1, starts), 1)
    np.add.at(crossing, ends, -1)
    least = np.where(np.cumsum(crossing)[:len(least)] > 0, _U(0), least)
    chosen = _sliding(np.concatenate([np.zeros(inside - 1, np.uint64), least, np.zeros(inside - 1, np.uint64)]), inside, np.maximum)
    return np.flatnonzero(chosen[:len(hashes)] == hashes), hashes


def packed(**arrays) -> bytes:
    """Arrays in one compressed binary."""
    parts = []
    for a in arrays.values():
        a = np.ascontiguousarray(a)
        parts += [np.array([len(a)], "<i8").tobytes(), a.dtype.str.encode().ljust(4), a.tobytes()]
    return zlib.compress(b"".join(parts), 1)


def unpacked(data: bytes) -> list[np.ndarray]:
    data, at, out = zlib.decompress(data), 0, []
    while at < len(data):
        n, kind = int(np.frombuffer(data, "<i8", 1, at)[0]), np.dtype(data[at + 8:at + 12].decode().strip())
        out.append(np.frombuffer(data, kind, n, at + 12))
        at += 12 + n * kind.itemsize
    return out


def by_bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each hash; rises with the hash."""
    return (((hashes >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)


@dataclass(frozen=True)
class Kind:
    """What the symbols are and how a bucket finds first occurrences.

    symbols(text)  the text's symbols as whole numbers, and the raw form that ``finish`` takes
    surroundings(chunk, starts, ends)  binary of the symbols themselves of many runs
    first(runs, left, right, chosen, rank)  for the chosen ones of the runs in that binary, with
        ``left`` and ``right`` symbols around the anchor's start, and the rank of each one's first
        occurrence: per window (by its start's distance before the anchor) the least
        rank of a run that holds it there; -1 where the run has no such window
    own_document  whether an earlier start in the same document counts
    finish(raw, removed)  the output columns named in ``schema``
    """

    length: int
    width: int
    symbols: Callable
    surroundings: Callable
    first: Callable
    own_document: bool
    finish: Callable
    schema: str


class Chunk:
    """The documents of a chunk, in an order that does not depend on how they arrived."""

    def __init__(self, kind: Kind, rows: pd.DataFrame, key: str, text: str):
        texts = rows[text].fillna("").to_list()
        ranks = [NO_KEY if k is None else int(k) for k in rows[key]]
        order = sorted(range(len(rows)), key=lambda i: (ranks[i], texts[i]))
        self.keys = [rows[key].iloc[i] for i in order]
        self.ranks = np.array([ranks[i] for i in order], np.int64)
        self.texts = [texts[i] for i in order]
        found = [kind.symbols(t) for t in self.texts]
        self.ends = np.cumsum([len(s) for s, _ in found]) if found else np.zeros(0, np.int64)
        self.starts = self.ends - np.array([len(s) for s, _ in found], np.int64)
        self.symbols = np.concatenate([s for s, _ in found]) if found else np.zeros(0, np.uint64)
        self.raw = [r for _, r in found]

    @cached_property
    def all_raw(self) -> list:
        """The raw symbols of all documents in one list, by place."""
        return [x for raw in self.raw for x in raw]

    def document_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, places, "right")


@dataclass
class Anchored:
    """The anchors of a chunk: place, symbols left and right that their windows reach, hash, name of the surroundings."""

    place: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    name: np.ndarray

    def take(self, which) -> Anchored:
        return Anchored(*(getattr(self, f)[which] for f in ("place", "left", "right", "value", "name")))


def _named(prefix: np.ndarray, place, left, right) -> np.ndarray:
    """A hash of the symbols from ``left`` before to ``right`` behind each place, and of where the place is in them."""
    whole = mixed((prefix[place + right] - prefix[place - left]) * powers(_INVERSE, len(prefix))[place - left])
    return mixed(whole ^ (left.astype(np.uint64) * _U(0x9FB21C651E98DF25)) ^ right.astype(np.uint64))


def _anchored(kind: Kind, chunk: Chunk, prefix: np.ndarray) -> Anchored:
    place, hashes = anchors(chunk.symbols.astype(np.uint64), chunk.ends, kind.length, kind.width)
    doc = chunk.document_of(place)
    own, sides = hashes[place], []
    for sign, border in ((-1, chunk.starts[doc]), (1, chunk.ends[doc] - kind.width)):
        reached, open_ = np.zeros(len(place), np.int64), np.arange(len(place))
        for step in range(1, kind.length - kind.width + 1):
            q = place[open_] + sign * step
            inside = sign * (border[open_] - q) >= 0
            open_, q = open_[inside], q[inside]
            # The leftmost of equal hashes is a window's anchor, so a window has one.
            open_ = open_[hashes[q] > own[open_] if sign < 0 else hashes[q] >= own[open_]]
            reached[open_] = step
        sides.append(reached)
    left, right = sides[0], sides[1] + kind.width
    keep = left + right >= kind.length
    place, left, right = place[keep], left[keep], right[keep]
    value = mixed(own[keep] ^ _U(0x5851F42D4C957F2D))
    return Anchored(place, left, right, value, _named(prefix, place, left, right))


def _extremes(x: np.ndarray, number: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest ``x`` of each of ``n`` numbers, all of which occur."""
    order = np.argsort(number, kind="stable")
    begin = np.searchsorted(number[order], np.arange(n))
    return (np.minimum.reduceat(x[order], begin), np.maximum.reduceat(x[order], begin)) if n else (x[:0], x[:0])


def _cut(hashes: np.ndarray, size: int) -> bytes:
    """The upper ``size`` bytes of each hash."""
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 8 - size:].tobytes()


def _uncut(data: bytes, n: int, size: int, at: int = 0) -> np.ndarray:
    wide = np.zeros((n, 8), np.uint8)
    wide[:, 8 - size:] = np.frombuffer(data, np.uint8, n * size, at).reshape(n, size)
    return wide.view("<u8").ravel()


def _rising(values: np.ndarray) -> bytes:
    """Six bytes of each of the sorted hashes, as steps: four bytes, and the rest compressed."""
    steps = np.diff(values >> _U(16), prepend=_U(0))
    high = zlib.compress((steps >> _U(32)).astype("<u2").tobytes(), 1)
    return np.array([len(high)], "<u4").tobytes() + steps.astype("<u4").tobytes() + high


def _risen(data: bytes, n: int) -> tuple[np.ndarray, int]:
    """The values of ``_rising`` and where their data ends."""
    size = int(np.frombuffer(data, "<u4", 1)[0])
    end = 4 + 4 * n + size
    high = np.frombuffer(zlib.decompress(data[4 + 4 * n:end]), "<u2").astype(np.uint64)
    return np.cumsum(np.frombuffer(data, "<u4", n, 4).astype(np.uint64) + (high << _U(32))), end


def _send_anchors(kind: Kind, buckets: int, key: str, text: str):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        chunk = Chunk(kind, rows, key, text)
        found = _anchored(kind, chunk, prefix_hashes(chunk.symbols.astype(np.uint64)))
        values, number = np.unique(found.value, return_inverse=True)
        if kind.own_document:
            twice = np.bincount(number, minlength=len(values)) > 1
        else:
            low, high = _extremes(chunk.document_of(found.place), number, len(values))
            twice = high > low
        name, other = _extremes(found.name, number, len(values))
        cuts = np.searchsorted(by_bucket(values, buckets), np.arange(buckets + 1))
        bits = (twice, name != other)
        return pd.DataFrame(
            [(b, int(rows["chunk"].iloc[0]),
              _rising(values[i:j]) + _cut(name[i:j], NAME_BYTES) + b"".join(np.packbits(x[i:j]).tobytes() for x in bits), int(j - i))
             for b, (i, j) in enumerate(zip(cuts, cuts[1:], strict=False)) if j > i],
            columns=["bucket", "chunk", "data", "n"])

    return run


def _answer_anchors(rows: pd.DataFrame) -> pd.DataFrame:
    """Per value sent: 0 if it occurs once, 1 if again in the same surroundings, 2 if in several, 3 if so in many chunks."""
    value, name, twice, various = [], [], [], []
    for data, n in zip(rows["data"], rows["n"], strict=True):
        values, at = _risen(data, n)
        value.append(values)
        name.append(_uncut(data, n, NAME_BYTES, at))
        at, step = at + NAME_BYTES * n, -(-n // 8)
        for out, at in ((twice, at), (various, at + step)):
            out.append(np.unpackbits(np.frombuffer(data, np.uint8, step, at), count=n).astype(bool))
    values, number, count = np.unique(np.concatenate(value), return_inverse=True, return_counts=True)
    low, high = _extremes(np.concatenate(name), number, len(values))
    _, differs = _extremes(np.concatenate(various), number, len(values))
    _, again = _extremes(np.concatenate(twice), number, len(values))
    differs |= low != high
    state = np.where(differs, np.where(count > HOT_CHUNKS, 3, 2), ((count > 1) | again).astype(int)).astype(np.uint8)
    parts = np.split(state[number], np.cumsum(rows["n"])[:-1])
    return pd.DataFrame({"chunk": rows["chunk"], "bucket": rows["bucket"], "data": [zlib.compress(p.tobytes(), 1) for p in parts]})


def _send_surroundings(kind: Kind, buckets: int, key: str, text: str):
    def run(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        columns = ["bucket", "chunk", "data"]
        if not len(rows) or not len(answers):
            return pd.DataFrame({c: [] for c in columns})
        number_of = int(rows["chunk"].iloc[0])
        chunk = Chunk(kind, rows, key, text)
        prefix = prefix_hashes(chunk.symbols.astype(np.uint64))
        found = _anchored(kind, chunk, prefix)
        answers = answers.sort_values("bucket")
        state = np.frombuffer(b"".join(zlib.decompress(d) for d in answers["data"]), np.uint8)
        state = state[np.unique(found.value, return_inverse=True)[1]]
        # Hot anchors: a run of its own for every window around them, and a bucket by its content.
        hot = found.take(state == 3)
        first, last = np.maximum(0, kind.length - hot.right), hot.left
        n = last - first + 1
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
        place = np.repeat(hot.place, n)
        name = _named(prefix, place, offset, kind.length - offset)
        single = Anchored(place, offset, kind.length - offset, name, name)
        rest = found.take((state > 0) & (state < 3))
        bare = np.concatenate([state[(state > 0) & (state < 3)] == 1, np.ones(len(place), bool)])
        rest = Anchored(*(np.concatenate([getattr(rest, f), getattr(single, f)]) for f in ("place", "left", "right", "value", "name")))
        names, member = np.unique(rest.name, return_inverse=True)
        doc = chunk.document_of(rest.place)
        # A run's first member, by document and place.
        order = np.argsort(rest.place, kind="stable")
        at = order[np.unique(rest.name[order], return_index=True)[1]]
        several = np.bincount(member, minlength=len(names)) > 1
        bucket = by_bucket(mixed(rest.value[at] ^ _U(0xA0761D6478BD642F)), buckets)
        out = []
        # Runs are numbered by bucket, so a bucket's are known from the first one's number.
        order = np.argsort(bucket, kind="stable")
        place_of = np.empty(len(order), np.int64)
        place_of[order] = np.arange(len(order))
        names, at, several, bucket, member = names[order], at[order], several[order], bucket[order], place_of[member]
        start = rest.place - chunk.starts[doc] if kind.own_document else np.zeros(len(rest.place), np.int64)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)):
            u = slice(cuts[b], cuts[b + 1])
            a = at[u]
            full = a[~bare[a]]
            begin, end = rest.place[full] - rest.left[full], rest.place[full] + rest.right[full]
            out.append((int(b), number_of, packed(
                number=np.array([cuts[b]], np.uint32), name=np.frombuffer(_cut(names[u], 6), np.uint8),
                left=rest.left[a].astype(np.uint8), right=rest.right[a].astype(np.uint8),
                several=several[u], bare=bare[a], doc=chunk.ranks[doc[a]], place=start[a],
                runs=np.frombuffer(kind.surroundings(chunk, begin, end), np.uint8))))
        # The members themselves stay with the chunk: a bucket of its own hands them back.
        order = np.argsort(rest.place, kind="stable")
        out.append((buckets + number_of, number_of, packed(
            step=np.diff(rest.place[order], prepend=0).astype(np.uint32), member=member[order].astype(np.uint32))))
        return pd.DataFrame(out, columns=columns)

    return run


def _answer_surroundings(kind: Kind, buckets: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["bucket"].iloc[0] >= buckets:
            return pd.DataFrame({"chunk": rows["chunk"], "members": True, "data": rows["data"]})
        sent = [unpacked(d) for d in rows["data"]]
        sizes = [len(s[2]) for s in sent]
        left, right, several, bare, doc, place = (np.concatenate([s[i] for s in sent]) for i in range(2, 8))
        name = np.concatenate([_uncut(s[1].tobytes(), n, 6) for s, n in zip(sent, sizes, strict=True)])
        number = np.concatenate([int(s[0][0]) + np.arange(n, dtype=np.uint32) for s, n in zip(sent, sizes, strict=True)])
        # A run that several chunks sent stands once, under its first occurrence.
        by = np.lexsort((place, doc, name))
        fresh = np.concatenate([[True], name[by][1:] != name[by][:-1]])
        chosen = by[fresh]
        run_of = np.empty(len(name), np.int64)
        run_of[by] = np.cumsum(fresh) - 1
        order = np.lexsort((place[chosen], doc[chosen]))  # ranks of the owners
        rank = np.empty(len(chosen), np.int64)
        rank[order] = np.arange(len(chosen))
        own = rank[run_of]
        first_doc, first_place = doc[chosen[order]], place[chosen[order]]
        # What the chunk cannot know: windows that start first elsewhere, or in a run it holds several times.
        foreign = (first_doc[own] != doc) | (first_place[own] != place) | several

        # Surroundings in one form only: all their windows start first where the run does.
        told = np.flatnonzero(bare & foreign)
        answers = [(told, np.maximum(0, kind.length - right[told].astype(np.int64)), left[told].astype(np.int64), own[told])]
        full = np.flatnonzero(~bare)
        if len(full):
            at = np.full(len(name), -1)
            at[full] = np.arange(len(full))
            index = np.flatnonzero(~bare[chosen])
            least = kind.first(
                b"".join(s[8].tobytes() for s in sent), left[full], right[full], at[chosen[index]], rank[index])
            row_of = np.full(len(chosen), -1)
            row_of[index] = np.arange(len(index))
            answer = least[row_of[run_of[full]]]
            row, offset = np.nonzero((answer >= 0) & ((answer != own[full][:, None]) | foreign[full][:, None]))
            value = answer[row, offset]
            begins = np.ones(len(row), bool)
            begins[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1]) | (offset[1:] != offset[:-1] + 1)
            start = np.flatnonzero(begins)
            end = np.append(start[1:], len(row))[:len(start)] - 1
            answers.append((full[row[start]], offset[start], offset[end], value[start]))
        row, low, high, value = (np.concatenate([a[i] for a in answers]) for i in range(4))
        order = np.argsort(row, kind="stable")
        row, low, high, value = row[order], low[order], high[order], value[order]
        out, top = [], np.cumsum(sizes)
        for chunk, a, b in zip(rows["chunk"], np.searchsorted(row, top - sizes), np.searchsorted(row, top), strict=True):
            if b > a:
                out.append((chunk, False, packed(
                    number=number[row[a:b]], low=low[a:b].astype(np.uint8), high=high[a:b].astype(np.uint8),
                    doc=first_doc[value[a:b]], place=first_place[value[a:b]])))
        return pd.DataFrame(out, columns=["chunk", "members", "data"])

    return run


def _apply(kind: Kind, key: str, text: str):
    def run(rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        chunk = Chunk(kind, rows, key, text)
        gone = np.zeros(len(chunk.symbols) + 1, np.int64)
        told = [unpacked(d) for d in answers.loc[~answers["members"].astype(bool), "data"]] if len(answers) else []
        if told:
            step, member = unpacked(answers.loc[answers["members"].astype(bool), "data"].iloc[0])
            p = np.cumsum(step.astype(np.int64))
            number, low, high, doc, place = (np.concatenate([t[i] for t in told]) for i in range(5))
            # Pair every answer with all members of its run.
            by_member = np.argsort(member, kind="stable")
            first = np.searchsorted(member[by_member], number, "left")
            count = np.searchsorted(member[by_member], number, "right") - first
            answer = np.repeat(np.arange(len(number)), count)
            at = by_member[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)]
            d = chunk.document_of(p[at])
            earlier = doc[answer] < chunk.ranks[d]
            if kind.own_document:
                earlier |= (doc[answer] == chunk.ranks[d]) & (place[answer] < p[at] - chunk.starts[d])
            at, answer = at[earlier], answer[earlier]
            np.add.at(gone, p[at] - high[answer].astype(np.int64), 1)
            np.add.at(gone, p[at] - low[answer].astype(np.int64) + kind.length, -1)
        removed = np.cumsum(gone)[:-1] > 0
        out = [
            (k, *kind.finish(raw, removed[a:b]))
            for k, raw, a, b in zip(chunk.keys, chunk.raw, chunk.starts, chunk.ends, strict=True)
        ]
        return pd.DataFrame(out, columns=[key, *[c.split()[0] for c in kind.schema.split(", ")]])

    return run


def without_repeats(docs: DataFrame, kind: Kind, *, key: str, text: str) -> DataFrame:
    """One row for each of ``docs``: the key and what ``kind.finish`` gives of its text and the removed symbols."""
    # Keys travel as text: pandas would round large numbers beside nulls.
    held = docs.select(F.col(key).cast("long").cast("string").alias(key), F.col(text).alias(text))
    size = docs.agg(F.sum(F.octet_length(text).cast("long") + 64)).first()[0] or 1
    chunks = int(size // CHUNK_BYTES) + 1
    buckets = int(size // BUCKET_BYTES) + 1
    held = held.withColumn("chunk", F.pmod(F.xxhash64(key, text), F.lit(chunks)))
    # Documents by chunk: one exchange, used by all three steps.
    tasks = int(size // (4 * CHUNK_BYTES)) + 1
    held = held.repartition(tasks, "chunk")
    sent = held.groupBy("chunk").applyInPandas(
        _send_anchors(kind, buckets, key, text), "bucket long, chunk long, data binary, n int")
    known = sent.groupBy("bucket").applyInPandas(_answer_anchors, "chunk long, bucket long, data binary")
    runs = held.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInPandas(
        _send_surroundings(kind, buckets, key, text), "bucket long, chunk long, data binary")
    told = runs.groupBy("bucket").applyInPandas(
        _answer_surroundings(kind, buckets), "chunk long, members boolean, data binary")
    done = held.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInPandas(
        _apply(kind, key, text), f"`{key}` string, {kind.schema}")
    return done.withColumn(key, F.col(key).cast("long"))
