"""Packing token sequences by Karmarkar-Karp multiway differencing.

Every task packs the documents it reads, batch by batch, so there is no shuffle and
memory is bounded by one batch. A document longer than a window fills whole windows;
its remainder is cut into pieces and differencing spreads all pieces of a batch over
near-equal windows. The window count starts at the least possible and rises
whenever a window exceeds its capacity.
"""

from __future__ import annotations

import heapq
import itertools
import re
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES = ("start long, length long, doc_tokens long, sequence_id long, offset long, ids binary")
# Sequence numbers of one task; the task's number stands above them.
SEQUENCES_PER_TASK = 1 << 40
# Words kept per worker; a full store drops those that are rarely used.
KNOWN_WORDS = 300_000
ENCODED_AT_ONCE = 256

# Text of these characters is its own NFC form and splits alike here and in the tokenizer.
_PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿ]*")
_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies use for each byte: itself, or the next free one from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = [b for b in range(256) if b not in own]
    return {b: chr(256 + other.index(b)) for b in other}


class Encoder:
    """Ids of whole texts, exactly as the tokenizer file gives them.

    The vocabulary joins nothing across white space, so the ids of what stands between two
    blanks are found once and looked up afterwards. Texts with characters beyond plain
    Latin go through the tokenizer as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.forget()

    def forget(self):
        self.number: dict[str, int] = {}
        self.lengths = self.starts = self.uses = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def thin(self):
        """Keep the words used most often, at most half of what may be known; most words come once."""
        least = 2
        while (self.uses >= least).sum() > KNOWN_WORDS // 2:
            least *= 2
        kept = np.flatnonzero(self.uses >= least)
        words = list(self.number)
        self.number = {words[i]: n for n, i in enumerate(kept.tolist())}
        lengths = self.lengths[kept]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        self.ids = self.ids[np.arange(total) + np.repeat(self.starts[kept] - (ends - lengths), lengths)]
        self.lengths, self.starts, self.uses = lengths, ends - lengths, self.uses[kept] // 2

    def _learn(self, words: list[str]):
        tokenize, letters = self.model.tokenize, self.letters
        found = [
            [x.id for part in _WORD.findall(w)
             for x in tokenize(part if part.isascii() else part.encode().decode("latin-1").translate(letters))]
            for w in words
        ]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter(itertools.chain.from_iterable(found), np.uint32, int(lengths.sum()))
        ends = len(self.ids) + np.cumsum(lengths)
        self.ids = np.concatenate([self.ids, flat])
        self.starts = np.concatenate([self.starts, ends - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.uses = np.concatenate([self.uses, np.zeros(len(words), np.int64)])
        self.number.update(zip(words, range(len(self.number), len(self.number) + len(words)), strict=True))

    def __call__(self, text: str) -> np.ndarray:
        return self.many([text])[0]

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list = [None] * len(texts)
        plain, words = [], []
        for i, text in enumerate(texts):
            if "<|" not in text and _PLAIN.fullmatch(text):
                own = text.lower().split()
                plain.append((i, len(own)))
                words += own
            else:
                out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
        if len(self.number) > KNOWN_WORDS:
            self.thin()
        at = np.fromiter(map(self.number.get, words, itertools.repeat(-1)), np.int64, len(words))
        unknown = np.flatnonzero(at < 0).tolist()
        if unknown:
            self._learn(list({words[i] for i in unknown}))
            at[unknown] = [self.number[words[i]] for i in unknown]
        self.uses += np.bincount(at, minlength=len(self.uses))
        lengths = self.lengths[at]
        ends = np.cumsum(lengths)
        ids = self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[at] - (ends - lengths), lengths)]
        ends = np.concatenate([[0], ends])
        first = 0
        for i, n in plain:
            out[i] = ids[ends[first]:ends[first + n]]
            first += n
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def difference(sizes: np.ndarray, k: int) -> list[list[int]]:
    """Split items into ``k`` parts of near-equal sums (Karmarkar-Karp differencing).

    A partial partition is its part sums, largest first, without the empty parts. The
    two partitions of largest imbalance are merged, the large parts of one with the
    small parts of the other, until one is left. Ties go by item number.
    """
    left, right = [], []  # joined nodes; node i < n is item i
    n = len(sizes)
    heap = [(-int(s), i, np.array([s]), np.array([i])) for i, s in enumerate(sizes)]
    if k == 1:
        return [list(range(n))]
    heapq.heapify(heap)
    made = n
    while len(heap) > 1:
        _, _, a, an = heapq.heappop(heap)
        _, _, b, bn = heapq.heappop(heap)
        p, q = len(a), len(b)
        if p + q <= k:
            sums, nodes = np.concatenate([a, b]), np.concatenate([an, bn])
        else:
            free, both = k - q, p + q - k
            joined = np.arange(n + len(left), n + len(left) + both)
            left.extend(an[free:].tolist())
            right.extend(bn[::-1][:both].tolist())
            sums = np.concatenate([a[:free], a[free:] + b[::-1][:both], b[::-1][both:]])
            nodes = np.concatenate([an[:free], joined, bn[::-1][both:]])
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        heapq.heappush(heap, (-int(sums[0] - (sums[-1] if len(sums) == k else 0)), made, sums, nodes))
        made += 1

    def items(node):
        stack, out = [int(node)], []
        while stack:
            x = stack.pop()
            if x < n:
                out.append(x)
            else:
                stack += [right[x - n], left[x - n]]
        return out

    return [items(x) for x in heap[0][3]] if heap else []


def windows(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Parts of at most ``capacity``: the least count that differencing can fill."""
    if not len(sizes):
        return []
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        parts = difference(sizes, min(k, len(sizes)))
        if all(sizes[p].sum() <= capacity for p in parts):
            return parts
        k += 1 + k // 256


def pack_documents(documents: list[tuple[object, np.ndarray]], capacity: int, piece: int, first: int):
    """Rows (key, start, length, doc_tokens, sequence_id, offset, ids) of one batch."""
    rows, parts, sequence = [], [], first
    for key, ids in documents:
        n = len(ids)
        whole = n - n % capacity
        for start in range(0, whole, capacity):
            rows.append((key, start, capacity, n, sequence, 0, ids[start:start + capacity].astype("<u4").tobytes()))
            sequence += 1
        rest = n - whole
        if rest:
            cuts = np.linspace(whole, n, -(-rest // piece) + 1).astype(int)
            parts += [(key, int(a), int(b - a), n, ids[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
    for part in windows(np.array([p[2] for p in parts], np.int64), capacity):
        offset = 0
        for key, start, length, n, ids in (parts[i] for i in sorted(part)):
            rows.append((key, start, length, n, sequence, offset, ids.astype("<u4").tobytes()))
            offset += length
        sequence += 1
    return rows, sequence


def pack(
    docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text", capacity: int = 2048, end_id: int = 1,
    piece: int = 512, batch_tokens: int = 1 << 20,
) -> DataFrame:
    """Pack every row of ``docs`` into sequences of at most ``capacity`` ids.

    Returns one row per piece: ``key``, start, length, doc_tokens, sequence_id, offset and the
    ids as little-endian unsigned 32-bit binary. A document's ids are followed by
    ``end_id``; a null text counts as empty and gives that id alone. Rows with the same key are
    packed as documents of their own, a null key stays null. Other columns are not read.
    An empty table gives no rows. Sequence numbers follow the input's partitions: over
    stored tables a repeated task gives the same rows.

    ``tokenizer`` is the path of a tokenizer file that every executor can open.
    """

    def run(batches):
        encode, task = encoder(tokenizer), TaskContext.get().partitionId()
        waiting, tokens, sequence = [], 0, task * SEQUENCES_PER_TASK

        def frame(rows):
            return pd.DataFrame(rows, columns=[key, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])

        for batch in batches:
            for at in range(0, len(batch), ENCODED_AT_ONCE):
                some = batch.iloc[at:at + ENCODED_AT_ONCE]
                for k, ids in zip(some[key], encode.many([t or "" for t in some[text]]), strict=True):
                    waiting.append((k, np.append(ids, np.uint32(end_id))))
                    tokens += len(ids) + 1
                if tokens >= batch_tokens:
                    rows, sequence = pack_documents(waiting, capacity, piece, sequence)
                    waiting, tokens = [], 0
                    yield frame(rows)
        if waiting:
            rows, sequence = pack_documents(waiting, capacity, piece, sequence)
            yield frame(rows)

    # Keys travel as text: pandas would round large numbers beside nulls.
    kind = docs.schema[key].dataType
    pieces = docs.select(F.col(key).cast("string").alias(key), text).mapInPandas(run, f"`{key}` string, {PIECES}")
    return pieces.withColumn(key, F.col(key).cast(kind))
