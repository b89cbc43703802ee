"""Repeated passages of words found with a compressed FM-index per shard.

A shard holds the distinct surroundings that ``repeats`` routes to it by content. Its index is
the Burrows-Wheeler transform of their words in a wavelet matrix of packed bits. The documents'
surroundings are streamed against it word by word from the right: backward search keeps the longest match,
cut to the window's length, and where that length is reached the interval names all occurrences, of which the
first in the corpus is reported.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from codelineage.llm.repeats import Kind, without_repeats

_U = np.uint64


class Bits:
    """A packed bit vector with rank: 64 bits a word and a count before each."""

    def __init__(self, bits: np.ndarray):
        words = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        words[:len(bits)] = bits
        self.words = np.packbits(words, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))]).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        low = self.words[word] & ((_U(1) << (at & 63).astype(np.uint64)) - _U(1))
        return self.before[word] + np.bitwise_count(low)


class WaveletMatrix:
    """Counts of a symbol before a place, in one step a bit of the symbol."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.levels = max(1, (symbols - 1).bit_length())
        self.bits, self.zeros = [], []
        for level in reversed(range(self.levels)):
            bit = (values >> level) & 1
            self.bits.append(Bits(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            values = np.concatenate([values[bit == 0], values[bit == 1]])
        self.base = self._down(np.arange(symbols), np.zeros(symbols, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits, zeros in zip(reversed(range(self.levels)), self.bits, self.zeros, strict=True):
            ones = bits.rank(at)
            at = np.where((symbol >> level) & 1, zeros + ones, at - ones)
        return at

    def count(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._down(symbol, at) - self.base[symbol]


def _numbered(x: np.ndarray) -> np.ndarray:
    """Each value's place among the distinct values."""
    return np.unique(x, return_inverse=True)[1]


class FmIndex:
    """Index over ``text``, whole numbers with 0 nowhere but at the end; for patterns of up to ``depth`` + 1 symbols."""

    def __init__(self, text: np.ndarray, depth: int):
        n, have = len(text), 1
        rank = text.astype(np.int64)
        self.depth = depth
        classes, done = np.zeros(n, np.int64), 0
        while True:
            if depth & have:  # classes of equal first ``depth`` symbols, put together from powers of two
                ahead = np.append(rank, 0)[np.minimum(np.arange(n) + done, n)]
                classes, done = _numbered(classes * (int(rank.max()) + 2) + ahead), done + have
            if have > depth:
                break
            ahead = np.append(rank[have:] + 1, np.zeros(min(have, n), np.int64))[:n]
            rank = _numbered(rank * (int(rank.max()) + 2) + ahead)
            have *= 2
        self.suffixes = np.argsort(rank, kind="stable")  # by their first ``have`` symbols
        symbols = int(text.max()) + 1
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])
        self.wavelet = WaveletMatrix(text[self.suffixes - 1], symbols)
        held = classes[self.suffixes]
        fresh = np.concatenate([[True], held[1:] != held[:-1]])
        self.begins = np.flatnonzero(fresh)
        self.group = np.cumsum(fresh) - 1
        self.ends = np.append(self.begins[1:], n)

    def extended(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Intervals of the matches with one more symbol before them."""
        both = self.wavelet.count(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.first[symbol] + both[:len(symbol)], self.first[symbol] + both[len(symbol):]

    def cut(self, low: np.ndarray):
        """Intervals of the first ``depth`` symbols of matches that begin at ``low``."""
        group = self.group[low]
        return self.begins[group], self.ends[group]


def _first(length: int, width: int):
    reach = length - width

    def first(data: bytes, left, right, chosen, rank):
        lines = data.split(b"\n")
        number: dict[bytes, int] = {}
        runs = [[number.setdefault(w, len(number) + 2) for w in lines[i].split(b" ")] for i in chosen.tolist()]
        sizes = np.fromiter(map(len, runs), np.int64, len(runs))
        # Runs with 1 between them; one 0 ends the text.
        text = np.array([x for run in runs for x in (*run, 1)] + [0], np.int64)
        begin = np.cumsum(sizes + 1) - (sizes + 1)
        index = FmIndex(text, length)
        owner = np.append(np.repeat(rank, sizes + 1), len(rank))
        least_of = np.minimum.reduceat(owner[index.suffixes], index.begins)

        least = np.full((len(runs), reach + 1), -1, np.int64)
        l = left[chosen].astype(np.int64)
        low, high = np.zeros(len(runs), np.int64), np.full(len(runs), len(text))
        matched = np.zeros(len(runs), np.int64)
        for step in range(int(sizes.max(initial=0))):
            on = np.flatnonzero(sizes > step)
            place = sizes[on] - 1 - step
            low[on], high[on] = index.extended(text[begin[on] + place], low[on], high[on])
            matched[on] += 1
            full = on[matched[on] >= length]
            low[full], high[full] = index.cut(low[full])
            matched[full] = length
            offset = l[full] - (sizes[full] - 1 - step)
            ours = (offset >= 0) & (offset <= reach)
            least[full[ours], offset[ours]] = least_of[index.group[low[full[ours]]]]
        return least

    return first


def _words(text: str):
    words = text.encode().split()
    digest = {w: xxhash.xxh64_intdigest(w) for w in set(words)}
    return np.fromiter(map(digest.__getitem__, words), np.uint64, len(words)), words


def _runs(chunk, starts, ends) -> bytes:
    words = chunk.all_raw
    return b"".join(b" ".join(words[a:b]) + b"\n" for a, b in zip(starts.tolist(), ends.tolist(), strict=True))


def _kept(words: list[bytes], removed: np.ndarray):
    if not removed.any():
        return len(words), 0, b" ".join(words)
    return len(words), int(removed.sum()), b" ".join(words[i] for i in np.flatnonzero(~removed).tolist())


def without_repeated_passages(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = 20, width: int = 8
) -> DataFrame:
    """(key, n_words, n_removed, kept) of every row of ``docs``.

    Words are what stands between ASCII blanks. A word is removed if a window of ``length`` words that covers it
    starts also earlier: in a document with a smaller key, or earlier in the same one; all windows
    are judged on the input. ``kept`` holds the other words joined by one space, in UTF-8. A null
    text has no words; a null key is larger than any other. Rows with one key count as copies of one document: a window
    at the same place of both is no earlier start. Keys are whole numbers; other columns are
    not read. ``width`` is the size of the anchors and changes no result; anchors are chosen by 64-bit hashes of
    words, the index holds the words themselves.
    """
    if not 1 <= width < length <= 255:
        raise ValueError("expected 1 <= width < length <= 255")
    kind = Kind(length, width, _words, _runs, _first(length, width), True, _kept, "n_words long, n_removed long, kept binary")
    return without_repeats(docs, kind, key=key, text=text)
