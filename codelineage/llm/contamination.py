"""Benchmark decontamination as a prefix-filtered set join with exact verification.

A benchmark item's windows are sets of word shingles. For a window to occur in a document
all its shingles must, so its necessary prefix is one shingle: the rarest in the corpus. Documents
are joined on those prefix shingles; of the pairs found, those whose window would
leave the document fall by the length and positional bounds and the others are compared word by word.

The benchmark is a query set of its own: it is taken in blocks of bounded size, each
shipped to the tasks that scan the documents, whatever its total size. Texts are never shuffled.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codelineage.llm.names import free_name

# What a row holds of the blocks so far.
STATE = "struct<n:long,items:array<string>,starts:array<long>,ends:array<long>>"
# Bytes other than 0-9, a-z and those of longer characters part words; A-Z become a-z.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split() if text else []


@dataclass
class Block:
    """Windows of some items as sequences of word numbers, and what is known of their shingles."""

    vocabulary: dict[bytes, int] = field(default_factory=dict)
    windows: dict[tuple[int, ...], set[str]] = field(default_factory=lambda: defaultdict(set))
    counts: dict[tuple[int, int], int] = field(default_factory=dict)

    def add(self, item: str, text: str | None, window: int):
        numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
        for i in range(max(1, len(numbers) - window + 1) if numbers else 0):
            self.windows[tuple(numbers[i:i + window])].add(item)

    def shingles(self, numbers: np.ndarray, size: int) -> np.ndarray:
        """A code for each place; -1 where a word is none of the block's."""
        n = len(numbers) - size + 1
        if n <= 0:
            return np.empty(0, np.int64)
        base, code, known = len(self.vocabulary) + 1, np.zeros(n, np.int64), np.ones(n, bool)
        for i in range(size):
            part = numbers[i:i + n]
            code = code * base + part
            known &= part > 0
        return np.where(known, code, -1)

    def of(self, words: list[bytes]) -> np.ndarray:
        get = self.vocabulary.get
        return np.fromiter((get(w, 0) for w in words), np.int64, len(words))

    def codes(self, shingle: int) -> dict[int, np.ndarray]:
        """Shingle size -> the sorted codes that the windows hold."""
        out = defaultdict(set)
        for w in self.windows:
            size = min(shingle, len(w))
            out[size].update(self.shingles(np.array(w, np.int64), size).tolist())
        return {size: np.array(sorted(codes), np.int64) for size, codes in out.items()}

    def prefixes(self, shingle: int) -> dict[int, tuple[np.ndarray, dict[int, list]]]:
        """Shingle size -> sorted prefix codes, and for each code (offset, window) of every window it stands for."""
        out = defaultdict(lambda: defaultdict(list))
        for w in sorted(self.windows):
            size = min(shingle, len(w))
            codes = self.shingles(np.array(w, np.int64), size).tolist()
            offset = min(range(len(codes)), key=lambda i: (self.counts.get((size, codes[i]), 0), codes[i], i))
            out[size][codes[offset]].append((offset, np.array(w, np.int64), w))
        return {size: (np.array(sorted(found), np.int64), dict(found)) for size, found in out.items()}


def _among(sorted_codes: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Places of ``codes`` that are among ``sorted_codes``."""
    at = np.minimum(np.searchsorted(sorted_codes, codes), len(sorted_codes) - 1)
    return np.flatnonzero(sorted_codes[at] == codes)


def _counted(block: Block, shingle: int, text: str):
    wanted = block.codes(shingle)

    def run(batches):
        total = {size: np.zeros(len(codes), np.int64) for size, codes in wanted.items()}
        for batch in batches:
            for t in batch[text]:
                numbers = block.of(words_of(t))
                for size, codes in wanted.items():
                    here = block.shingles(numbers, size)
                    hit = here[_among(codes, here)]
                    np.add.at(total[size], np.searchsorted(codes, hit), 1)
        for size, codes in wanted.items():
            some = total[size] > 0
            yield pd.DataFrame({"size": size, "code": codes[some], "n": total[size][some]})

    return run


def _matched(block: Block, shingle: int):
    prefixes = block.prefixes(shingle)

    def found(t, items, spans):
        words = words_of(t)
        numbers = block.of(words)
        for size, (codes, windows) in prefixes.items():
            here = block.shingles(numbers, size)
            for at in _among(codes, here).tolist():
                for offset, wanted, window in windows[int(here[at])]:
                    start, end = at - offset, at - offset + len(wanted)
                    if start >= 0 and end <= len(numbers) and (numbers[start:end] == wanted).all():
                        items |= block.windows[window]
                        spans.append((start, end))
        merged: list[list[int]] = []
        for start, end in sorted(spans):
            if merged and start <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        return len(words), sorted(items), [s for s, _ in merged], [e for _, e in merged]

    @F.pandas_udf(STATE)
    def run(texts: pd.Series, before: pd.DataFrame) -> pd.DataFrame:
        rows = [
            found(t, set(() if i is None else i), [] if i is None else list(zip(s, e, strict=True)))
            for t, i, s, e in zip(texts, before["items"], before["starts"], before["ends"], strict=True)
        ]
        return pd.DataFrame(rows, columns=["n", "items", "starts", "ends"])

    return run


def scan(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item: str = "item_id", item_text: str = "text",
    window: int = 13, shingle: int = 3, block_words: int = 200_000, into: str = "found",
) -> DataFrame:
    """Add ``into``, what each row of ``docs`` holds of the benchmark; every row and column stays.

    ``into`` is a struct: n_words, n_hit (words inside any occurrence of a window), items (ids
    of the items with occurring windows, as strings in string order) and spans (maximal runs of hit
    words). A window is ``window`` consecutive words of an item, or a shorter item as a whole. A null
    or empty text has no words and is never hit; an item without words has no window; items
    without an id are left out; items that share an id or a text count as they are. Equal rows get
    equal results. A column that is named ``into`` already is replaced.
    """
    items = benchmark.filter(F.col(item).isNotNull()).select(F.col(item).cast("string").alias("item"), F.col(item_text).alias("t"))
    # A word takes two characters at least with its blank, so a block holds block_words or fewer on average.
    most = items.agg(F.sum(F.length("t") / 2 + 1).alias("n")).first()["n"]
    blocks = int(most or 0) // block_words + 1
    name = free_name(docs.columns, "state")
    out = docs.withColumn(name, F.lit(None).cast(STATE))
    for number in range(blocks):
        block = Block()
        for row in items.filter(F.pmod(F.xxhash64("item", "t"), F.lit(blocks)) == number).toLocalIterator():
            block.add(row["item"], row["t"], window)
        if not block.windows and number < blocks - 1:
            continue  # the last block counts the words even if there is nothing to find
        counts = docs.select(text).mapInPandas(_counted(block, shingle, text), "size int, code long, n long")
        for row in counts.groupBy("size", "code").agg(F.sum("n").alias("n")).collect() if block.windows else ():
            block.counts[row["size"], row["code"]] = row["n"]
        out = out.withColumn(name, _matched(block, shingle)(F.col(text), F.col(name)))
    state = F.col(name)
    spans = F.zip_with(state["starts"], state["ends"], lambda a, b: F.struct(a.alias("start"), b.alias("end")))
    hit = F.aggregate(spans, F.lit(0).cast("long"), lambda sum_, s: sum_ + s["end"] - s["start"])
    kept = [c for c in docs.columns if c.lower() != into.lower()]
    return out.select(*kept, F.struct(
        state["n"].alias("n_words"), hit.alias("n_hit"), state["items"].alias("items"), spans.alias("spans")).alias(into))


def contaminated(found: Column, share: int = 20) -> Column:
    """Whether at least one in ``share`` words of the document is hit."""
    return (found["n_hit"] > 0) & (share * found["n_hit"] >= found["n_words"])
