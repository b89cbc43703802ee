"""Exact substring dedup by a hash-compared suffix sort.

Buckets of repeated surroundings (see ``repeats``) sort the suffixes that start at an anchor, and the
reversed prefixes that end there, by mergesort. Two suffixes are compared by the longest extension on which
their prefix polynomial hashes agree, found by binary search. The sorted order is verified byte
by byte, so a hash collision cannot change a result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from codelineage.llm.repeats import BASE, Kind, powers, without_repeats

_U = np.uint64


def common_extension(hashes: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Longest common prefix of rows i and j, by binary search over their prefix hashes."""
    low = np.zeros(len(i), np.int64)
    high = np.full(len(i), hashes.shape[1] - 1)
    for _ in range(int(hashes.shape[1] - 1).bit_length()):
        middle = (low + high + 1) >> 1
        same = hashes[i, middle] == hashes[j, middle]
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    return low


def sorted_suffixes(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows by group and bytes, and the common prefix of each with the one before it in its group.

    All groups are merged at once, bottom up: a row's place after a merge is its place in its own run
    plus the rows of the neighbouring run that stand before it.
    """
    n, m = rows.shape
    hashes = np.zeros((n, m + 1), np.uint64)
    np.cumsum((rows.astype(np.uint64) + _U(1)) * powers(BASE, m)[None, :], axis=1, out=hashes[:, 1:])
    order = np.argsort(group, kind="stable")
    g = group[order]
    fresh = np.concatenate([[True], g[1:] != g[:-1]])
    begin = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
    size = np.diff(np.append(np.flatnonzero(fresh), n))
    end = begin + size[np.cumsum(fresh) - 1]

    def before(i, j):
        """-1, 0, 1 as row i stands before, with or after row j."""
        same = common_extension(hashes, i, j)
        at = np.minimum(same, m - 1)
        a, b = rows[i, at].astype(np.int16), rows[j, at].astype(np.int16)
        return np.where(same == m, 0, np.sign(a - b))

    width, most = 1, int(size.max(initial=0))
    while width < most:
        at = np.flatnonzero(end - begin > width)
        local = at - begin[at]
        base = begin[at] + local // (2 * width) * (2 * width)
        middle = base + width
        paired = middle < end[at]
        at, local, base, middle = at[paired], local[paired], base[paired], middle[paired]
        in_left = at < middle
        low = np.where(in_left, middle, base)
        high = np.where(in_left, np.minimum(base + 2 * width, end[at]), middle)
        first = low.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            probe = (low[open_] + high[open_]) >> 1
            sign = before(order[probe], order[at[open_]])
            goes = np.where(in_left[open_], sign < 0, sign <= 0)
            low[open_] = np.where(goes, probe + 1, low[open_])
            high[open_] = np.where(goes, high[open_], probe)
        own = np.where(in_left, at - base, at - middle)
        merged = order.copy()
        merged[base + own + low - first] = order[at]
        order = merged
        width *= 2

    a, b = rows[order[:-1]], rows[order[1:]]
    differs = a != b
    common = np.where(differs.any(1), differs.argmax(1), m)
    inside = ~fresh[1:]
    at = np.minimum(common, m - 1)
    wrong = inside & (common < m) & (np.take_along_axis(a, at[:, None], 1) > np.take_along_axis(b, at[:, None], 1))[:, 0]
    if wrong.any():  # a collision misled the merge: sort by the bytes themselves
        order = np.lexsort((*rows.T[::-1], group))
        a, b = rows[order[:-1]], rows[order[1:]]
        differs = a != b
        common = np.where(differs.any(1), differs.argmax(1), m)
    return order, np.concatenate([[0], np.where(inside, common, 0)])


def _classes(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """Number of the class of each row: equal if and only if group and first ``depth`` bytes are."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(np.concatenate([[True], common[1:] < depth]) if depth else common < 0)
    return out


def _first(length: int, width: int):
    reach = length - width

    def first(data: bytes, left, right, chosen, rank):
        left, right = left.astype(np.int64), right.astype(np.int64)
        begin = np.cumsum(left + right) - (left + right)
        text = np.frombuffer(data, np.uint8)
        l, r, at = left[chosen], right[chosen], begin[chosen] + left[chosen]
        least = np.where(
            (np.arange(reach + 1)[None, :] <= l[:, None]) & (length - np.arange(reach + 1)[None, :] <= r[:, None]), rank[:, None], -1)

        def gathered(sign, count, most):
            steps = np.arange(most)[None, :]
            inside = steps < count[:, None]
            place = np.where(inside, at[:, None] + (steps if sign > 0 else -1 - steps), 0)
            return np.where(inside, text[place] if len(text) else 0, 0).astype(np.uint8)

        ahead = gathered(1, r, length)
        # Runs group by their anchor, which all have whole.
        anchor = np.ascontiguousarray(ahead[:, :width]).view(f"V{width}").ravel()
        _, group, members = np.unique(anchor, return_inverse=True, return_counts=True)
        shared = np.flatnonzero(members[group] > 1)
        if not len(shared):
            return least
        shared = shared[np.argsort(rank[shared])]
        group, ahead = group[shared], ahead[shared]
        behind = gathered(-1, l, reach)[shared]
        by_ahead, by_behind = sorted_suffixes(ahead, group), sorted_suffixes(behind, group)
        for offset in range(reach + 1):
            use = np.flatnonzero(least[shared, offset] >= 0)
            key = _classes(*by_ahead, length - offset)[use] * (len(shared) + 1) + _classes(*by_behind, offset)[use]
            # Rows stand by rank: the first of a class is its least.
            _, where, which = np.unique(key, return_index=True, return_inverse=True)
            least[shared[use], offset] = rank[shared[use]][where][which]
        return least

    return first


def _bytes(text: str):
    data = text.encode()
    return np.frombuffer(data, np.uint8), data


def _runs(chunk, starts, ends) -> bytes:
    n = ends - starts
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts, n)
    return chunk.symbols[at].tobytes()


def _kept(data: bytes, removed: np.ndarray):
    if not removed.any():
        return len(data), 0, 0, data
    spans = int(removed[0]) + int((removed[1:] & ~removed[:-1]).sum())
    return len(data), int(removed.sum()), spans, np.frombuffer(data, np.uint8)[~removed].tobytes()


def without_repeated_substrings(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: int = 50, width: int = 20
) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept) of every row of ``docs``.

    A byte is removed if a string of ``length`` bytes that covers it starts also in a document with a smaller key; all
    strings are judged on the input. ``kept`` holds the other bytes, n_spans counts the maximal removed
    runs. Matches never cross documents. A null text counts as empty; a null key as larger
    than any other and equal to other null keys; rows with one key never remove from each
    other. Keys are whole numbers; other columns are not read. ``width`` is the size of the
    anchors and changes no result.
    """
    if not 1 <= width < length <= 255:
        raise ValueError("expected 1 <= width < length <= 255")
    kind = Kind(length, width, _bytes, _runs, _first(length, width), False, _kept,
                "n_bytes long, n_removed long, n_spans long, kept binary")
    return without_repeats(docs, kind, key=key, text=text)
