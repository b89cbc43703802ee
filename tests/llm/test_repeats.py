"""Substring and passage dedup beside brute force, through every way the routing can take."""

import numpy as np
import pytest
from brute import passages, substrings
from conftest import plain, texts, with_clashes
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st

from codelineage.llm import repeats
from codelineage.llm.passages import FmIndex, without_repeated_passages
from codelineage.llm.substrings import sorted_suffixes, without_repeated_substrings

# chunk bytes, bucket bytes, chunks from which an anchor counts as hot
WAYS = [(1 << 21, 1 << 23, 64), (1500, 3000, 64), (700, 1400, 1), (700, 1400, 0)]


@pytest.mark.parametrize("way", range(len(WAYS)))
def test_both_equal_brute_force(spark, monkeypatch, way):
    for name, value in zip(("CHUNK_BYTES", "BUCKET_BYTES", "HOT_CHUNKS"), WAYS[way], strict=True):
        monkeypatch.setattr(repeats, name, value)
    docs = texts(way + 10)
    df = with_clashes(spark, docs)
    got = without_repeated_substrings(df).collect()
    assert plain((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got) == plain(substrings(docs))
    got = without_repeated_passages(df).collect()
    assert plain((r[0], r[1], r[2], bytes(r[3])) for r in got) == plain(passages(docs))


def test_other_lengths(spark, given, documents):
    got = without_repeated_substrings(documents, length=12, width=3).collect()
    assert plain((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got) == plain(substrings(given, 12))
    got = without_repeated_passages(documents, length=5, width=2).collect()
    assert plain((r[0], r[1], r[2], bytes(r[3])) for r in got) == plain(passages(given, 5))


def test_empty_tables(nothing):
    assert without_repeated_substrings(nothing).collect() == []
    assert without_repeated_passages(nothing).collect() == []


@settings(max_examples=40, deadline=None)
@cases(st.lists(st.tuples(st.integers(0, 3), st.binary(min_size=6, max_size=6)), min_size=1, max_size=40))
def test_suffix_order(rows):
    group = np.array([g for g, _ in rows])
    data = np.array([[b % 3 for b in x] for _, x in rows], np.uint8)
    order, common = sorted_suffixes(data, group)
    keys = [(group[i], data[i].tolist()) for i in order]
    assert keys == sorted(keys)
    for i in range(1, len(keys)):
        same = keys[i - 1][0] == keys[i][0]
        want = next((k for k in range(6) if keys[i - 1][1][k] != keys[i][1][k]), 6) if same else 0
        assert common[i] == want


def test_misled_merge_is_repaired(monkeypatch):
    import codelineage.llm.substrings as module

    monkeypatch.setattr(module, "common_extension", lambda hashes, i, j: np.zeros(len(i), np.int64) + 2)
    rng = np.random.default_rng(3)
    data = rng.integers(0, 3, (50, 6)).astype(np.uint8)
    order, _ = sorted_suffixes(data, np.zeros(50, int))
    assert [data[i].tolist() for i in order] == sorted(data.tolist())


@settings(max_examples=40, deadline=None)
@cases(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.integers(1, 5))
def test_backward_search_counts(symbols, depth):
    text = np.array([*symbols, 0])
    index = FmIndex(text, depth)
    for start in range(len(symbols)):
        pattern = symbols[start:start + depth]
        low, high = np.array([0]), np.array([len(text)])
        for c in reversed(pattern):
            low, high = index.extended(np.array([c]), low, high)
        want = [i for i in range(len(symbols)) if symbols[i:i + len(pattern)] == pattern]
        assert sorted(index.suffixes[low[0]:high[0]].tolist()) == want
        if len(pattern) == depth:
            assert index.cut(low) == (low, high)
