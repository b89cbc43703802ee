"""SimHash, embeddings and components beside brute force."""

import random

import numpy as np
import pytest
from brute import fingerprint, reachable
from conftest import plain

from codelineage.llm import embeddings, simhash
from codelineage.llm.components import components


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randint(-300, 300), rng.randint(-300, 300)) for _ in range(350)] + [(i, i + 1) for i in range(400, 700)] + [(400, 400)] + [(5, i) for i in range(1000, 1400)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long").repartition(5)).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: root(x) for x in list(parent) if root(x) != x}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def wanted(docs):
    prints = np.array([fingerprint(t) for _, t in docs], np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    return prints, reachable(near, [d for d, _ in docs])


@pytest.mark.parametrize("tile", [1024, 2])
def test_simhash(spark, given, documents, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    prints, roots = wanted(given)
    got = simhash.near_duplicates(documents).collect()
    assert plain((r.doc_id, r.fingerprint % 2**64, r.component) for r in got) == plain(
        (d, int(p), r) for (d, _), p, r in zip(given, prints, roots, strict=True))


def test_simhash_chain_of_near_fingerprints(spark):
    rng = random.Random(2)
    prints = [rng.getrandbits(64)]
    for _ in range(40):
        x = prints[-1]
        for b in rng.sample(range(64), 3):
            x ^= 1 << b
        prints.append(x)
    prints += [rng.getrandbits(64) for _ in range(100)]
    signed = [x - 2**64 if x >> 63 else x for x in prints]
    links = simhash.near_links(spark.createDataFrame([(x,) for x in signed], "fingerprint long"))
    got = {r.node: r.component for r in components(links).collect()}
    a = np.array(prints, np.uint64)
    want = reachable(np.bitwise_count(a[:, None] ^ a[None, :]) <= 3, range(len(a)))
    group = {}
    for x, r in zip(signed, want, strict=True):
        group.setdefault(r, []).append(x)
    assert got == {x: min(g) for g in group.values() for x in g if x != min(g)}


def test_one_document_of_each_group(spark, given, documents, nothing):
    _, roots = wanted(given)
    got = simhash.first_of_each(documents, simhash.near_duplicates(documents))
    want = sorted({r for (d, _), r in zip(given, roots, strict=True) if d is not None and r == d})
    assert sorted(r.doc_id for r in got.collect() if r.doc_id is not None) == want
    assert got.columns == documents.columns
    assert simhash.first_of_each(nothing, simhash.near_duplicates(nothing)).collect() == []


def vectors(seed, n=300, size=20):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, size))
    x[100:200] = x[0] + 0.25 * rng.normal(size=(100, size))
    x[200:230] = x[1]
    x[230:260] = 3 * x[2]
    rows = [(i, [float(np.float32(v)) for v in x[i]]) for i in range(n)]
    bad = [None, [], [0.0] * size, [float("nan")] + [1.0] * (size - 1), [None] + [1.0] * (size - 1), [float("inf")] * size, [1.0, 2.0]]
    rows += [(1000 + i, b) for i, b in enumerate(bad)] + [(2000 + i, b) for i, b in enumerate(bad)] + [(None, rows[1][1])]
    return rows


@pytest.mark.parametrize("tile", [2048, 32])
def test_embeddings(spark, monkeypatch, tile):
    monkeypatch.setattr(embeddings, "TILE", tile)
    rows = vectors(1)
    df = spark.createDataFrame([(k, v, "kept", 1) for k, v in rows], "vec_id long, embedding array<float>, x string, id int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component) for r in embeddings.near_duplicates(df).collect()}
    good = np.array([v for _, v in rows[:300]], float)
    norm = np.sqrt((good * good).sum(1))
    near = good @ good.T / norm[:, None] / norm[None, :] >= 0.9
    np.fill_diagonal(near, True)
    roots = reachable(near, range(300))
    want = {i: (int(near[i].sum()) - 1, roots[i]) for i in range(300)}
    want |= {k: (0, k) for k, _ in rows[300:]}
    assert got == want
    assert max(n for n, _ in want.values()) > 30


def test_embeddings_of_every_length_in_double_precision(spark):
    turned = lambda c: [c, (1 - c * c) ** 0.5]
    rows = [(1, [1.0, 0.0]), (2, turned(0.9 + 1e-9)), (3, [1.0, 0.0, 0.0]), (4, [*turned(0.9 - 1e-9), 0.0])]
    rows += [(5, [1e300, 0.0, 0.0, 0.0]), (6, [2e300, 1e299, 0.0, 0.0]), (7, [1.0] * 5), (8, [1.0] * 6), (9, [1.0] * 6), (10, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component) for r in embeddings.near_duplicates(df, every_length=True).collect()}
    linked = {1: 1, 2: 1, 5: 5, 6: 5, 8: 8, 9: 8}
    assert got == {i: (1, linked[i]) if i in linked else (0, i) for i, _ in rows}


def test_no_usable_embeddings(spark):
    df = spark.createDataFrame([(1, None), (2, [0.0])], "vec_id long, embedding array<float>")
    assert sorted(map(tuple, embeddings.near_duplicates(df).collect())) == [(1, 0, 1), (2, 0, 2)]
    assert embeddings.near_duplicates(df.limit(0)).collect() == []
