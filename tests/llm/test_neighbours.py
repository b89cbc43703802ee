"""Approximate nearest neighbours against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from codelineage.llm import neighbours, queries


def exact(vectors, query, k):
    """{query: [(key, score)]} over all rows (key, vector) of one length."""
    keys = np.array([v for v, _ in vectors])
    x = np.array([v for _, v in vectors], float)
    out = {}
    for q in query:
        scores = x @ x[list(keys).index(q)]
        order = [i for i in np.lexsort((keys, -scores)) if keys[i] != q][:k]
        out[q] = [(int(keys[i]), float(scores[i])) for i in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query, [])) + 1
        out[r.query].append((r.vec_id, r.score))
    return out


def test_recall_scores_and_order(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 24)) * 2
    x = np.concatenate([rng.normal(size=(1500, 24)), centres[rng.integers(0, 20, 1500)] + rng.normal(size=(1500, 24)) * 0.05])
    x = x.astype(np.float32).astype(float)
    x[600:1200] = x[600]  # a fifth of all rows is one vector
    vectors = [(int(i), v.tolist()) for i, v in enumerate(x)]
    odd = [(5000, None), (5001, []), (5002, [0.0] * 24), (5003, [float("nan")] * 24), (5004, [None] * 24), (5005, [float("inf")] * 24), (None, [1.0] * 24),
           (5020, [1.0, 2.0]), (5040, [2.0, 1.0]), vectors[3], vectors[600]]
    df = spark.createDataFrame([(k, v, "c") for k, v in vectors + odd], "vec_id long, embedding array<double>, query string").repartition(5)
    got = found(neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=20, shard_rows=700))
    want = exact(vectors, range(0, 3000, 20), 20)
    assert got.pop(5020) == [(5040, 4.0)] and got.pop(5040) == [(5020, 4.0)]
    assert set(got) == set(want)
    hits = 0
    for q, rows in want.items():
        assert len(got[q]) == 20 and q not in dict(got[q]) and len(dict(got[q])) == 20
        assert all(abs(s - x[q] @ x[k]) < 1e-9 for k, s in got[q])
        assert got[q] == sorted(got[q], key=lambda r: (-r[1], r[0]))
        hits += len(dict(got[q]).keys() & dict(rows).keys())
    assert hits >= 0.95 * 20 * len(want)
    # Of the hot vector the smallest keys come first.
    assert [k for k, _ in got[620]][:5] == [k for k, _ in want[620]][:5]


def test_norms_of_all_sizes(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 8)) * np.exp(rng.normal(size=(600, 1))) * 1e100
    vectors = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = found(neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=5))
    want = exact(vectors, range(0, 600, 20), 5)
    assert sum(len(dict(got[q]).keys() & dict(want[q]).keys()) for q in want) >= 0.9 * 5 * len(want)


def test_fewer_rows_than_asked_for(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (20, [0.5, 0.5]), (7, [0.5, 0.5])], "vec_id int, embedding array<float>")
    assert found(neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=20)) == {0: [(7, 0.5), (20, 0.5)], 20: [(0, 0.5), (7, 0.5)]}
    assert neighbours.nearest(df, F.lit(False)).collect() == []
    assert neighbours.nearest(df.limit(0), F.lit(True)).collect() == []


@pytest.mark.parametrize("kind", ["random", "far clusters", "line"])
def test_every_node_is_reached(kind):
    rng = np.random.default_rng(6)
    x = {"random": rng.normal(size=(900, 16)),
         "far clusters": (np.eye(16) * 100)[rng.integers(0, 16, 900)] + rng.normal(size=(900, 16)) * 1e-3,
         "line": np.arange(1, 901)[:, None] * np.ones((1, 16))}[kind]
    graph, entries = neighbours.build_graph(neighbours.lifted(x))
    seen, front = set(entries.tolist()), entries.tolist()
    while front:
        front = [int(t) for n in front for t in set(graph[n].tolist()) - seen]
        seen |= set(front)
    assert len(seen) == 900 and graph.shape == (900, neighbours.DEGREE)


def test_query_on_the_smallest_tables(spark):
    folder = "/root/testdata/sf0.001"
    rows = queries.table(spark, folder, "embeddings").collect()
    vectors = [(r.vec_id, np.asarray(r.embedding, float)) for r in rows]
    want = exact(vectors, [k for k, _ in vectors if k % 20 == 0], 20)
    got = {}
    for r in queries.QUERIES["op12_neighbours"](spark, folder).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == set(want)
    assert sum(len({k for k, _ in got[q].values()} & {k for k, _ in want[q]}) for q in want) >= 0.95 * 20 * len(want)
