from __future__ import annotations

import numpy as np
import pytest
from helpers import with_extras
from pyspark.sql import functions as F

from skyledger.llm import ann


def brute(rows, queries, k=10):
    """(query, rank, id, distance) by looking at all."""
    out = []
    for q in sorted(queries):
        near = sorted((float(np.sqrt(((rows[q] - v) ** 2).sum())), i) for i, v in rows.items() if i != q)
        out += [(q, rank, i, d) for rank, (d, i) in enumerate(near[:k], 1)]
    return out


@pytest.fixture
def covers_all(monkeypatch):
    """Forests whose searches look into every leaf."""
    monkeypatch.setattr(ann.Forest, "_measured", lambda self, sample, rng: 1.0)


def test_whole_coverage_is_exact(spark, covers_all):
    rng = np.random.default_rng(5)
    rows = {i: rng.standard_normal(6).astype(np.float32) for i in range(0, 700)}
    for i in range(30, 330):  # many copies of one vector
        rows[i] = rows[30]
    data = [(i, v.tolist()) for i, v in rows.items()]
    data += [(7, rows[7].tolist())]  # a repeated row
    odd = [None, [], [0.0] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] + [1.0] * 5, [float("inf")] + [1.0] * 5, [1.0] * 5]
    data += [(1000 + 100 * k, v) for k, v in enumerate(odd)] + [(None, rows[1].tolist())]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(4)
    frame = with_extras(frame, "vector", "score", "rank", "ids")
    got = sorted(tuple(r) for r in ann.nearest(frame, F.col("vec_id") % 100 == 0).collect())
    exact = {i: v.astype(np.float64) for i, v in rows.items()}
    assert got == brute(exact, [i for i in rows if i % 100 == 0])


def compared(forest, rows, queries):
    """Rows that a query is compared with, a mean share of all."""
    leaves = [np.bincount(tree.leaves(rows), minlength=1 << forest.depth) for tree in forest.trees]
    return np.mean([sum(leaves[t][leaf] for t, leaf in forest.probes(q)) for q in queries]) / len(rows)


@pytest.mark.parametrize("kind, most", [("clusters", 0.2), ("line", 0.2), ("even", 1.6)])
def test_recall_with_the_defaults(spark, kind, most):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((4000, 16))
    if kind == "clusters":
        x += np.tile(rng.standard_normal((40, 16)) * 6, (100, 1))
    if kind == "line":
        x = x * 0.05 + np.linspace(0, 50, 4000)[:, None] * np.ones(16)
    rows = dict(enumerate(x))
    forest = ann.Forest(x)
    assert compared(forest, x, x[::100]) < most
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in rows.items()], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id) for r in ann.nearest(frame, F.col("vec_id") % 50 == 0).collect()}
    want = {(q, i) for q, _, i, _ in brute(rows, [i for i in rows if i % 50 == 0])}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


def test_few_and_no_rows(spark):
    kind = "vec_id long, embedding array<float>"
    assert ann.nearest(spark.createDataFrame([], kind), F.lit(True)).collect() == []
    assert ann.nearest(spark.createDataFrame([(0, [1.0, 2.0])], kind), F.lit(True)).collect() == []
    frame = spark.createDataFrame([(0, [1.0, 2.0]), (5, [1.0, 2.0]), (9, [1.0, 3.0])], kind)
    got = sorted(tuple(r) for r in ann.nearest(frame, F.col("vec_id") == 0).collect())
    assert got == [(0, 1, 5, 0.0), (0, 2, 9, 1.0)]
