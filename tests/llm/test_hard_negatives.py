from __future__ import annotations

import numpy as np
import pytest
from helpers import with_extras
from pyspark.sql import functions as F

from skyledger.llm import hard_negatives

SCHEMA = "vec_id long, label int, vector array<long>"
def anchor():
    return F.col("vec_id") % 10 == 0


def by_loops(rows, positives=5, negatives=10, low=30, high=90, every=10):
    out = []
    for i, label, vector in rows:
        if i % every:
            continue
        scored = [(-int(sum(int(a) * int(b) for a, b in zip(vector, v, strict=False))), j, x) for j, x, v in rows if j != i]
        scored.sort()
        for score, j, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [(s, k) for s, k, x in scored if x != label and 30 * -score <= 100 * -s <= 90 * -score]
            assert (low, high) == (30, 90)
            out += [(i, j, r, k, -score, -s) for r, (s, k) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def mined(spark, rows, **options):
    return sorted(tuple(r) for r in hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), anchor(), **options).collect())


def some_rows(n, dims, labels, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    centers = rng.normal(0, 60, (labels, dims))
    label = rng.integers(0, labels, n)
    vectors = (centers[rng.integers(0, labels, n)] * rng.random((n, 1)) + rng.normal(0, 40 * spread, (n, dims))).astype(int)
    return [(int(i), int(x), [int(c) for c in v]) for i, (x, v) in enumerate(zip(label, vectors, strict=True))]


@pytest.fixture
def small(monkeypatch):
    """Several passes, blocks and buckets on small tables."""
    for name, value in (("FIRST_ROWS", 40), ("ANCHORS", 12), ("BUCKET_ROWS", 16), ("GROWTH", 4)):
        monkeypatch.setattr(hard_negatives, name, value)


@pytest.mark.parametrize(("n", "dims", "labels", "spread"), [(300, 8, 3, 1.0), (400, 3, 2, 0.05), (200, 40, 5, 1.0), (30, 4, 40, 1.0)])
def test_equals_loops(spark, small, n, dims, labels, spread):
    rows = some_rows(n, dims, labels, seed=n, spread=spread)
    want = by_loops(rows)
    assert mined(spark, rows) == want
    assert want or labels == 40


def test_ties_copies_and_one_length(spark, small):
    rows = [(i, i % 3, [3, 4] if i % 2 else [4, 3]) for i in range(150)]
    assert mined(spark, rows) == by_loops(rows)
    rows += [(200 + i, 7, [2, 2]) for i in range(90)]
    assert mined(spark, rows) == by_loops(rows)


def test_zero_negative_and_no_partner(spark, small):
    rows = [(0, 1, [0, 0]), (1, 1, [5, 5]), (2, 2, [1, 0]), (10, 2, [-3, -3]), (20, 3, [7, 1]), (30, 1, [-4, 0])]
    assert mined(spark, rows) == by_loops(rows)
    assert mined(spark, [(0, 1, [5]), (1, 2, [5])]) == []


def test_large_components_stay_exact(spark, small):
    rng = np.random.default_rng(1)
    for top in (1 << 27, 1 << 29):
        rows = [(i, i % 2, [int(x) for x in rng.integers(-top, top, 4)]) for i in range(60)]
        rows += [(100 + i, v[1], [v[2][0] + 1, *v[2][1:]]) for i, v in enumerate(rows)]
        assert mined(spark, rows) == by_loops(rows)


def test_edges(spark, small):
    assert mined(spark, []) == []
    rows = some_rows(60, 4, 2, seed=4)
    odd = [(None, 1, [1, 2, 3, 4]), (500, None, [1, 2, 3, 4]), (510, 1, None), (520, 1, [1, None, 3, 4])]
    again = [(i, label + 1, vector) for i, label, vector in rows]
    assert mined(spark, rows + odd + again) == by_loops(rows)
    short = [*rows, (70, 1, [9, 9]), (71, 1, []), (72, 0, [3])]
    padded = [(i, x, [*v, *[0] * (4 - len(v))]) for i, x, v in short]
    assert mined(spark, short) == by_loops(padded)
    frame = with_extras(spark.createDataFrame(rows, SCHEMA), "level", "length", "anchor_id", "score")
    assert sorted(tuple(r) for r in hard_negatives.mine(frame, anchor()).collect()) == by_loops(rows)


def test_pruning_leaves_rows_out_and_loses_none():
    rng = np.random.default_rng(8)
    rows = rng.normal(0, 1, (500, 6)) * (rng.random((500, 1)) < 0.1) * 300 + rng.normal(0, 12, (500, 6))
    rows = rows.astype(np.int64)
    orders = np.argsort(hard_negatives._unit(rows), axis=0, kind="stable").T.astype("<u2").tobytes()
    longest = np.sqrt((rows.astype(float) ** 2).sum(axis=1)).max()
    bucket = hard_negatives.Bucket(range(500), [0] * 500, longest, rows.astype("<i8").tobytes(), orders, np.float64)
    left = []
    for query in rows[:60]:
        unit, length = hard_negatives._unit(query), float(np.sqrt((query**2).sum()))
        scores = rows @ query
        for least in (*np.sort(scores)[[-2, -20, -200]], 0, -5, longest * length, longest * length * 1.01):
            found = bucket.candidates(unit, length, float(least))
            must = np.flatnonzero(scores >= least)
            if found is not None:
                assert np.isin(must, found).all()
                left.append(len(found) / 500)
    assert np.mean(left) < 0.5


def test_whole_numbers(spark):
    schema = "vec_id long, embedding array<float>"
    rows = [(1, [0.5, -0.001]), (2, [float("nan")]), (3, [float("inf")]), (4, [None]), (5, None), (6, [])]
    got = spark.createDataFrame(rows, schema).select("vec_id", hard_negatives.whole_numbers("embedding").alias("v")).collect()
    assert {r.vec_id: r.v for r in got} == {1: [128, -1], 2: None, 3: None, 4: None, 5: None, 6: []}
