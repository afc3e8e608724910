"""Exact top-k search against brute force, in integers."""

import math
import random

import numpy as np
import pytest

from tagwise.llm import topk

SCHEMA = "vec_id long, embedding array<double>, label int, row string, score double"


def brute(rows, k):
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v, *_ in rows
          if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(ok):
        if i is None or i % 100:
            continue
        hits = sorted((-sum(x * y for x, y in zip(q, v)), j is None, j or 0) for b, (j, v) in enumerate(ok) if b != a and len(v) == len(q))
        out += [(i, n + 1, None if h[1] else h[2], -h[0]) for n, h in enumerate(hits[:k])]
    return sorted(out, key=repr)


def found(spark, rows, k=10, **kw):
    df = spark.createDataFrame([(i, v, 0, "r", 0.5) for i, v in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, topk.search(df, lambda i: i % 100 == 0, k, **kw).collect()), key=repr)


def vectors(n, dim=12, seed=1):
    rng = np.random.default_rng(seed)
    return [(i * 25, [float(x) for x in rng.normal(size=dim)]) for i in range(n)]


@pytest.mark.parametrize("segments", [1, 2, 3])
def test_random_vectors(spark, segments):
    rows = vectors(300)
    assert found(spark, rows, segments=segments) == brute(rows, 10)


def test_crowds_copies_ties_and_repeated_ids(spark):
    rng = random.Random(3)
    base = [rng.uniform(-1, 1) for _ in range(8)]
    rows = [(i, list(base)) for i in range(0, 400, 4)]                              # copies, queries among them
    rows += [(1000 + i, [x + rng.uniform(-1e-3, 1e-3) for x in base]) for i in range(0, 300, 10)]   # near copies
    rows += [(100, [-x for x in base]), (100, list(base)), (100, list(base)), (None, list(base)), (-200, [0.0] * 8)]
    rows += [(5000 + i, [-3.0 - i] * 8) for i in range(0, 300, 100)]                 # all scores but few negative
    assert found(spark, rows) == brute(rows, 10)


def test_nulls_lengths_and_large_components(spark):
    rows = vectors(30, 4) + [(100, None), (200, [1.0, None, 2.0, 1.0]), (300, [float("nan")] * 4), (400, [float("inf"), 0.0, 0.0, 0.0]),
                             (600, []), (700, []), (800, [1.0, 2.0]), (900, [3.0, -4.0]), (1000, [2.0e5, -1.0e5, 3.0, 4.0]), (1100, [1.9e5, 3.0, 1.0, 1.0])]
    assert found(spark, rows) == brute(rows, 10)
    assert found(spark, [*rows, (1200, [1e300] * 4)]) == brute(rows, 10)       # beyond long: takes no part


def test_fewer_rows_than_asked_and_blocks_of_queries(spark, monkeypatch):
    rows = vectors(60, 6)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    assert found(spark, rows) == brute(rows, 10)
    monkeypatch.undo()
    assert found(spark, rows[:5]) == brute(rows[:5], 10)
    assert found(spark, [(0, [1.0, 2.0])]) == []
    assert found(spark, []) == []


def test_products_are_exact_beyond_doubles():
    a = np.array([[2 ** 28 + 1, 3]], np.int64)
    assert topk.products(a, a)[0, 0] == (2 ** 28 + 1) ** 2 + 9
