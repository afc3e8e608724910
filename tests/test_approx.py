"""Pivot-list search: measured recall against the exact neighbours."""

import os

import numpy as np
import pytest

from tagwise.operators import approx as AX

SCHEMA = "vec_id long, embedding array<double>, label int"


def exact(X, k):
    S = X @ X.T
    np.fill_diagonal(S, -2)
    return [{int(j) for j in np.argsort(-row, kind="stable")[:k] if row[j] > 0} for row in S]


def run(spark, X, k):
    df = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in enumerate(X)], SCHEMA).repartition(4)
    rows = AX.cosine_topk_approx(df, k).collect()
    U = X / np.maximum(np.linalg.norm(X, axis=1), 1e-12)[:, None]
    for r in rows:
        assert r.id != r.other_id and abs(r.score - U[r.id] @ U[r.other_id]) < 1e-9
    got = {}
    for r in rows:
        got.setdefault(r.id, {})[r.rank] = r.other_id
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in got.values())
    truth = exact(U, k)
    return sum(len(truth[i] & set(got.get(i, {}).values())) for i in range(len(X))) / sum(map(len, truth))


@pytest.mark.parametrize("kind", ["no near neighbours", "clusters", "one crowd of a third"])
def test_recall(spark, kind, monkeypatch):
    rng = np.random.default_rng(8)
    X = rng.normal(size=(600, 24))
    if kind == "clusters":
        X = rng.normal(size=(30, 24))[rng.integers(0, 30, 600)] + 0.3 * rng.normal(size=(600, 24))
    if kind == "one crowd of a third":
        X[:200] = X[0] + 0.2 * rng.normal(size=(200, 24))
        monkeypatch.setattr(AX, "LIST_ROWS", 64)         # lists of the crowd are cut into chunks
    assert run(spark, X, 10) >= 0.9


def test_clusters_are_searched_in_few_lists(spark):
    rng = np.random.default_rng(9)
    far = rng.normal(size=(500, 24))
    near = rng.normal(size=(25, 24))[rng.integers(0, 25, 500)] + 0.2 * rng.normal(size=(500, 24))
    probes = []
    for X in (far, near):
        df = spark.createDataFrame([(i, [float(x) for x in v], 0) for i, v in enumerate(X)], SCHEMA)
        unit = AX.unit_vectors(df, "vec_id", "embedding").cache()
        pivots = np.stack(AX._drawn(unit, "pivot", 45)["u"].to_list())
        probes.append(AX.probes_needed(AX.with_pivots(unit, pivots, AX.ASSIGN), unit, pivots, 10, AX.RECALL, AX.SAMPLE))
    assert probes[1] <= 3 < probes[0]


def test_odd_vectors_and_empty_tables(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [2.0, 0.1], 1), (2, None, 1), (3, [0.0, 0.0], 1), (4, [None, 1.0], 1), (5, [float("nan"), 1.0], 1), (6, [-1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert sorted((r.id, r.other_id) for r in AX.cosine_topk_approx(df, 5).collect()) == [(0, 1), (1, 0)]
    assert AX.cosine_topk_approx(df.limit(0), 5).collect() == []
    assert AX.cosine_topk_approx(df.limit(1), 5).collect() == []


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01"), reason="driver tables absent")
def test_recall_on_the_driver_table(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").orderBy("vec_id").toPandas()
    assert run(spark, np.stack(d["embedding"].to_list()).astype(float), 20) >= 0.9
