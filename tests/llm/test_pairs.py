"""n-gram Jaccard join and embedding index against brute force."""

import re

import numpy as np
import pytest

from tagwise.llm import ngram_join, pivots
from tagwise.llm.graph import connected_components


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def components(sets, ids, linked):
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(sets)):
        for j in range(i):
            if linked(sets[i], sets[j]):
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, k in enumerate(ids):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [least.get(find(i)) for i in range(len(sets))]


def jaccard(a, b):
    return bool(a) and bool(b) and 100 * len(a & b) >= 75 * len(a | b)


def key(r):
    return tuple((x is None, x or 0) for x in r)


def expect(rows):
    sets, ids = [shingles(r[1]) for r in rows], [r[0] for r in rows]
    return sorted(zip(ids, map(len, sets), components(sets, ids, jaccard)), key=key)


def test_jaccard_components_equal_brute_force(docs, rows):
    got = sorted((tuple(r) for r in ngram_join.jaccard_components(docs, n_buckets=5).collect()), key=key)
    assert got == expect(rows)


def test_chain_of_edits(spark, words):
    """Links that only a chain of near copies makes, and a shared passage that links nothing."""
    passage = " ".join(words[:60])
    rows, cur = [], [f"w{i}" for i in range(60)]
    for k in range(40):
        cur = list(cur)
        cur[(7 * k) % 60] = f"x{k}"
        rows.append((k, " ".join(cur)))
    rows += [(100 + k, passage + " " + " ".join(f"own{k}_{i}" for i in range(40))) for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in ngram_join.jaccard_components(df).collect())
    assert got == expect(rows)


@pytest.mark.parametrize("block, held, few", [(1024, 1 << 20, 12), (3, 500, 2)])
def test_jaccard_links_equal_brute_force(spark, docs, rows, words, monkeypatch, block, held, few):
    """Every link of every row: copies, a star and a chain of edits, a dense group."""
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", held)
    monkeypatch.setattr(ngram_join, "FEW", few)
    more, cur = [], [f"w{i}" for i in range(60)]
    for k in range(40):
        cur = list(cur)
        cur[(7 * k) % 60] = f"x{k}"
        more.append((1000 + k, " ".join(cur[:60 - k % 9])))
    dense = [words[(3 * i) % 400] for i in range(90)]
    more += [(2000 + k, " ".join([*dense[:(5 * k) % 90], f"own{k}", *dense[(5 * k) % 90 + 1:]])) for k in range(50)]
    both = [*((r[0], r[1]) for r in rows), *more]
    sets = [shingles(r[1]) for r in both]
    n = [sum(jaccard(a, b) for j, b in enumerate(sets) if j != i) for i, a in enumerate(sets)]
    want = sorted(((*r[:1], len(x), m) for r, x, m in zip(both, sets, n)), key=key)
    df = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    got = ngram_join.jaccard_links(df, n_buckets=5)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "n_links"]
    assert sorted(((r["doc_id"], r["n_shingles"], r["n_links"]) for r in got.collect()), key=key) == want


def test_join_on_empty_table(empty):
    assert ngram_join.jaccard_components(empty).collect() == []
    assert ngram_join.jaccard_links(empty).collect() == []
    assert ngram_join.keep_first(empty).columns == empty.columns


def test_keep_first_keeps_one_of_each(docs, rows):
    kept = {r["doc_id"] for r in ngram_join.keep_first(docs).collect()}
    comp = {i: c for i, _, c in expect(rows)}
    assert kept == {i for i, c in comp.items() if i == c or i is None}


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(None, 3), (70, 60), (60, 60)], "a long, b long")
    got = {r["node"]: r["label"] for r in connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(51)}, 60: 60, 70: 60}


def vectors(seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(120, 16))
    x[40:70] = x[40] + 0.05 * rng.normal(size=(30, 16))
    x[70:75] = x[70]
    return x


def test_near_duplicates_equal_brute_force(spark):
    x = vectors()
    rows = [(i, [float(v) for v in r], i) for i, r in enumerate(x)]
    rows += [(500, None, 0), (501, [0.0] * 16, 0), (502, [float("nan")] * 16, 0), (503, [1.0, 2.0], 0), (504, [None] + [1.0] * 15, 0),
             (None, [float(v) for v in x[0]], 0), (505, [float(v) * 1e200 for v in x[1]], 0), (7, [float(v) for v in x[7]], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int")
    ok = [r[1] if r[0] not in (500, 501, 502, 503, 504) else None for r in rows]
    unit = [None if v is None else np.array(v) / np.abs(v).max() for v in ok]
    unit = [None if v is None else v / np.linalg.norm(v) for v in unit]
    linked = lambda a, b: a is not None and b is not None and float(a @ b) >= 0.9
    comp = components(unit, [r[0] for r in rows], linked)
    n = [sum(linked(a, b) for j, b in enumerate(unit) if j != i) for i, a in enumerate(unit)]
    want = sorted(zip([r[0] for r in rows], n, comp), key=key)
    got = sorted((tuple(r)[:3] for r in pivots.near_duplicates(df).collect()), key=key)
    assert got == want


def test_index_recall(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 32))
    for k in range(0, 600, 3):
        x[k + 1], x[k + 2] = x[k] + 0.2 * rng.normal(size=32), x[k] + 0.1 * rng.normal(size=32)
    u = x / np.linalg.norm(x, axis=1)[:, None]
    total = int((u @ u.T >= 0.9).sum()) - len(u)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    found = sum(r["n_links"] for r in pivots.near_duplicates(df, max_pivots=256).collect())
    assert 0.9 * total <= found <= total


@pytest.mark.parametrize("share, noise", [(3, 0.25), (3, 0.4), (1, 0.25)])
def test_index_recall_in_a_crowd(spark, monkeypatch, share, noise):
    """A crowd of a third of all rows, or of all, of near (not equal) vectors."""
    monkeypatch.setattr(pivots, "BLOCK", 300)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(3000, 64))
    m = len(x) // share
    x[:m] = x[0] + noise * rng.normal(size=(m, 64))
    x[m // 2:m:5] = x[:m][m // 2::5] + 0.5 * rng.normal(size=x[m // 2:m:5].shape)       # stragglers around it
    u = x / np.linalg.norm(x, axis=1)[:, None]
    want = (u @ u.T >= 0.9).sum(axis=1) - 1
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in pivots.near_duplicates(df).collect()}
    recall = sum(got.values()) / want.sum()
    print(f"crowd of 1/{share}, noise {noise}: recall {recall:.4f} of {want.sum() // 2} links")
    assert all(got[i] <= want[i] for i in got) and recall >= 0.999


def test_index_on_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert pivots.near_duplicates(df).collect() == []
