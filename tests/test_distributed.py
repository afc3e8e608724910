"""The custom distributed operators against brute force on small fixtures."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from tagwise.operators import feedback as FB
from tagwise.operators import search as SR
from tagwise.operators import similarity as sim


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_blocked_topk_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(60):
        for t in rng.choice(25, size=5, replace=False):
            rows.append((i, int(t), float(rng.random())))
    rows += [(60 + k, t, w) for k, (i, t, w) in enumerate(rows[:5])]  # exact copies
    v = spark.createDataFrame(rows, "id long, term_idx int, w double")
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(__import__("pyspark.sql").sql.Window.partitionBy("id")))
    v = v.select("id", "term_idx", (F.col("w") / norm).alias("w"))
    got = {(r.id, r.rank): (r.other_id, round(r.score, 9))
           for r in sim.topk_neighbours(v, 7, block_rows=16, materialize=False).collect()}
    vec = {}
    for r in v.collect():
        vec.setdefault(r.id, {})[r.term_idx] = r.w
    for a in vec:
        sc = [(b, sum(vec[a].get(t, 0) * x for t, x in vec[b].items())) for b in vec if b != a]
        sc = sorted([(b, s) for b, s in sc if s > 0], key=lambda x: (-round(x[1], 9), x[0]))[:7]
        for k, (b, s) in enumerate(sc, 1):
            assert got[(a, k)][0] == b and abs(got[(a, k)][1] - s) < 1e-9
    assert all(r[0] != a for (a, _), r in got.items())


def test_prefix_scan_equals_running_sum(spark):
    random.seed(1)
    rows = [(i, random.randint(0, 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(7)
    out = FB.prefix_scan(df, ["k"], {"v": F.col("v")}).orderBy("k").collect()
    run = list(itertools.accumulate(v for _, v in rows))
    assert [r.rn for r in out] == list(range(1, 201))
    assert [r.cum_v for r in out] == run


def test_global_lag(spark):
    df = spark.createDataFrame([(i,) for i in range(50)], "k long").repartition(5)
    out = FB.global_lag(df, ["k"], "k").orderBy("k").collect()
    assert [r.prev for r in out] == [None] + list(range(49))


def test_contains_join_equals_brute_force(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma"), (2, "betamax x"), (3, "zz ab"), (4, "delta")],
                                  "movie_id long, tags string")
    keys = spark.createDataFrame([(1, "beta"), (2, "a"), (3, "zz"), (4, "q"), (5, "ammag")], "kid long, key string")
    words = SR.tag_words(items)
    got = {(r.kid, r.id) for r in SR.contains_join(keys, words, SR.word_table(words)).collect()}
    want = {(k, i) for k, key in keys.collect() for i, t in items.collect() if key in t}
    assert got == want


def test_fuzzy_match_equals_brute_force(spark):
    titles = ["the matrix", "matrix", "avatar", "the avengers", "up", "alien", "aliens", "héros"]
    queries = [(1, "the matrx"), (2, "avengers"), (3, "alien"), (4, "zzz"), (5, "heros"), (6, "u")]
    t = spark.createDataFrame([(x,) for x in titles], "title string")
    q = spark.createDataFrame(queries, "kid long, q string")
    got = {r.kid: (r.matched, round(r.ratio, 9)) for r in SR.fuzzy_title_match(q, t).collect()}
    for kid, s in queries:
        best = None
        for x in titles:
            r = 1 - _lev(s, x) / max(len(s), len(x))
            if r >= 0.6 - 1e-12 and (best is None or (r, x) > best):
                best = (r, x)
        if best is None:
            assert kid not in got
        else:
            assert got[kid] == (best[1], round(best[0], 9))


def test_topk_for_rows_equals_full_kernel(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(t), float(rng.random())) for i in range(50) for t in rng.choice(20, size=4, replace=False)]
    v = spark.createDataFrame(rows, "id long, term_idx int, w double")
    sample = spark.createDataFrame([(3,), (17,), (42,)], "id long")
    full = sim.topk_neighbours(v, 6, block_rows=8, materialize=False).join(sample, "id")
    part = sim.topk_for_rows(v, sample, 6, block_rows=8)
    key = lambda df: sorted((r.id, r.rank, r.other_id, round(r.score, 9)) for r in df.collect())
    assert key(part) == key(full)
