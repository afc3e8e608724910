"""What containment and person search shuffle follows the matches, not the words or the pairs of blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwise.operators import search as SR


def test_frequent_keys_are_looked_for_in_the_texts(spark, monkeypatch):
    """a key in most items gives no row per word that holds it."""
    rows = [(i // 2, f"anna ban{i} can{i} xan{i % 3} zq{i}") for i in range(40)] + [(None, "anna"), (99, "")]
    items = spark.createDataFrame(rows, "movie_id long, tags string")
    keys = spark.createDataFrame([(1, "an"), (2, "ban7"), (3, "zq1"), (4, "nope"), (5, "an"), (6, "xan2")], "kid long, key string")
    words = SR.tag_words(items)
    written, cut = {}, SR.cut_lineage
    monkeypatch.setattr(SR, "cut_lineage", lambda df, name="t": written.setdefault(name, cut(df, name)))
    got = SR.contains_join(keys, words, SR.word_table(words), items.select(F.col("movie_id").alias("id"), F.col("tags").alias("text")))
    assert sorted((r.kid, str(r.id)) for r in got.collect()) == sorted({(k, str(i)) for k, key in keys.collect() for i, t in items.collect() if key in t})
    assert {r.kid for r in written["broad_keys"].collect()} == {1, 5}
    assert written["rare_words"].count() == 13      # ban7; zq1, zq10 to zq19; xan2


@pytest.mark.parametrize("kids_kept", [256, 3])
def test_person_scores_equal_brute_force(spark, monkeypatch, kids_kept):
    """anchors are added in the tasks; titles count once."""
    monkeypatch.setattr(SR, "SUM_ROWS", kids_kept)
    rng = np.random.default_rng(9)
    n, k = 60, 4
    V = rng.random((n, 25)) * (rng.random((n, 25)) < 0.25)
    V[:, 0] += 0.01
    V /= np.linalg.norm(V, axis=1)[:, None]
    long = spark.createDataFrame([(i, t, float(V[i, t])) for i in range(n) for t in np.flatnonzero(V[i]).tolist()], "id long, term_idx int, w double")
    title = [f"t{i % 23}" for i in range(n)]
    items = spark.createDataFrame([(i, title[i]) for i in range(n)], "movie_id long, title string").repartition(3)
    asks = {kid: rng.choice(n, 1 + kid * 5, replace=False).tolist() for kid in range(7)}
    anchors = spark.createDataFrame([(kid, a) for kid, x in asks.items() for a in x], "kid long, anchor_id long")
    for vectors in (long, SR.vectors_arrays(long)):
        cands = SR.person_scores(anchors, vectors, items, k, block_rows=16)
        assert "FlatMapGroups" not in cands._jdf.queryExecution().toString()
        rows = cands.join(items.select(F.col("movie_id").alias("id"), "title"), "id").collect()
        for kid, x in asks.items():
            s = V[x].sum(axis=0) @ V.T
            want, seen = [], set()
            for i in sorted(range(n), key=lambda i: (-round(s[i], 9), i)):
                if s[i] > 0 and title[i] not in seen:
                    seen.add(title[i])
                    want.append((i, round(s[i], 6)))
            got, seen = [], set()
            for r in sorted((r for r in rows if r.kid == kid), key=lambda r: (-round(r.score, 9), r.id)):
                if r.title not in seen:
                    seen.add(r.title)
                    got.append((r.id, round(r.score, 6)))
            assert got[:k] == want[:k]
