"""What a step writes or shuffles follows its input, not its pairs."""

import contextlib
import io

import numpy as np

from tagwise.functions import text as tx
from tagwise.operators import approx as AX
from tagwise.operators import search as SR


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_edit_distance_numbers_no_characters(spark):
    """titles meet on length bands; no row per character is sorted."""
    titles = spark.createDataFrame([("alien",), ("aliens",), ("",), (None,), ("the long title of a film",)], "title string")
    queries = spark.createDataFrame([(1, "alien"), (2, "alienz"), (3, ""), (4, None), (5, "the long title of film"), (6, "zz")], "kid long, q string")
    got = SR.fuzzy_title_match(queries, titles)
    assert "Window" not in plan(got)
    rows = {r.kid: (r.matched, round(r.ratio, 6)) for r in got.collect()}
    assert rows == {1: ("alien", 1.0), 2: ("aliens", round(1 - 1 / 6, 6)), 3: ("", 1.0), 5: ("the long title of a film", round(1 - 2 / 24, 6))}


def test_lists_are_not_shuffled_to_their_probes(spark):
    """blocks of different rows meet without a grouped row per probe."""
    rng = np.random.default_rng(5)
    X = rng.normal(size=(200, 8))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(X)]
    got = AX.cosine_topk_approx(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 5)
    assert "FlatMapGroupsInPandas" not in plan(got)
    once = {(r.id, r["rank"], r.other_id) for r in got.collect()}
    unit = AX.unit_vectors(spark.createDataFrame(rows + rows[:50], "vec_id long, embedding array<double>"), "vec_id", "embedding")
    listed = AX.with_pivots(unit, X[:10] / np.linalg.norm(X[:10], axis=1)[:, None], 4)
    assert AX.packed_lists(listed).selectExpr("sum(size(ids)) as n").first().n == 200
    assert len(once) == 5 * len({i for i, _, _ in once})


def test_containment_writes_no_row_per_word_and_gram(spark, monkeypatch):
    """tables written on the way follow the keys."""
    items = spark.createDataFrame([(i, " ".join(f"w{i * 40 + j:05d}x" for j in range(40))) for i in range(30)], "movie_id long, tags string")
    keys = spark.createDataFrame([(1, "w00007x"), (2, "00"), (3, "9"), (4, "w01"), (5, "none"), (6, "199x")], "kid long, key string")
    words = SR.tag_words(items)
    index = SR.word_table(words)
    written = {}

    def cut(df, name="t"):
        written[name] = df.count()
        return df
    monkeypatch.setattr(SR, "cut_lineage", cut)
    hits = {(r.kid, r.word) for r in SR.contains_words(keys, index).collect()}
    assert hits == {(k, w.word) for k, key in keys.collect() for w in index.collect() if key in w.word}
    assert max(written.values()) <= sum(max(1, len(k.key) - 2) for k in keys.collect())


def test_json_lists_are_parsed_once(spark):
    """one parse of a text however often the list is looked at."""
    df = spark.createDataFrame([('[{"name": "A"}, {"name": "B"}]',), ('[{"job": "x"}]',), ("no",), (None,), ("[]",)], "j string")
    for parse, want in ((tx.parse_names, [["A", "B"], [], [], [], []]), (lambda c: tx.parse_cast(c, 1), [["A"], [], [], [], []])):
        got = df.select(parse("j").alias("a"))
        assert [r.a for r in got.collect()] == want
        text = plan(got)
        assert text.count("from_json") == 1 * text.count("Project")
