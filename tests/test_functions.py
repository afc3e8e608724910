"""Exact-value cases (parsing, cleaning, tags, validation, sorting, drift)."""

import pytest
from pyspark.sql import functions as F

from tagwise.functions import fixed as FX
from tagwise.functions import text as tx
from tagwise.operators import catalog as CT
from tagwise.operators import drift as DR
from tagwise.operators import feedback as FB
from tagwise.operators import quality as QA
from tagwise.operators import search as SR


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_parse_names_in_order(spark):
    assert one(spark, tx.parse_names("x"), '[{"id": 1, "name": "Action"}, {"id": 2, "name": "Drama"}]') \
        == ["Action", "Drama"]


def test_parse_names_not_json_is_empty(spark):
    assert one(spark, tx.parse_names("x"), "not json at all") == []


def test_parse_cast_at_most_five(spark):
    six = "[" + ",".join('{"name": "A%d"}' % i for i in range(6)) + "]"
    assert one(spark, tx.parse_cast("x"), six) == ["A0", "A1", "A2", "A3", "A4"]


def test_parse_director_first_director(spark):
    crew = '[{"job": "Director", "name": "Jane Roe"}, {"job": "Producer", "name": "Joe Bloggs"}]'
    assert one(spark, tx.parse_director("x"), crew) == ["Jane Roe"]


def test_parse_director_none(spark):
    assert one(spark, tx.parse_director("x"), '[{"job": "Producer", "name": "Joe Bloggs"}]') == []


def test_clean_name_and_text(spark):
    assert one(spark, tx.clean_name("x"), "Tom Hanks") == "tomhanks"
    assert one(spark, tx.clean_text("x"), "   Hello   WORLD  ") == "hello world"


def test_tokens_and_bigrams(spark):
    toks = one(spark, tx.ngrams_1_2(tx.tokenize("x")), "The quick brown fox and a dog")
    assert toks == ["quick", "brown", "fox", "dog", "quick brown", "brown fox", "fox dog"]


def test_word_count_and_ratio_round(spark):
    assert one(spark, tx.word_count("x"), "  a  b\tc ") == 3
    df = spark.createDataFrame([(815, 4000), (1, 3)], "a long, b long")
    assert [r[0] for r in df.select(tx.ratio_round("a", "b", 4)).collect()] == [0.2038, 0.3333]


def _raw(spark, rows):
    return spark.createDataFrame(rows, "movie_id long, title string, overview string, genres string, "
                                       "keywords string, cast string, crew string")


def test_drop_nulls_and_tags(spark):
    rows = [(1, "A", "Some Plot", '[{"id": 1, "name": "Science Fiction"}]', "[]",
             '[{"name": "Tom Hanks"}]', '[{"job": "Director", "name": "Jane Roe"}]'),
            (2, None, "x", "[]", "[]", "[]", "[]")]
    cat = CT.prepare_catalog(_raw(spark, rows))
    out = cat.collect()
    assert len(out) == 1
    assert out[0]["tags"] == ("some plot sciencefiction sciencefiction tomhanks tomhanks "
                              "janeroe janeroe janeroe")


def test_validate_schema_missing(spark):
    df = spark.createDataFrame([(1,)], "id long")
    with pytest.raises(ValueError):
        QA.validate_schema(df, ["id", "title"], "movies")
    assert QA.validate_schema(df, ["id"], "movies")


def test_missing_values_count(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "v long")
    r = QA.missing_values(df, "t").first()
    assert r["missing"] == 1 and r["rate"] == 0.3333 and r["level"] == "high"


def test_duplicate_titles(spark):
    df = spark.createDataFrame([("A",), ("A",), ("B",)], "title string")
    assert QA.duplicate_titles(df).first()["value"] == 1


def _sorted(spark, rows):
    df = spark.createDataFrame(rows, "query string, pos int, title string, rating double")
    out = SR.sort_recommendations(df, ["query"]).orderBy("display_pos").collect()
    return [(r["title"], r["rating_label"]) for r in out]


def test_sort_searched_first_then_rating_then_unrated(spark):
    rows = [(" s ", 0, "Z", 0.0), (" s ", 1, "L", 6.0), (" s ", 2, "H", 9.0), (" s ", 3, "N", None),
            (" s ", 4, "R", 8.432), (" s ", 5, "S", 5.0)]
    assert _sorted(spark, rows) == [("S", "5.0"), ("H", "9.0"), ("R", "8.4"), ("L", "6.0"), ("Z", "N/A"), ("N", "N/A")]


def test_enrich_metadata_outcomes(spark):
    titles = spark.createDataFrame([("a", False), ("b", False), ("c", False), ("d", True)], "title string, failed boolean")
    cand = spark.createDataFrame([("a", 2, "/2", 7.25, "two"), ("a", 1, None, 1.0, "one"), ("a", 3, "/3", 9.0, "three"),
                                  ("b", 1, None, 8.0, "no poster"), ("d", 1, "/4", 5.0, "late")],
                                 "title string, cand_pos int, poster_path string, vote_average double, overview string")
    got = {r["title"]: tuple(r)[1:] for r in SR.enrich_metadata(titles, cand, "failed").collect()}
    none = (FX.POSTER_PLACEHOLDER, None, FX.NO_DESCRIPTION)
    assert got["a"] == (FX.POSTER_PREFIX + "/2", 7.25, "two", "success")
    assert got["b"] == (*none, "fallback") and got["c"] == (*none, "fallback") and got["d"] == (*none, "error")


def test_only_the_title_route_reports_similarity(spark):
    rows = [("q", "person", 0, "A", 14.7), ("t", "title", 0, "T", None), ("t", "title", 1, "U", 0.5), ("t", "title", 2, "V", 0.25)]
    df = spark.createDataFrame(rows, "query string, route string, pos int, title string, score double")
    got = {r["query"]: tuple(r)[2:] for r in SR.recommend_metrics(df).collect()}
    assert got == {"q": (1, 0.0, 0.0), "t": (3, 0.5, 0.375)}


def test_a_lone_object_is_no_list(spark):
    df = spark.createDataFrame([('{"name": "A", "job": "Director"}',), (' [{"name": "A", "job": "Director"}]',)], "j string")
    got = df.select(tx.parse_names("j").alias("a"), tx.parse_cast("j").alias("b"), tx.parse_director("j").alias("c")).collect()
    assert tuple(got[0]) == ([], [], []) and tuple(got[1]) == (["A"], ["A"], ["A"])


def test_blank_queries_are_rejected(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), ("x",)], "query string")
    assert [(r["accepted"], r["status"]) for r in SR.blank_query_guard(df).collect()] == [(False, "error")] * 3 + [(True, "accepted")]


def test_quartiles_by_rank(spark):
    import numpy as np
    x = [float(v) for v in np.random.default_rng(0).integers(0, 40, 501)] + [None]
    r = QA.iqr_bounds(spark.createDataFrame([(v,) for v in x], "v double"), "v").first()
    q1, q3 = np.percentile([v for v in x if v is not None], [25, 75])
    assert (r["q1"], r["q3"]) == (q1, q3)


def test_drift_without_baseline(spark):
    s = spark.createDataFrame([("click x", "success", 1.0)], "query string, status string, latency_ms double")
    p = spark.createDataFrame([], "ts timestamp")
    r = DR.detect_drift(FB.feedback_stats(s, p), None).first()
    assert r["drift_detected"] is False and r["reason"] == "no_baseline"


def test_blank_query_is_rejected(spark):
    raw = spark.createDataFrame([("   ",), ("drama",)], "query string")
    q = SR.prepare_queries(raw)
    assert [r["query"] for r in q.collect()] == ["drama"]
    res = spark.createDataFrame([], "query string, pos int, title string")
    out = SR.recommend_outcome(spark.createDataFrame([("  ",)], "query string"), res).first()
    assert out["status"] == "error"
