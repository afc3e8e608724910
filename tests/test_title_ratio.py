"""The title match by common blocks against the standard library's matcher,
and the counting of items per key without (key, item) rows."""

import difflib
import random

from pyspark.sql import functions as F

from tagwise.operators import search as SR


def frames(spark, titles, queries):
    return (spark.createDataFrame([(k, q) for k, q in enumerate(queries)], "kid long, q string").repartition(3),
            spark.createDataFrame([(t,) for t in titles], "title string").repartition(3))


def edited(rng, s):
    s = list(s)
    for _ in range(rng.randint(0, max(1, len(s) // 3))):
        i = rng.randrange(len(s) + 1)
        s[i:i + rng.randint(0, 2)] = rng.choice(["", "e", "th", " ", "é", "漢"])
    return "".join(s)


def check(spark, titles, queries):
    q, t = frames(spark, titles, queries)
    rows = {r.kid: r for r in SR.fuzzy_title_ratio(q, t).collect()}
    lower = [x for x in titles if x]
    for k, s in enumerate(queries):
        best = difflib.get_close_matches(s, lower, n=1, cutoff=0.6) if s else []
        assert (rows[k].matched if k in rows else None) == (best[0] if best else None), s
        if best:
            assert rows[k].ratio == difflib.SequenceMatcher(None, best[0], s).ratio()
            assert rows[k].scored <= rows[k].candidates
    return rows


def test_equals_the_standard_matcher(spark):
    rng = random.Random(11)
    words = ["the", "matrix", "alien", "aliens", "été", "of", "rings", "lord", "2", "up", "漢字"]
    titles = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 5))) for _ in range(120)] + ["", "a", "ab", "ba"]
    queries = [edited(rng, rng.choice(titles)) for _ in range(150)] + titles[:5] + ["", "ab", "aab", "zzzz", "b"]
    rows = check(spark, titles, queries)
    assert len(rows) > 60


def test_ties_go_to_the_larger_title(spark):
    rows = check(spark, ["abcx", "abcy", "xabc", "abc1"], ["abcq", "qabc"])
    assert rows[0].matched == "xabc"


def test_long_texts_where_frequent_characters_are_left_out(spark):
    rng = random.Random(5)
    titles = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (190, 220, 260, 400)]
    queries = [t[:50] + "zz" + t[60:] for t in titles] + [titles[3][::-1]]
    check(spark, titles, queries)


def test_bounds_leave_few_pairs(spark):
    titles = [f"title number {i:03d} {'x' * (i % 40)}" for i in range(200)]
    q, t = frames(spark, titles, ["title numbr 117", "qqqqqqqq"])
    rows = {r.kid: r for r in SR.fuzzy_title_ratio(q, t).collect()}
    assert 0 < rows[0].scored < rows[0].candidates < len(titles)
    assert 1 not in rows


def test_items_per_key_without_item_rows(spark):
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice(["alpha", "beta", "betamax", "x", "delta", f"w{i}", f"rare{i % 40}"]) for _ in range(4))) for i in range(90)]
    keys = ["a", "beta", "w1", "rare3", "rare39", "max", "zzz", "w", "alphabet", "are1"]
    it = spark.createDataFrame(items, "movie_id long, tags string")
    ks = spark.createDataFrame(list(enumerate(keys)), "kid long, key string")
    words = SR.tag_words(it)
    for least in (1, 3, 7):
        got = {r.kid for r in SR.keys_in_items(ks, words, SR.word_table(words), least).collect()}
        assert got == {k for k, key in enumerate(keys) if sum(key in t for _, t in items) >= least}
    none = SR.keys_in_items(ks.where(F.lit(False)), words, SR.word_table(words), 3)
    assert none.collect() == []
