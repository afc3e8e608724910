"""Any number of languages, populations of any size, and input columns that
come back as they are whatever their names."""

import random
from fractions import Fraction
from math import comb

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwise.llm import columns, gam, kneser_ney, langid, mixing, sharding


def tongue(k, rng, n):
    """Words over a small alphabet of the language's own."""
    letters = [chr(0x4E00 + 8 * k + i) for i in range(6)]
    return " ".join("".join(rng.choice(letters) for _ in range(3)) for _ in range(n))


@pytest.fixture(scope="module")
def babel(spark):
    rng = random.Random(3)
    rows = [(300 * j + k, tongue(k, rng, 30), f"l{k:03d}") for k in range(300) for j in range(6)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4).cache()


def test_three_hundred_languages_are_learned(babel):
    prof = langid.learn(babel)
    assert len(prof.langs) == 300 and len(prof.blocks) == 2
    got = langid.predict(babel, prof).where("lang <> lang_pred").count()
    assert got == 0


def test_every_language_has_a_model(spark, babel, monkeypatch):
    monkeypatch.setattr(kneser_ney, "LANG_BLOCK", 2)
    some = babel.where("lang <= 'l004'").union(spark.createDataFrame([(9999, "no language here", None)], babel.schema))
    got = kneser_ney.quality_rules(some).select("doc_id", "model_lang", "lang", "log_perplexity").collect()
    assert len(got) == some.count() and all(r.model_lang == (r.lang or kneser_ney.OTHER) for r in got)
    monkeypatch.undo()
    one = {r.doc_id: r.log_perplexity for r in kneser_ney.quality_rules(some).collect()}
    assert all(abs(one[r.doc_id] - r.log_perplexity) < 1e-12 for r in got)


@pytest.mark.parametrize("good,bad,n", [(5, 7, 6), (50, 9, 30), (3, 60, 20), (40, 40, 79)])
def test_draws_follow_the_law(good, bad, n):
    rng = np.random.default_rng(1)
    draws = np.array([sharding.hypergeometric(rng, good, bad, n, most=0) for _ in range(20_000)])
    total = comb(good + bad, n)
    for k in range(max(0, n - bad), min(n, good) + 1):
        p = float(Fraction(comb(good, k) * comb(bad, n - k), total))
        assert abs((draws == k).mean() - p) < 5 * (p * (1 - p) / len(draws)) ** 0.5 + 1e-4


def test_draws_from_populations_beyond_a_billion():
    rng = np.random.default_rng(2)
    good, bad, n = 2_500_000_000, 97_500_000_000, 1_000_000_000
    x = np.array([sharding.hypergeometric(rng, good, bad, n) for _ in range(300)], float)
    p, sd = good / (good + bad), (n * 0.025 * 0.975 * (1 - n / (good + bad))) ** 0.5
    assert abs(x.mean() - n * p) < 5 * sd / 300 ** 0.5 and 0.85 < x.std() / sd < 1.15
    assert sharding.hypergeometric(rng, 10 ** 10, 0, 7) == 7
    m = sharding.communication_matrix(np.array([10 ** 9, 2 * 10 ** 9 + 5, 7]), 4, 3)
    assert m.sum(axis=1).tolist() == [10 ** 9, 2 * 10 ** 9 + 5, 7] and np.ptp(m.sum(axis=0)) <= 1


def same(before, after, key="doc_id"):
    rows = lambda df: sorted(map(repr, df.select(*before.columns).collect()))
    assert rows(after) == rows(before.join(after.select(key).distinct(), key, "left_semi"))


def test_names_of_input_columns(spark):
    assert columns.fresh(["a", "A_", "b"], "a", "c", "a") == ["a__", "c", "a___"]
    rng = random.Random(4)
    names = ["_crc", "_part", "_first", "_again", "_at", "_upto", "_cell", "_in", "_start", "score", "lang_pred", "size", "source_size",
             "target", "copies", "_copy", "_mix_source", "Score_"]
    rows = [(i, tongue(i % 3, rng, 40), f"l{i % 3}", f"s{i % 2}", *[f"{n}-{i}" for n in names]) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"`{n}` string" for n in names))
    shards = sharding.shard(docs, 3, 4)
    assert shards.columns == [*docs.columns, "shard", "slot"]
    same(docs, shards)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    for out in (gam.keep_good(docs, labels, cut=0.0), langid.keep_identified(docs), mixing.emit(docs).distinct()):
        assert out.columns == docs.columns and out.count() > 0
        same(docs, out)
    assert mixing.emit(docs).where(F.col("_copy").isNull() | ~F.col("_copy").startswith("_copy-")).count() == 0
