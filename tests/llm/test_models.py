"""Quality classifier, language profiles, quality rules and LM scores."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagwise.llm import gam, kneser_ney, langid, lattice
from tagwise.llm.queries import vocab_path


@pytest.fixture(scope="module")
def labelled(spark, words):
    """Good texts, and four kinds of junk."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(900):
        w = [rng.choice(words) for _ in range(rng.randint(60, 200))]
        kind = i % 6
        if kind == 3:
            w = [x.upper() + "!!" for x in w]
        elif kind == 4:
            w = [x + rng.choice(["###", "%%%"]) for x in w]
        elif kind == 5:
            w = [w[0]] * 100 + [w[1]] * 50
        rows.append((i, " ".join(w), ["xx", "yy", None][i % 3], "s"))
        labels.append((i, int(kind < 3), 0))
    labels += [(0, 0, 0), (None, 1, 0), (1, None, 0), (2, 7, 0)]
    docs = spark.createDataFrame(rows + [(5000, None, None, None), (None, "", "xx", "s"), (5001, " ", "zz", "s")],
                                 "doc_id long, text string, lang string, source string").cache()
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_on_held_out(labelled):
    docs, labels = labelled
    model = gam.fit(docs, labels)
    got = gam.score(docs, model).withColumn("held_out", gam.held_out(3, 1)).collect()
    assert len(got) == 903 and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 5000]
    assert len(held) > 200 and np.mean([(r["score"] >= 0.5) == (r["doc_id"] % 6 < 3) for r in held]) > 0.97
    again = gam.score(docs.repartition(5), gam.fit(docs.repartition(2), labels)).collect()
    assert {(r["doc_id"], r["text"]): r["score"] for r in got} == {(r["doc_id"], r["text"]): r["score"] for r in again}


def test_quality_without_labels(labelled, empty):
    docs, labels = labelled
    none = labels.where("doc_id < 0")
    assert {r["score"] for r in gam.score(docs, gam.fit(docs, none)).collect()} == {0.5}
    assert gam.keep_good(docs, none).columns == docs.columns
    assert gam.score(empty, gam.fit(empty, none)).collect() == []


def test_score_replaces_a_column_of_its_name(docs, rows):
    got = gam.score(docs, gam.Gam())
    assert sorted(got.columns) == sorted(docs.columns) and got.count() == len(rows)


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(4)
    parts = {"aa": ["ba", "lo", "mi"], "bb": ["sch", "ung", "ei"], "cc": ["ño", "que", "és"]}
    rows = []
    for i in range(300):
        lang = "abc"[i % 3] * 2
        rows.append((i, " ".join("".join(rng.choice(parts[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(3, 60))), lang))
    rows += [(900, None, "aa"), (901, "", "aa"), (902, "12 34 !!", "bb"), (903, "ьжщ", None), (None, "schung eisch", "bb"), (904, "X", "aa")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_profiles(tongues, empty):
    prof = langid.learn(tongues)
    assert prof.langs == ["aa", "bb", "cc"]
    got = {r["doc_id"]: r for r in langid.predict(tongues, prof).collect()}
    assert np.mean([got[i]["lang_pred"] == got[i]["lang"] for i in range(300)]) > 0.98
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (900, 901, 902))
    assert got[903]["score"] == 0 and got[None]["lang_pred"] == "bb" and all(0 <= r["score"] <= 1 for r in got.values())
    kept = langid.keep_identified(tongues)
    assert kept.columns == tongues.columns and kept.count() == 302
    assert langid.predict(empty, langid.learn(empty)).collect() == []
    assert {r["lang_pred"] for r in langid.predict(tongues, langid.learn(empty)).collect()} == {"und"}


def test_keep_identified_rejects_unlearned_text(spark, tongues):
    """Random letters and a language that was not learned, of the learned letters."""
    rng = random.Random(8)
    letters, strange = "abilmo", ["ab", "ol", "im"]
    rows = [(2000 + i, " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(40)), None) for i in range(40)]
    rows += [(3000 + i, " ".join("".join(rng.choice(strange) for _ in range(rng.randint(1, 4))) for _ in range(40)), None) for i in range(40)]
    more = tongues.union(spark.createDataFrame(rows, tongues.schema))
    scores = {r["doc_id"]: r["score"] for r in langid.predict(more, langid.learn(more)).collect()}
    print("passed by the one limit for all:", sum(scores[r[0]] >= langid.REJECT for r in rows), "of", len(rows))
    assert sum(scores[r[0]] >= langid.REJECT for r in rows) > len(rows) / 2
    kept = {r["doc_id"] for r in langid.keep_identified(more).collect()}
    clean, wrong = sum(i in kept for i in range(300)) / 300, sum(r[0] in kept for r in rows) / len(rows)
    print(f"clean texts kept {clean:.4f}, others kept {wrong:.4f}")
    assert clean >= 0.99 and wrong <= 0.05


def test_out_of_place_distance_by_hand():
    """Against a plain count of n-grams and ranks."""
    import pyarrow as pa

    from tagwise.llm.charcodes import Folded, point_slices

    def grams(t):
        s = " " + re.sub(r"[^a-z]+", " ", t.lower()).strip() + " "
        return Counter(s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1)
                       if s[i:i + n].strip() and (n < 3 or s[i + 1] != " "))
    a, b = "the cat sat on the mat", "a dog, ate THE hat"
    code = lambda g: sum(langid._letter(ord(c)) << 20 * (len(g) - 1 - k) for k, c in enumerate(g))
    order = lambda t: sorted(grams(t), key=lambda g: (-grams(t)[g], code(g)))
    (_, _, cp, bounds), = point_slices(pa.array([a, b]))
    rows, codes, n = langid._distinct(*langid._grams(Folded(langid._letter)(cp), bounds))
    for k, t in enumerate((a, b)):
        assert dict(zip(codes[rows == k].tolist(), n[rows == k].tolist())) == {code(g): m for g, m in grams(t).items()}
    prof = langid.Profiles(["x"], [np.array([code(g) for g in order(a)])])
    (dist,), _ = prof.distances(rows, codes, n, 2)
    place = {g: i for i, g in enumerate(order(a))}
    assert dist[0, 0] == 0
    assert dist[1, 0] == sum(abs(i - place[g]) if g in place else langid.PROFILE for i, g in enumerate(order(b)))


def base_stats(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    c, cov, seen, dup = Counter(zip(w, w[1:], w[2:])), set(), set(), 0
    for k in range(len(w) - 2):
        if c[w[k], w[k + 1], w[k + 2]] >= 2:
            cov |= {k, k + 1, k + 2}
    for x in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), dup, len(cov)


def test_quality_rules(spark, labelled):
    docs, _ = labelled
    extra = spark.createDataFrame([(7000, "a b c\n\na b c\n x \n x \nx", "xx", "s"), (7001, "é# | ü\r\n  <b>", None, "s"), (7001, "é# | ü", None, "s")], docs.schema)
    got = kneser_ney.quality_rules(docs.union(extra)).collect()
    assert len(got) == 906
    for r in got:
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == base_stats(r["text"])
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    good = [r["kept"] for r in got if r["doc_id"] is not None and r["doc_id"] < 900 and r["doc_id"] % 6 < 3]
    assert np.mean(good) > 0.97


def test_quality_rules_on_empty_table(empty):
    assert kneser_ney.quality_rules(empty).collect() == []


def test_quality_rules_replace_columns_of_their_own_names(labelled):
    docs, _ = labelled
    clash = docs
    for c in (*kneser_ney.SPREADS, *kneser_ney.LIMITS, "kept", "_lang", "lower"):
        clash = clash.withColumn(c, F.lit("mine"))
    got, plain = ({(r.doc_id, r.text): r for r in kneser_ney.quality_rules(x).collect()} for x in (clash, docs))
    for key, r in got.items():
        assert r._lang == r["lower"] == "mine"
        assert all(r[c] == v for c, v in plain[key].asDict().items())


@pytest.mark.parametrize("bits,order", [(6, 3), (10, 2)])
def test_kneser_ney_sums_to_one(bits, order):
    rng = np.random.default_rng(1)
    sym = rng.integers(1, 12, 4000)
    row, code = kneser_ney._codes(sym, np.array([0, 2500, 4000]), bits, order)
    c, n = np.unique(code, return_counts=True)
    model = kneser_ney.KneserNey(bits, order)
    model.add("x", c, n)
    for ctx in (0, 3 << bits | 5, 11 << bits | 11, 50 << bits | 60, 60)[:5 if order == 3 else 1] + (11, 700)[:order - 1]:
        p = 10 ** model.log10("x", (ctx << bits) + np.arange(1 << bits))
        assert abs(p.sum() - 1) < 1e-6 and p.min() > 0


def test_tokens_of_slices(monkeypatch):
    texts = ["Don't stop, É é.", None, "", " \t", "a\nB  c", "##x", "日本 ok"]
    want = ["Don ' t stop , É é .", "", "", "", "a B c", "# # x", "日本 ok"]
    cells = {}
    for limit in (1 << 18, 1):
        monkeypatch.setattr(kneser_ney, "SLICE", limit)
        got, n = [], []
        for a, b, cell, cls, bounds in kneser_ney.token_slices(pa.array(texts, pa.string())):
            got += list(zip(cell.tolist(), cls.tolist()))
            n += np.diff(bounds).tolist()
        assert n == [len(w.split()) for w in want]
        for w, (cell, cls) in zip(" ".join(want).split(), got, strict=True):
            assert cells.setdefault(w, cell) == cell and 1 <= cls <= kneser_ney.CLASSES
            assert (cls > kneser_ney.CLASSES // 2) == (w in ("Don", "É", "B"))
    assert len(set(cells.values())) == len(cells)


def test_quality_rules_reject_shuffled_words(spark):
    """Sentences of a small grammar, two texts in a hundred with their words shuffled."""
    rng = random.Random(12)
    nouns, verbs = ([f"{x}{y}" for x in s.split() for y in ("ta", "ri", "mo", "lu", "ne")] for s in ("ba ke do si fu ga he", "pol mir tan vus jek"))

    def sentence():
        w = ["The", rng.choice(nouns), rng.choice(verbs), rng.choice(["a", "the", "some"]), rng.choice(nouns)]
        return " ".join(w + (["of", "the", rng.choice(nouns)] if rng.random() < 0.4 else [])) + "."
    rows = []
    for i in range(1500):
        w = " ".join(sentence() for _ in range(rng.randint(15, 40))).split()
        if i % 50 == 7:
            rng.shuffle(w)
        rows.append((i, " ".join(w), "xx"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = [r for r in kneser_ney.quality_rules(docs).collect() if not r.base_failed]
    bad, good = ([r.kept for r in got if (r.doc_id % 50 == 7) == x] for x in (True, False))
    assert len(bad) > 20 and np.mean(bad) < 0.1 and np.mean(good) > 0.98


@pytest.fixture(scope="module")
def pieces():
    return lattice.Pieces(vocab_path("piece_bpe_32k.model"))


def test_lattice_sums_all_segmentations(pieces):
    p = dict(zip(pieces.names, np.exp(pieces.logp)))

    def total(q):
        return 1.0 if not q else sum(p[q[:k]] * total(q[k:]) for k in range(1, len(q) + 1) if q[:k] in p)
    words = ["the", "thing", "é", "a", "zqx!", "don't", "日"]
    got, expected = pieces.score(words, np.ones(len(words)))
    for w, g in zip(words, got):
        assert math.isclose(math.exp(g), total((256, *w.encode())), rel_tol=1e-9)
    size = np.array([len(q) for q in pieces.names])
    assert math.isclose((expected * size).sum(), sum(len(w.encode()) + 1 for w in words), rel_tol=1e-9)
    assert abs(np.exp(pieces.logp).sum() - 1) < 1e-9


def test_base_score_and_counts(docs, rows):
    fold = {c: c + 32 for c in range(65, 91)}
    toks = [re.findall(r"[^\x20\x09-\x0D]+", (r[1] or "").translate(fold)) + [None] for r in rows]
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    c = Counter(x for t, h in zip(toks, held) if not h for x in t)
    n, v = sum(c.values()), len(c)
    want = sorted((r[0] is None, r[0] or 0, h, len(t), sum(c[x] > 0 for x in t), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in t), 6))
                  for r, t, h in zip(rows, toks, held))
    for head in (10, lattice.HEAD):
        old, lattice.HEAD = lattice.HEAD, head
        try:
            got = lattice.score_texts(docs, vocab_path("piece_bpe_32k.model")).collect()
        finally:
            lattice.HEAD = old
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
        assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)


def test_lm_on_empty_and_untrained_tables(empty, spark):
    path = vocab_path("piece_bpe_32k.model")
    assert lattice.score_texts(empty, path).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r, = lattice.score_texts(spark.createDataFrame([(held, "some words")], "doc_id long, text string"), path).collect()
    assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (True, 3, 0, 0) and r["score"] < 0
