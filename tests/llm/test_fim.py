"""Boundary sets against plain lists, fill-in-middle against a plain cut."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagwise.llm import boundaries, fim

UNITS = re.compile(r"[^\n]*\n|[^\n]+")


def plain(doc_id, text, rate=100, spm=50):
    t = text or ""
    u = UNITS.findall(t)
    h = hashlib.sha256(("7:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    d = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((d[0] % (len(u) + 1), d[1] % (len(u) + 1)))
    pre, mid, suf = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or d[2] % 100 >= rate:
        return len(u), "plain", None, None, t
    if d[3] % 100 < spm:
        return len(u), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(u), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("share,kind", [(0.01, boundaries.ARRAY), (0.5, boundaries.BITMAP), (1.0, boundaries.RUNS)])
def test_select_in_each_kind_of_container(share, kind):
    rng = random.Random(4)
    texts = ["".join("\n" if rng.random() < share else rng.choice("aé漢😀") for _ in range(150_000)), "", "no break", "\n", "x\n\ny"]
    sets = boundaries.line_ends([t.encode() for t in texts])
    assert sets.kind[0] == kind
    for i, t in enumerate(texts):
        want = np.cumsum([len(u) for u in UNITS.findall(t)])
        assert sets.size[i] == len(want)
        if len(want):
            assert (sets.select(np.full(len(want), i), np.arange(len(want))) == want).all()


def test_equals_a_plain_cut_and_comes_back(spark, rows):
    rng = random.Random(9)
    texts = ["", "\n", "\n\n", "a", "a\nb", "a\nb\n", "é漢\n😀\r\nz", "has <P> in it\nx", "<S>", "\n<M>", "<\n<P\n>\nS>\n", None,
             "".join("\n" if rng.random() < 0.6 else rng.choice("aé漢<>PSM") for _ in range(100_000)).replace("<P>", "").replace("<S>", "").replace("<M>", "")]
    data = [(i, t, "x", i, "y") for i, t in enumerate(texts * 6)] + [(None, "a\nb\nc", "x", 1, "y"), (-3, "q\nr\n", "x", 2, "y"), (-3, "q\nr\n", "x", 2, "y")]
    data += [(r[0], r[1], "d", r[4], "z") for r in rows]
    df = spark.createDataFrame(data, "doc_id long, text string, h string, n long, form string").repartition(3)
    out = fim.transform(df)
    assert out.columns == [*df.columns, "fim"]
    got = out.withColumn("back", fim.restore(F.col("fim.output"), F.col("fim.form"))).collect()
    assert sorted(map(repr, (tuple(r[c] for c in df.columns) for r in got))) == sorted(map(repr, data))      # inputs untouched
    for r in got:
        assert tuple(r["fim"]) == plain(r["doc_id"], r["text"])
        assert r["back"] == (r["text"] or "")
    assert {r["fim"]["form"] for r in got} == {"plain", "psm", "spm"}


def test_rates(spark):
    df = spark.createDataFrame([(i, f"a{i}\nb\nc\n") for i in range(400)], "doc_id long, text string")
    got = fim.transform(df, rate=30, spm_rate=0).collect()
    assert all(tuple(r["fim"]) == plain(r["doc_id"], r["text"], 30, 0) for r in got)
    assert {r["fim"]["form"] for r in got} == {"plain", "psm"}


def test_empty_table_and_slices(empty, monkeypatch):
    assert fim.transform(empty).collect() == []
    monkeypatch.setattr(fim, "SLICE_BYTES", 10)
    texts = [b"a\nb\nc", b"", b"x" * 50 + b"\n", b"\n\n"]
    got = fim.cut_lines(texts, np.array([1, 2, 1, 1]), np.array([2, 9, 0, 2]))
    assert got.tolist() == [[3, 2, 4], [0, 0, 0], [1, 0, 51], [2, 1, 2]]
