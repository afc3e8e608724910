"""Language identification by rank-order profiles.

A profile is the ``PROFILE`` most frequent 1-, 2- and 3-grams of a language's
letters (a run of other characters is one blank), in order of count. A text's
own most frequent ``PROFILE`` n-grams are compared with each profile by the
out-of-place distance: the sum of rank differences, ``PROFILE`` for an n-gram
that the profile lacks. The nearest language wins, ties by code point.

n-grams are counted inside tasks first; Spark sums them per language. The
profiles (languages x 300 n-grams) are broadcast and compared in blocks of
``LANG_BLOCK`` languages; every language that a text has is learned.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagwise.llm.charcodes import Folded, counted, point_slices
from tagwise.llm.columns import set_aside
from tagwise.llm.ship import Shipped
from tagwise.session import cut_lineage

PROFILE = 300
LANG_BLOCK = 256        # languages compared at a time
REJECT = 0.15           # a document below this score has no sure language, whatever its language's own limit
LOW_SCORE, MARGIN = 0.05, 0.15      # a language's own limit: this quantile of its learning texts' scores, less the margin
FOLD_MOD, FOLD_REST = 5, 0


def _letter(c: int) -> int:
    """1 for what is no letter, else the lower-case code point + 2 in 20 bits."""
    ch = chr(c)
    if not ch.isalpha():
        return 1
    low = ch.lower()
    return (ord(low) if len(low) == 1 else c) % 0xFFFF0 + 2


def _grams(sym: np.ndarray, bounds: np.ndarray):
    """(row, code) of the 1- to 3-grams; runs of non-letters are one blank,
    and a blank stands before and after each text."""
    n = len(bounds) - 1
    row = np.repeat(np.arange(n), np.diff(bounds))
    keep = np.ones(len(sym), bool)
    keep[1:] = (sym[1:] != 1) | (sym[:-1] != 1) | (row[1:] != row[:-1])
    sym, row = sym[keep], row[keep]
    # one blank of its own before each row and after the last symbol
    per = np.bincount(row, minlength=n)
    start = np.concatenate([[0], np.cumsum(per + 2)])
    s = np.ones(start[-1], np.int64)
    r = np.repeat(np.arange(n), per + 2)
    s[np.arange(len(sym)) + 2 * row + 1] = sym
    rows, codes = [r[s > 1]], [s[s > 1]]
    same2 = (r[1:] == r[:-1]) & ((s[1:] > 1) | (s[:-1] > 1))
    two = s[:-1] << 20 | s[1:]
    rows.append(r[:-1][same2])
    codes.append(two[same2])
    if len(s) > 2:
        same3 = (r[2:] == r[:-2]) & (s[1:-1] > 1)
        rows.append(r[:-2][same3])
        codes.append((two[:-1] << 20 | s[2:])[same3])
    return np.concatenate(rows), np.concatenate(codes)


def _distinct(rows: np.ndarray, codes: np.ndarray):
    """Distinct (row, code) with counts; codes have up to 60 bits."""
    uniq, inv = np.unique(codes, return_inverse=True)
    bits = max(1, int(len(uniq)).bit_length())
    r, c, n = counted(rows, inv, bits)
    return r, uniq[c] if len(c) else c, n


def _count_rows(langs: list[str]):
    index = {x: i for i, x in enumerate(langs)}

    def run(batches):
        fold, total = Folded(_letter), {}

        def out():
            rows = [(langs[k >> 60], k & ((1 << 60) - 1), n) for k, n in total.items()]
            total.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                                               pa.array([r[2] for r in rows], pa.int64())], ["lang", "code", "n"])
        for t in batches:
            lang = np.array([index.get(x, -1) for x in t.column("lang").to_pylist()])
            for a, b, cp, bounds in point_slices(t.column("text")):
                rows, codes = _grams(fold(cp), bounds)
                which = lang[a:b][rows]
                r, c, n = _distinct(which[which >= 0], codes[which >= 0])
                for x, y, m in zip(r.tolist(), c.tolist(), n.tolist()):
                    k = x << 60 | y
                    total[k] = total.get(k, 0) + m
                if len(total) > 500_000:
                    yield out()
        yield out()
    return run


class Profiles:
    """Profiles of any number of languages, in blocks of ``LANG_BLOCK``: the
    n-grams of a block, sorted, with their rank in each of its profiles."""

    def __init__(self, langs: list[str], grams: list[np.ndarray]):
        self.langs, self.blocks = langs, []
        for begin in range(0, len(langs), LANG_BLOCK):
            part = grams[begin:begin + LANG_BLOCK]
            codes = np.unique(np.concatenate(part))
            rank = np.full((len(codes), len(part)), -1, np.int64)
            for k, g in enumerate(part):
                rank[np.searchsorted(codes, g), k] = np.arange(len(g))
            self.blocks.append((codes, rank))

    def distances(self, rows, codes, n, n_rows: int):
        """Per block of languages: out-of-place distance per row and language;
        and the number of n-grams compared per row."""
        order = np.lexsort((codes, -n, rows))
        rows, codes = rows[order], codes[order]
        first = np.searchsorted(rows, np.arange(n_rows))
        place = np.arange(len(rows)) - first[rows]
        top = place < PROFILE
        rows, codes, place = rows[top], codes[top], place[top]

        def blocks():
            for held, ranks in self.blocks:
                at = np.minimum(np.searchsorted(held, codes), max(0, len(held) - 1))
                known = held[at] == codes if len(held) else np.zeros(len(codes), bool)
                out = np.zeros((n_rows, ranks.shape[1]))
                for k in range(ranks.shape[1]):
                    rank = np.where(known, ranks[at, k], -1) if len(held) else np.full(len(codes), -1)
                    out[:, k] = np.bincount(rows, np.where(rank < 0, PROFILE, np.abs(rank - place)), n_rows)
                yield out
        return blocks(), np.bincount(rows, minlength=n_rows)

    def nearest(self, rows, codes, n, n_rows: int):
        """Per row the nearest language (ties: the first), its distance, and the
        number of n-grams compared."""
        blocks, compared = self.distances(rows, codes, n, n_rows)
        best, near, begin = np.zeros(n_rows, np.int64), np.full(n_rows, np.inf), 0
        for dist in blocks:
            k = dist.argmin(axis=1)
            d = dist[np.arange(n_rows), k]
            best, near = np.where(d < near, begin + k, best), np.minimum(d, near)
            begin += dist.shape[1]
        return best, near, compared


def _predict_rows(shared, keep: list[str]):
    def run(batches):
        prof, fold = shared.get(), Folded(_letter)
        for t in batches:
            langs, scores = [], []
            for a, b, cp, bounds in point_slices(t.column("text")):
                rows, codes = _grams(fold(cp), bounds)
                best, near, n = prof.nearest(*_distinct(rows, codes), b - a)
                if not prof.langs:
                    n[:], near = 0, np.zeros(b - a)
                score = np.where(n > 0, 1 - near / np.maximum(1, n * PROFILE), 0.0)
                langs += [prof.langs[k] if m else "und" for k, m in zip(best, n)]
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [*[t.column(c) for c in keep], pa.array(langs, pa.string()),
                 pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())], [*keep, "lang_pred", "score"])
    return run


def in_fold(mod: int = FOLD_MOD, rest: int = FOLD_REST):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % mod == rest, F.lit(False))


def learn(docs: DataFrame) -> Profiles:
    """Profiles from ``text`` and non-null ``lang`` of the rows outside the
    held-out fold, of every language there is: 300 n-grams each."""
    src = (docs.where("lang is not null and text is not null").where(~in_fold())
           .select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")))
    langs = sorted((r["lang"] for r in src.select("lang").distinct().collect()), key=lambda x: x.encode())
    counts = (src.mapInArrow(_count_rows(langs), "lang string, code long, n long")
              .groupBy("lang", "code").agg(F.sum("n").alias("n")))
    w = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    top = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= PROFILE).toPandas()
    of = dict(list(top.sort_values(["lang", "rank"]).groupby("lang")["code"]))
    return Profiles(langs, [of[x].to_numpy(np.int64) if x in of else np.zeros(0, np.int64) for x in langs])


def predict(docs: DataFrame, profiles: Profiles, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of every row (all by default), ``lang_pred`` and
    ``score`` (1 - distance / largest distance). ``und`` with score 0 where
    the text is null, empty or without letters, or nothing could be learned.
    Columns with the new names are replaced; empty table: empty result."""
    keep = [c for c in (keep or docs.columns) if c not in ("lang_pred", "score")]
    src = docs.withColumn("text", F.col("text").cast("string"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in src.select(*keep).dtypes), "lang_pred string, score double"])
    shared = Shipped(docs.sparkSession, profiles)
    return src.select(*dict.fromkeys([*keep, "text"])).mapInArrow(_predict_rows(shared, keep), schema)


def score_limits(scored: DataFrame) -> dict[str, float]:
    """The least sure score of each language, from the scores of the rows that
    profiles are learned from and that are recognised. Short clean texts score
    lower than long ones; the margin is for them."""
    rows = (scored.where((F.col("lang").cast("string") == F.col("lang_pred")) & ~in_fold()).groupBy("lang_pred")
            .agg(F.percentile_approx("score", LOW_SCORE, 10_000).alias("low")).collect())
    return {r["lang_pred"]: r["low"] - MARGIN for r in rows}


def keep_identified(docs: DataFrame, least: float = REJECT) -> DataFrame:
    """Rows of ``docs`` with a sure language, all columns as they are (also ones
    named score or lang_pred): the score reaches ``least`` and the limit of the
    language found (``score_limits``)."""
    aside, back = set_aside(docs, ["score", "lang_pred"])
    scored = cut_lineage(predict(aside, learn(aside)), "languages")
    limits = [F.lit(x) for lang, low in score_limits(scored).items() for x in (lang, max(least, low))]
    limit = F.coalesce(F.create_map(*limits)[F.col("lang_pred")], F.lit(least)) if limits else F.lit(least)
    return scored.where((F.col("lang_pred") != "und") & (F.col("score") >= limit)).select(*back)
