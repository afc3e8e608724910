"""Quality classifier: a generalised additive model with pairwise
interactions.

Cyclic boosting: in each round every feature in turn gets one shallow tree
fitted to the residuals over its bins, added to that feature's lookup table;
then the pairs that reduce the residual deviance most get two-feature tables
in the same way. A text's score is the sum of one table entry per feature and
pair, by vectorised bin look-ups.

The model is fitted on at most ``max_fit_rows`` labelled rows (chosen by a
hash of doc_id; a documented bound), of which only the features reach the
driver; every text of the table is scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwise.llm.docstats import statistics
from tagwise.llm.columns import set_aside
from tagwise.llm.ship import Shipped

FEATURES = ("log_words", "word_len", "upper", "symbols", "exclaim", "pipes", "digits", "stops",
            "wide", "twins", "repeated", "covered", "dup_lines", "words_per_line")
MAX_FIT_ROWS = 30_000
BINS, PAIR_BINS, ROUNDS, PAIR_ROUNDS, N_PAIRS, RATE, LEAF = 48, 12, 150, 80, 8, 0.15, 20


def features(s: dict) -> np.ndarray:
    """Feature matrix of a slice's statistics; every value is defined for
    empty texts too."""
    w = np.maximum(s["n_words"], 1)
    byte, letters = np.maximum(s["n_bytes"], 1), np.maximum(s["letters"], 1)
    return np.column_stack([
        np.log1p(s["n_words"]), s["word_chars"] / w, s["upper"] / letters, s["n_symbols"] / w, s["exclaim"] / w,
        s["pipes"] / w, s["digits"] / byte, s["stops"] / w, s["wide"] / byte, s["twins"] / w, s["repeated"] / w,
        s["n_repeat_words"] / w, s["n_dup_lines"] / np.maximum(s["n_lines"], 1), s["n_words"] / np.maximum(s["n_lines"], 1)])


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """A shallow tree over ordered bins: Newton value per bin."""
    out = np.zeros(len(g))

    def grow(a: int, b: int, d: int) -> None:
        G, H = g[a:b].cumsum(), h[a:b].cumsum()
        N = n[a:b].cumsum()
        value = G[-1] / (H[-1] + 1.0)
        if d and b - a > 1:
            gain = G[:-1] ** 2 / (H[:-1] + 1.0) + (G[-1] - G[:-1]) ** 2 / (H[-1] - H[:-1] + 1.0)
            gain[(N[:-1] < LEAF) | (N[-1] - N[:-1] < LEAF)] = -1
            k = int(gain.argmax())
            if gain[k] > G[-1] ** 2 / (H[-1] + 1.0) + 1e-9:
                grow(a, a + k + 1, d - 1)
                grow(a + k + 1, b, d - 1)
                return
        out[a:b] = value

    grow(0, len(g), depth)
    return out


def _quadrants(g, h, n):
    """Best split of a two-feature grid into four quadrants: (gain, values)."""
    cg, ch, cn = (x.cumsum(0).cumsum(1) for x in (g, h, n))
    best, out = 0.0, np.zeros_like(g)
    if min(g.shape) < 2:
        return best, out

    def parts(c):
        a, row, col = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1]
        return a, row - a, col - a, c[-1, -1] - row - col + a
    G, H, N = parts(cg), parts(ch), parts(cn)
    gain = sum(np.where(m >= LEAF, x ** 2 / (y + 1.0), 0.0) for x, y, m in zip(G, H, N))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    vals = [x[i, j] / (y[i, j] + 1.0) if m[i, j] >= LEAF else 0.0 for x, y, m in zip(G, H, N)]
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = vals
    return float(gain[i, j]), out


class Gam:
    """``fit`` on a feature matrix, ``score`` by additions of table entries."""

    def __init__(self):
        self.edges, self.tables, self.pair_edges, self.pairs = [], [], [], {}
        self.intercept = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Gam:
        if not len(y) or y.min() == y.max():      # nothing to learn from: the label's rate
            rate = (y.sum() + 1) / (len(y) + 2)
            self.intercept = float(np.log(rate / (1 - rate)))
            return self
        self.edges = [_edges(c, BINS) for c in x.T]
        self.pair_edges = [_edges(c, PAIR_BINS) for c in x.T]
        bins = [np.searchsorted(e, c, "right") for e, c in zip(self.edges, x.T)]
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.intercept = float(np.log(y.mean() / (1 - y.mean())))
        f = np.full(len(y), self.intercept)
        counts = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, self.tables)]
        for _ in range(ROUNDS):
            for b, t, n in zip(bins, self.tables, counts):
                p = 1 / (1 + np.exp(-f))
                step = RATE * _tree(np.bincount(b, y - p, len(t)), np.bincount(b, p * (1 - p), len(t)), n)
                t += step
                f += step[b]
        grid = [np.searchsorted(e, c, "right") for e, c in zip(self.pair_edges, x.T)]
        size = [len(e) + 1 for e in self.pair_edges]

        def cell(i, j, w=None):
            return np.bincount(grid[i] * size[j] + grid[j], w, size[i] * size[j]).reshape(size[i], size[j])
        p = 1 / (1 + np.exp(-f))
        gains = sorted(((_quadrants(cell(i, j, y - p), cell(i, j, p * (1 - p)), cell(i, j))[0], i, j)
                        for i in range(x.shape[1]) for j in range(i)), reverse=True)[:N_PAIRS]
        self.pairs = {(i, j): np.zeros((size[i], size[j])) for gain, i, j in gains if gain > 0}
        for _ in range(PAIR_ROUNDS):
            for (i, j), t in self.pairs.items():
                p = 1 / (1 + np.exp(-f))
                step = RATE * _quadrants(cell(i, j, y - p), cell(i, j, p * (1 - p)), cell(i, j))[1]
                t += step
                f += step[grid[i], grid[j]]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.intercept)
        for e, t, c in zip(self.edges, self.tables, x.T):
            f += t[np.searchsorted(e, c, "right")]
        for (i, j), t in self.pairs.items():
            f += t[np.searchsorted(self.pair_edges[i], x[:, i], "right"), np.searchsorted(self.pair_edges[j], x[:, j], "right")]
        return 1 / (1 + np.exp(-f))


def _feature_rows(batches):
    for t in batches:
        parts = [features(s) for _, _, s in statistics(t.column("text"), lower=True)]
        x = np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))
        yield pa.RecordBatch.from_arrays([t.column("y"), *[pa.array(c, pa.float64()) for c in x.T]], ["y", *FEATURES])


def _score_rows(model, keep: list[str]):
    def run(batches):
        gam = model.get()
        for t in batches:
            parts = [gam.score(features(s)) for _, _, s in statistics(t.column("text"), lower=True)]
            score = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*[t.column(c) for c in keep], pa.array(score, pa.float64())], [*keep, "score"])
    return run


def held_out(mod: int, rest: int):
    """Whether crc32 of doc_id as text leaves ``rest`` by ``mod``; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % mod == rest, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_fit_rows: int = MAX_FIT_ROWS) -> Gam:
    """Model of ``labels.quality`` from labelled rows outside the held-out
    fold. Ids without one clear label (null, other values, both values) are
    left out; no usable label at all gives the constant 0.5."""
    y = (labels.select("doc_id", "quality").where("doc_id is not null and quality in (0, 1)").where(~held_out(3, 1))
         .groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("y2")).where("y = y2")
         .select("doc_id", F.col("y").cast("double").alias("y"))
         .orderBy(F.xxhash64(F.lit(3), "doc_id"), "doc_id").limit(max_fit_rows))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(y), "doc_id")   # at most max_fit_rows ids
    got = rows.select("y", "text").mapInArrow(_feature_rows, "y double, " + ", ".join(f"{f} double" for f in FEATURES)).toArrow()
    # the order in which tasks deliver must not change the model
    x = np.column_stack([got.column(f).to_numpy() for f in FEATURES]) if got.num_rows else np.zeros((0, len(FEATURES)))
    t = got.column("y").to_numpy()
    order = np.lexsort((*x.T, t))
    return Gam().fit(x[order], t[order])


def score(docs: DataFrame, model: Gam, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of every row (all by default) and ``score``, the
    probability of label 1. Null and empty texts are scored like a text
    without words; a column named score is replaced; empty table: empty
    result."""
    keep = [c for c in (keep or docs.columns) if c != "score"]
    src = docs.withColumn("text", F.col("text").cast("string"))
    schema = ", ".join([*(f"`{c}` {t}" for c, t in src.select(*keep).dtypes), "score double"])
    shared = Shipped(docs.sparkSession, model)
    return src.select(*dict.fromkeys([*keep, "text"])).mapInArrow(_score_rows(shared, keep), schema)


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that the classifier takes for label 1, all columns as
    they are, one named score included."""
    aside, back = set_aside(docs, ["score"])
    return score(aside, fit(aside, labels)).where(F.col("score") >= cut).select(*back)
