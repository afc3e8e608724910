"""Approximate nearest neighbours by pivot lists with measured probing.

Rows are listed under their ``ASSIGN`` nearest pivots (2 * sqrt(n) rows drawn
by a hash), and a query meets the lists of its nearest pivots. How many lists it
probes is not guessed: a bounded sample of rows is compared with every row, and
the least number of probes that finds the wished share of the sample's true
neighbours is taken. So clustered vectors are searched in a few lists, and
vectors without near neighbours in many (the number is part of the result's
cost, not of its quality).

Rows are packed into blocks of ``LIST_ROWS`` in the order of their nearest
pivot, written once, and the table of blocks meets itself in a cartesian
product: nothing is shuffled per list or probe. A task works out the lists that
a block's rows probe, passes over blocks that stand in none of them, and keeps
the best of the rows that do. A pivot in the middle of a crowd makes more
blocks, not longer ones. Only the pivots, the sample and one row per pivot are
broadcast; their sizes are bounded by parameters and sqrt(n).
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagwise.functions.fixed import TOP_K
from tagwise.operators.similarity import _KERNEL_SCHEMA, NO_ID, TIE_DIGITS, _Best, _topk_rows, num_blocks, rank_neighbours
from tagwise.session import cut_lineage

ASSIGN = 4              # lists that hold a row
PIVOTS_PER_ROOT = 2     # pivots = this times the root of the rows
MAX_PIVOTS = 16_384     # beyond, lists get longer (and more chunks)
SAMPLE = 100            # rows that the probing is fitted on
RECALL = 0.93           # share of the sample's neighbours to be found
LIST_ROWS = 2048


def unit_vectors(emb: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, u): vectors of length one; zero vectors and those with null or
    non-finite components are left out."""
    v = F.col("v")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return (emb.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
            .withColumn("norm", norm).where((F.col("norm") > 0) & (F.col("norm") < float("inf")))
            .select("id", F.transform(v, lambda x: x / F.col("norm")).alias("u")))


def _drawn(unit: DataFrame, word: str, n: int) -> pd.DataFrame:
    """The ``n`` rows of least md5: a bounded number of rows, on the driver."""
    return unit.orderBy(F.md5(F.concat(F.lit(f"{word}|"), F.col("id").cast("string"))), "id").limit(n).toPandas()


def _order(u: np.ndarray, pivots: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` nearest pivots of each row, nearest first (ties: first drawn)."""
    near = np.round(u @ pivots.T, TIE_DIGITS)
    if most < near.shape[1]:
        kth = np.partition(near, -most, axis=1)[:, -most]
        near = np.where(near >= kth[:, None], near, -np.inf)
    return np.argsort(-near, axis=1, kind="stable")[:, :most]


def with_pivots(unit: DataFrame, pivots: np.ndarray, most: int) -> DataFrame:
    """(id, u, lists): the ``most`` nearest pivots of every row."""
    def run(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(lists=list(_order(np.stack(pdf["u"].to_list()), pivots, most).astype(np.int32)))
    return unit.mapInPandas(run, "id long, u array<double>, lists array<int>")


def _true_neighbours(unit: DataFrame, sample: pd.DataFrame, k: int) -> DataFrame:
    """Exact neighbours (id, other_id) of the sample: sample x all rows."""
    ids, table = sample["id"].to_numpy(np.int64), np.stack(sample["u"].to_list())

    def run(batches):
        for pdf in batches:
            if len(pdf):
                other = pdf["id"].to_numpy(np.int64)
                yield _topk_rows(table @ np.stack(pdf["u"].to_list()).T, ids, other, k, ids[:, None] == other[None, :])[0]
    return rank_neighbours(unit.mapInPandas(run, _KERNEL_SCHEMA), k).select("id", "other_id")


def probes_needed(listed: DataFrame, unit: DataFrame, pivots: np.ndarray, k: int, recall: float, sample: int) -> int:
    """The least number of lists in which ``recall`` of the true neighbours of
    ``sample`` rows are found. A neighbour is found at the first of the row's
    lists that holds it."""
    rows = _drawn(unit, "sample", sample)
    order = _order(np.stack(rows["u"].to_list()), pivots, len(pivots))
    ranks = unit.sparkSession.createDataFrame([(int(i), [int(x) for x in np.argsort(o)]) for i, o in zip(rows["id"], order)], "id long, at array<int>")
    held = listed.select(F.col("id").alias("other_id"), F.slice("lists", 1, ASSIGN).alias("lists"))
    found = (_true_neighbours(unit, rows, k).join(F.broadcast(ranks), "id").join(held, "other_id")     # sample x k rows
             .select(F.array_min(F.transform("lists", lambda p: F.col("at")[p] + 1)).alias("probes")))
    per = found.groupBy("probes").count().orderBy("probes").toPandas()      # at most one row per pivot
    if not len(per):
        return 1
    return int(per["probes"][np.argmax(per["count"].cumsum() >= recall * per["count"].sum())])


def packed_lists(listed: DataFrame) -> DataFrame:
    """One row per block of ``LIST_ROWS`` rows (different ones; in the order of
    their nearest pivot, by hash among its rows): ids, vectors and lists."""
    rows = listed.dropDuplicates(["id", "u"]).withColumn("first", F.element_at("lists", 1))
    per = cut_lineage(rows.groupBy("first").agg(F.count(F.lit(1)).alias("n")), "first_pivots")     # one row per pivot
    before = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    start = per.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    at = F.col("start") + F.pmod(F.xxhash64("id"), F.col("n"))
    blocked = rows.join(F.broadcast(start), "first").select("id", "u", "lists", F.floor(at / LIST_ROWS).cast("int").alias("blk"))
    e = blocked.groupBy("blk").agg(F.collect_list(F.struct("id", "u", "lists")).alias("e"))
    return cut_lineage(e.select("blk", F.col("e.id").alias("ids"), F.flatten("e.u").alias("u"), F.flatten("e.lists").alias("lists")), "list_blocks")


def _list_kernel(k: int, pivots: np.ndarray, probes: int):
    """Pairs of blocks -> candidates. A row is compared with the rows of the
    lists that it probes; a task hands on ``k`` per row that it met, at its end."""
    def column(t, name, i, kind):
        return np.asarray(t.column(name)[i].values.fill_null(NO_ID if kind is np.int64 else 0), kind)

    def run(batches):
        best: dict = {}
        seen, ids, u, asks = None, None, None, None
        for t in batches:
            for i, lo in enumerate(t.column("a_blk").to_pylist()):
                if seen != lo:
                    seen, ids = lo, column(t, "a_ids", i, np.int64)
                    u = column(t, "a_u", i, np.float64).reshape(len(ids), -1)
                    asks = np.zeros((len(ids), len(pivots)), bool)
                    asks[np.arange(len(ids))[:, None], _order(u, pivots, probes)] = True
                other = column(t, "b_ids", i, np.int64)
                lists = column(t, "b_lists", i, np.int32).reshape(len(other), -1)
                if not asks[:, np.unique(lists)].any():
                    continue
                met = asks[:, lists[:, 0]]
                for c in range(1, lists.shape[1]):
                    met |= asks[:, lists[:, c]]
                S = u @ column(t, "b_u", i, np.float64).reshape(len(other), -1).T
                S[~met] = 0.0
                best.setdefault(lo, _Best(ids, k, False)).add(S, other, ids[:, None] == other[None, :])
        for found in best.values():
            cols = found.rows()
            if len(cols[0]):
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64()),
                                                  pa.array(cols[3], pa.string())], _KERNEL_SCHEMA.fieldNames())
    return run


def cosine_topk_approx(emb: DataFrame, k: int = TOP_K, id_col: str = "vec_id", vec_col: str = "embedding",
                       recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """(id, rank, other_id, score): up to ``k`` nearest other rows by cosine,
    positive ones only, of which about ``recall`` are the true ones. Ids are
    unique. An empty table gives an empty result."""
    spark = emb.sparkSession
    unit = cut_lineage(unit_vectors(emb, id_col, vec_col), "unit_vectors")
    n = unit.count()
    if not n:
        return spark.createDataFrame([], "id long, rank int, other_id long, score double")
    pivots = np.stack(_drawn(unit, "pivot", min(MAX_PIVOTS, math.ceil(PIVOTS_PER_ROOT * math.sqrt(n))))["u"].to_list())
    listed = cut_lineage(with_pivots(unit, pivots, min(len(pivots), ASSIGN)), "pivot_lists")
    probes = probes_needed(listed, unit, pivots, k, recall, sample)
    blocks = packed_lists(listed)
    side = lambda name: blocks.select(*[F.col(c).alias(f"{name}_{c}") for c in blocks.columns])
    asking = side("a").repartition(min(num_blocks(n, LIST_ROWS), 4 * spark.sparkContext.defaultParallelism), "a_blk")
    met = asking.crossJoin(side("b")).mapInArrow(_list_kernel(k, pivots, probes), _KERNEL_SCHEMA)
    cands = met.groupBy("id", "other_id").agg(F.max("score").alias("score"))     # an id may stand on several rows
    return rank_neighbours(cands, k).select("id", "rank", "other_id", "score")
