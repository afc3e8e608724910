"""Embedding near-duplicates by a pivot-permutation index.

Vectors are described by their nearest reference points (pivots) in order.
The inverted list of a pivot holds the vectors that have it among their
``N_NEAR`` nearest; two vectors are candidates when they share ``MIN_SHARED``
of these pivots or more, and every candidate is verified by its cosine in
double precision. (Of the two tests on the pairs of a list the cheaper runs
first: a single-precision product with a margin, then the shared pivots, then
the exact cosine. They commute.)

The pivots are a sample of the table, bounded by ``MAX_PIVOTS`` and chosen by
hash; every vector is indexed. Lists are cut into blocks of ``BLOCK`` rows and
each pair of blocks of a list is one unit of work, so no task holds more than
two blocks however many vectors crowd around a pivot. A candidate that several
lists hold is worked on in the list of the smallest shared pivot only. Equal
vectors are one entry of the index (keyed by a 64-bit hash of the vector). Of
verified links a task hands on each vector's number of links, and edges of a
spanning forest of its block pair, so a crowd of near copies costs as many rows
as it has members, not as it has pairs.

Where more than ``N_NEAR`` pivots lie close together, a crowd of the table holds
them, and its members' nearest pivots are a draw among almost equal ones. Such
pivots are put under one centre (their mean direction), centres being apart from
one another. A vector within ``HOME`` of a centre has its home there and leaves
the pivot lists; a centre's list holds its homes and, as visitors, the vectors
within ``HOME`` plus the angle of the least cosine. By the triangle inequality
these are all that can link with a home, so every pair with a home is compared,
in the list of the smaller home, without the test on shared pivots.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwise.llm.graph import connected_components
from tagwise.llm.ship import Shipped
from tagwise.session import cut_lineage

MIN_COSINE = 0.9
MAX_PIVOTS = 1024
N_NEAR, MIN_SHARED = 20, 2
CLOSE = 0.6                     # cosine of pivots that count as close together
HOME = np.arccos(np.sqrt(0.5))  # a crowd's members are this near to its centre
BLOCK = 2048
SEED = 4_242


def _matrix(col, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Values in double precision, and which rows are usable: not null, of the
    table's length, finite, not zero."""
    rows = col.to_pylist()
    ok = np.array([r is not None and len(r) == dim and None not in r for r in rows], bool)
    x = np.zeros((len(rows), dim))
    if ok.any():
        x[ok] = np.array([r for r, k in zip(rows, ok) if k], np.float64)
    ok &= np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
    return x, ok


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, which keeps the squares in range."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _centres(pivots: np.ndarray) -> np.ndarray:
    """Centres of the groups of more than ``N_NEAR`` pivots that are close to
    one of them; the largest group first, its pivots taken out."""
    close, out = pivots @ pivots.T >= CLOSE, []
    while True:
        size = close.sum(axis=1)
        if not len(size) or size.max() <= N_NEAR:
            return np.array(out).reshape(len(out), pivots.shape[1])
        group = close[size.argmax()].copy()
        out.append(_unit(pivots[group].sum(axis=0)[None, :])[0])
        close[group] = False
        close[:, group] = False


def _int_lists(rows: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """``values`` as one list per row; ``rows`` ascend."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.astype(np.int32)))


def _describe(shared, dim: int, kind: str, least: float):
    """Usable vectors (packed) with their nearest pivots, nearest first, their
    home (-1: none) and the centres they visit."""
    reach = min(np.pi, HOME + np.arccos(np.clip(least, -1, 1)) + 1e-6)

    def run(batches):
        pivots, centres = shared.get()
        k = min(N_NEAR, len(pivots))
        for t in batches:
            x, ok = _matrix(t.column("embedding"), dim)
            x = x[ok]
            u = _unit(x) if len(x) else x
            near = np.argsort(-(u @ pivots.T), axis=1, kind="stable")[:, :k]
            home, visits = np.full(len(x), -1), np.zeros((len(x), len(centres)), bool)
            if len(centres) and len(x):
                at = u @ centres.T
                best = at.argmax(axis=1)
                home = np.where(at[np.arange(len(x)), best] >= np.cos(HOME), best, -1)
                # a pair of two homes belongs to the smaller one
                visits = (at >= np.cos(reach)) & ((home < 0)[:, None] | (np.arange(len(centres)) < home[:, None]))
            yield pa.RecordBatch.from_arrays(
                [t.column("key").filter(pa.array(ok)), t.column("size").filter(pa.array(ok)),
                 pa.array([v.tobytes() for v in x.astype(kind)], pa.binary()),
                 _int_lists(np.repeat(np.arange(len(x)), k), near.ravel(), len(x)),
                 pa.array(home.astype(np.int32)), _int_lists(*np.nonzero(visits), len(x))],
                ["key", "size", "vec", "near", "home", "visits"])
    return run


def _verify(least: float, kind: str):
    """Verified links of one pair of blocks of one list; lists of centres have
    numbers below zero."""
    def run(key, table):
        pivot, i, j = (k.as_py() for k in key)
        side = table.column("block").to_numpy()
        ids, size = table.column("key").to_numpy(), table.column("size").to_numpy()
        x = _unit(np.frombuffer(b"".join(table.column("vec").to_pylist()), kind).reshape(len(ids), -1).astype(np.float64))
        flat = table.column("near").combine_chunks().flatten() if table.num_rows else None
        near = flat.to_numpy().reshape(len(ids), -1)
        a, b = np.flatnonzero(side == i), np.flatnonzero(side == j)
        f = x.astype(np.float32)
        ok = f[a] @ f[b].T >= least - 1e-4
        if i == j:
            ok &= ids[a][:, None] < ids[b][None, :]
        r, c = np.nonzero(ok)
        r, c = a[r], b[c]
        hit = np.zeros(len(r), bool)
        for k in range(0, len(r), 20_000):
            p, q = r[k:k + 20_000], c[k:k + 20_000]
            hit[k:k + 20_000] = np.einsum("ij,ij->i", x[p], x[q]) >= least
            if pivot < 0:
                continue
            common = (near[p][:, :, None] == near[q][:, None, :]).any(axis=2)
            first = np.where(common, near[p], 1 << 30).min(axis=1)       # the list that works on this pair
            hit[k:k + 20_000] &= (common.sum(axis=1) >= min(MIN_SHARED, near.shape[1])) & (first == pivot)
        r, c = r[hit], c[hit]
        linked = np.bincount(r, size[c], len(ids)) + np.bincount(c, size[r], len(ids))
        root = _forest(len(ids), r, c)
        some = np.flatnonzero(linked)
        return pa.table({"key": pa.array(ids[some]), "linked": pa.array(linked[some].astype(np.int64)),
                         "root": pa.array(ids[root[some]])})
    return run


def _forest(n: int, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Smallest position that each of ``n`` positions reaches by links (r, c)."""
    root = np.arange(n)
    while len(r):
        low = np.minimum(root[r], root[c])
        new = root.copy()
        np.minimum.at(new, r, low)
        np.minimum.at(new, c, low)
        np.minimum.at(new, root[r], low)
        np.minimum.at(new, root[c], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def near_duplicates(vectors: DataFrame, least: float = MIN_COSINE, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``vectors``
    (``vec_id``, ``embedding``; other columns are ignored).

    Vectors that are null, zero, of another length than most, or hold null or
    non-finite values link with nothing. Rows with equal vectors link with one
    another. A null vec_id counts for links but never names a component. An
    empty table gives an empty result."""
    spark = vectors.sparkSession
    raw = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    dims = raw.where("embedding is not null").groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    dim = dims[0]["d"] if dims else 0
    # equal vectors share one key: the smallest row number by id
    same = raw.groupBy("embedding").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("size"))
    classes = cut_lineage(same.withColumn("key", F.xxhash64("embedding")), "vectors")
    usable = classes.where("embedding is not null")
    sample = (usable.where(F.size("embedding") == dim).orderBy(F.xxhash64(F.lit(SEED), "key"), "key").limit(max_pivots)
              .select("embedding").toArrow().column("embedding"))
    x, ok = _matrix(sample, dim)
    pivots = _unit(x[ok]) if ok.any() else np.zeros((1, max(dim, 1)))
    kind = "<f4" if dict(vectors.dtypes)["embedding"] == "array<float>" else "<f8"
    index = cut_lineage(usable.select("key", "size", "embedding").mapInArrow(
        _describe(Shipped(spark, (pivots, _centres(pivots))), max(dim, 1), kind, least),
        "key long, size long, vec binary, near array<int>, home int, visits array<int>"), "index")

    # lists of pivots (0, 1, ..) and of centres (-1, -2, ..); visitors meet homes only
    centre = F.transform("visits", lambda c: F.struct((-1 - c).alias("pivot"), F.lit(True).alias("visitor")))
    own = F.when(F.col("home") < 0, F.transform("near", lambda p: F.struct(p.alias("pivot"), F.lit(False).alias("visitor")))).otherwise(
        F.array(F.struct((-1 - F.col("home")).alias("pivot"), F.lit(False).alias("visitor"))))
    lists = index.select("key", "size", "vec", "near", F.inline(F.concat(own, centre)))
    blocks = lambda n: F.ceil(F.count_if(n) / BLOCK).cast("int")
    sizes = lists.groupBy("pivot").agg(blocks(~F.col("visitor")).alias("own"), blocks(F.col("visitor")).alias("visiting")).where("own > 0")
    hashed = F.xxhash64("key", F.lit(SEED))
    lists = (lists.join(F.broadcast(sizes), "pivot")      # one row per list
             .withColumn("block", F.when(F.col("visitor"), F.col("own") + F.pmod(hashed, F.col("visiting")))
                         .otherwise(F.pmod(hashed, F.col("own"))).cast("int"))
             .withColumn("others", F.col("own") + F.when(F.col("visitor"), 0).otherwise(F.col("visiting"))))
    work = lists.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("others") - 1))).select(
        "pivot", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "key", "size", "vec", "near")
    found = cut_lineage(work.groupBy("pivot", "i", "j").applyInArrow(_verify(least, kind), "key long, linked long, root long"), "links")
    links = found.groupBy("key").agg(F.sum("linked").alias("linked"))
    comp = connected_components(found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    named = (classes.select("key", "size", "least_id").join(index.select("key", F.lit(True).alias("good")), "key", "left")
             .join(links, "key", "left").join(comp.withColumnRenamed("node", "key"), "key", "left")
             .withColumn("label", F.coalesce("label", "key")))
    least_id = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    by_class = (named.where("good").join(least_id, "label")
                .select("key", (F.coalesce("linked", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id"))
    out = raw.select("vec_id", F.when(F.col("embedding").isNotNull(), F.xxhash64("embedding")).alias("key")).join(by_class, "key", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
