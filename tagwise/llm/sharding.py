"""Sharding by a hypergeometric communication matrix (law ``rows``).

Rows fall into virtual partitions by a hash. How many rows partition i sends
to shard s is drawn from the multivariate hypergeometric law, given the places
that the partitions before left, so shard sizes are exact (at most one apart)
and every assignment is as likely as under one global shuffle. Rows are
permuted within their partition (which of them go where), exchanged, and
permuted again within their shard. The permutations order by seeded hashes,
so a lost task comes back with the same rows.

The matrix has (partitions x shards) cells, bounded by parameters and not by
the rows; only it is made on the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagwise.llm.columns import set_aside

N_SHARDS = 40
SEED = 7_001


NUMPY_MOST = 1_000_000_000      # numpy's sampler takes populations below this
WINDOW = 40                     # standard deviations; beyond lies less than doubles can tell from 0


def hypergeometric(rng, good: int, bad: int, n: int, most: int = NUMPY_MOST) -> int:
    """How many of ``n`` draws without replacement are good, for a population of
    any size. Beyond numpy's range the law's own probabilities are summed
    around the mode, each from its neighbour by their exact ratio, and one
    uniform number picks among them."""
    if not bad:
        return n
    if good + bad < most:
        return int(rng.hypergeometric(good, bad, n))
    lo, hi = max(0, n - bad), min(n, good)
    mode = min(hi, max(lo, (n + 1) * (good + 1) // (good + bad + 2)))
    p = good / (good + bad)
    reach = int(WINDOW * (n * p * (1 - p) * (good + bad - n) / max(1, good + bad - 1)) ** 0.5) + WINDOW
    k = np.arange(max(lo, mode - reach), min(hi, mode + reach) + 1)
    a = k[:-1].astype(np.float64)
    step = np.log((good - a) * (n - a)) - np.log((a + 1) * (float(bad - n) + a + 1))       # log of p(k + 1) / p(k)
    logp = np.concatenate([[0.0], np.cumsum(step)])
    upto = np.cumsum(np.exp(logp - logp.max()))
    return int(k[min(len(k) - 1, np.searchsorted(upto, rng.random() * upto[-1], side="right"))])


def communication_matrix(counts: np.ndarray, n_shards: int, seed: int) -> np.ndarray:
    """Rows per (partition, shard): row sums are ``counts``, column sums are
    at most one apart."""
    total = int(counts.sum())
    places = np.full(n_shards, total // n_shards, np.int64)
    places[:total % n_shards] += 1
    rng = np.random.default_rng(seed)
    out = np.zeros((len(counts), n_shards), np.int64)
    for i, n in enumerate(counts):
        left = int(n)
        pool = int(places.sum())
        for s in range(n_shards):       # conditional draws, one shard after another
            pool -= int(places[s])
            if places[s] and left:
                k = hypergeometric(rng, int(places[s]), pool, left)
            else:
                k = 0
            out[i, s] = k
            left -= k
        places -= out[i]
    return out


def shard(docs: DataFrame, n_shards: int = N_SHARDS, n_parts: int | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` with ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from
    0 within the shard); columns of these names are replaced, all others
    come back as they are.

    Null ids and texts take part like any value. Rows that are equal in
    doc_id and text are interchangeable, and each keeps a place of its own.
    Empty table: empty result."""
    spark = docs.sparkSession
    n_parts = n_parts or max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    aside, back = set_aside(docs.drop("shard", "slot"), ["_crc", "_part", "_first", "_again", "_at", "_upto", "_cell", "_in", "_start"])
    crc = F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")))
    h = lambda k: F.xxhash64(F.lit(seed + k), F.col("doc_id"), F.col("_crc"))
    base = (aside.withColumn("_crc", crc)
            .withColumn("_part", F.pmod(h(0), F.lit(n_parts)).cast("int"))
            .withColumn("_first", h(1)).withColumn("_again", h(2)))
    per = {r["_part"]: r["n"] for r in base.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = np.array([per.get(i, 0) for i in range(n_parts)], np.int64)
    matrix = communication_matrix(counts, n_shards, seed)
    upto = spark.createDataFrame([(i, [int(x) for x in np.cumsum(matrix[i])]) for i in range(n_parts)],
                                 "_part int, _upto array<long>")
    local = Window.partitionBy("_part").orderBy("_first", "doc_id", "_crc")
    sent = (base.withColumn("_at", F.row_number().over(local) - 1)
            .join(F.broadcast(upto), "_part")      # n_parts rows of n_shards numbers
            .withColumn("shard", F.size(F.filter("_upto", lambda x: x <= F.col("_at"))).cast("int")))
    sent = sent.drop("_upto", "_at", "_part", "_first")
    # permute again: cells of the second hash bound what one task sorts
    n_cells = max(1, n_parts // n_shards)
    width = (1 << 62) // n_cells * 4
    cell = sent.withColumn("_cell", F.floor((F.shiftrightunsigned("_again", 2)) / F.lit(width // 4)).cast("int"))
    cells = cell.groupBy("shard", "_cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    start = cells.select("shard", "_cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    inner = Window.partitionBy("shard", "_cell").orderBy("_again", "doc_id", "_crc")
    return (cell.withColumn("_in", F.row_number().over(inner) - 1)
            .join(F.broadcast(start), ["shard", "_cell"])   # about n_parts rows
            .withColumn("slot", (F.col("_start") + F.col("_in")).cast("long"))
            .select(*back, "shard", "slot"))
