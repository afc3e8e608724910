"""Exact top-k by inner product, by a uniform threshold in three phases.

Vectors are held in segments of their components; a segment's list gives each
vector's share of the score (its local score), and a score is the sum of the
shares. For a block of queries:

1. each segment's list gives its ``k`` best entries; those vectors' scores are
   resolved, and the k-th best of them is a floor ``t`` under the answer;
2. a score of at least ``t`` has a share of at least ``t / segments``, so that
   cutoff is broadcast and every list hands over all its entries from it on;
   entries of one vector are summed, the floor is raised to the k-th best of the
   vectors that every list gave, and vectors are dropped whose shares, with less
   than the cutoff for each list that did not give them, cannot reach it;
3. the scores of the vectors that remain are resolved exactly.

Shares may be negative; the argument needs none of them to be positive. Scores
are integers, computed exactly.

Equal vectors have equal scores, so only the ``k + 1`` smallest ids among equal
vectors can be in an answer (one may be the query itself): the others are left
out before the lists are made, and equal queries are answered once. So a crowd
of copies costs what one vector costs.

Queries go in blocks of ``QUERY_BLOCK``, which bounds what is broadcast; vectors
stay where they are written, each task scans its part of a segment's column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagwise.llm.places import with_places
from tagwise.llm.ship import Shipped
from tagwise.session import cut_lineage

K = 10
SCALE = 1024
SEGMENTS = 2
QUERY_BLOCK = 8192      # queries met by one pass over the lists
ROWS, QUERIES = 4096, 512       # of one product inside a task
MOST = 2.0 ** 58        # squared norm below which sums of shares fit a long
EXACT = 2 ** 53         # integers that doubles hold
LOWEST = -(2 ** 59)     # below every share


def integer_vectors(vectors: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """``row`` (a number of its own), ``id``, ``vec`` array<long>: floor of
    ``scale`` times each component, as a double. Null vectors and those with null
    or non-finite components are left out, as are those whose squared norm
    passes 2**58 (sums of their shares may not fit a long)."""
    x = F.col("raw")
    finite = F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    base = (vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("raw"))
            .where(x.isNotNull()).where(finite)
            .where(F.aggregate(x, F.lit(0.0), lambda a, v: a + F.pow(v * scale, F.lit(2.0))) < MOST))
    return base.select(F.monotonically_increasing_id().alias("row"), "id", F.transform(x, lambda v: F.floor(v * scale)).cast("array<long>").alias("vec"))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two integer tables, as exact longs."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if int(np.abs(a).max()) * int(np.abs(b).max()) * a.shape[1] < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _segment(vec, s: int, segments: int):
    """The components of segment ``s``."""
    cut = lambda i: F.floor(F.size(vec) * F.lit(i) / F.lit(segments)).cast("int")
    return F.slice(vec, cut(s) + 1, cut(s + 1) - cut(s))


def _matrices(parts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, indexes, table) for each width among the lists."""
    parts = parts.combine_chunks() if isinstance(parts, pa.ChunkedArray) else parts
    width = np.diff(parts.offsets.to_numpy())
    values = parts.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    begin = parts.offsets.to_numpy()[:-1] - parts.offsets.to_numpy()[0]
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        yield int(w), at, values[begin[at][:, None] + np.arange(w)]


class QueryBlock:
    """At most ``QUERY_BLOCK`` queries: by vector length, their numbers and
    components; ``cut``: per number the least share that counts."""

    def __init__(self, numbers: np.ndarray, vecs: pa.Array, segments: int, cut: np.ndarray | None = None):
        self.by_dim = {w: (numbers[at], table) for w, at, table in _matrices(vecs)}
        self.segments, self.cut, self.first = segments, cut, int(numbers.min())

    def segment(self, dim: int, s: int) -> tuple[np.ndarray, np.ndarray]:
        numbers, table = self.by_dim.get(dim, (np.zeros(0, np.int64), np.zeros((0, dim), np.int64)))
        return numbers, table[:, dim * s // self.segments:dim * (s + 1) // self.segments]


def _chunks(batches: Iterator[pa.RecordBatch], block: QueryBlock, s: int):
    """(query numbers, rows, shares) for each block of queries and of rows."""
    for b in batches:
        dims, rows = b.column("dim").to_numpy(), b.column("row").to_numpy()
        for dim in np.unique(dims):
            mine = np.flatnonzero(dims == dim)
            numbers, q = block.segment(int(dim), s)
            if not len(numbers):
                continue
            _, _, table = next(_matrices(b.column("part").take(pa.array(mine))))
            for r in range(0, len(mine), ROWS):
                for i in range(0, len(numbers), QUERIES):
                    yield numbers[i:i + QUERIES], rows[mine[r:r + ROWS]], products(q[i:i + QUERIES], table[r:r + ROWS])


ENTRY = "query long, row long, share long"


def _entries(query, row, share) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x), pa.int64()) for x in (query, row, share)], ["query", "row", "share"])


def _best_of_list(shipped: Shipped, s: int, k: int):
    """Phase 1 in a task: the k largest shares of each query."""
    def run(batches):
        held: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for numbers, rows, shares in _chunks(batches, shipped.get(), s):
            at = np.argpartition(-shares, k - 1, axis=1)[:, :k] if shares.shape[1] > k else np.tile(np.arange(shares.shape[1]), (len(shares), 1))
            best, who = np.take_along_axis(shares, at, axis=1), rows[at]
            if (old := held.get(int(numbers[0]))) is not None:
                best, who = np.concatenate([old[1], best], axis=1), np.concatenate([old[2], who], axis=1)
                if best.shape[1] > k:
                    at = np.argpartition(-best, k - 1, axis=1)[:, :k]
                    best, who = np.take_along_axis(best, at, axis=1), np.take_along_axis(who, at, axis=1)
            held[int(numbers[0])] = (numbers, best, who)
        for numbers, best, who in held.values():
            yield _entries(np.repeat(numbers, best.shape[1]), who.ravel(), best.ravel())
    return run


def _from_cutoff(shipped: Shipped, s: int):
    """Phase 2 in a task: all shares from the cutoff on."""
    def run(batches):
        block = shipped.get()
        for numbers, rows, shares in _chunks(batches, block, s):
            q, r = np.nonzero(shares >= block.cut[numbers - block.first][:, None])
            if len(q):
                yield _entries(numbers[q], rows[r], shares[q, r])
    return run


def _resolve(shipped: Shipped):
    """Exact scores of (query, row) pairs that carry the row's vector."""
    def run(batches):
        block = shipped.get()
        for b in batches:
            query, row = b.column("query").to_numpy(), b.column("row").to_numpy()
            score = np.zeros(len(query), np.int64)
            for w, at, table in _matrices(b.column("vec")):
                numbers, q = block.by_dim[w]
                for i in range(0, len(at), ROWS):
                    some = at[i:i + ROWS]
                    a, v = q[np.searchsorted(numbers, query[some])], table[i:i + ROWS]
                    score[some] = np.einsum("ij,ij->i", a, v)
            yield _entries(query, row, score)
    return run


def _kth(scored: DataFrame, k: int) -> DataFrame:
    """``query, floor``: the k-th largest score, for queries that have so many."""
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.col("share").desc(), "row"))
    return scored.withColumn("nth", nth).where(F.col("nth") <= k).where(F.col("nth") == k).select("query", F.col("share").alias("floor"))


def _answer(block: DataFrame, lists: list[DataFrame], vectors: DataFrame, k: int) -> DataFrame:
    """``query, found``: the k best (row, id, score) of one block of queries."""
    spark, segments = block.sparkSession, len(lists)
    held = block.orderBy("query").toArrow()         # at most QUERY_BLOCK rows
    numbers, vecs = held.column("query").to_numpy(), held.column("vec")
    asked = Shipped(spark, QueryBlock(numbers, vecs, segments))
    resolved = lambda pairs: (pairs.select("query", "row").join(vectors.select("row", "vec"), "row")
                              .select("query", "row", "vec").mapInArrow(_resolve(asked), ENTRY))
    # phase 1
    nth = F.row_number().over(Window.partitionBy("segment", "query").orderBy(F.col("share").desc(), "row"))
    top = None
    for s, part in enumerate(lists):
        one = part.mapInArrow(_best_of_list(asked, s, k), ENTRY).withColumn("segment", F.lit(s))
        top = one if top is None else top.unionByName(one)
    first = top.withColumn("nth", nth).where(F.col("nth") <= k).select("query", "row").distinct()
    floors = np.full(int(numbers.max()) - int(numbers.min()) + 1, LOWEST, object)
    for r in _kth(resolved(first), k).toLocalIterator():        # one number per query
        floors[r["query"] - int(numbers.min())] = r["floor"]
    cut = np.array([LOWEST if f == LOWEST else -((-int(f)) // segments) for f in floors], np.int64)
    # phase 2
    cutting = Shipped(spark, QueryBlock(numbers, vecs, segments, cut))
    handed = None
    for s, part in enumerate(lists):
        one = part.mapInArrow(_from_cutoff(cutting, s), ENTRY)
        handed = one if handed is None else handed.unionByName(one)
    known = cut_lineage(handed.groupBy("query", "row").agg(F.sum("share").alias("share"), F.count(F.lit(1)).alias("given")), "topk-known")
    limits = spark.createDataFrame([(int(n), int(cut[n - numbers[0]]), None if floors[n - numbers[0]] == LOWEST else int(floors[n - numbers[0]])) for n in numbers],
                                   "query long, cut long, floor long")
    raised = (limits.join(_kth(known.where(F.col("given") == segments), k).withColumnRenamed("floor", "seen"), "query", "left")
              .select("query", "cut", F.greatest("floor", "seen").alias("floor")))
    most = F.col("share") + (segments - F.col("given")) * (F.col("cut") - 1)
    left = known.join(F.broadcast(raised), "query").where(F.col("floor").isNull() | (most >= F.col("floor")))
    # phase 3
    best = Window.partitionBy("query").orderBy(F.col("share").desc(), F.col("id").asc_nulls_last(), "row")
    final = (resolved(left).join(vectors.select("row", "id"), "row")
             .withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k))
    return cut_lineage(final.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("nth", "row", "id", F.col("share").alias("score")))).alias("found")), "topk-found")


def search(vectors: DataFrame, is_query, k: int = K, key: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
           segments: int = SEGMENTS) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``vectors`` for which
    ``is_query`` (a function of the id column) holds, the ``k`` other rows with the
    highest integer inner products (all, if fewer), ties to the smaller id (null
    ids last).

    Every row is an answer for every other one, also one with the same id;
    repeated query rows are answered each. Rows of different vector lengths
    don't meet. Null ids are no queries; for vectors that take no part see
    ``integer_vectors``. Other columns of ``vectors`` are not read. Empty table:
    empty result."""
    rows = cut_lineage(integer_vectors(vectors, key, vector, scale), "topk-vectors")
    alike = Window.partitionBy("vec").orderBy(F.col("id").asc_nulls_last(), "row")
    few = rows.withColumn("nth", F.row_number().over(alike)).where(F.col("nth") <= k + 1)
    few = cut_lineage(few.select("row", "id", F.size("vec").alias("dim"), "vec", *[_segment(F.col("vec"), s, segments).alias(f"s{s}") for s in range(segments)]), "topk-lists")
    lists = [few.select("row", "dim", F.col(f"s{s}").alias("part")) for s in range(segments)]
    asking = rows.where(is_query(F.col("id")))
    distinct, _ = with_places(asking.select("vec").distinct(), ["vec"], name="topk-queries")
    distinct = cut_lineage(distinct.select(F.col("place").alias("query"), "vec"), "topk-blocks")
    n, found = distinct.count(), None
    for begin in range(0, n, QUERY_BLOCK):
        part = _answer(distinct.where(F.col("query").between(begin, begin + QUERY_BLOCK - 1)), lists, few, k + 1)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    own = asking.join(distinct, "vec").select("row", "id", "query").join(found, "query")
    others = F.slice(F.filter("found", lambda f: f["row"] != F.col("row")), 1, k)
    return (own.select(F.col("id").alias("query_id"), F.posexplode(others).alias("at", "hit"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score")))
