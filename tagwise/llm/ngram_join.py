"""N-gram Jaccard join by set-relation skipping.

Plan (theta = 0.75, whole texts, every set indexed):

1. Each text becomes its set of 64-bit shingle hashes; equal sets are one
   *class* from here on (key: 128-bit digest of the set), so copies cost one
   row each.
2. The global order of shingles is: the low 3/8 of the hash range first, by
   how many classes hold them, then the rest by hash. Document frequencies
   are counted for the low range only; tasks send packed blobs of hashes to
   ``n_buckets`` buckets and only shingles that two classes or more hold come
   back. A class that has more unshared shingles than a quarter of its set
   has no partner and leaves here; this drops nearly all unrelated texts.
3. Index lists (shingle -> class, position) hold the order's prefix of each
   remaining set. The remaining sets are counted once more over the whole
   hash range: a set can't share more than its ``cap`` shingles that other
   sets hold. **Index-level skip:** lists are cut into blocks by size band and
   keep each block's best remaining length and cap, so a block is skipped when
   no position in it can reach the needed overlap.
4. **Answer-level skip:** each set is first compared with one centre of its
   lists only, the one with the least share of shingles of its own (linear, no
   pairs within a group); linked sets form groups. What remains are pairs of
   groups that share a list: their centres are compared once, and the answers
   of the members are derived from the centres':
   |x n y| <= |cx n cy| + |x - cx| + |y - cy|, where of x - cx only shingles
   count that some other set holds. Member pairs that this bound can't decide
   are compared themselves, first with one member of the larger group, then,
   where the groups are still apart, all of them.

Links are verified on whole sets with ``array_intersect`` in the JVM.

5. The number of links of each class: every link lies inside a component, and
   its two sizes are in the same or in neighbouring bands (powers of 4/3). A
   component's band is cut into blocks, which meet one another and the blocks of
   the next band; each pair of blocks is one unit of work, counts all its
   intersections at once, and hands on one row per class, not per pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwise.llm.graph import connected_components
from tagwise.llm.vectext import mix, shingle_sets
from tagwise.session import cut_lineage

WIDTH = 5
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20      # classes and shingles of a block of a component
FEW, COLUMNS = 12, 4096
PIECE = 1 << 19         # shingles that a task packs at a time
LOW = (1 << 64) // 8 * 3          # hashes below are counted: 3/8, above the quarter that the prefix needs


def _digest(u: np.ndarray) -> bytes:
    a = mix(u).sum(dtype=np.uint64)
    b = mix(u ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(u))
    return a.tobytes() + b.tobytes()


def _prefix(n: int) -> int:
    return n - (3 * n + 3) // 4 + 1


def _class_rows(width: int):
    def run(batches):
        for t in batches:
            n, low, sid = [], [], []
            for _, u in shingle_sets(t.column("text"), width):
                n.append(len(u))
                low.append(int(np.searchsorted(u, np.uint64(LOW))))
                sid.append(_digest(u) if len(u) else None)
            yield pa.RecordBatch.from_arrays(
                [t.column("doc_id"), t.column("th"), pa.array(n, pa.int64()), pa.array(low, pa.int64()),
                 pa.array(sid, pa.binary())], ["doc_id", "th", "n", "n_low", "sid"])
    return run


def _pack(sets, n_buckets: int) -> pa.RecordBatch:
    """One row per bucket of packed (shingle, class); ``sets`` has (digest,
    shingles) of distinct classes."""
    tok = np.concatenate([u for _, u in sets]) if sets else np.zeros(0, np.uint64)
    loc = np.repeat(np.arange(len(sets), dtype=np.uint32), [len(u) for _, u in sets])
    bucket = (tok % np.uint64(n_buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    tok, loc, bucket = tok[order], loc[order], bucket[order]
    cut = np.searchsorted(bucket, np.arange(n_buckets + 1))
    ids = np.frombuffer(b"".join(d for d, _ in sets), np.uint64).reshape(-1, 2)
    rows = []
    for k in np.flatnonzero(np.diff(cut)):
        s = slice(cut[k], cut[k + 1])
        uniq, inv = np.unique(loc[s], return_inverse=True)
        rows.append((int(k), tok[s].tobytes(), inv.astype(np.uint32).tobytes(), ids[uniq].tobytes()))
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), *[pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3)]],
        ["bucket", "tok", "loc", "ids"])


def _blob_rows(width: int, n_buckets: int):
    """The counted part of each distinct set, packed by pieces of a bounded
    number of shingles however long the texts of an Arrow batch are."""
    def run(batches):
        for t in batches:
            found, held = {}, 0
            for _, u in shingle_sets(t.column("text"), width):
                if len(u) and (d := _digest(u)) not in found:
                    found[d] = u[:max(int(np.searchsorted(u, np.uint64(LOW))), _prefix(len(u)))].copy()
                    held += len(found[d])
                    if held >= PIECE:
                        yield _pack(list(found.items()), n_buckets)
                        found, held = {}, 0
            if found:
                yield _pack(list(found.items()), n_buckets)
    return run


def _packed_sets(n_buckets: int):
    def run(batches):
        for t in batches:
            flat = t.column("toks").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            offs = np.concatenate([[0], np.cumsum(t.column("n").to_numpy(zero_copy_only=False))])
            yield _pack([(d, flat[offs[i]:offs[i + 1]]) for i, d in enumerate(t.column("sid").to_pylist())], n_buckets)
    return run


def _unpack(table: pa.Table):
    """Of one bucket: class digests, and the (shingle, class, number of
    classes that hold the shingle) entries that two classes or more share."""
    tok, cls, ids, n = [], [], [], 0
    for a, b, c in zip(*(table.column(k).to_pylist() for k in ("tok", "loc", "ids"))):
        tok.append(np.frombuffer(a, np.uint64))
        cls.append(np.frombuffer(b, np.uint32).astype(np.int64) + n)
        ids.append(np.frombuffer(c, np.uint64).reshape(-1, 2))
        n += len(ids[-1])
    tok, cls, ids = np.concatenate(tok), np.concatenate(cls), np.concatenate(ids)
    # number the classes by digest, so that copies from other batches are one
    o = np.lexsort((ids[:, 1], ids[:, 0]))
    new = np.ones(len(o), bool)
    new[1:] = (ids[o][1:] != ids[o][:-1]).any(axis=1)
    num = np.empty(len(o), np.int64)
    num[o] = np.cumsum(new) - 1
    ids, cls = ids[o][new], num[cls]
    o = np.lexsort((cls, tok))
    tok, cls = tok[o], cls[o]
    new = np.ones(len(tok), bool)
    new[1:] = (tok[1:] != tok[:-1]) | (cls[1:] != cls[:-1])
    tok, cls = tok[new], cls[new]
    head = np.flatnonzero(np.concatenate([[True], tok[1:] != tok[:-1]]))
    size = np.diff(np.append(head, len(tok)))
    df = np.repeat(size, size)
    return ids, tok[df >= 2], cls[df >= 2], df[df >= 2]


def _sids(ids: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(16), len(ids), [None, pa.py_buffer(ids.tobytes())]).cast(pa.binary())


def _shared(table: pa.Table) -> pa.Table:
    """Rows of the shared shingles of one bucket."""
    ids, tok, cls, df = _unpack(table)
    return pa.table({"token": pa.array(tok.view(np.int64)), "df": pa.array(df.astype(np.int64)),
                     "low": pa.array(tok < np.uint64(LOW)), "sid": _sids(ids[cls])})


def _shared_counts(n_parts: int):
    """How many shared shingles each class has in one bucket, packed in one
    row per part of the classes."""
    def run(table: pa.Table) -> pa.Table:
        ids, _, cls, _ = _unpack(table)
        n = np.bincount(cls, minlength=len(ids)).astype(np.int64)
        part = (ids[:, 0] % np.uint64(n_parts)).astype(np.int32)
        rows = [(int(k), ids[part == k].tobytes(), n[part == k].tobytes()) for k in np.unique(part)]
        return pa.table({"part": pa.array([r[0] for r in rows], pa.int32()), "ids": pa.array([r[1] for r in rows], pa.binary()),
                         "k": pa.array([r[2] for r in rows], pa.binary())})
    return run


def _sum_counts(table: pa.Table) -> pa.Table:
    """Shared shingles of each class of one part, over all buckets."""
    ids = np.frombuffer(b"".join(table.column("ids").to_pylist()), np.uint64).reshape(-1, 2)
    k = np.frombuffer(b"".join(table.column("k").to_pylist()), np.int64)
    order = np.lexsort((ids[:, 1], ids[:, 0]))
    ids, k = ids[order], k[order]
    head = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]).any(axis=1)]))
    return pa.table({"sid": _sids(ids[head]), "cap": pa.array(np.add.reduceat(k, head))})


def _set_rows(width: int):
    def run(batches):
        for t in batches:
            sets = [(_digest(u), u.view(np.int64)) for _, u in shingle_sets(t.column("text"), width)]
            offs = np.concatenate([[0], np.cumsum([len(u) for _, u in sets])]).astype(np.int32)
            vals = np.concatenate([u for _, u in sets]) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([d for d, _ in sets], pa.binary()),
                 pa.ListArray.from_arrays(pa.array(offs), pa.array(vals))], ["sid", "toks"])
    return run


def _linked(o: str, n: str, m: str):
    """Jaccard >= 3/4 in whole numbers: 100 o >= 75 (n + m - o)."""
    return F.col(o) * 7 >= (F.col(n) + F.col(m)) * 3


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) with both sizes and the size of the intersection."""
    s1 = sets.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("toks").alias("ta"))
    s2 = sets.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("toks").alias("tb"))
    return (pairs.select("a", "b").distinct().join(s1, "a").join(s2, "b")
            .select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).cast("long").alias("o")))


def _reachable(*caps, n):
    """Whether the least of some bounds of the overlap reaches what sizes that sum to ``n`` need."""
    return F.least(*caps, F.lit(1 << 60)) * 7 >= n * 3


def _intersections(rows: np.ndarray, toks: np.ndarray, n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets ``a`` with sets ``b`` (row numbers);
    (``rows``, ``toks``) are the entries of ``n`` sets."""
    order = np.lexsort((rows, toks))
    rows, toks = rows[order], toks[order]
    head = np.flatnonzero(np.concatenate([[True], toks[1:] != toks[:-1]]))
    df = np.diff(np.append(head, len(toks)))
    col, held = np.repeat(np.arange(len(df)), df), np.repeat(df, df)
    # shingles of few sets: their pairs one by one
    out = np.zeros((n, n), np.int32)
    few = (held >= 2) & (held <= FEW)
    r, c = rows[few], col[few]
    for d in range(1, FEW if len(r) else 0):
        same = c[d:] == c[:-d]
        np.add.at(out, (r[:-d][same], r[d:][same]), 1)
    out = (out + out.T)[np.ix_(a, b)].astype(np.float64)
    # the others: products of 0/1 matrices, some columns at a time
    r, c = rows[held > FEW], np.unique(col[held > FEW], return_inverse=True)[1]
    cuts = np.searchsorted(c, np.arange(0, (c[-1] if len(c) else -1) + 1 + COLUMNS, COLUMNS))
    for k in range(len(cuts) - 1):
        m = np.zeros((n, COLUMNS), np.float32)
        m[r[cuts[k]:cuts[k + 1]], c[cuts[k]:cuts[k + 1]] - k * COLUMNS] = 1
        out += m[a] @ m[b].T
    return out


def _count_links(key, table):
    """Rows that link with each class of one pair of blocks."""
    i, j = key[2].as_py(), key[3].as_py()
    side, size = table.column("block").to_numpy(), table.column("size").to_numpy().astype(np.float64)
    toks = table.column("toks").combine_chunks()
    n = toks.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    a, b = np.flatnonzero(side == i), np.flatnonzero(side == j)
    o = _intersections(np.repeat(np.arange(len(n)), n), toks.flatten().to_numpy(zero_copy_only=False), len(n), a, b)
    ok = 7 * o >= 3 * (n[a][:, None] + n[b][None, :])
    linked = np.zeros(len(n))
    if i == j:
        np.fill_diagonal(ok, False)
    else:
        linked[b] = size[a] @ ok
    linked[a] = ok @ size[b]
    some = np.flatnonzero(linked)
    return pa.table({"sid": table.column("sid").take(pa.array(some)), "linked": pa.array(linked[some].astype(np.int64))})


def _links_by_class(members: DataFrame) -> DataFrame:
    """``sid, linked``: rows of other classes that link with each class of
    ``members`` (``label, sid, n, size, toks``); classes without a link may lack."""
    band = F.floor(F.log("n") / F.log(F.lit(4 / 3))).cast("int")
    lists = members.withColumn("own_band", band).select("label", "sid", "n", "size", "toks", F.inline(F.array(
        F.struct(F.col("own_band").alias("band"), F.lit(False).alias("visitor")),
        F.struct((F.col("own_band") - 1).alias("band"), F.lit(True).alias("visitor")))))

    def blocks(which):
        return F.ceil(F.greatest(F.count_if(which) / BLOCK, F.sum(F.when(which, F.col("n")).otherwise(0)) / BLOCK_SHINGLES)).cast("int")
    sizes = (lists.groupBy("label", "band")
             .agg(blocks(~F.col("visitor")).alias("own"), blocks(F.col("visitor")).alias("visiting"), F.count(F.lit(1)).alias("rows"))
             .where("own > 0 and rows > 1").drop("rows"))
    hashed = F.xxhash64("sid", F.lit(WIDTH))
    lists = (lists.join(sizes, ["label", "band"])
             .withColumn("block", F.when(F.col("visitor"), F.col("own") + F.pmod(hashed, F.col("visiting")))
                         .otherwise(F.pmod(hashed, F.col("own"))).cast("int"))
             .withColumn("others", F.col("own") + F.when(F.col("visitor"), 0).otherwise(F.col("visiting"))))
    work = lists.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("others") - 1))).select(
        "label", "band", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "sid", "size", "toks")
    return (work.groupBy("label", "band", "i", "j").applyInArrow(_count_links, "sid binary, linked long")
            .groupBy("sid").agg(F.sum("linked").alias("linked")))


def jaccard_components(docs: DataFrame, width: int = WIDTH, n_buckets: int | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs``
    (``doc_id``, ``text``; other columns are ignored, so names can't clash).

    Two rows link at Jaccard >= 0.75 of their shingle sets; component_id is
    the smallest doc_id that links reach. Null or blank text: size 0, linked
    with nothing. Repeated rows each stay a row, copies share a component; a
    row whose doc_id is null counts for links, but never names a component
    (null where no member has an id, as for an unlinked row). Empty table:
    empty result."""
    return _by_row(*_join(docs, width, n_buckets)[:2])


def jaccard_links(docs: DataFrame, width: int = WIDTH, n_buckets: int | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links`` for each row of ``docs``:
    the rows of ``jaccard_components`` with the number of other rows that each
    links with, copies counted one by one (0 for null or blank text)."""
    rows, by_class, sets = _join(docs, width, n_buckets)
    by_class = cut_lineage(by_class, "components")
    linked = _links_by_class(by_class.where("in_group").select("label", "sid", "size").join(sets, "sid"))
    by_class = (by_class.join(linked, "sid", "left")
                .withColumn("n_links", F.coalesce("linked", F.lit(0)) + F.col("size") - 1))
    return _by_row(rows, by_class, F.coalesce("n_links", F.lit(0)).alias("n_links"))


def _by_row(rows: DataFrame, by_class: DataFrame, *more) -> DataFrame:
    return (rows.join(by_class, "sid", "left")
            .select("doc_id", rows.n.alias("n_shingles"),
                    F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), *more))


def _join(docs: DataFrame, width: int, n_buckets: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with their class; classes with rows, component and its least id;
    whole sets of the classes that may link."""
    spark = docs.sparkSession
    n_buckets = n_buckets or max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = text.withColumn("th", F.xxhash64("text"))
    rows = cut_lineage(keyed.mapInArrow(
        _class_rows(width), "doc_id long, th long, n long, n_low long, sid binary"), "classes")
    reps = (rows.where("sid is not null").groupBy("sid")
            .agg(F.min("doc_id").alias("least_id"), F.min(F.struct("th", "doc_id")).alias("at"),
                 F.first("n").alias("n"), F.first("n_low").alias("n_low"), F.count(F.lit(1)).alias("size")))

    # 2. document frequencies of the low range; only shared shingles return
    shared = (text.select("text").mapInArrow(_blob_rows(width, n_buckets), "bucket int, tok binary, loc binary, ids binary")
              .groupBy("bucket").applyInArrow(_shared, "token long, df long, low boolean, sid binary"))
    own = shared.groupBy("sid").agg(
        F.sort_array(F.collect_list(F.when(F.col("low"), F.struct("df", "token")))).alias("lows"),
        F.collect_list(F.when(~F.col("low"), F.col("token"))).alias("highs"))
    p = F.col("n") - F.floor((3 * F.col("n") + 3) / 4) + 1
    pre = (own.join(reps, "sid")
           .withColumn("uniq", F.col("n_low") - F.size("lows"))
           .withColumn("room", (p - F.col("uniq")).cast("int"))
           .where("room > 0")
           .select("sid", "n", F.concat(
               F.transform(F.slice("lows", F.lit(1), F.greatest("room", F.lit(0))),
                           lambda x, i: F.struct(x["token"].alias("token"), (F.col("uniq") + i).alias("pos"))),
               F.transform("highs", lambda x: F.struct(x.alias("token"), F.col("n_low").alias("pos")))).alias("pre")))
    post = cut_lineage(pre.select("sid", "n", F.explode("pre").alias("x"))
                       .select("sid", "n", "x.token", (F.col("n") - F.col("x.pos")).alias("rem")), "lists")

    # whole sets of the classes that are left; what each can share at most
    left = post.select("sid").distinct().join(reps, "sid").select("at.th", F.col("at.doc_id").alias("rid"))
    texts = keyed.join(left, (keyed.th == left.th) & keyed.doc_id.eqNullSafe(left.rid), "left_semi").select("text")
    sets = cut_lineage(texts.mapInArrow(_set_rows(width), "sid binary, toks array<long>")
                       .dropDuplicates(["sid"]).withColumn("n", F.size("toks").cast("long")), "sets")
    caps = cut_lineage(sets.mapInArrow(_packed_sets(n_buckets), "bucket int, tok binary, loc binary, ids binary")
                       .groupBy("bucket").applyInArrow(_shared_counts(n_buckets), "part int, ids binary, k binary")
                       .groupBy("part").applyInArrow(_sum_counts, "sid binary, cap long"), "caps")
    post = cut_lineage(post.join(caps, "sid").where(_reachable(F.col("cap"), n=F.col("n") + F.col("cap"))), "lists")

    # 4a. one centre per list, the class with the least share of its own: linear in the lists
    centre = post.groupBy("token").agg(F.min(F.struct(1 - F.col("cap") / F.col("n"), "sid", "n", "rem", "cap")).alias("c"))
    near = (post.join(centre, "token").where(F.col("sid") != F.col("c.sid"))
            .where(_reachable("rem", "c.rem", "cap", "c.cap", n=F.col("n") + F.col("c.n")))
            .select(F.col("c.sid").alias("a"), F.col("sid").alias("b")))
    links = cut_lineage(_overlaps(near, sets).where(_linked("o", "na", "nb")).select("a", "b"), "links")
    groups = connected_components(links)
    # a group is named by its most central class
    lead = (groups.join(post.select(F.col("sid").alias("node"), "cap", "n").distinct(), "node")
            .groupBy("label").agg(F.min(F.struct(1 - F.col("cap") / F.col("n"), "node"))["node"].alias("g")))
    groups = cut_lineage(groups.join(lead, "label").select(F.col("node").alias("sid"), "g"), "groups")

    # 4b. blocks of lists that hold several groups
    band = F.floor(F.log("n") / F.log(F.lit(4 / 3))).cast("int")
    with_g = (post.join(groups, "sid", "left").withColumn("g", F.coalesce("g", "sid")).withColumn("band", band))
    several = with_g.groupBy("token").agg(F.min("g").alias("lo"), F.max("g").alias("hi")).where("lo <> hi").select("token")
    open_lists = cut_lineage(with_g.join(several, "token", "left_semi"), "open-lists")
    block = open_lists.groupBy("token", "band", "g").agg(F.max(F.least("rem", "cap")).alias("cap"), F.min("n").alias("n"))
    b1 = block.select("token", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"),
                      F.col("g").alias("a"), F.col("cap").alias("ca"), F.col("n").alias("na"))
    b2 = block.select("token", "band", F.col("g").alias("b"), F.col("cap").alias("cb"), F.col("n").alias("nb"))
    met = (b1.join(b2, ["token", "band"]).where("a < b")
           .where(_reachable("ca", "cb", n=F.col("na") + F.col("nb"))).select("a", "b"))
    centres = cut_lineage(_overlaps(met, sets), "centres")
    links = links.union(centres.where(_linked("o", "na", "nb")).select("a", "b"))

    # 4c. derive the members' answers from the centres' where the bound decides
    # off: what a member can share with anyone, outside of its group's centre
    off = cut_lineage(_overlaps(groups.where("sid <> g").select(F.col("sid").alias("a"), F.col("g").alias("b")), sets)
                      .select(F.col("a").alias("sid"), F.col("b").alias("g"), "o", F.col("na").alias("n")).join(caps, "sid")
                      .select("sid", "g", "n", (F.col("cap") - F.col("o")).alias("off")), "off")
    spread = off.groupBy("g").agg(F.max("off").alias("off"), F.min("n").alias("n"))
    undecided = cut_lineage(
        centres.where(~_linked("o", "na", "nb"))
        .join(spread.select(F.col("g").alias("a"), F.col("off").alias("oa"), F.col("n").alias("ma")), "a", "left")
        .join(spread.select(F.col("g").alias("b"), F.col("off").alias("ob"), F.col("n").alias("mb")), "b", "left")
        .where("oa is not null or ob is not null")
        .where(_reachable(F.col("o") + F.coalesce("oa", F.lit(0)) + F.coalesce("ob", F.lit(0)),
                          n=F.least("na", F.coalesce("ma", "na")) + F.least("nb", F.coalesce("mb", "nb"))))
        .select("a", "b", "o"), "undecided")
    if undecided.limit(1).count():
        size = groups.groupBy("g").agg(F.count(F.lit(1)).alias("size"))
        pair = (undecided.join(size.select(F.col("g").alias("a"), F.col("size").alias("sa")), "a", "left")
                .join(size.select(F.col("g").alias("b"), F.col("size").alias("sb")), "b", "left"))
        large = F.coalesce("sa", F.lit(1)) >= F.coalesce("sb", F.lit(1))
        pair = pair.select(F.when(large, F.col("a")).otherwise(F.col("b")).alias("gx"),
                           F.when(large, F.col("b")).otherwise(F.col("a")).alias("gy"), "o")
        each = cut_lineage(
            open_lists.groupBy("sid", "g").agg(F.first("n").alias("n"), F.max(F.least("rem", "cap")).alias("cap"), F.collect_list("token").alias("tokens"))
            .join(off.select("sid", "off"), "sid", "left")
            .select("g", F.struct(F.coalesce("off", F.lit(0)).alias("off"), "sid", "n", "cap", "tokens").alias("m")), "members")

        def member_pairs(x, pair):
            """Pairs that the bounds leave open and that share a list, once each."""
            return (x.select(F.col("g").alias("gx"), F.col("m").alias("x")).join(pair, "gx")
                    .where(_reachable("x.cap", "cap_y", F.col("o") + F.col("x.off") + F.col("off_y"), n=F.col("x.n") + F.col("n_y")))
                    .join(each.select(F.col("g").alias("gy"), F.col("m").alias("y")), "gy")
                    .where(_reachable("x.cap", "y.cap", F.col("o") + F.col("x.off") + F.col("y.off"), n=F.col("x.n") + F.col("y.n")))
                    .where(F.arrays_overlap("x.tokens", "y.tokens"))
                    .select(F.col("x.sid").alias("a"), F.col("y.sid").alias("b")))

        # what the best member of the smaller group could do drops most members of the larger one at once
        best = each.groupBy(F.col("g").alias("gy")).agg(F.max("m.off").alias("off_y"), F.max("m.cap").alias("cap_y"), F.min("m.n").alias("n_y"))
        pair = pair.join(best, "gy")

        # one member of the larger group first, the one that can share most: linear; then what still is apart
        ahead = each.groupBy("g").agg(F.max_by("m", F.struct("m.off", "m.sid")).alias("m"))
        some = _overlaps(member_pairs(ahead, pair), sets).where(_linked("o", "na", "nb")).select("a", "b")
        links = cut_lineage(links.union(some), "links")
        now = connected_components(links)
        apart = (pair.join(now.toDF("gx", "lx"), "gx", "left").join(now.toDF("gy", "ly"), "gy", "left")
                 .where(F.coalesce("lx", "gx") != F.coalesce("ly", "gy")).drop("lx", "ly"))
        links = links.union(_overlaps(member_pairs(each, apart), sets).where(_linked("o", "na", "nb")).select("a", "b"))
    final = connected_components(links)

    # smallest doc_id of each component, by class first (copies combine map-side)
    named = (reps.select("sid", "least_id", "size").join(final.withColumnRenamed("node", "sid"), "sid", "left")
             .withColumn("in_group", F.col("label").isNotNull()).withColumn("label", F.coalesce("label", "sid")))
    least = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
    return rows, named.join(least, "label").select("sid", "label", "in_group", "size", "component_id"), sets


BUCKET_BYTES = 4 << 20      # text whose shingles one bucket takes


def buckets_for(docs: DataFrame) -> int:
    """Buckets that follow the data, so that what one task holds does not."""
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    return max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))


def keep_first(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """All columns of ``docs``, one document of each component: the one with
    its smallest doc_id. Rows that repeat this doc_id are the same document and
    stay; rows without an id are never dropped."""
    comp = jaccard_components(docs, width, buckets_for(docs))
    drop = comp.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(drop, "doc_id", "left_anti")
