"""Merkle dataset manifest, climbed by a recursive query.

Every record is a leaf. Each group's leaves, in order, are hashed in runs of
``arity`` until one node (the subroot) is left; the subroots, in order of their
groups, are hashed alike into the root.

The tree is stored as parent-linked rows: a row holds ``levels`` consecutive
levels above one stretch of ``arity ** levels`` nodes (one run with
``levels=1``), the row above it and its place there. To check a record, its
presented digest climbs: a Spark recursive query joins the climbers with the
row that holds them, appends the siblings met there and folds the digest
upwards, until a row has no parent. A step carries the climber and the
siblings of that step alone, so the work is rows x steps; a hot group only has
more rows in its tree, and every row of the tree is met by a bounded number of
leaves.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwise.llm.places import with_places
from tagwise.session import cut_lineage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
LEVELS = 5          # 243 nodes below one stored row
TOP = -1            # the tree of the subroots


@dataclass
class Manifest:
    """``leaves``: tree, place, key, leaf, claim, node, spot (the stored row
    above and the place in it); ``nodes``: node, parent, spot, levels;
    ``groups``: tree, the group's value, subroot; ``root``: None if there is
    no record."""
    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    root: str | None
    arity: int = ARITY


def digest_of(fields: Sequence[Column]) -> Column:
    """Lowercase hex sha256 of the fields: ``-`` for null, else UTF-8 byte
    count, ``:``, value."""
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in fields]), 256)


def _node(tree, level: int, at) -> Column:
    return F.concat_ws("/", tree.cast("string"), F.lit(str(level)), at.cast("string"))


def _above(nodes: DataFrame, level: int, arity: int, levels: int, n_trees: int) -> DataFrame:
    """Adds ``node`` and ``spot`` of the stored row above (tree, place, n): in
    the same tree, or in that of the subroots, or none above the root."""
    span = F.lit(arity ** levels)
    own = F.col("n") > 1
    top = (F.col("tree") != TOP) & F.lit(n_trees > 1)
    up = lambda c: F.floor(c / span).cast("long")
    return (nodes.withColumn("node", F.when(own, _node(F.col("tree"), level, up(F.col("place"))))
                             .when(top, _node(F.lit(TOP), 0, up(F.col("tree")))))
            .withColumn("spot", F.when(own, F.pmod("place", span)).when(top, F.pmod("tree", span)).cast("int")))


def _runs(level: Column, arity: int) -> Column:
    """The next level: a digest per run of ``arity`` nodes (the last may be shorter)."""
    return F.transform(F.sequence(F.lit(1), F.size(level), F.lit(arity)),
                       lambda i: F.sha2(F.array_join(F.slice(level, i, arity), ""), 256))


def _grow(nodes: DataFrame, most: int, arity: int, levels: int, n_trees: int) -> tuple[list[DataFrame], DataFrame]:
    """Stored rows above ``nodes`` (tree, place, n, digest), and each tree's
    last digest. ``most``: nodes of the largest tree."""
    span, level, stored, done = arity ** levels, 0, [], [nodes.where("n = 1").select("tree", "digest")]
    while most > 1:
        rows = (nodes.where("n > 1").groupBy("tree", F.floor(F.col("place") / span).cast("long").alias("at"), "n")
                .agg(F.sort_array(F.collect_list(F.struct("place", "digest"))).alias("below"))
                .select("tree", "at", "n", F.col("below.digest").alias("l0")))
        width = F.col("n")
        for k in range(levels):     # stops where one node of the tree is left
            rows = rows.withColumn(f"l{k + 1}", F.when(width > 1, _runs(F.col(f"l{k}"), arity)))
            width = F.ceil(width / arity)
        kept = F.filter(F.array(*[F.when(F.col(f"l{k + 1}").isNotNull(), F.col(f"l{k}")) for k in range(levels)]), lambda x: x.isNotNull())
        top = F.coalesce(*[F.col(f"l{k}") for k in range(levels, 0, -1)])[0]
        rows = cut_lineage(rows.select("tree", "at", F.ceil(F.col("n") / span).cast("long").alias("n"), kept.alias("levels"), top.alias("digest")), f"merkle-{level}")
        up = rows.select("tree", F.col("at").alias("place"), "n", "digest", "levels")
        stored.append(_above(up, level + 1, arity, levels, n_trees)
                      .select(_node(F.col("tree"), level, F.col("place")).alias("at_node"), F.col("node").alias("parent"), "spot", "levels"))
        nodes, level, most = up.drop("levels"), level + 1, -(-most // span)
        done.append(nodes.where("n = 1").select("tree", "digest"))
    return stored, _union(done)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def manifest(docs: DataFrame, claim: dict[str, Column] | None = None, fields: Sequence[str] = FIELDS, key: str = "doc_id",
             group: str = "source", arity: int = ARITY, levels: int = LEVELS) -> Manifest:
    """The tree over ``docs``: leaves ascend by ``key`` (null first) within a
    value of ``group`` (in UTF-8 order, null first).

    ``claim`` maps a field to the value that is presented for checking in its
    place (None, or a null claim digest: the record itself). Rows with equal
    keys take the order of their digests, so equal rows are interchangeable;
    null keys, groups and texts are values like others. Other columns of
    ``docs`` play no part and may have any name. An empty table has no root."""
    spark = docs.sparkSession
    text = {f: F.col(f).cast("string") for f in fields}
    changed = {**text, **{f: c.cast("string") for f, c in (claim or {}).items()}}
    leaf = digest_of([text[f] for f in fields])
    slim = docs.select(F.col(key).alias("key"), F.col(group).cast("string").alias("grp"), leaf.alias("leaf"),
                       (digest_of([changed[f] for f in fields]) if claim else F.lit(None).cast("string")).alias("claim"))
    placed, sizes = with_places(cut_lineage(slim, "merkle-leaves"), ["key", "leaf"], "grp", "merkle-sorted")
    groups, _ = with_places(sizes, ["grp"], name="merkle-groups")
    groups = cut_lineage(groups.select("grp", "n", F.col("place").alias("tree")), "merkle-trees")
    n_trees, most = groups.agg(F.count(F.lit(1)), F.max("n")).first()
    leaves = (placed.join(groups.withColumnRenamed("grp", "of"), F.col("grp").eqNullSafe(F.col("of")))
              .select("tree", "place", "n", "key", "leaf", F.coalesce("claim", "leaf").alias("claim")))
    leaves = cut_lineage(_above(leaves, 0, arity, levels, n_trees), "merkle-placed")
    stored, tops = _grow(leaves.select("tree", "place", "n", F.col("leaf").alias("digest")), most or 0, arity, levels, n_trees)
    tops = cut_lineage(tops, "merkle-subroots")
    roof = tops.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(n_trees).cast("long").alias("n"), "digest")
    above, root = _grow(roof, n_trees, arity, levels, n_trees)
    root = root.first()
    nodes = [s.withColumnRenamed("at_node", "node") for s in stored + above]
    none = spark.createDataFrame([], "node string, parent string, spot int, levels array<array<string>>")
    return Manifest(leaves, _union(nodes) if nodes else none,
                    groups.join(tops.withColumnRenamed("digest", "subroot"), "tree"), root["digest"] if root else None, arity)


CLIMB = """
WITH RECURSIVE climb(tree, place, key, leaf, step, node, spot, folded, met) AS (
  SELECT tree, place, key, leaf, 0, node, spot, claim, CAST(NULL AS BINARY) FROM {leaves}
  UNION ALL
  SELECT tree, place, CAST(NULL AS {key}), CAST(NULL AS STRING), step, node, spot, up.digest, unhex(up.met) FROM (
    SELECT c.tree, c.place, c.step + 1 AS step, n.parent AS node, n.spot AS spot,
           aggregate(n.levels, named_struct('at', c.spot, 'digest', c.folded, 'met', ''),
             (a, level) -> named_struct(
               'at', CAST(a.at div {arity} AS INT),
               'digest', sha2(array_join(transform(slice(level, a.at - a.at % {arity} + 1, {arity}),
                                                   (x, i) -> if(i = a.at % {arity}, a.digest, x)), ''), 256),
               'met', concat(a.met, array_join(filter(slice(level, a.at - a.at % {arity} + 1, {arity}),
                                                      (x, i) -> i <> a.at % {arity}), '')))) AS up
    FROM climb c JOIN {nodes} n ON c.node = n.node))
SELECT tree, place, key, leaf, step, folded, met FROM climb
"""


def climb(m: Manifest) -> DataFrame:
    """``tree, place, key, leaf, step, folded, met``: one row per leaf and step
    (0: the presented digest itself); ``met`` holds the siblings of the step's
    levels, low to high and left to right, as bytes. Written to the
    checkpoint folder; the limit on rows of a recursive query, which counts
    all leaves together, is lifted meanwhile."""
    spark = m.leaves.sparkSession
    limit = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        sql = CLIMB.replace("{arity}", str(m.arity)).replace("{key}", m.leaves.schema["key"].dataType.simpleString())
        return cut_lineage(spark.sql(sql, leaves=m.leaves, nodes=m.nodes), "merkle-climb")
    finally:
        spark.conf.set(limit, before)


def verify(m: Manifest) -> DataFrame:
    """One row per record: ``key, leaf, subroot, root, proof`` (bytes of all
    siblings, from the leaf's run to the root's), ``folded_root`` (of the
    presented record) and ``verified`` (it equals the root). A record that is
    the only one has an empty proof. Empty manifest: empty result."""
    steps = climb(m).groupBy("tree", "place").agg(F.sort_array(F.collect_list(F.struct("step", "met", "folded", "key", "leaf"))).alias("s"))
    # joined as bytes: transform keeps them binary, and null (step 0) is left out
    one = steps.select("tree", F.col("s")[0]["key"].alias("key"), F.col("s")[0]["leaf"].alias("leaf"), F.element_at("s", -1)["folded"].alias("folded_root"),
                       F.aggregate(F.transform("s", lambda x: x["met"]), F.unhex(F.lit("")), lambda a, x: F.coalesce(F.concat(a, x), a)).alias("proof"))
    return (one.join(m.groups.select("tree", "subroot"), "tree")
            .select("key", "leaf", "subroot", F.lit(m.root).alias("root"), "proof", "folded_root", (F.col("folded_root") == F.lit(m.root)).alias("verified")))
