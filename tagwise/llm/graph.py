"""Connected components over an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwise.session import cut_lineage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, label)`` for every node of an edge: label is the smallest node
    that it reaches. Each round takes the least label among the neighbours
    and then the label of that label (pointer jumping), so the number of
    rounds is logarithmic in practice. Aggregates combine map-side and joins
    split hot keys, so one component may hold most nodes. Each round is
    written to the checkpoint folder. Nulls on either side are left out; an
    empty edge table gives an empty result."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v")
    both = cut_lineage(e.union(e.select("v", "u")).distinct(), "cc-edges")
    cur = cut_lineage(both.groupBy("u").agg(F.min("v").alias("m"))
                      .select(F.col("u").alias("node"), F.least("u", "m").alias("label")), "cc")
    while True:
        near = (both.join(cur.select(F.col("node").alias("v"), "label"), "v")
                .groupBy("u").agg(F.min("label").alias("near")))
        step = (cur.join(near, cur.node == near.u)
                .select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid")))
        hop = cur.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        new = cut_lineage(step.join(hop, "mid", "left")
                          .select("node", "old", F.least("mid", F.coalesce("far", "mid")).alias("label")), "cc")
        changed = new.where("old <> label").limit(1).count()
        cur = new.select("node", "label")
        if not changed:
            return cur
