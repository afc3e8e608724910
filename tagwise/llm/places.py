"""Exact gapless positions of rows in an order, without an ordered window
over the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagwise.session import cut_lineage


def with_places(df: DataFrame, order: list[str], group: str | None = None, name: str = "places") -> tuple[DataFrame, DataFrame]:
    """``df`` with ``place`` (0, 1, ... in the order of the columns ``order``,
    nulls first, within each value of ``group``) and a table of the groups:
    the group column and ``n``, its rows.

    One range exchange sorts the rows; each sorted partition numbers its own
    (partition and index are what ``monotonically_increasing_id`` is made of),
    and a table of (partition, group) counts gives the offsets. So a group may
    hold any share of the rows. Rows equal in group and order are placed in any
    order. The numbered rows are written to the checkpoint folder."""
    keys = ([group] if group else []) + order
    numbered = cut_lineage(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), name)
    by = F.col(group) if group else F.lit(0)
    part = F.shiftright("_at", 33)
    per = numbered.groupBy(part.alias("_part"), by.alias("_group")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    per = cut_lineage(per, f"{name}-counts")
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    start = per.select("_part", "_group", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    placed = (numbered.withColumn("_by", by)
              .join(start, (part == F.col("_part")) & F.col("_by").eqNullSafe(F.col("_group")))
              .withColumn("place", F.col("_at") + F.col("_shift")).drop("_at", "_by", "_part", "_group", "_shift"))
    sizes = per.groupBy("_group").agg(F.sum("_n").cast("long").alias("n"))
    return placed, sizes.withColumnRenamed("_group", group) if group else sizes.drop("_group")
