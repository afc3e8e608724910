"""Mixing sources to target weights, in DataFrame functions only.

Words are counted per source, targets follow the weights with a ceiling of
``max_repeat`` times the source's own words, and each document is emitted
``floor(rate)`` times plus one more time when a hash of it falls below the
rate's fraction. Nothing but the table of sources is shuffled beside the
map-side combined counts; that table is broadcast when it has at most
``BROADCAST_SOURCES`` rows and joined by shuffle (with AQE's skew splitting)
beyond.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagwise.llm.columns import set_aside
from tagwise.session import cut_lineage

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEAT = 3.0
BROADCAST_SOURCES = 20_000
SEED = 20_011


def n_words(text: str = "text"):
    """Number of ``[^\\x20\\x09-\\x0D]+`` runs; null counts 0."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: float = MAX_REPEAT) -> DataFrame:
    """``source, source_size, weight, target`` from ``source, size`` rows.

    Sources in code point order (null last) take the weights in turn. The
    targets share the sum of all sizes by weight; a target stops at
    ``max_repeat`` times its source's size and the excess goes to the others
    by weight until none is above. In one pass: with sources sorted by
    ceiling / weight, the sources at their ceiling are a prefix, and the level
    of the others is (all - ceilings before) / weights left. The windows run
    over one row per source."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    per = per.select("source", "source_size", w.alias("weight")).withColumn("ceiling", F.col("source_size") * F.lit(max_repeat))
    fill = Window.orderBy(F.col("ceiling") / F.col("weight"), F.col("source").isNull(), "source")
    done = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(whole) - F.coalesce(F.sum("ceiling").over(done), F.lit(0.0)))
             / F.sum("weight").over(rest))
    per = per.withColumn("level", level).withColumn("full", F.col("ceiling") <= F.col("level") * F.col("weight"))
    # the first source below its ceiling fixes the level for all after it
    free = F.min(F.struct(F.col("full"), F.col("ceiling") / F.col("weight"), F.col("level"))).over(whole)
    return per.select("source", "source_size", "weight",
                      F.when(F.col("full"), F.col("ceiling"))
                      .otherwise(F.least(free["level"] * F.col("weight"), F.col("ceiling"))).alias("target"))


def mixed(docs: DataFrame, weights=WEIGHTS, max_repeat: float = MAX_REPEAT, seed: int = SEED) -> DataFrame:
    """``docs`` with ``size, source_size, target, copies``: how often the mix
    takes each row. Columns of ``docs`` with these names are replaced. Null
    text has size 0; null sources are one source. Rows that are equal in
    doc_id and text get the same decision, so reruns agree. Empty table:
    empty result."""
    new = ("size", "source_size", "target", "copies")
    base = docs.drop(*new).withColumn("size", n_words())
    targets = cut_lineage(source_targets(base.select(F.col("source").cast("string").alias("source"), "size"), weights, max_repeat), "mix-targets")
    t = targets.select(F.col("source").alias("_mix_source"), "source_size", "target")
    if targets.count() <= BROADCAST_SOURCES:
        t = F.broadcast(t)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    # 52 bits of an md5 that other engines compute alike
    key = F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce(F.col("text"), F.lit("")))
    draw = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / float(1 << 52)
    return (base.join(t, base["source"].cast("string").eqNullSafe(F.col("_mix_source")), "left").drop("_mix_source")
            .withColumn("copies", (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")))


def emit(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with the
    columns of ``docs`` alone, as they are, whatever their names."""
    aside, back = set_aside(docs, ["size", "source_size", "target", "copies", "_copy", "_mix_source"])
    m = mixed(aside, **kw).where("copies > 0")
    return m.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*back)
