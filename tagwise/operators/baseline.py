"""Catalog baselines for drift detection, and feature importance.

All statistics come from one global aggregation (partial aggregates on every
partition, one tiny final merge); medians use exact ``median``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwise.functions import text as tx
from tagwise.functions.fixed import FEATURE_WEIGHTS


def baseline_tag_length(cat: DataFrame) -> DataFrame:
    n = tx.char_length("tags")
    return cat.agg(F.avg(n).alias("mean"), F.var_samp(n).alias("variance"),
                   F.min(n).cast("double").alias("min"), F.max(n).cast("double").alias("max"),
                   F.median(n).alias("median"))


def baseline_word_count(cat: DataFrame) -> DataFrame:
    n = tx.word_count("tags")
    return cat.agg(F.avg(n).alias("mean"), F.var_samp(n).alias("variance"),
                   F.min(n).cast("double").alias("min"), F.max(n).cast("double").alias("max"))


def baseline_list_counts(cat: DataFrame) -> DataFrame:
    """(feature, mean_per_item, variance, items_empty) for genres, cast, keywords."""
    feats = ["genres", "cast", "keywords"]
    aggs = []
    for f in feats:
        s = F.size(f)
        aggs += [F.avg(s).alias(f"{f}_m"), F.var_samp(s).alias(f"{f}_v"),
                 F.count_if(s == 0).alias(f"{f}_e")]
    row = cat.agg(*aggs)
    body = ", ".join(f"'{f}', {f}_m, {f}_v, {f}_e" for f in feats)
    return row.selectExpr(f"stack({len(feats)}, {body}) AS (feature, mean_per_item, variance, items_empty)")


def baseline_director_counts(cat: DataFrame) -> DataFrame:
    s = F.size("crew")
    return cat.agg(F.count_if(s > 0).alias("with_director"),
                   F.count_if(s == 0).alias("without_director"))


def top_genres(cat: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent genres (ties: name ascending) with counts."""
    counts = cat.select(F.explode("genres").alias("genre")).groupBy("genre").count()
    return counts.orderBy(F.desc("count"), F.asc("genre")).limit(n)


def baseline_statistics(cat: DataFrame) -> DataFrame:
    """The whole baseline as one row: total plus tag length / word count /
    list-count / director statistics (single pass) and the top-genre map."""
    tl, wc = tx.char_length("tags"), tx.word_count("tags")
    g, c, k, d = F.size("genres"), F.size("cast"), F.size("keywords"), F.size("crew")
    stats = cat.agg(
        F.count(F.lit(1)).alias("total_items"),
        F.struct(F.avg(tl).alias("mean"), F.var_samp(tl).alias("variance"),
                 F.min(tl).cast("double").alias("min"), F.max(tl).cast("double").alias("max"),
                 F.median(tl).alias("median")).alias("tag_length"),
        F.struct(F.avg(wc).alias("mean"), F.var_samp(wc).alias("variance"),
                 F.min(wc).cast("double").alias("min"),
                 F.max(wc).cast("double").alias("max")).alias("word_count"),
        F.struct(F.avg(g).alias("mean_per_item"), F.var_samp(g).alias("variance"),
                 F.count_if(g == 0).alias("items_no_genre")).alias("genre_counts"),
        F.struct(F.avg(c).alias("mean_per_item"), F.var_samp(c).alias("variance"),
                 F.count_if(c == 0).alias("items_no_cast")).alias("cast_counts"),
        F.struct(F.count_if(d > 0).alias("items_with_director"),
                 F.count_if(d == 0).alias("items_without_director")).alias("director_counts"),
        F.struct(F.avg(k).alias("mean_per_item"), F.var_samp(k).alias("variance"),
                 F.count_if(k == 0).alias("items_no_keywords")).alias("keyword_counts"))
    tg = top_genres(cat).agg(F.map_from_entries(F.collect_list(F.struct("genre", "count")))
                             .alias("top_genres"))
    return stats.crossJoin(tg)


def feature_importance(cat: DataFrame, weights: dict | None = None) -> DataFrame:
    """Share (%) of tag words contributed by each feature, rounded to 2."""
    w = weights or FEATURE_WEIGHTS
    parts = {
        "overview": F.sum(tx.word_count(F.coalesce(F.col("overview").cast("string"), F.lit("nan")))),
        "genres": F.sum(F.size("genres") * w["genres"]),
        "keywords": F.sum(F.size("keywords") * w["keywords"]),
        "cast": F.sum(F.size("cast") * w["cast"]),
        "director": F.sum(F.size("crew") * w["director"]),
    }
    row = cat.agg(F.sum(tx.word_count("tags")).alias("total"),
                  *[v.alias(k) for k, v in parts.items()])
    body = ", ".join(f"'{k}', CAST({k} AS DOUBLE)" for k in parts)
    long = row.selectExpr("total", f"stack({len(parts)}, {body}) AS (feature, words)")
    return long.select("feature", F.col("words").cast("long").alias("words"),
                       F.round(F.col("words") / F.col("total") * 100, 2).alias("importance"))
