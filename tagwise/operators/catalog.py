"""Catalog preparation: merge, projection, null handling, JSON parsing, tags."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagwise.functions import text as tx
from tagwise.functions.fixed import CAST_TOP_N, FEATURE_WEIGHTS

CATALOG_COLUMNS = ["movie_id", "title", "overview", "genres", "keywords", "cast", "crew"]


def catalog_merge(movies: DataFrame, credits: DataFrame) -> DataFrame:
    """movies JOIN credits on title (inner; duplicate titles multiply), with
    ``id`` renamed to ``movie_id`` and a single ``movie_id`` kept."""
    m = movies.withColumnRenamed("id", "movie_id")
    c = credits.drop("movie_id")
    return m.join(c, "title", "inner")


def catalog_merge_by_id(movies: DataFrame, credits: DataFrame) -> DataFrame:
    """Keyed variant: join on the id; the credits title is dropped."""
    m = movies.withColumnRenamed("id", "movie_id")
    return m.join(credits.drop("title"), "movie_id", "inner")


def rename_id(df: DataFrame, src: str = "id", dst: str = "movie_id") -> DataFrame:
    return df.withColumnRenamed(src, dst)


def project_catalog(df: DataFrame) -> DataFrame:
    return df.select(*CATALOG_COLUMNS)


def drop_nulls(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=cols)


def drop_nulls_report(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One-pass count of rows before / after dropping rows with any null."""
    cols = cols or df.columns
    any_null = F.greatest(*[F.col(c).isNull().cast("int") for c in cols]) if len(cols) > 1 \
        else F.col(cols[0]).isNull().cast("int")
    return df.agg(F.count(F.lit(1)).alias("rows_before"),
                  F.sum(any_null).alias("rows_dropped")) \
        .select(F.col("rows_before"), F.coalesce("rows_dropped", F.lit(0)).alias("rows_dropped"),
                (F.col("rows_before") - F.coalesce("rows_dropped", F.lit(0))).alias("rows_after"))


def parse_catalog(df: DataFrame, cast_top_n: int = CAST_TOP_N) -> DataFrame:
    """Raw JSON-in-text columns -> cleaned name lists."""
    return (df
            .withColumn("genres", tx.clean_names(tx.parse_names("genres")))
            .withColumn("keywords", tx.clean_names(tx.parse_names("keywords")))
            .withColumn("cast", tx.clean_names(tx.parse_cast("cast", cast_top_n)))
            .withColumn("crew", tx.clean_names(tx.parse_director("crew"))))


def tags_expr(exclude: str | None = None, weights: dict | None = None):
    """overview(1x) + genres(2x) + keywords(1x) + cast(2x) + director(3x),
    joined by single spaces; an empty cleaned overview still contributes an
    empty first part (leading space), as a Python ``" ".join`` would."""
    w = weights or FEATURE_WEIGHTS
    parts = []
    if exclude != "overview":
        parts.append(F.array(tx.clean_text(F.coalesce(F.col("overview").cast("string"),
                                                      F.lit("nan")))))
    for feat, col in (("genres", "genres"), ("keywords", "keywords"),
                      ("cast", "cast"), ("director", "crew")):
        if exclude != feat:
            parts.append(tx.repeat_list(col, w[feat]))
    if not parts:
        return F.lit("")
    return F.array_join(F.concat(*parts) if len(parts) > 1 else parts[0], " ")


def build_tags(df: DataFrame) -> DataFrame:
    return df.withColumn("tags", tags_expr())


def build_tags_without(df: DataFrame, feature: str) -> DataFrame:
    return df.withColumn("tags", tags_expr(exclude=feature))


def build_tag_variants(df: DataFrame, features: list[str]) -> DataFrame:
    """Full tags plus one variant per left-out feature, as rows keyed by
    ``variant`` so one plan serves the whole ablation (no per-variant jobs)."""
    variants = [F.struct(F.lit("full").alias("variant"), tags_expr().alias("tags"))]
    variants += [F.struct(F.lit(f).alias("variant"), tags_expr(exclude=f).alias("tags"))
                 for f in features]
    keep = [c for c in df.columns if c != "tags"]
    return (df.select(*keep, F.explode(F.array(*variants)).alias("_v"))
            .select(*keep, "_v.variant", "_v.tags"))


def prepare_catalog(raw: DataFrame) -> DataFrame:
    """project -> drop nulls -> parse JSON -> clean -> tags."""
    return build_tags(parse_catalog(drop_nulls(project_catalog(raw))))
