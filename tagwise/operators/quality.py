"""Data-quality checks: schema, missing values, row count, duplicates,
blank strings, IQR outliers, and the combined report.

Every check is a single aggregation pass; the per-column results are
unpivoted with ``stack`` so the report is a long table
``(source, check, column, value, issue)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagwise.operators.feedback import prefix_scan
from tagwise.functions import text as tx

from tagwise.functions.fixed import IQR_FACTOR, MIN_ROWS, MISSING_HIGH_RATE


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    present = set(df.columns)
    return [c for c in required if c not in present]


def validate_schema(df: DataFrame, required: list[str], source: str) -> bool:
    """True when all required columns exist; ValueError naming the missing ones."""
    miss = missing_columns(df, required)
    if miss:
        raise ValueError(f"{source} is missing required columns: {miss}")
    return True


def schema_table(df: DataFrame, required: list[str], source: str) -> DataFrame:
    """(source, column, present) for each required column (a tiny driver-side
    list of names; no data is read)."""
    spark = df.sparkSession
    present = set(df.columns)
    rows = [(source, c, c in present) for c in required]
    schema = T.StructType([T.StructField("source", T.StringType()),
                           T.StructField("column", T.StringType()),
                           T.StructField("present", T.BooleanType())])
    return spark.createDataFrame(rows, schema)


def _stack(exprs: dict[str, str], value_type: str = "bigint") -> str:
    body = ", ".join(f"'{k}', CAST(`{v}` AS {value_type})" for k, v in exprs.items())
    return f"stack({len(exprs)}, {body}) AS (column, value)"


def missing_values(df: DataFrame, source: str, cols: list[str] | None = None,
                   high_rate: float = MISSING_HIGH_RATE) -> DataFrame:
    """(source, column, missing, rate, level) in one pass; the rate is null
    for an empty table."""
    cols = cols or df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(cols)])
    long = agg.selectExpr("_n", _stack({c: f"_m{i}" for i, c in enumerate(cols)}))
    rate = tx.ratio_round("value", "_n", 4)
    return long.select(
        F.lit(source).alias("source"), "column", F.col("value").alias("missing"),
        rate.alias("rate"),
        F.when(rate > high_rate, "high").when(F.col("value") > 0, "some")
         .otherwise("none").alias("level"))


def min_rows_check(df: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    n = df.agg(F.count(F.lit(1)).alias("value"))
    return n.select(F.lit("min_rows").alias("check"), F.lit(None).cast("string").alias("column"),
                    F.col("value").cast("double").alias("value"),
                    F.when(F.col("value") < min_rows,
                           F.format_string("Too few rows: %d < %d", F.col("value"), F.lit(min_rows)))
                    .alias("issue"))


def duplicate_titles(df: DataFrame, col: str = "title") -> DataFrame:
    """Rows repeating an earlier value: n - distinct (null counts as a value)."""
    n = df.agg((F.count(F.lit(1)) - F.count_distinct(F.struct(col))).alias("value"))
    return n.select(F.lit("duplicates").alias("check"), F.lit(col).alias("column"),
                    F.col("value").cast("double").alias("value"),
                    F.when(F.col("value") > 0, F.format_string("%d duplicate %s values",
                                                               F.col("value"), F.lit(col)))
                    .alias("issue"))


def empty_strings(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per string column: values that are blank after stripping whitespace."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    blank = lambda c: F.regexp_replace(F.col(c), r"(?U)^\s+|\s+$", "") == ""
    agg = df.agg(*[F.count_if(blank(c)).alias(f"_e{i}") for i, c in enumerate(cols)])
    long = agg.selectExpr(_stack({c: f"_e{i}" for i, c in enumerate(cols)}))
    return long.select(F.lit("empty_strings").alias("check"), "column",
                       F.col("value").cast("double").alias("value"),
                       F.when(F.col("value") > 0, F.format_string("%d empty values in %s",
                                                                  F.col("value"), F.col("column")))
                       .alias("issue"))


def iqr_bounds(df: DataFrame, col: str, factor: float = IQR_FACTOR) -> DataFrame:
    """Exact quartiles (linear interpolation) and the fences, one row. Equal
    values are counted first (map-side combined); a distributed prefix scan
    over the distinct values gives their ranks, and the values at the two ranks
    around each quartile are picked by one aggregate."""
    per = (df.select(F.col(col).cast("double").alias("v")).where("v is not null")
           .groupBy("v").agg(F.count(F.lit(1)).alias("c")))
    ranks = prefix_scan(per, ["v"], {"c": F.col("c")})
    n = per.agg(F.sum("c").alias("n"))

    def at(rank):
        return F.min(F.when(F.col("cum_c") > rank, F.col("v")))
    pos = {"q1": (F.col("n") - 1) * 0.25, "q3": (F.col("n") - 1) * 0.75}
    x = ranks.crossJoin(F.broadcast(n)).agg(*[f(p).alias(f"{k}{s}") for k, p in pos.items() for s, f in (
        ("lo", lambda p: at(F.floor(p))), ("hi", lambda p: at(F.ceil(p))), ("w", lambda p: F.max(p - F.floor(p))))])
    q = x.select(*[(F.col(f"{k}lo") + (F.col(f"{k}hi") - F.col(f"{k}lo")) * F.col(f"{k}w")).alias(k) for k in pos])
    return q.select(
        "q1", "q3", (F.col("q1") - factor * (F.col("q3") - F.col("q1"))).alias("lower"),
        (F.col("q3") + factor * (F.col("q3") - F.col("q1"))).alias("upper"))


def rating_outliers(df: DataFrame, col: str, factor: float = IQR_FACTOR) -> DataFrame:
    """Count of values outside [Q1 - f*IQR, Q3 + f*IQR]; the one-row bounds
    are broadcast, so the scan is filtered without a shuffle."""
    b = iqr_bounds(df, col, factor)
    n = (df.select(col).crossJoin(F.broadcast(b))
         .agg(F.count_if((F.col(col) < F.col("lower")) | (F.col(col) > F.col("upper")))
              .alias("value")))
    return n.select(F.lit("outliers").alias("check"), F.lit(col).alias("column"),
                    F.col("value").cast("double").alias("value"),
                    F.when(F.col("value") > 0, F.format_string("%d outliers in %s",
                                                               F.col("value"), F.lit(col)))
                    .alias("issue"))


def quality_issues(df: DataFrame, title_col: str, rating_col: str,
                   string_cols: list[str] | None = None, min_rows: int = MIN_ROWS) -> DataFrame:
    """All checks as rows (check, column, value, issue)."""
    return (min_rows_check(df, min_rows)
            .unionByName(duplicate_titles(df, title_col))
            .unionByName(empty_strings(df, string_cols))
            .unionByName(rating_outliers(df, rating_col)))


def quality_summary(issues: DataFrame) -> DataFrame:
    """Pass/fail plus the ordered list of issue messages."""
    return issues.agg(
        F.count_if(F.col("issue").isNotNull()).alias("issue_count"),
        F.sort_array(F.collect_list("issue")).alias("issues")
    ).select((F.col("issue_count") == 0).alias("passed"), "issue_count", "issues")


def validation_report(movies: DataFrame, credits: DataFrame, merged: DataFrame, title: str = "title",
                      rating: str = "vote_average", string_cols: list[str] | None = None) -> DataFrame:
    """The load's report as rows (section, source, name, value, note): row
    counts before and after the merge, missing values and quality checks of
    both sides, and the status."""
    def rows(df, source):
        return df.agg(F.count(F.lit(1)).cast("double").alias("value")).select(
            F.lit("rows").alias("section"), F.lit(source).alias("source"), F.lit("rows").alias("name"), "value",
            F.lit(None).cast("string").alias("note"))

    def missing(df, source):
        return missing_values(df, source).select(F.lit("missing").alias("section"), "source", F.col("column").alias("name"),
                                                 F.col("missing").cast("double").alias("value"), F.col("level").alias("note"))

    def quality(issues, source):
        return issues.select(F.lit("quality").alias("section"), F.lit(source).alias("source"),
                             F.concat_ws(":", "check", "column").alias("name"), "value", F.col("issue").alias("note"))
    credits_issues = (min_rows_check(credits).unionByName(duplicate_titles(credits, title))
                      .unionByName(empty_strings(credits, [title])))
    parts = [rows(movies, "movies"), rows(credits, "credits"), rows(merged, "merged"),
             missing(movies, "movies"), missing(credits, "credits"),
             quality(quality_issues(movies, title, rating, string_cols or [title]), "movies"), quality(credits_issues, "credits")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = movies.sparkSession.createDataFrame([("status", "load", "status", None, "passed")],
                                                 "section string, source string, name string, value double, note string")
    return out.unionByName(status)


def eda_profile(df: DataFrame, name: str) -> DataFrame:
    """(table, column, type, rows): shape and column list."""
    spark = df.sparkSession
    meta = spark.createDataFrame([(name, i, f.name, f.dataType.simpleString())
                                  for i, f in enumerate(df.schema.fields)],
                                 "table string, position int, column string, type string")
    return meta.crossJoin(df.agg(F.count(F.lit(1)).alias("rows")))
