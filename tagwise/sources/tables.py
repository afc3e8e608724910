"""Readers for the parquet tables and the raw CSV logs/catalogs.

Readers return lazy DataFrames; Catalyst prunes columns and pushes filters
into the parquet scan, so callers select only what they use.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations"]

MOVIES_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("overview", T.StringType()),
    T.StructField("genres", T.StringType()),
    T.StructField("keywords", T.StringType()),
    T.StructField("vote_average", T.DoubleType()),
    T.StructField("vote_count", T.LongType()),
    T.StructField("popularity", T.DoubleType()),
    T.StructField("release_date", T.StringType()),
])

CREDITS_SCHEMA = T.StructType([
    T.StructField("movie_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("cast", T.StringType()),
    T.StructField("crew", T.StringType()),
])

SEARCH_FEEDBACK_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("query", T.StringType()),
    T.StructField("matched_title", T.StringType()),
    T.StructField("recommendations_count", T.IntegerType()),
    T.StructField("latency_ms", T.StringType()),  # parsed with try_cast downstream
    T.StructField("status", T.StringType()),
])

POSITIVE_FEEDBACK_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("movie", T.StringType()),
    T.StructField("source", T.StringType()),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


ISO_TS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"  # the logs' ISO timestamps


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Header CSV; fails if the path is absent. ``multi_line`` allows quoted
    line breaks, at the price of one task per file."""
    return (spark.read.schema(schema)
            .option("header", True).option("multiLine", multi_line)
            .option("quote", '"').option("escape", '"')
            .option("timestampFormat", ISO_TS)
            .option("mode", "PERMISSIVE")
            .csv(path))


def scan_catalog(spark: SparkSession, movies_path: str, credits_path: str):
    """Read the two raw catalog files (error if either is absent)."""
    return (read_csv(spark, movies_path, MOVIES_SCHEMA, multi_line=True),
            read_csv(spark, credits_path, CREDITS_SCHEMA, multi_line=True))


def scan_feedback(spark: SparkSession, search_path: str, positive_path: str):
    return (read_csv(spark, search_path, SEARCH_FEEDBACK_SCHEMA),
            read_csv(spark, positive_path, POSITIVE_FEEDBACK_SCHEMA))
