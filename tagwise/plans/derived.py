"""How the operators map onto the driver tables.

catalog      <- documents: movie_id = doc_id, overview = text (whole),
                title = the text's heading unit (to the first line break or
                sentence end, whitespace runs collapsed),
                genres = [the language's genre], director = [source], cast = [],
                keywords = all distinct tokens of 10 characters or more over
                the whole text.
raw catalog  <- orders JOIN lineitem JOIN part as JSON text columns
                (genres = part types, keywords = brands, cast = part names
                in line order, crew = part names with job Director when the
                line was returned, else Producer); title = customer name.
feedback     <- events: status error->error, view->not_found, else success;
                latency_ms = value * 10; query = event_type || ' ' || props.
positives    <- events with event_type = 'purchase'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagwise.functions import text as tx
from tagwise.operators.catalog import build_tags
from tagwise.sources.tables import table

ASCII_WS = "[ \t\n\r]+"
HEADING_PATTERN = r"[^\n.!?]*[^ \t\n\r.!?][^\n.!?]*"


KEYWORD_CHARS = 10
LANG_GENRE = {"en": "drama", "de": "action", "fr": "romance", "es": "comedy"}


def genre_of(lang: str):
    """The genre that stands for a language in this mapping; others keep their name."""
    name = tx.clean_name(lang)
    known = F.create_map(*[F.lit(x) for kv in LANG_GENRE.items() for x in kv])
    return F.coalesce(known[name], name)


def heading(text_col: str = "text"):
    """The heading unit of a text: what stands before its first line break or
    sentence end (of the first unit that holds anything), white space
    collapsed."""
    unit = F.regexp_extract(F.col(text_col), HEADING_PATTERN, 0)
    return F.trim(F.regexp_replace(unit, ASCII_WS, " "))


def _keywords(text_col: str, n_chars: int = KEYWORD_CHARS):
    """All distinct tokens of ``n_chars`` characters or more, sorted."""
    toks = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(r"[\p{L}\p{N}_]{%d,}" % n_chars), 0)
    return F.sort_array(F.array_distinct(toks))


def documents_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    cat = d.select(
        F.col("doc_id").alias("movie_id"),
        heading().alias("title"),
        F.col("text").alias("overview"),
        F.array(genre_of("lang")).alias("genres"),
        _keywords("text").alias("keywords"),
        F.array().cast("array<string>").alias("cast"),
        F.array(tx.clean_name("source")).alias("crew"),
    )
    return build_tags(cat)


def raw_catalog_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-shaped catalog with JSON text columns, built from TPC-H tables."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber",
                                                 "l_returnflag")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    lines = li.join(p, li.l_partkey == p.p_partkey)
    job = F.when(F.col("l_returnflag") == "R", "Director").otherwise("Producer")
    per_order = (lines.groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list(F.struct("l_linenumber", "p_type", "p_brand", "p_name",
                                             job.alias("job")))).alias("ls")))
    js = lambda fields: F.to_json(F.transform("ls", lambda x: F.struct(*fields(x))))
    raw = per_order.select(
        F.col("l_orderkey").alias("id"),
        js(lambda x: [x["p_type"].alias("name")]).alias("genres"),
        js(lambda x: [x["p_brand"].alias("name")]).alias("keywords"),
        js(lambda x: [x["p_name"].alias("name")]).alias("cast"),
        js(lambda x: [x["job"].alias("job"), x["p_name"].alias("name")]).alias("crew"))
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(raw, o.o_orderkey == raw.id)
            .select(F.col("id").alias("movie_id"), F.col("c_name").alias("title"),
                    F.col("o_orderpriority").alias("overview"),
                    "genres", "keywords", "cast", "crew"))


def feedback_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type",
                                             "value", "props")
    status = (F.when(F.col("event_type") == "error", "error")
              .when(F.col("event_type") == "view", "not_found").otherwise("success"))
    return e.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id",
        F.concat_ws(" ", "event_type", "props").alias("query"),
        status.alias("status"), (F.col("value") * 10).alias("latency_ms"), "event_type")


def positives_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    return (e.filter(F.col("event_type") == "purchase")
            .select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id",
                    F.col("props").alias("movie"), F.lit("favorites").alias("source")))
