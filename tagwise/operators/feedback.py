"""Feedback-log analytics: summary stats, counters, histograms, gauges,
running (prefix) statistics and sessions.

Running statistics never use a global un-partitioned window (one task for the
whole log). ``prefix_scan`` is the distributed scan: range-sort, running sums
inside each sorted partition, a tiny per-partition total table turned into
offsets and broadcast back.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagwise.functions import text as tx
from tagwise.functions.fixed import (MAX_LATENCY_MS, MIN_FEEDBACK_FOR_DRIFT,
                                     REQUEST_LATENCY_BUCKETS)


def prefix_scan(df: DataFrame, order_cols: list[str], values: dict[str, Column]) -> DataFrame:
    """Adds ``rn`` (1-based global position in ``order_cols`` order, which must
    be a total order) and ``cum_<name>`` = running sum of each value up to and
    including the row."""
    names = list(values)
    base = (df.select("*", *[F.coalesce(values[k], F.lit(0)).alias(f"_v_{k}") for k in names])
            .orderBy(*order_cols)
            .withColumn("_pid", F.spark_partition_id()))
    o = [F.col(c) for c in order_cols]
    wl = Window.partitionBy("_pid").orderBy(*o)
    wr = wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    loc = base.select("*", F.row_number().over(wl).alias("_lrn"),
                      *[F.sum(f"_v_{k}").over(wr).alias(f"_c_{k}") for k in names])
    loc = loc.persist(StorageLevel.MEMORY_AND_DISK)
    tot = loc.groupBy("_pid").agg(F.max("_lrn").alias("_pn"),
                                  *[F.max_by(f"_c_{k}", "_lrn").alias(f"_t_{k}") for k in names])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: bounded by the partition count
    off = tot.select("_pid", F.coalesce(F.sum("_pn").over(before), F.lit(0)).alias("_on"),
                     *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_o_{k}")
                       for k in names])
    out = loc.join(F.broadcast(off), "_pid")
    keep = [c for c in df.columns]
    return out.select(*keep, (F.col("_on") + F.col("_lrn")).alias("rn"),
                      *[(F.col(f"_o_{k}") + F.col(f"_c_{k}")).alias(f"cum_{k}") for k in names])


def global_lag(df: DataFrame, order_cols: list[str], col: str, name: str = "prev") -> DataFrame:
    """``lag(col)`` over the whole table in ``order_cols`` order without a
    single-partition window: lag inside each range-sorted partition, and the
    first row of a partition takes the last value of the partition before
    (a per-partition table, broadcast)."""
    base = df.orderBy(*order_cols).withColumn("_pid", F.spark_partition_id())
    wl = Window.partitionBy("_pid").orderBy(*[F.col(c) for c in order_cols])
    loc = base.select("*", F.lag(col).over(wl).alias("_l"),
                      F.row_number().over(wl).alias("_r")).persist(StorageLevel.MEMORY_AND_DISK)
    last = loc.groupBy("_pid").agg(F.max_by(col, "_r").alias("_last"))
    prev_last = last.select("_pid", F.lag("_last").over(Window.orderBy("_pid")).alias("_pl"))
    return (loc.join(F.broadcast(prev_last), "_pid")
            .select(*df.columns, F.when(F.col("_r") == 1, F.col("_pl")).otherwise(F.col("_l")).alias(name)))


def feedback_stats(search: DataFrame, positives: DataFrame,
                   min_rows: int = MIN_FEEDBACK_FOR_DRIFT) -> DataFrame:
    """One row: totals, rates, query-length mean and population variance,
    mean latency (unparseable values skipped), distinct queries."""
    wc = tx.word_count("query")
    lat = F.col("latency_ms").cast("string").try_cast("double")
    s = search.agg(
        F.count(F.lit(1)).alias("total_queries"),
        F.avg(wc).alias("query_length_mean"),
        F.var_pop(wc).alias("query_length_variance"),
        F.coalesce(F.avg(lat), F.lit(0.0)).alias("avg_latency_ms"),
        F.try_divide(F.count_if(F.col("status") == "success"), F.count(F.lit(1))).alias("success_rate"),
        F.try_divide(F.count_if(F.col("status") == "not_found"), F.count(F.lit(1))).alias("not_found_rate"),
        F.count_distinct("query").alias("unique_queries"))
    p = positives.agg(F.count(F.lit(1)).alias("positive_count"))
    x = s.crossJoin(p)
    return x.select(
        (F.col("total_queries") >= min_rows).alias("sufficient_data"),
        "total_queries", "positive_count",
        tx.ratio_round("positive_count", "total_queries", 4).alias("positive_rate"),
        "query_length_mean", "query_length_variance", "avg_latency_ms",
        "success_rate", "not_found_rate", "unique_queries",
        F.lit(min_rows).alias("required"))


def status_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))


def latency_histogram(df: DataFrame, seconds: Column, buckets: list[float] | None = None,
                      by: list[str] | None = None) -> DataFrame:
    """Cumulative bucket counts (le, count) plus +Inf, per ``by`` group, with
    sum and count; one aggregation pass (one count_if per bucket)."""
    buckets = buckets or REQUEST_LATENCY_BUCKETS
    by = by or []
    aggs = [F.count_if(seconds <= b).alias(f"b{i}") for i, b in enumerate(buckets)]
    row = df.groupBy(*by).agg(*aggs, F.count(F.lit(1)).alias("cnt"), F.sum(seconds).alias("total"))
    entries = [F.struct(F.lit(str(b)).alias("le"), F.col(f"b{i}").alias("n"))
               for i, b in enumerate(buckets)]
    entries.append(F.struct(F.lit("+Inf").alias("le"), F.col("cnt").alias("n")))
    return (row.select(*by, "cnt", "total", F.explode(F.array(*entries)).alias("e"))
            .select(*by, F.col("e.le").alias("le"), F.col("e.n").alias("bucket_count"),
                    F.col("total").alias("sum_seconds"), F.col("cnt").alias("count")))


def latency_violations(df: DataFrame, ms: Column, limit: float = MAX_LATENCY_MS,
                       by: list[str] | None = None) -> DataFrame:
    by = by or []
    return df.groupBy(*by).agg(F.count_if(ms > limit).alias("violations"),
                               F.count(F.lit(1)).alias("requests"))


def last_gauge(df: DataFrame, series: list[str], value: str, ts: str, tiebreak: str) -> DataFrame:
    """Last value per series by time (ties: largest tiebreak)."""
    return df.groupBy(*series).agg(
        F.max_by(value, F.struct(ts, tiebreak)).alias("last_value"),
        F.max(ts).alias("last_ts"))


def favorites_count(pos: DataFrame, user: str = "user_id", item: str = "movie") -> DataFrame:
    return pos.groupBy(user).agg(F.count_distinct(item).alias("favorites"))


LOG_TOTALS = ("n", "wc", "wc2", "succ", "nf", "new", "pos")
LOG_TOTALS_SCHEMA = "n long, wc double, wc2 double, succ long, nf long, new long, pos long"


def first_queries(search: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """(query, ts, event_id) of each query's first row, without queries of
    ``seen``: a min aggregate (combined map-side, so a hot query is no hot
    task)."""
    f = search.groupBy("query").agg(F.min(F.struct("ts", "event_id")).alias("f"))
    if seen is not None:
        f = f.join(seen.select("query"), "query", "left_anti")
    return f.select("query", F.col("f.ts").alias("ts"), F.col("f.event_id").alias("event_id"))


def log_rows(search: DataFrame, positives: DataFrame, firsts: DataFrame) -> DataFrame:
    """Both logs in one table of what each row adds to the running totals
    (positives sort first at equal times)."""
    wc = tx.word_count("query").cast("double")
    new = firsts.select("ts", "event_id", F.lit(1).cast("long").alias("new"))      # joined back on the unique (ts, event_id)
    srch = (search.join(new, ["ts", "event_id"], "left")
            .select("ts", "event_id", F.lit(1).alias("kind"), F.lit(1).cast("long").alias("n"), wc.alias("wc"), (wc * wc).alias("wc2"),
                    (F.col("status") == "success").cast("long").alias("succ"), (F.col("status") == "not_found").cast("long").alias("nf"),
                    F.coalesce("new", F.lit(0).cast("long")).alias("new"), F.lit(0).cast("long").alias("pos")))
    zero = [F.lit(0).cast("double" if c.startswith("wc") else "long").alias(c) for c in LOG_TOTALS[:-1]]
    return srch.unionByName(positives.select("ts", "event_id", F.lit(0).alias("kind"), *zero, F.lit(1).cast("long").alias("pos")))


def log_totals(rows: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """One row: the totals over ``rows`` and those ``before`` them."""
    all_rows = rows.select(*LOG_TOTALS)
    if before is not None:
        all_rows = all_rows.unionByName(before.select(*LOG_TOTALS))
    return all_rows.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("double" if c.startswith("wc") else "long").alias(c) for c in LOG_TOTALS])


def drift_checkpoints(search: DataFrame, positives: DataFrame, every: int = 10, before: DataFrame | None = None,
                      seen: DataFrame | None = None, success_only: bool = True) -> DataFrame:
    """Statistics over everything logged so far, at every ``every``-th search
    row (with ``success_only``: where that row is a success; order: time, then
    event id): running count, query-length mean and population variance,
    success and not-found rates, distinct queries so far and positives logged
    up to that time. Both logs go through one prefix scan.

    A log that comes in pieces goes on from the totals ``before`` it (one
    row) and the queries already ``seen``."""
    return checkpoints_of(log_rows(search, positives, first_queries(search, seen)), every, before, success_only)


def checkpoints_of(rows: DataFrame, every: int = 10, before: DataFrame | None = None, success_only: bool = True) -> DataFrame:
    s = prefix_scan(rows, ["ts", "kind", "event_id"], {c: F.col(c) for c in LOG_TOTALS})
    if before is not None:      # one row
        b = before.select(*[F.col(c).alias(f"before_{c}") for c in LOG_TOTALS])
        s = s.crossJoin(F.broadcast(b)).withColumns({f"cum_{c}": F.col(f"cum_{c}") + F.col(f"before_{c}") for c in LOG_TOTALS})
    cp = s.filter((F.col("kind") == 1) & (F.col("cum_n") % every == 0))
    if success_only:
        cp = cp.filter(F.col("succ") == 1)
    n = F.col("cum_n").cast("double")
    mean = F.col("cum_wc") / n
    return cp.select(
        F.col("cum_n").alias("rn"), "ts", "event_id",
        F.round(mean, 6).alias("query_length_mean"),
        F.round(F.greatest(F.col("cum_wc2") / n - mean * mean, F.lit(0.0)), 6).alias("query_length_variance"),
        F.round(F.col("cum_succ") / n, 6).alias("success_rate"),
        F.round(F.col("cum_nf") / n, 6).alias("not_found_rate"),
        F.col("cum_new").alias("unique_queries"),
        F.col("cum_pos").alias("positive_count"))


def active_requests(df: DataFrame, start: str, duration_ms: Column, key: str) -> DataFrame:
    """Requests in flight: +1 at start, -1 at end; running sum in time order
    (ends before starts at equal times); returns the peak and when."""
    ends = F.col(start) + F.make_dt_interval(secs=duration_ms / 1000.0)
    ev = (df.select(F.col(start).alias("t"), F.lit(1).alias("d"), F.lit(1).alias("kind"), key)
          .unionByName(df.select(ends.alias("t"), F.lit(-1).alias("d"), F.lit(0).alias("kind"), key)))
    s = prefix_scan(ev, ["t", "kind", key], {"d": F.col("d")})
    return s.agg(F.max("cum_d").alias("max_active"),
                 F.min_by("t", F.struct(-F.col("cum_d"), "t")).alias("first_peak_at"))


def session_activity(df: DataFrame, user: str, ts: str, gap: str = "30 minutes") -> DataFrame:
    """Sessions per user (gap-based), with request counts and success share."""
    return (df.groupBy(user, F.session_window(ts, gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("requests"),
                 F.count_if(F.col("status") == "success").alias("successes"))
            .select(user, F.col("s.start").alias("session_start"),
                    F.col("s.end").alias("session_end"), "requests", "successes"))
