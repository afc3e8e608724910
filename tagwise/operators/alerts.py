"""Alert rules over the request log, evaluated on sliding steps.

* ``step_counts``: the log is counted once per step (one minute); every step's
  counts are added to the windows (the last w steps) that hold it, so windows
  slide by a step with one scan of the log and no ordered window over time. A
  time spine (one row per step of the log's span, not of its rows) gives the
  empty windows, which have zero counts and no ratio.
* ``evaluate_rules``: one generic evaluator; the fixed rule table (24 rows) is
  broadcast and every rule's signal is a CASE over the window columns. A signal
  without value makes the condition false.
* ``alert_for_duration``: runs of consecutive true steps per rule (and
  instance); a rule fires at the first step that lies ``for`` seconds after the
  run's first one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagwise.functions.fixed import ALERT_RULES, MAX_LATENCY_MS, REQUEST_LATENCY_BUCKETS
from tagwise.operators.feedback import global_lag, prefix_scan

RULE_SCHEMA = ("rule string, signal string, window_seconds int, op string, threshold double, "
               "for_seconds int, severity string, team string, reason string")
LOG_SIGNALS = ["ratio_5xx", "ratio_error", "ratio_not_found", "ratio_success", "pct_4xx_5xx", "rate_success",
               "rate_requests", "increase_violations", "p95_latency_ms"]
HOST_SIGNALS = ["cpu_used_pct", "memory_used_pct", "disk_used_pct", "rate_rx_bytes"]


def rules_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ALERT_RULES, RULE_SCHEMA)


STEP = 60


def count_columns(buckets: list[float] | None = None) -> list:
    """What a step counts of the log."""
    return [F.count(F.lit(1)).alias("total"),
            F.count_if(F.col("status") == "error").alias("n_error"),
            F.count_if(F.col("status") == "not_found").alias("n_not_found"),
            F.count_if(F.col("status") == "success").alias("n_success"),
            F.count_if(F.col("latency_ms") > MAX_LATENCY_MS).alias("n_violations"),
            *[F.count_if(F.col("latency_ms") / 1000.0 <= b).alias(f"b{i}") for i, b in enumerate(buckets or REQUEST_LATENCY_BUCKETS)]]


def step_counts(log: DataFrame, sizes: list[int], ts: str = "ts",
                buckets: list[float] | None = None, step: int = STEP) -> DataFrame:
    """(window_seconds, evaluated_at, total, n_error, n_not_found, n_success,
    n_violations, b0..bk): evaluated_at = end of a step, counts over the
    ``window_seconds`` before it."""
    us = step * 1_000_000
    k = F.floor(F.unix_micros(F.col(ts)) / us)
    per = log.groupBy(k.alias("k")).agg(*count_columns(buckets))
    names = [c for c in per.columns if c != "k"]
    span = log.agg(F.floor(F.unix_micros(F.min(ts)) / us).alias("k0"), F.floor(F.unix_micros(F.max(ts)) / us).alias("k1"))
    all_sizes = F.explode(F.array(*[F.lit(w) for w in sizes])).alias("window_seconds")
    spine = (span.where("k0 is not null").select(all_sizes, "k0", "k1")
             .select("window_seconds", F.explode(F.sequence("k0", "k1")).alias("k")))
    held = (per.select("*", all_sizes)
            .select("window_seconds", *names, F.explode(F.sequence(F.col("k"), F.col("k") + (F.col("window_seconds") / step).cast("long") - 1)).alias("k"))
            .groupBy("window_seconds", "k").agg(*[F.sum(c).alias(c) for c in names]))
    return (spine.join(held, ["window_seconds", "k"], "left").na.fill(0, names)
            .select("window_seconds", F.timestamp_micros((F.col("k") + 1) * us).alias("evaluated_at"), *names))


def p95_from_buckets(buckets: list[float] | None = None, q: float = 0.95):
    """Histogram quantile: the bucket where the cumulative count reaches
    q * total, linear inside it (lower edge 0 for the first bucket); beyond
    the last finite bucket -> that bucket's upper edge. In milliseconds."""
    buckets = buckets or REQUEST_LATENCY_BUCKETS
    rank = F.lit(q) * F.col("total")
    expr = F.lit(buckets[-1] * 1000.0)
    for i in reversed(range(len(buckets))):
        lo = 0.0 if i == 0 else buckets[i - 1]
        prev = F.lit(0) if i == 0 else F.col(f"b{i - 1}")
        inside = lo + (buckets[i] - lo) * (rank - prev) / (F.col(f"b{i}") - prev)
        expr = F.when(F.col(f"b{i}") >= rank, inside * 1000.0).otherwise(expr)
    return F.when(F.col("total") > 0, expr)


def compare(value, op="op", threshold="threshold"):
    """The rule's condition; false where there is no value."""
    o, t = F.col(op), F.col(threshold)
    return F.coalesce(F.when(o == ">", value > t).when(o == "<", value < t).when(o == "==", value == t), F.lit(False))


def evaluate_rules(counts: DataFrame, rules: DataFrame) -> DataFrame:
    """(rule, severity, for_seconds, evaluated_at, value, condition) for every windowed
    rule whose signal the log carries."""
    r = rules.filter(F.col("signal").isin(LOG_SIGNALS))
    x = counts.join(F.broadcast(r), "window_seconds")
    tot = F.col("total")
    ratio = lambda n: F.when(tot > 0, F.col(n) / tot)
    value = (F.when(F.col("signal") == "ratio_5xx", ratio("n_error"))
             .when(F.col("signal") == "ratio_error", ratio("n_error"))
             .when(F.col("signal") == "ratio_not_found", ratio("n_not_found"))
             .when(F.col("signal") == "ratio_success", ratio("n_success"))
             .when(F.col("signal") == "pct_4xx_5xx",
                   F.when(tot > 0, (F.col("n_error") + F.col("n_not_found")) / tot * 100))
             .when(F.col("signal") == "rate_success", F.col("n_success") / F.col("window_seconds"))
             .when(F.col("signal") == "rate_requests", tot / F.col("window_seconds"))
             .when(F.col("signal") == "increase_violations", F.col("n_violations").cast("double"))
             .when(F.col("signal") == "p95_latency_ms", p95_from_buckets()))
    return (x.withColumn("value", value).withColumn("condition", compare(F.col("value")))
            .select("rule", "severity", "for_seconds", "evaluated_at", "value", "condition"))


def host_threshold(samples: DataFrame, rules: DataFrame, ts: str = "ts", step: int = STEP) -> DataFrame:
    """Samples (instance, ts, one column per host signal) -> the rules on host
    signals: per instance and step the mean of the samples in the rule's
    window (of the step itself where the rule has none)."""
    us = step * 1_000_000
    k = F.floor(F.unix_micros(F.col(ts)) / us)
    long = samples.select("instance", k.alias("k"), F.explode(F.array(*[
        F.struct(F.lit(s).alias("signal"), F.col(s).cast("double").alias("v")) for s in HOST_SIGNALS])).alias("s"))
    per = long.groupBy("instance", "k", "s.signal").agg(F.sum("s.v").alias("sum"), F.count("s.v").alias("n"))
    r = rules.filter(F.col("signal").isin(HOST_SIGNALS))
    w = (F.greatest(F.col("window_seconds"), F.lit(step)) / step).cast("long")
    x = (per.join(F.broadcast(r), "signal")
         .withColumn("k", F.explode(F.sequence(F.col("k"), F.col("k") + w - 1)))
         .groupBy("rule", "severity", "for_seconds", "op", "threshold", "instance", "k")
         .agg((F.sum("sum") / F.sum("n")).alias("value")))
    return x.select("rule", "severity", "for_seconds", "instance", F.timestamp_micros((F.col("k") + 1) * us).alias("evaluated_at"),
                    "value", compare(F.col("value")).alias("condition"))


def alert_for_duration(evaluated: DataFrame, by: list[str] | None = None, step: int = STEP) -> DataFrame:
    """Runs of consecutive true steps per rule and ``by`` columns; one row per
    run whose last step lies at least ``for_seconds`` after its first:
    (rule, severity, by.., started_at, fired_at, steps)."""
    by = ["rule", "severity", "for_seconds", *(by or [])]
    us = step * 1_000_000
    true = evaluated.filter("condition").withColumn("k", F.floor(F.unix_micros("evaluated_at") / us))
    # consecutive steps keep the same distance to their rank; a gap or a false step changes it
    x = true.withColumn("run", F.col("k") - F.row_number().over(Window.partitionBy(*by).orderBy("k")))
    runs = x.groupBy(*by, "run").agg(F.min("evaluated_at").alias("started_at"), F.count(F.lit(1)).alias("steps"))
    return (runs.filter((F.col("steps") - 1) * step >= F.col("for_seconds"))
            .withColumn("fired_at", F.timestamp_micros(F.unix_micros("started_at") + F.col("for_seconds") * 1_000_000))
            .select(*[c for c in by if c != "for_seconds"], "started_at", "fired_at", "steps"))


def alert_labels(fired: DataFrame, rules: DataFrame) -> DataFrame:
    """Firings per rule with the rule's labels (severity, team, reason)."""
    n = fired.groupBy("rule").agg(F.count(F.lit(1)).alias("firings"))
    return n.join(F.broadcast(rules.select("rule", "severity", "team", "reason", "signal")), "rule")


def rate_windows(log: DataFrame, size: str, slide: str | None = None, ts: str = "ts",
                 label: str = "status") -> DataFrame:
    """Events per second per label in tumbling or sliding windows."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    seconds = F.unix_micros(F.col("window.end")) / 1e6 - F.unix_micros(F.col("window.start")) / 1e6
    return (log.groupBy(w.alias("window"), label).agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("window.start").alias("window_start"), label, "n",
                    (F.col("n") / seconds).alias("rate")))


def gauge_alert(log: DataFrame, value: str, threshold: float, for_seconds: int,
                ts: str = "ts", tiebreak: str = "event_id") -> DataFrame:
    """Last-value gauge: runs of consecutive samples above ``threshold``
    lasting >= for_seconds (first to last sample of the run). Run ids come
    from a distributed prefix sum of change flags."""
    x = log.select(ts, tiebreak, (F.col(value) > threshold).alias("c"))
    x = global_lag(x, [ts, tiebreak], "c", "pc")
    x = prefix_scan(x, [ts, tiebreak], {"chg": F.when(F.col("c") != F.col("pc"), 1).otherwise(0)})
    runs = (x.filter("c").groupBy(F.col("cum_chg").alias("run"))
            .agg(F.min(ts).alias("started_at"), F.max(ts).alias("ended_at"),
                 F.count(F.lit(1)).alias("samples")))
    dur = F.unix_micros("ended_at") - F.unix_micros("started_at")
    return runs.filter(dur >= for_seconds * 1_000_000).select("started_at", "ended_at", "samples")


def up_alert(log: DataFrame, max_gap_seconds: int, ts: str = "ts", tiebreak: str = "event_id") -> DataFrame:
    """Target silent: heartbeat gaps longer than the limit."""
    x = global_lag(log.select(ts, tiebreak), [ts, tiebreak], ts, "prev")
    gap = F.unix_micros(ts) - F.unix_micros("prev")
    return (x.filter(gap > max_gap_seconds * 1_000_000)
            .select(F.col("prev").alias("down_from"), F.col(ts).alias("up_again"),
                    (gap / 1e6).alias("gap_seconds")))
