"""Drift detection, retrain requests, quality gate and the model registry.

The registry is an append-only table of versions; "pointers" (latest,
production, previous production) are derived with windows and max_by rather
than mutated, so promote / rollback are pure queries over it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagwise.functions import text as tx

from tagwise.functions.fixed import (DRIFT_THRESHOLD_MEAN, DRIFT_THRESHOLD_VARIANCE,
                                     LOW_POSITIVE_RATE, LOW_SUCCESS_RATE, MIN_GENRE_MATCH,
                                     POSITIVE_RATE_MIN_TOTAL)


def baseline_row(baseline: DataFrame) -> DataFrame:
    """(base_mean, base_var) rounded to 9 digits, so the drift ratios do not
    depend on the summation order of the engine that built the baseline."""
    return baseline.select(F.round("mean", 9).alias("base_mean"),
                           F.round(F.coalesce(F.col("variance"), F.lit(1.0)), 9).alias("base_var"))


def detect_drift(stats: DataFrame, baseline: DataFrame | None) -> DataFrame:
    """stats: one row of ``feedback_stats``; baseline: one row (mean,
    variance) or None. Returns one row with scores, signals and action."""
    if baseline is None:
        return stats.select(F.lit(False).alias("drift_detected"), F.lit("no_baseline").alias("reason"),
                            F.lit(None).cast("double").alias("mean_drift"),
                            F.lit(None).cast("double").alias("variance_drift"),
                            F.lit(0).alias("signal_count"), F.lit("").alias("signals"),
                            F.lit("NO_ACTION").alias("recommendation"))
    b = baseline_row(baseline)
    x = stats.crossJoin(F.broadcast(b))  # 1 x 1 rows
    has_base = F.col("base_mean") > 0
    md = F.when(has_base, F.abs(F.col("query_length_mean") - F.col("base_mean")) / F.col("base_mean"))
    vd = F.when(has_base, F.abs(F.col("query_length_variance") - F.col("base_var"))
                / F.greatest(F.col("base_var"), F.lit(1.0)))
    pct = lambda c: F.format_string("%.1f%%", c * 100)
    signals = F.array_compact(F.array(
        F.when(md > DRIFT_THRESHOLD_MEAN, F.concat(F.lit("Query length mean drifted "), pct(md))),
        F.when(vd > DRIFT_THRESHOLD_VARIANCE, F.concat(F.lit("Query length variance drifted "), pct(vd))),
        F.when(F.col("success_rate") < LOW_SUCCESS_RATE,
               F.concat(F.lit("Low success rate: "), pct(F.col("success_rate")))),
        F.when((F.col("total_queries") > POSITIVE_RATE_MIN_TOTAL)
               & (F.coalesce("positive_rate", F.lit(0.0)) < LOW_POSITIVE_RATE),
               F.concat(F.lit("Low positive feedback rate: "),
                        pct(F.coalesce("positive_rate", F.lit(0.0)))))))
    ok = F.col("sufficient_data")
    drifted = ok & (F.size(signals) > 0)
    return x.select(
        drifted.alias("drift_detected"),
        F.when(~ok, "insufficient_data").otherwise("evaluated").alias("reason"),
        F.when(ok, F.round(md, 4)).alias("mean_drift"),
        F.when(ok, F.round(vd, 4)).alias("variance_drift"),
        F.when(ok, F.size(signals)).otherwise(0).alias("signal_count"),
        F.when(ok, F.array_join(signals, "; ")).otherwise("").alias("signals"),
        F.when(drifted, "RETRAIN").otherwise("NO_ACTION").alias("recommendation"))


def drift_scores(stats: DataFrame, baseline: DataFrame) -> DataFrame:
    """(feature, score) rows: mean/variance drift, plus 1 - rate for the
    success and positive rates when they signalled."""
    d = detect_drift(stats, baseline).crossJoin(stats.select("success_rate", "positive_rate",
                                                             "total_queries"))
    rows = F.array(
        F.struct(F.lit("query_length_mean").alias("feature"), F.col("mean_drift").alias("score")),
        F.struct(F.lit("query_length_variance").alias("feature"), F.col("variance_drift").alias("score")),
        F.struct(F.lit("success_rate").alias("feature"),
                 F.when(F.col("success_rate") < LOW_SUCCESS_RATE,
                        F.round(1 - F.col("success_rate"), 4)).alias("score")),
        F.struct(F.lit("positive_rate").alias("feature"),
                 F.when((F.col("total_queries") > POSITIVE_RATE_MIN_TOTAL)
                        & (F.col("positive_rate") < LOW_POSITIVE_RATE),
                        F.round(1 - F.col("positive_rate"), 4)).alias("score")))
    return (d.select(F.explode(rows).alias("r")).select("r.feature", "r.score")
            .filter(F.col("score").isNotNull()))


def checkpoint_drift(checkpoints: DataFrame, baseline: DataFrame) -> DataFrame:
    """Drift verdict at every checkpoint of ``drift_checkpoints`` (the
    per-10-requests evaluation), with the retrain request it would raise."""
    b = baseline_row(baseline)
    x = checkpoints.crossJoin(F.broadcast(b))
    md = F.abs(F.col("query_length_mean") - F.col("base_mean")) / F.col("base_mean")
    vd = F.abs(F.col("query_length_variance") - F.col("base_var")) / F.greatest(F.col("base_var"), F.lit(1.0))
    prate = tx.ratio_round("positive_count", "rn", 4)
    drifted = ((md > DRIFT_THRESHOLD_MEAN) | (vd > DRIFT_THRESHOLD_VARIANCE)
               | (F.col("success_rate") < LOW_SUCCESS_RATE)
               | ((F.col("rn") > POSITIVE_RATE_MIN_TOTAL) & (prate < LOW_POSITIVE_RATE)))
    return x.select("rn", "ts", F.round(md, 4).alias("mean_drift"), F.round(vd, 4).alias("variance_drift"),
                    "success_rate", prate.alias("positive_rate"), drifted.alias("drift_detected"))


def retrain_reason(verdicts: DataFrame) -> DataFrame:
    """``verdicts`` with the reason of the retraining that each asks for (null:
    none)."""
    return verdicts.withColumn("retrain_reason", F.when(
        F.col("drift_detected"), F.concat(F.lit("auto_drift_"), F.col("rn").cast("string"), F.lit("_requests"))))


def retrain_requests(verdicts: DataFrame, triggered_by: str = "drift_detection") -> DataFrame:
    """Outbox rows for every drifted checkpoint (delivery is not built)."""
    return (retrain_reason(verdicts).filter("drift_detected")
            .select(F.concat(F.lit("retrain_"), F.date_format("ts", "yyyyMMdd_HHmmss"),
                             F.lit("_"), F.col("rn").cast("string")).alias("request_id"),
                    F.col("retrain_reason").alias("reason"), F.lit(triggered_by).alias("triggered_by"),
                    "ts", "rn"))


def quality_gate(runs: DataFrame, score_col: str = "genre_match_rate",
                 threshold: float = MIN_GENRE_MATCH) -> DataFrame:
    return runs.withColumn("decision", F.when(F.col(score_col) >= threshold, "promote")
                           .otherwise("rollback"))


def stage_transitions(registry: DataFrame, score_col: str = "genre_match_rate",
                      threshold: float = MIN_GENRE_MATCH) -> DataFrame:
    """Replay the registry in version order: a passing version goes to
    Production and archives the one before it; a failing one stays in
    Staging. Final stage per version plus the version it replaced."""
    w = Window.orderBy("registered_at", "version")
    passing = F.col(score_col) >= threshold
    x = registry.select("*", passing.alias("_pass"))
    # the next passing version after each row archives it
    nxt = F.min(F.when(F.col("_pass"), F.struct("registered_at", "version"))).over(
        w.rowsBetween(1, Window.unboundedFollowing))
    prev = F.max(F.when(F.col("_pass"), F.col("version"))).over(
        w.rowsBetween(Window.unboundedPreceding, -1))
    return x.select("version", "registered_at", F.col(score_col),
                    F.when(~F.col("_pass"), "Staging")
                     .when(nxt.isNotNull(), "Archived").otherwise("Production").alias("stage"),
                    F.when(F.col("_pass"), prev).alias("replaced_version"))


def registry_describe(registry: DataFrame, score_col: str = "genre_match_rate") -> DataFrame:
    return registry.select(
        "version",
        F.format_string("Content model, genre match rate %.4f, %d items, vocabulary %d",
                        F.col(score_col), F.col("n_items"), F.col("vocabulary_size")).alias("description"),
        F.create_map(F.lit("genre_match_rate"), F.format_string("%.4f", F.col(score_col)),
                     F.lit("trained_on"), F.date_format("registered_at", "yyyy-MM-dd")).alias("tags"))


def latest_pointer(registry: DataFrame) -> DataFrame:
    """The newest version (``unknown`` when the registry is empty)."""
    return registry.agg(F.coalesce(F.max_by("version", F.struct("registered_at", "version")),
                                   F.lit("unknown")).alias("latest_version"))


def promote_and_rollback(registry: DataFrame, score_col: str = "genre_match_rate",
                         threshold: float = MIN_GENRE_MATCH) -> DataFrame:
    """Per version: gate decision, the promoted version serving after it
    (itself when promoted, else the previous promoted one, none -> keep
    current) and the backup location of the version it replaced."""
    w = Window.orderBy("registered_at", "version").rowsBetween(Window.unboundedPreceding, -1)
    passing = F.col(score_col) >= threshold
    prev_prod = F.max_by(F.when(passing, F.col("version")),
                         F.when(passing, F.struct("registered_at", "version"))).over(w)
    x = registry.select("*", passing.alias("_pass"), prev_prod.alias("_prev"))
    return x.select(
        "version", F.round(score_col, 4).alias(score_col),
        F.when(F.col("_pass"), "promote").otherwise("rollback").alias("decision"),
        F.when(F.col("_pass"), F.col("version"))
         .otherwise(F.coalesce(F.col("_prev"), F.lit("keep_current"))).alias("serving_version"),
        F.when(F.col("_pass") & F.col("_prev").isNotNull(),
               F.concat(F.lit("backup/"), F.col("_prev"))).alias("backup_location"))


def rollback_version(registry: DataFrame, score_col: str = "genre_match_rate",
                     threshold: float = MIN_GENRE_MATCH) -> DataFrame:
    """Per version as the serving one: what a rollback restores, the last
    promoted version before it; status ``rolled_back``, or ``no_backup`` where
    none was promoted before (the pointer stays)."""
    w = Window.orderBy("registered_at", "version").rowsBetween(Window.unboundedPreceding, -1)     # one row per version
    passing = F.col(score_col) >= threshold
    prev = F.max_by(F.when(passing, F.col("version")), F.when(passing, F.struct("registered_at", "version"))).over(w)
    return registry.select("version", prev.alias("prev")).select(
        "version", F.coalesce("prev", "version").alias("serving_version"),
        F.when(F.col("prev").isNull(), "no_backup").otherwise("rolled_back").alias("status"))


def latest_baseline(model_baselines: DataFrame, store_baselines: DataFrame) -> DataFrame:
    """The model's own baseline first, else the lexically largest store version."""
    u = (model_baselines.select(F.lit(0).alias("prio"), "version", "path")
         .unionByName(store_baselines.select(F.lit(1).alias("prio"), "version", "path")))
    return u.orderBy("prio", F.desc("version")).limit(1).select("version", "path")


def artifact_readiness(required: DataFrame, present: DataFrame, name: str = "artifact") -> DataFrame:
    """Missing required artifacts (anti join) and the ready flag."""
    missing = required.join(present, name, "left_anti")
    return missing.agg(F.sort_array(F.collect_list(name)).alias("missing"),
                       F.count(F.lit(1)).alias("missing_count")) \
        .select((F.col("missing_count") == 0).alias("ready"), "missing_count", "missing")


def experiment_metrics(run_id: DataFrame, metrics: dict) -> DataFrame:
    """(run_id, kind, key, value) long table from named metric columns."""
    cols = [F.struct(F.lit(kind).alias("kind"), F.lit(k).alias("key"),
                     F.col(k).cast("double").alias("value"))
            for kind, keys in metrics.items() for k in keys]
    return (run_id.select("run_id", F.explode(F.array(*cols)).alias("m"))
            .select("run_id", "m.kind", "m.key", "m.value"))
