"""Structured Streaming twins of the feedback operators.

The request log arrives as a file stream (the driver's ``events`` parquet);
every query is a plain ``readStream -> transformations -> writeStream`` with
an event-time watermark, so windows are emitted once closed and late rows
beyond the watermark are dropped. ``run_available`` drains what is there
(``trigger(availableNow=True)``) into a parquet sink whose checkpoint lives in
the shared checkpoint folder, so a restarted job resumes exactly once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagwise.functions import text as tx
from tagwise.operators import drift as DR
from tagwise.operators import feedback as FB
from tagwise.session import cut_lineage, ensure_checkpoint_dir

WATERMARK = "10 minutes"


def event_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """The events table as a file stream, be it one file or a folder of part
    files. ``max_files`` bounds the files of a micro-batch (no bound unless
    given)."""
    path = f"{sf_dir.rstrip('/')}/events.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # a glob of the parent matches the file itself and, for a folder, its part files
    return reader.parquet(f"{sf_dir.rstrip('/')}/events.parque[t]")


def feedback_stream(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """Same mapping as the batch ``feedback_from_events``; ts cast to
    TIMESTAMP (watermarks need it) and watermarked."""
    e = event_stream(spark, sf_dir, max_files)
    status = (F.when(F.col("event_type") == "error", "error")
              .when(F.col("event_type") == "view", "not_found").otherwise("success"))
    return (e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id",
                     F.concat_ws(" ", "event_type", "props").alias("query"), status.alias("status"),
                     (F.col("value") * 10).alias("latency_ms"), "event_type", "props")
            .withWatermark("ts", WATERMARK))


def run_available(df: DataFrame, name: str, mode: str = "append", foreach_batch=None,
                  schema: T.StructType | str | None = None,
                  provider: str | None = None) -> DataFrame:
    """Drain the stream into a parquet table in the checkpoint folder and read
    it back as a batch DataFrame with the declared schema (``schema`` is that
    of ``foreach_batch``'s result). A batch's rows lie in a folder of its epoch
    that a retry overwrites. ``provider`` names the state store the query needs,
    if it isn't the session's."""
    if provider:
        conf = df.sparkSession.conf
        key = "spark.sql.streaming.stateStore.providerClass"
        before = conf.get(key)
        conf.set(key, provider)
        try:
            return run_available(df, name, mode, foreach_batch, schema)
        finally:
            conf.set(key, before)
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    run = f"{name}-{uuid.uuid4().hex}"
    out, ckpt = f"{base}/streams/{run}/data", f"{base}/streams/{run}/checkpoint"
    w = df.writeStream.outputMode(mode).option("checkpointLocation", ckpt).trigger(availableNow=True)
    schema = schema or df.schema
    empty = spark.createDataFrame([], schema)
    if foreach_batch is not None:
        empty.write.parquet(f"{out}/batch-none")        # the table exists, also without a batch

        def sink(batch_df, epoch_id):
            foreach_batch(batch_df, epoch_id).write.mode("overwrite").parquet(f"{out}/batch-{epoch_id}")
        q = w.foreachBatch(sink).start()
        q.awaitTermination()
        return spark.read.schema(schema).parquet(f"{out}/batch-*")
    q = w.format("parquet").option("path", out).start()
    q.awaitTermination()
    return spark.read.schema(schema).parquet(out)


def stream_feedback_ingest(spark, sf_dir) -> DataFrame:
    return run_available(feedback_stream(spark, sf_dir), "ingest")


def windowed_feedback_stats(fb: DataFrame, size: str = "1 hour") -> DataFrame:
    wc = tx.word_count("query")
    return (fb.groupBy(F.window("ts", size).alias("w"))
            .agg(F.count(F.lit(1)).alias("total_queries"),
                 F.avg(wc).alias("query_length_mean"), F.var_pop(wc).alias("query_length_variance"),
                 F.avg("latency_ms").alias("avg_latency_ms"),
                 F.count_if(F.col("status") == "success").alias("successes"),
                 F.count_if(F.col("status") == "not_found").alias("not_found"),
                 F.approx_count_distinct("query").alias("unique_queries_approx"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*")
            .drop("w"))


def stream_feedback_stats(spark, sf_dir) -> DataFrame:
    return run_available(windowed_feedback_stats(feedback_stream(spark, sf_dir)), "stats")


def stream_positive_dedup(spark, sf_dir) -> DataFrame:
    """A favourite counts once per (user, item), however far apart in time or
    in micro-batches: the state is one key per pair that was ever seen."""
    p = (feedback_stream(spark, sf_dir).filter(F.col("event_type") == "purchase")
         .select("user_id", F.col("props").alias("movie"), "ts")
         .dropDuplicates(["user_id", "movie"]))
    return run_available(p, "dedup")


def stream_session_activity(spark, sf_dir, gap: str = "30 minutes") -> DataFrame:
    s = (feedback_stream(spark, sf_dir)
         .groupBy("user_id", F.session_window("ts", gap).alias("s"))
         .agg(F.count(F.lit(1)).alias("requests"),
              F.count_if(F.col("status") == "success").alias("successes"))
         .select("user_id", F.col("s.start").alias("session_start"),
                 F.col("s.end").alias("session_end"), "requests", "successes"))
    return run_available(s, "sessions")


def stream_alert_counts(spark, sf_dir, size: str = "1 hour") -> DataFrame:
    c = (feedback_stream(spark, sf_dir).groupBy(F.window("ts", size).alias("w"), "status")
         .agg(F.count(F.lit(1)).alias("n"))
         .select(F.col("w.start").alias("window_start"), "status", "n"))
    return run_available(c, "alert_counts")


def stream_drift(spark, sf_dir, baseline: DataFrame, max_files: int | None = None) -> DataFrame:
    """One drift verdict at every tenth logged request that is a success, with
    the reason of the retraining that it asks for.

    The running statistics are state: after each micro-batch the totals (one
    row) and the queries first seen in it are written under the batch's epoch in
    the checkpoint folder, and the next batch's prefix scan goes on from them. A
    retried batch reads the epochs before its own and overwrites its own, so
    every request counts once. Requests are in time order inside a batch, and
    batches in order of arrival: a log cut into files by time gives the same
    verdicts as one file."""
    state = f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/drift-state-{uuid.uuid4().hex}"
    baseline = cut_lineage(baseline, "drift-baseline")
    none = {"totals": spark.createDataFrame([], FB.LOG_TOTALS_SCHEMA), "seen": spark.createDataFrame([], "query string")}

    def earlier(kind, epoch):       # epochs before this one
        return spark.read.parquet(f"{state}/{kind}").filter(F.col("epoch") < epoch) if epoch else none[kind]

    def keep(df, kind, epoch):
        df.write.mode("overwrite").parquet(f"{state}/{kind}/epoch={epoch}")

    def per_batch(batch_df, epoch):
        last = earlier("totals", epoch) if epoch == 0 else earlier("totals", epoch).filter(F.col("epoch") == epoch - 1)
        before = FB.log_totals(none["totals"], last)
        pos = batch_df.filter(F.col("event_type") == "purchase")
        firsts = cut_lineage(FB.first_queries(batch_df, earlier("seen", epoch)), "drift-firsts")
        rows = cut_lineage(FB.log_rows(batch_df, pos, firsts), "drift-rows")
        keep(FB.log_totals(rows, before), "totals", epoch)
        keep(firsts.select("query"), "seen", epoch)
        verdict = DR.checkpoint_drift(FB.checkpoints_of(rows, before=before), baseline)
        return DR.retrain_reason(verdict).withColumn("epoch", F.lit(epoch).cast("long"))

    schema = ("rn long, ts timestamp, mean_drift double, variance_drift double, success_rate double, positive_rate double, "
              "drift_detected boolean, retrain_reason string, epoch long")
    return run_available(feedback_stream(spark, sf_dir, max_files), "drift", foreach_batch=per_batch, schema=schema)
