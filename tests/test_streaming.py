"""Stream twin = batch twin (closed windows only), on the smallest driver tables."""

import os

import pytest
from pyspark.sql import functions as F

from tagwise.plans import derived
from tagwise.streaming import feedback_stream as ST

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables absent")
def test_stream_window_counts_equal_batch(spark):
    got = {(r.window_start, r.status, r.n) for r in ST.stream_alert_counts(spark, SF).collect()}
    fb = derived.feedback_from_events(spark, SF)
    wm = fb.agg(F.max("ts")).first()[0]
    from datetime import timedelta
    batch = (fb.groupBy(F.window("ts", "1 hour").alias("w"), "status").count()
             .filter(F.col("w.end") <= F.lit(wm - timedelta(minutes=10)))
             .select(F.col("w.start").alias("window_start"), "status", F.col("count").alias("n")))
    want = {(r.window_start, r.status, r.n) for r in batch.collect()}
    assert got == want and len(got) > 0


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables absent")
def test_stream_dedup_equals_distinct(spark):
    got = {(r.user_id, r.movie) for r in ST.stream_positive_dedup(spark, SF).collect()}
    want = {(r.user_id, r.movie) for r in derived.positives_from_events(spark, SF)
            .select("user_id", "movie").distinct().collect()}
    assert got == want


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables absent")
def test_streams_read_files_and_folders_alike(spark, tmp_path):
    """The events table as one file, as a folder, and as two files of several micro-batches."""
    events = spark.read.parquet(f"{SF}/events.parquet")
    events.repartition(2).write.parquet(str(tmp_path / "events.parquet"))
    want = ST.stream_positive_dedup(spark, SF).select("user_id", "movie").collect()
    got = ST.stream_positive_dedup(spark, str(tmp_path)).select("user_id", "movie").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) > 0
    p = (ST.feedback_stream(spark, str(tmp_path), max_files=1).filter("event_type = 'purchase'")
         .select("user_id", "props").dropDuplicates())
    assert ST.run_available(p, "two").count() == len(want)
