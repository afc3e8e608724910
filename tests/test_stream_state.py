"""Stateful streams: the same rows whether the log comes as one file or in
several micro-batches, and timers that fire while a target is silent."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tagwise.operators import alerts as AL
from tagwise.operators import drift as DR
from tagwise.operators import feedback as FB
from tagwise.plans import derived
from tagwise.plans.registry import RULE_SIZES
from tagwise.streaming import alert_stream as AS
from tagwise.streaming import feedback_stream as ST

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2024, 1, 1, 10, 0, 0)

driver_tables = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables absent")


def log_files(spark, df, folder, cuts):
    """``df`` as files of the stream, cut at these times, in order of arrival."""
    for i, (a, b) in enumerate(zip([None, *cuts], [*cuts, None])):
        part = df if a is None else df.where(F.col("ts") >= F.lit(a))
        part = part if b is None else part.where(F.col("ts") < F.lit(b))
        part.coalesce(1).write.mode("append").parquet(str(folder / "events.parquet"))
        for f in os.listdir(folder / "events.parquet"):
            path = folder / "events.parquet" / f
            if f.endswith(".parquet") and os.path.getmtime(path) > 2_000_000:
                os.utime(path, (1_000_000 + i, 1_000_000 + i))


def sliced(spark, folder, n):
    e = spark.read.parquet(f"{SF}/events.parquet")
    lo, hi = e.agg(F.min("ts"), F.max("ts")).first()
    log_files(spark, e, folder, [lo + (hi - lo) * i / n for i in range(1, n)])
    return str(folder)


@driver_tables
def test_drift_state_goes_on_between_batches(spark, tmp_path):
    base = spark.createDataFrame([(10.0, 2.0)], "mean double, variance double")
    search, pos = derived.feedback_from_events(spark, SF), derived.positives_from_events(spark, SF)
    want = DR.checkpoint_drift(FB.drift_checkpoints(search, pos), base).collect()
    cut = ST.stream_drift(spark, sliced(spark, tmp_path, 3), base, max_files=1).collect()
    rows = lambda rs: sorted((r.rn, r.ts, r.mean_drift, r.variance_drift, r.success_rate, r.positive_rate, r.drift_detected) for r in rs)
    assert rows(cut) == rows(want) and len({r.epoch for r in cut}) == 3
    assert all(r.rn % 10 == 0 for r in cut)
    assert all((r.retrain_reason == f"auto_drift_{r.rn}_requests") == r.drift_detected for r in cut)


def test_checkpoints_follow_a_success_only(spark):
    log = [(i, T0 + dt.timedelta(seconds=i), f"q {i % 4}", "error" if i == 20 else "success") for i in range(1, 31)]
    search = spark.createDataFrame(log, "event_id long, ts timestamp, query string, status string")
    pos = spark.createDataFrame([(100, T0)], "event_id long, ts timestamp")
    got = {r.rn: r for r in FB.drift_checkpoints(search, pos).collect()}
    assert sorted(got) == [10, 30] and got[30].unique_queries == 4 and got[10].positive_count == 1


@driver_tables
def test_rules_fire_alike_in_one_batch_and_in_several(spark, tmp_path):
    rules = AL.rules_table(spark)
    fired = lambda df: sorted((r.rule, r.started_at, r.fired_at) for r in df.collect())
    cut = fired(AS.alert_stream(ST.feedback_stream(spark, sliced(spark, tmp_path, 3), max_files=1), rules, RULE_SIZES))
    log = derived.feedback_from_events(spark, SF).withColumn("ts", F.col("ts").cast("timestamp"))
    batch = AL.alert_for_duration(AL.evaluate_rules(AL.step_counts(log, RULE_SIZES), rules))
    closed = log.withColumn("end", F.timestamp_micros((F.floor(F.unix_micros("ts") / 60_000_000) + 1) * 60_000_000)).crossJoin(
        log.agg((F.max("ts") - F.expr("interval 10 minutes")).alias("wm"))).where("end <= wm").agg(F.max("end")).first()[0]
    assert cut == [r for r in fired(batch) if r[2] <= closed] and len(cut) > 10


def beats(spark, rows):
    return spark.createDataFrame([(t, T0 + dt.timedelta(minutes=m)) for t, m in rows], "target string, ts timestamp")


def test_silence_fires_while_it_lasts_and_once(spark, tmp_path):
    """The monitor stops at minute 4 for good; the backend pauses from 30 to 60."""
    rows = [("api", m) for m in [*range(0, 31, 3), *range(60, 100, 3)]] + [("monitor", m) for m in range(0, 5)]
    want = [("api", T0 + dt.timedelta(minutes=30)), ("monitor", T0 + dt.timedelta(minutes=4))]
    for name, cuts in (("one", []), ("two", [20]), ("four", [12, 45, 80])):
        (tmp_path / name).mkdir()
        log_files(spark, beats(spark, rows), tmp_path / name, [T0 + dt.timedelta(minutes=m) for m in cuts])
        df = ST.event_stream(spark, str(tmp_path / name), max_files=1).withWatermark("ts", "10 minutes")
        got = AS.heartbeat_stream(df, 15 * 60).collect()
        assert sorted((r.target, r.down_from) for r in got) == want, name
        assert all(r.fired_at - r.down_from == dt.timedelta(minutes=15) for r in got)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != AS.ROCKSDB


def test_silence_is_not_fired_before_its_time(spark, tmp_path):
    log_files(spark, beats(spark, [("api", m) for m in range(0, 34, 2)] + [("monitor", m) for m in range(0, 10)]), tmp_path, [T0 + dt.timedelta(minutes=11)])
    df = ST.event_stream(spark, str(tmp_path), max_files=1).withWatermark("ts", "10 minutes")
    assert AS.heartbeat_stream(df, 15 * 60).collect() == []       # the watermark is at 22, the monitor is missed at 25
