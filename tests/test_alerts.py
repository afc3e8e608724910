"""Rules on sliding steps: gaps, durations, labels."""

from datetime import datetime, timedelta

from tagwise.operators import alerts as AL

T0 = datetime(2024, 1, 1)


def log(spark, rows):
    return spark.createDataFrame([(T0 + timedelta(seconds=s), st, lat) for s, st, lat in rows], "ts timestamp, status string, latency_ms double")


def test_windows_slide_by_a_step(spark):
    df = log(spark, [(10, "error", 1.0), (70, "success", 300.0), (400, "success", 1.0)])
    got = {(r["window_seconds"], int((r["evaluated_at"] - T0).total_seconds())): (r["total"], r["n_error"], r["n_violations"])
           for r in AL.step_counts(df, [120, 300]).collect()}
    assert got[120, 60] == (1, 1, 0) and got[120, 120] == (2, 1, 1) and got[120, 180] == (1, 0, 1)
    assert got[120, 240] == (0, 0, 0) and got[300, 300] == (2, 1, 1) and got[300, 360] == (1, 0, 1)
    assert len(got) == 2 * 7


def test_a_window_without_value_ends_a_run(spark):
    """The ratio has no value in an empty window: two short runs, no long one."""
    bad = [(60 * k, "error", 1.0) for k in range(4)]
    df = log(spark, bad + [(s + 1200, st, lat) for s, st, lat in bad] + [(4000, "success", 1.0)])
    ev = AL.evaluate_rules(AL.step_counts(df, [300]), AL.rules_table(spark)).filter("rule = 'HighErrorRate'")
    assert ev.filter("value is null and condition").count() == 0
    fired = AL.alert_for_duration(ev).collect()
    assert len(fired) == 2 and all(r["steps"] == 8 for r in fired)
    assert fired[0]["fired_at"] - fired[0]["started_at"] == timedelta(seconds=120)


def test_for_is_longer_than_a_step(spark):
    rows = [("r", "s", 180, T0 + timedelta(minutes=m), 1.0, c) for m, c in enumerate([True, True, True, False, True, True, True, True, True])]
    ev = spark.createDataFrame(rows, "rule string, severity string, for_seconds int, evaluated_at timestamp, value double, condition boolean")
    got = AL.alert_for_duration(ev).collect()
    assert [(r["started_at"], r["fired_at"], r["steps"]) for r in got] == [(T0 + timedelta(minutes=4), T0 + timedelta(minutes=7), 5)]


def test_host_rules_by_instance(spark):
    rows = [(i, T0 + timedelta(minutes=m), 95.0 if i else 10.0) for i in (0, 1) for m in range(8)]
    s = spark.createDataFrame(rows, "instance int, ts timestamp, cpu_used_pct double")
    s = s.selectExpr("*", "0D AS memory_used_pct", "0D AS disk_used_pct", "CAST(null AS double) AS rate_rx_bytes")
    fired = AL.alert_for_duration(AL.host_threshold(s, AL.rules_table(spark)), ["instance"])
    assert {(r["rule"], r["instance"]) for r in fired.collect()} == {("HighCPUWarning", 1), ("HighCPUCritical", 1)}
    got = {r["rule"]: (r["firings"], r["team"], r["reason"]) for r in AL.alert_labels(fired.select("rule"), AL.rules_table(spark)).collect()}
    assert got == {"HighCPUWarning": (1, "infrastructure", "high_cpu"), "HighCPUCritical": (1, "infrastructure", "high_cpu")}
