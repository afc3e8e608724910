import datetime as dt

from tagwise.plans.sql_registry import ORACLE
from tagwise.operators import feedback as FB
from tagwise.plans.registry import QUERIES

T0 = dt.datetime(2026, 1, 1)


def write_events(spark, folder, kinds):
    rows = [(i, T0 + dt.timedelta(seconds=i), i % 3, k, float(i % 5), '{"k": %d}' % (i % 4)) for i, k in enumerate(kinds, 1)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string") \
        .write.parquet(f"{folder}/events.parquet")
    docs = [(i, f"Heading {i}. some words of the text", "en", "s") for i in range(4)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/documents.parquet")


def test_every_tenth_row_is_a_checkpoint(spark, tmp_path):
    kinds = ["click"] * 30
    kinds[9], kinds[19] = "error", "view"       # rows 10 and 20 are no successes
    write_events(spark, str(tmp_path), kinds)
    for name in ("drift_checkpoints", "checkpoint_drift", "retrain_requests"):
        got = QUERIES[name](spark, str(tmp_path))
        assert sorted(r.rn for r in got.select("rn").collect()) == [10, 20, 30], name
        assert "status = 'success' AND cum_n" not in ORACLE[name]


def test_success_only_stays_for_the_stream(spark):
    log = [(i, T0 + dt.timedelta(seconds=i), "q", "error" if i == 20 else "success") for i in range(1, 31)]
    search = spark.createDataFrame(log, "event_id long, ts timestamp, query string, status string")
    pos = spark.createDataFrame([(100, T0)], "event_id long, ts timestamp")
    rn = lambda **k: sorted(r.rn for r in FB.drift_checkpoints(search, pos, **k).collect())
    assert rn() == [10, 30] and rn(success_only=False) == [10, 20, 30]
