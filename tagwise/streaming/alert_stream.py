"""Alerts on the stream: chained stateful operators with event-time timers.

``alert_stream``: the log is counted per minute (a windowed aggregate, so a hot
minute is combined map-side), the minutes become sliding windows (state per
window size: the minutes that the longest window still needs), the rules are
evaluated by the batch operator's expressions, and runs of true steps are
followed (state per rule: the run's first and last step). A rule fires at the
step that lies its ``for`` behind the run's first one, while the run goes on.

``heartbeat_stream``: heartbeats are reduced to each target's first and last one
per minute; a target's state is its last heartbeat, with a timer at the end of
the minute in which it would be missed. The alert fires when the watermark
passes that time, so while the target is silent, and once per silence.

Minutes are final once the watermark has passed them. A task holds one key's
rows, which are minutes and not requests.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tagwise.functions.fixed import REQUEST_LATENCY_BUCKETS
from tagwise.operators import alerts as AL
from tagwise.streaming.feedback_stream import run_available

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STEP_MS = AL.STEP * 1000
COUNTS = ["total", "n_error", "n_not_found", "n_success", "n_violations", *[f"b{i}" for i in range(len(REQUEST_LATENCY_BUCKETS))]]


def _sorted(rows: Iterator[pd.DataFrame], by: str) -> pd.DataFrame:
    """The key's rows of a micro-batch: at most one per minute."""
    return pd.concat(list(rows), ignore_index=True).sort_values(by, kind="stable", ignore_index=True)


class SlidingCounts(StatefulProcessor):
    """Minutes -> counts of the window that ends with each minute, minutes
    without requests included. State: the last minutes that later windows
    reach back to."""

    OUT = f"window_seconds int, evaluated_at timestamp, {', '.join(f'{c} long' for c in COUNTS)}"

    def init(self, handle):
        self.kept = handle.getValueState("kept", "minutes array<array<long>>")

    def handleInputRows(self, key, rows, timerValues):
        steps = key[0] // AL.STEP
        new = _sorted(rows, "k")[["k", *COUNTS]].to_numpy(np.int64)
        old = np.array(self.kept.get()[0], np.int64).reshape(-1, len(COUNTS) + 1) if self.kept.exists() else new[:0]
        begin, end = (old[-1, 0] + 1 if len(old) else new[0, 0]), new[-1, 0]
        table = np.zeros((end - begin + steps, len(COUNTS)), np.int64)      # the steps - 1 minutes before, then begin..end
        for part in (old, new):
            at = part[:, 0] - begin + steps - 1
            np.add.at(table, at[at >= 0], part[at >= 0, 1:])
        upto = np.concatenate([np.zeros((1, len(COUNTS)), np.int64), table.cumsum(axis=0)])
        held = upto[steps:] - upto[:-steps]
        out = pd.DataFrame(held, columns=COUNTS)
        out.insert(0, "evaluated_at", pd.to_datetime((np.arange(begin, end + 1) + 1) * STEP_MS, unit="ms", utc=True))
        out.insert(0, "window_seconds", key[0])
        every = np.concatenate([old, new])
        self.kept.update(([[int(x) for x in r] for r in every[(every[:, 0] > end - steps) | (every[:, 0] == end)]],))
        yield out

    def close(self):
        pass


class RunState(StatefulProcessor):
    """True steps of a rule -> the firings of its runs. State: first and last
    step of the run, and whether it has fired."""

    OUT = "rule string, severity string, started_at timestamp, fired_at timestamp"

    def init(self, handle):
        self.run = handle.getValueState("run", "first long, last long, fired boolean")

    def handleInputRows(self, key, rows, timerValues):
        rule, severity, for_seconds = key
        first, last, fired = self.run.get() if self.run.exists() else (None, None, False)
        out = []
        for k in _sorted(rows, "k")["k"].tolist():
            if last is None or k != last + 1:
                first, fired = k, False
            last = k
            if not fired and (k - first) * AL.STEP >= for_seconds:
                begin = pd.Timestamp(first * STEP_MS, unit="ms", tz="UTC")
                out.append((rule, severity, begin, begin + pd.Timedelta(seconds=for_seconds)))
                fired = True
        self.run.update((first, last, fired))
        yield pd.DataFrame(out, columns=["rule", "severity", "started_at", "fired_at"])

    def close(self):
        pass


def firing_rules(fb: DataFrame, rules: DataFrame, sizes: list[int]) -> DataFrame:
    """Watermarked request log -> one row per firing of a rule on the log."""
    minute = fb.groupBy(F.window("ts", f"{AL.STEP} seconds").alias("w")).agg(*AL.count_columns())
    k = F.floor(F.unix_micros("w.start") / (AL.STEP * 1_000_000)).cast("long")
    per_size = minute.select(F.explode(F.array(*[F.lit(s) for s in sizes])).alias("window_seconds"), k.alias("k"), *COUNTS)
    counts = per_size.groupBy("window_seconds").transformWithStateInPandas(SlidingCounts(), SlidingCounts.OUT, "append", "None")
    true = AL.evaluate_rules(counts, rules).filter("condition")
    step = F.floor(F.unix_micros("evaluated_at") / (AL.STEP * 1_000_000)).cast("long")
    return (true.select("rule", "severity", "for_seconds", step.alias("k")).groupBy("rule", "severity", "for_seconds")
            .transformWithStateInPandas(RunState(), RunState.OUT, "append", "None"))


def alert_stream(fb: DataFrame, rules: DataFrame, sizes: list[int]) -> DataFrame:
    return run_available(firing_rules(fb, rules, sizes), "alerts", provider=ROCKSDB)


class Heartbeat(StatefulProcessor):
    """First and last heartbeat of each minute -> one row per silence that is
    longer than the limit. State: the last heartbeat, its timer, and whether
    the silence since then has fired."""

    OUT = "target string, down_from timestamp, fired_at timestamp"

    def __init__(self, limit_seconds: int):
        self.limit = limit_seconds * 1_000_000

    def init(self, handle):
        self.handle = handle
        self.last = handle.getValueState("last", "last long, timer long, fired boolean")

    def _row(self, key, last):
        return (key[0], pd.Timestamp(last, unit="us", tz="UTC"), pd.Timestamp(last + self.limit, unit="us", tz="UTC"))

    def _missed(self, last: int) -> int:
        """End of the minute in which the heartbeat is missed, in ms: then no
        heartbeat of before can still come."""
        return ((last + self.limit) // (STEP_MS * 1000) + 1) * STEP_MS

    def handleInputRows(self, key, rows, timerValues):
        last, timer, fired = self.last.get() if self.last.exists() else (None, None, False)
        out = []
        for a, b in _sorted(rows, "first_at")[["first_at", "last_at"]].itertuples(index=False):
            if last is not None and not fired and a - last > self.limit:
                out.append(self._row(key, last))
            last, fired = int(b), False
        if timer is not None:
            self.handle.deleteTimer(timer)
        due = self._missed(last)
        if due <= timerValues.getCurrentWatermarkInMs():
            out.append(self._row(key, last))
            timer, fired = None, True
        else:
            timer = due
            self.handle.registerTimer(timer)
        self.last.update((last, timer, fired))
        yield pd.DataFrame(out, columns=["target", "down_from", "fired_at"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        last, _, fired = self.last.get()
        self.last.update((last, None, True))
        yield pd.DataFrame([] if fired else [self._row(key, last)], columns=["target", "down_from", "fired_at"])

    def close(self):
        pass


def silences(beats: DataFrame, limit_seconds: int) -> DataFrame:
    """Watermarked heartbeats (target, ts) -> (target, down_from, fired_at)."""
    us = F.unix_micros("ts")
    minute = beats.groupBy("target", F.window("ts", f"{AL.STEP} seconds").alias("w")).agg(F.min(us).alias("first_at"), F.max(us).alias("last_at"))
    return (minute.select("target", "first_at", "last_at").groupBy("target")
            .transformWithStateInPandas(Heartbeat(limit_seconds), Heartbeat.OUT, "append", "EventTime"))


def heartbeat_stream(beats: DataFrame, limit_seconds: int) -> DataFrame:
    return run_available(silences(beats, limit_seconds), "up", provider=ROCKSDB)
