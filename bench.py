"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]
and print one JSON line {"metric", "value", "unit", "queries", "sf"}.

Each query is fully computed into Spark's no-op sink (no collect), so the
time covers the whole plan; the session is shared and warmed up once.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "topk_neighbours",        # TF-IDF + exact blocked cosine top-20 (flagship)
    "embedding_topk",
    "genre_match_rate",
    "baseline_statistics",
    "feature_importance",
    "parse_catalog",
    "quality_issues",
    "missing_values",
    "feedback_stats",
    "latency_histogram",
    "drift_checkpoints",
    "detect_drift",
    "session_activity",
    "promote_version",
    "route_query",
    "enrich_metadata",
    "alert_for_duration",
    "stream_feedback_stats",
    "feature_impact",
    "title_recommend",
    "search_by_person",
    "similarity_summary",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    from tagwise.session import build_session
    spark = build_session(f"local[{cpus}]", max(cpus, 8),
                          extra={"spark.ui.showConsoleProgress": "false"})
    from tagwise.plans.registry import QUERIES

    # warm-up: JVM, Python workers, codegen paths (not timed)
    QUERIES["baseline_director_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times, errors = {}, {}
    for name in names:
        t = time.time()
        try:
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t, 3)
            print(f"[bench] {name} {times[name]}s", file=sys.stderr, flush=True)
        except Exception as e:  # report, keep going
            errors[name] = repr(e)[:300]
        finally:
            spark.catalog.clearCache()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else sf_dir}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
