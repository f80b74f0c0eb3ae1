"""Times the headline queries and prints one JSON line.

Every query is built and executed in full (to the ``noop`` sink). Environment: BENCH_SF_DIR, BENCH_CPUS, and
BENCH_QUERIES (names separated by commas, or ``all``).
"""

from __future__ import annotations

import json
import os
import sys
import time

from callsieve import plans
from callsieve.session import local_session

HEADLINE = [
    "number_risk", "salted_partial", "skew_report", "hot_rows_semi", "complaint_features_20", "behavior_features_31",
    "fraud_features", "profile_describe", "profile_missing", "pr_curve", "roc_auc", "threshold_f1", "psi_total", "drift_report",
    "ab_ztest", "running_consensus", "running_dominant_category", "asof_reputation", "burst_throttle", "report_decisions",
    "stream_features_running", "training_set", "inject_missing", "dbscan", "train_lr", "score_numbers",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    named = os.environ.get("BENCH_QUERIES", "")
    names = list(plans.QUERIES) if named == "all" else named.split(",") if named else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    plans.QUERIES["key_frequency"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm the JVM
    seconds = {}
    for name in names:
        start = time.perf_counter()
        plans.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
