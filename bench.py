"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder with the tables (default /root/testdata/sf0.1), BENCH_CPUS the number
of local threads (default 8), BENCH_RUNS how often each query runs (default 2): the best time counts, so
that what a query pays for being the first of its kind is not taken for its cost. Every query runs to
completion into a sink that keeps nothing. With arguments, only the named queries run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from tidemark.plans.queries import registered
from tidemark.session import build_session

HEADLINE = [
    "q_valid_events",
    "q_dead_letter",
    "q_staging",
    "q_trailing_1h",
    "q_is_new_merchant",
    "q_distance_from_home",
    "q_realtime_vector",
    "q_hop_1h",
    "q_daily_features",
    "q_daily_joined",
    "q_history_daily",
    "q_rolling_metrics",
    "q_rolling_union",
    "q_history_rolling",
    "q_bootstrap_features",
    "q_txn_summary",
    "q_asof_features",
    "q_asof_training_set",
    "q_feature_diff",
    "q_snapshots_to_expire",
    "q_feature_vector",
    "q_model_input",
    "q_skew_report",
    "q_stream_hop_1h",
    "q_stream_dead_letter",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "tidemark-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    names = sys.argv[1:] or HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("q_daily_features")  # starts the JVM's compilers; not counted
    runs = max(1, int(os.environ.get("BENCH_RUNS", "2")))
    times = {name: min(run(name) for _ in range(runs)) for name in names}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "runs": runs,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
