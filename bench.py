"""Times the headline queries and prints one JSON line.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 4), BENCH_RUNS (default 1 after a warm-up)
"""

from __future__ import annotations

import json
import os
import statistics
import time

from checks.queries import QUERIES
from ledgerloom.session import build_session

HEADLINE = [
    "project_training_cols", "customer_metrics", "customer_metrics_from_sources", "training_table", "dq_raw",
    "dq_report", "percentile_cont", "percentile_cont_hot_groups", "column_quartiles", "column_quartiles_long",
    "impute", "iqr_filter_onepass", "iqr_filter_sequential", "customer_features", "label_encode_apply",
    "standard_scale_apply", "prepare_dataframe", "stratified_split", "weighted_prf", "auc_binary",
    "auc_ovr_weighted", "train_random_forest", "train_logistic", "batch_score", "daily_retraining", "rate_alert",
    "rate_alert_stream", "arrival_source",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "6g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["dq_raw"](spark, sf_dir).collect()  # start the executors and load the classes
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs):
            started = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.time() - started)
        seconds[name] = round(statistics.median(taken), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
