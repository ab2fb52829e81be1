"""Time the headline queries; print one JSON line.

Every query writes its whole result to the no-op sink, twice unless it trains; the shortest
run counts. Each time goes to the error stream as it comes, and a query that fails is named
in the line and does not end the run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from registry.queries import QUERIES
from wardlight.session import build_session

HEADLINE = [
    "encode_all", "clean_report", "diagnosis_groups", "patient_features",
    "patient_features_joined", "diagnosis_range_join", "cohort_rates", "cohort_subtotals",
    "prior_year_visits", "auc_encounters", "model_report", "score_fixed", "top_factors",
    "risk_percentile", "what_if", "bundle_flatten", "hash_split", "preprocessing_job",
    "feature_vectors", "train_lr", "train_dt",
]
ONCE = {"preprocessing_job", "feature_vectors", "train_lr", "train_dt"}


def main() -> None:
    data_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": cores,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds, failed = {}, {}
    for name in HEADLINE:
        runs = []
        try:
            for _ in range(1 if name in ONCE else 2):
                start = time.perf_counter()
                QUERIES[name](spark, data_dir).write.format("noop").mode("overwrite").save()
                runs.append(time.perf_counter() - start)
        except Exception as problem:  # noqa: BLE001 - the other queries are still timed
            failed[name] = str(problem)[:2000]
            print(f"{name} failed: {failed[name]}", file=sys.stderr, flush=True)
            continue
        seconds[name] = round(min(runs), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "sum of headline query times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "failed": failed,
                "sf": data_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
