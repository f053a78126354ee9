"""Time the headline queries over one data folder and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from ledgerlens.plans.queries import QUERIES
from ledgerlens.session import local_session

HEADLINE = (
    "ingest_row_counts", "null_profile", "clean_application", "clean_installments_pit",
    "bureau_features", "payment_features", "prev_features", "credit_features", "pit_join_absolute",
    "credit_summary", "explorer_page", "audit_verdict", "label_encode", "stratified_folds",
    "roc_auc", "classification_report", "cv_summary", "permutation_importance",
    "throttle_window", "throttle_sliding_log", "gbt_scores",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    QUERIES["default_rate"](spark, sf_dir).collect()  # JVM start-up is not part of any query
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
