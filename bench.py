"""Wall seconds per headline query, as one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskweave.plans import catalog  # noqa: E402
from riskweave.session import local_session, release  # noqa: E402

HEADLINE = [
    "scan_labelled", "join_identity", "join_integrity", "null_profile", "rate_by_category",
    "describe_by_label", "corr_with_label", "temporal_split", "stratified_carve",
    "prepare_splits", "column_medians", "group_medians", "engineer_no_te", "engineer_full",
    "loo_encode", "pr_curve", "risk_metrics", "reliability_curve", "psi", "feature_drift",
    "rate_drift", "serving_metrics_24h", "sliding_24h", "request_defaults", "feature_upsert",
    "runs_pivot", "linear_attribution", "topk_attribution", "smote_knn", "gbt_score",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    catalog.QUERIES["scan_labelled"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        release(spark)  # derived tables of the query
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
