"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores.
Each query is built and run to the end once, after one warm-up query for the session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallystone.plans import catalog  # noqa: E402
from tallystone.session import build_session  # noqa: E402

HEADLINE = [
    # data quality
    "missing_report",
    "duplicate_report",
    "iqr_outliers",
    "range_check",
    # description
    "numeric_profile",
    "categorical_profile",
    "top_values",
    "histogram_auto",
    # inference
    "confidence_intervals",
    "welch_ttest",
    "mann_whitney",
    "kruskal",
    "chi_square",
    "ks_shift",
    "spearman",
    # preparation
    "stratified_split",
    "impute_median",
    "one_hot",
    "scale_standard",
    "feature_plan",
    "prepared_loans",
    # evaluation and scoring
    "evaluate",
    "roc_points",
    "train_logistic_regression",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus}
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = catalog.queries()
    known["basic_stats"](spark, sf_dir).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.monotonic()
        known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.monotonic() - start, 3)
    print(
        json.dumps({
            "metric": "headline queries, total wall time",
            "value": round(sum(seconds.values()), 3),
            "unit": "sec",
            "queries": seconds,
            "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        })
    )
    spark.stop()


if __name__ == "__main__":
    main()
