"""Headline queries on one machine; prints one JSON line."""

from __future__ import annotations

import json
import os
import pathlib
import sys
import time

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from lastro.catalog.queries import QUERIES  # noqa: E402
from lastro.session import local_session  # noqa: E402

HEADLINE = (
    "scan_payments", "dq_report", "dedup_keep_last", "clean_payments", "join_match_rate", "enrich",
    "payments_features", "heuristic_score", "portfolio_overview", "payer_risk", "beneficiary_risk",
    "temporal_analysis", "uf_analysis", "cnae_analysis", "score_distribution", "alerts_payers",
    "dashboard_kpis", "filter_transactions", "aging_buckets", "describe_value", "delay_histogram",
    "impute_median", "encode_ordinal", "auc_roc", "score_dataset",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, app="lastro-bench")
    # One short query first, so that starting Spark is not charged to the first one measured.
    QUERIES["default_flag"](spark, folder).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": pathlib.Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
