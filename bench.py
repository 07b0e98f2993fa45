"""Time the headline queries: one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Each query is built and fully computed by a write to the no-op sink; the best of two runs
counts, so that code generation and class loading are not measured as query time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.catalog import all_queries  # noqa: E402
from millrace.session import build_session  # noqa: E402

HEADLINE = [
    "merge_impute_flagship",
    "merge_impute_chained",
    "imp_numeric_chained",
    "imp_median",
    "imp_cat_mean_code",
    "enc_zscore",
    "enc_onehot",
    "enc_category_codes",
    "feat_total_services",
    "feat_customer_spend",
    "feat_activity",
    "dq_missing",
    "dq_cardinality",
    "dq_duplicate_rows",
    "dq_iqr_outliers",
    "dq_report",
    "ge_suite_a",
    "ge_suite_b",
    "eda_describe",
    "eda_corr_matrix",
    "eda_histogram",
    "eda_kde",
    "eda_boxplot",
    "fs_pit_join",
    "fs_pit_join_ttl",
    "fs_pit_join_sliced",
    "fs_materialize",
    "fs_online_lookup",
    "fs_on_demand",
    "snap_fingerprint",
    "snap_diff",
    "dml_insert_if_absent",
    "wh_full_refresh",
    "stream_file_ingest",
    "stream_push_latest",
    "ml_model_matrix",
    "ml_logreg",
    "ml_forest",
]
ROUNDS = 2


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    wanted = sys.argv[1:] or HEADLINE
    best, first = {}, {}
    for name in wanted:
        for round_no in range(ROUNDS):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            first.setdefault(name, round(took, 3))
            best[name] = round(min(took, best.get(name, took)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "first_run": first,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
