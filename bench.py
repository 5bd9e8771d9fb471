"""Headline timings: one JSON line on stdout.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the local cores (default 8).
Every query runs once to warm up and is then timed, including the building of its plan and all
intermediate tables, with all result rows produced (a sink that discards them).
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from riskloom.session import build_session  # noqa: E402

HEADLINE = (
    "clean_amount_mean_fill", "dedup_rows", "agg_distinct_with_null", "multi_hot_pay",
    "global_rank_tied_lines", "auc_exact", "auc_exact_continuous",
    "wide_credit", "wide_user", "wide_address", "wide_bankcard", "wide_order", "wide_order_time",
    "wide_matrix", "compact_bankcard", "compact_order", "compact_auth_order", "compact_matrix",
    "select_variance", "select_chi2", "select_binary_split", "blend_three",
)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    folder = tempfile.TemporaryDirectory(prefix="riskloom-bench-")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "12g", "spark.log.level": "ERROR",
        "spark.checkpoint.dir": folder.name})
    spark.sparkContext.setLogLevel("ERROR")

    def run(name):
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    timings = {}
    for name in HEADLINE:
        run(name)
        timings[name] = round(run(name), 3)
    spark.stop()
    folder.cleanup()
    print(json.dumps({"metric": "headline_total", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings,
                      "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
