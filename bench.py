"""Benchmark the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries": {name: sec}, "sf"}.
Each query is fully executed with the ``noop`` sink (no driver collect); value is the
sum of per-query seconds. Timings are steady-state: every headline query first runs
once on the smallest driver scale factor (same plan shapes, so the JIT and Spark's
generated-code cache are warm); the warm-up is not timed.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "segment_el_rollup", "borrower_features", "user_daily_velocity", "merchant_chargeback_rate",
    "rolling_amount_1h", "geo_mismatch", "velocity_spike", "final_decisions", "fraud_kpis_daily",
    "psi_numeric", "roc_auc_gini", "calibration_deciles", "ab_arm_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from riskspark.plans.registry import QUERIES
    from riskspark.session import get_session

    spark = get_session(f"local[{cpus}]", int(cpus) * 2, app_name="riskspark-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # warm-up on the smallest scale factor: JVM JIT + generated-code cache, not timed
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for n in names:
        QUERIES[n](spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    if not sys.argv[1:]:  # the table that several queries read is timed on its own line
        from riskspark.plans.fraud import decision_log_table

        t0 = time.perf_counter()
        decision_log_table(spark, sf_dir)
        times["decision_log_write"] = round(time.perf_counter() - t0, 3)
    for n in names:
        t0 = time.perf_counter()
        QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
