"""Physical-plan summary of registered queries (no execution).

usage: python scripts/plan_report.py [sf_dir] [name ...]

Prints, per query, the number of shuffle exchanges, broadcast exchanges, window
operators, sort-based aggregates, scans, and the pruned read schema of every scan, so
plan regressions (an extra shuffle, a scan reading unused columns) show up in review.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskspark.plans.registry import QUERIES  # noqa: E402
from riskspark.session import get_session  # noqa: E402

SKIP_PREFIX = ("stream_", "train_", "log_roundtrip", "rollup_csv")  # these execute while building


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")] or [n for n in QUERIES if not n.startswith(SKIP_PREFIX)]
    spark = get_session("local[2]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    for n in names:
        plan = QUERIES[n](spark, sf)._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition", plan))
        single = len(re.findall(r"Exchange SinglePartition", plan))
        bcast = plan.count("BroadcastExchange")
        windows = len(re.findall(r"\bWindow ", plan))
        sortagg = plan.count("SortAggregate")
        scans = re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan)
        print(f"{n}: shuffles={shuffles} single_partition={single} broadcasts={bcast} windows={windows} "
              f"sort_aggs={sortagg} scans={len(scans)}")
    spark.stop()


if __name__ == "__main__":
    main()
