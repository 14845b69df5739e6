"""Count the physical operators of each registered query's plan.

    python tools/plan_summary.py [--sf DIR] [name ...]

Prints one Markdown row per query: scans, shuffle exchanges, broadcast
exchanges, sort-merge / broadcast-hash joins, hash aggregates, and sorts of the
initial adaptive plan (before run-time
re-planning; written intermediates appear as scans).
"""

from __future__ import annotations

import argparse
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

COUNTS = [
    ("scans", r"^\(\d+\) Scan "),
    ("shuffles", r"^\(\d+\) Exchange\b"),
    ("broadcasts", r"^\(\d+\) BroadcastExchange\b"),
    ("smj", r"^\(\d+\) SortMergeJoin\b"),
    ("bhj", r"^\(\d+\) BroadcastHashJoin\b"),
    ("hash_aggs", r"^\(\d+\) HashAggregate\b"),
    ("sorts", r"^\(\d+\) Sort\b"),
]


def summarize(df) -> dict:
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    lines = text.splitlines()
    out = {}
    for name, pattern in COUNTS:
        out[name] = sum(1 for line in lines if re.search(pattern, line))
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()

    from trackcast import catalog
    from trackcast.session import build_session

    spark = build_session("local[8]", 8)
    names = args.names or sorted(catalog.QUERIES)
    print("| query | " + " | ".join(n for n, _ in COUNTS) + " |")
    print("| --- |" + " --- |" * len(COUNTS))
    for name in names:
        s = summarize(catalog.QUERIES[name](spark, args.sf))
        print(f"| {name} | " + " | ".join(str(s[n]) for n, _ in COUNTS) + " |")
    spark.stop()


if __name__ == "__main__":
    main()
