"""Print the physical plan operators of headline queries (for docs/PLANS.md).

Usage: python tools/plans.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from isobar.plans.registry import QUERIES  # noqa: E402
from isobar.session import build_session  # noqa: E402

NAMES = ["flatten_hourly", "dedupe_latest", "rolling_mean_3", "daily_summary", "daily_summary_hash", "temperature_anomalies", "dq_report"]
KEEP = re.compile(
    r"(Exchange \w+|WindowGroupLimit|Window \[|BroadcastHashJoin|SortMergeJoin|BroadcastExchange|HashAggregate|SortAggregate|"
    r"Generate|FileScan parquet|Expand|Union)"
)


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    print("# Physical plans of headline queries (operators only, sf0.01, before AQE)\n")
    for n in NAMES:
        plan = QUERIES[n](spark, sf)._jdf.queryExecution().executedPlan().toString()
        print(f"## {n}\n\n```")
        for line in plan.splitlines():
            m = KEEP.search(line)
            if m:
                indent = len(line) - len(line.lstrip(" :+-"))
                text = line.strip(" :+-")
                text = re.sub(r"#\d+L?", "", text)
                if text.startswith("FileScan parquet"):
                    cols = re.search(r"FileScan parquet [^\[]*\[([^\]]*)\]", text)
                    rs = re.search(r"ReadSchema: (struct<[^>]*>)", text)
                    text = f"FileScan parquet [{cols.group(1) if cols else ''}] ReadSchema: {rs.group(1) if rs else ''}"
                print(" " * indent + text[:160])
        print("```\n")


if __name__ == "__main__":
    main()
