"""Tally the physical operators of every registered query into PLANS.md.

Usage: python tools/plan_report.py [sf_dir] [out.md]

Counts come from ``explain("formatted")`` of the plan Spark would run
(adaptive execution may still coalesce partitions or switch a join to
broadcast at run time). Scalar subqueries are counted in their own column.
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from logtide import queries as Q  # noqa: E402

COLUMNS = [
    ("scans", ("Scan parquet", "Scan binaryFile", "Scan text", "Scan ExistingRDD", "Range")),
    ("shuffles", ("Exchange",)),
    ("broadcasts", ("BroadcastExchange",)),
    ("partial aggs", ("HashAggregate", "ObjectHashAggregate", "SortAggregate")),
    ("joins", ("BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin")),
    ("top-k", ("TakeOrderedAndProject",)),
    ("sorts", ("Sort",)),
    ("windows", ("Window",)),
    ("generate", ("Generate",)),
    ("python", ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas")),
    ("pair joins", ("CartesianProduct", "BroadcastNestedLoopJoin")),
]


NOTES = [
    "## Reading the table",
    "",
    "* Every aggregate appears twice (partial in the scan stage, final after the",
    "  shuffle); the shuffle carries at most one row per key per task.",
    "* Timeline-based queries shuffle three times before any sort: per file",
    "  (per-line timestamp only), per application (ids parsed once per file),",
    "  per cluster. The later two carry one row per file or application.",
    "* A trailing sort is a range shuffle of the final, aggregated rows.",
    "* `largest_cluster_apps`, `cluster_lookup_join`, `cluster_share` and the chart",
    "  queries use a timeline or a per-cluster table more than once; equal exchanges are",
    "  planned once per use here and reused at run time.",
    "* `log_entries` has two branches over one exchange of the lines, which is reused.",
    "* The `subqueries` column counts references to scalar subqueries; Spark runs",
    "  each distinct subquery once and reuses it (`ReusedSubquery`).",
    "* The only hinted broadcast is the `limit(1)` top cluster; others are chosen by Spark",
    "  from measured or estimated sizes. `pair joins` and `python` are 0 everywhere.",
]


def tally(text: str) -> tuple[Counter, int]:
    ops = Counter()
    main, _, subs = text.partition("\n===== Subqueries =====")
    for m in re.finditer(r"^\(\d+\) ([A-Za-z]+(?: [A-Za-z]+)?)", main, re.M):
        ops[m.group(1)] += 1
    nsub = len(re.findall(r"^Subquery:\d+ Hosting operator .* = Subquery ", subs, re.M))
    return ops, nsub


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(
        os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    spark = (SparkSession.builder.master("local[8]")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    jvm = spark._jvm
    rows = []
    for name, fn in Q.REGISTRY.items():
        df = fn(spark, sf)
        text = jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
            df._jdf.queryExecution(), "formatted")
        ops, nsub = tally(text)
        cells = []
        for _, names in COLUMNS:
            n = 0
            for k, v in ops.items():
                if any(k == x or k.startswith(x + " ") for x in names):
                    n += v
            cells.append(n)
        rows.append((name, cells, nsub))
    head = "| query | " + " | ".join(c for c, _ in COLUMNS) + " | subqueries |"
    sep = "| --- |" + " --- |" * (len(COLUMNS) + 1)
    lines = [
        "# Physical plans of the registered queries",
        "",
        "Operator counts from `explain(\"formatted\")` at sf0.01 (`python tools/plan_report.py`).",
        "`scans` counts file scans of the plan before equal exchanges are reused at run time.",
        "`partial aggs` counts partial and final aggregate operators together.",
        "",
        head, sep,
    ]
    for name, cells, nsub in rows:
        lines.append(f"| `{name}` | " + " | ".join(str(c) for c in cells) + f" | {nsub} |")
    lines += ["", *NOTES]
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print(out)
    spark.stop()


if __name__ == "__main__":
    main()
