"""Write QUERIES.md: every registered query with its output columns and types.

Usage: python tools/query_catalog.py [sf_dir] [out.md]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from logtide import oracle as O  # noqa: E402
from logtide import queries as Q  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    out = sys.argv[2] if len(sys.argv) > 2 else os.path.join(
        os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "QUERIES.md")
    spark = (SparkSession.builder.master("local[4]")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    sql = O.SQL
    lines = ["# Registered queries", "",
             "Generated by `python tools/query_catalog.py`: each query of",
             "`__spark_entry__.queries()` with its output columns (Spark types) and",
             "whether a DuckDB oracle checks it. Operators live in `logtide/operators/`,",
             "the query definitions in `logtide/queries.py`.", "",
             "| query | columns | oracle |", "| --- | --- | --- |"]
    for name, fn in Q.REGISTRY.items():
        df = fn(spark, sf)
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        lines.append(f"| `{name}` | {cols} | {'yes' if name in sql else 'rows only'} |")
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    print(out)
    spark.stop()


if __name__ == "__main__":
    main()
