"""Command line: ``python -m logtide {levels,usage,messages,inventory,daily,...} ...`` (or via spark-submit).

The master URL and cluster settings come from spark-submit or the
environment; ``--master`` is only for local runs.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from logtide.plans import jobs
from logtide.plans.session import RECOMMENDED_CONF
from logtide.sources.logs import compact_logs
from logtide.sources.trips import monthly_paths


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="logtide")
    ap.add_argument("--master", default=None)
    sub = ap.add_subparsers(dest="job", required=True)
    for name in ("levels", "usage", "messages"):
        p = sub.add_parser(name)
        p.add_argument("input", help="root folder of application_*/container_*.log files (any URI)")
        p.add_argument("output", help="output folder")
        p.add_argument("--compacted", action="store_true",
                       help="input is a table written by the compact command")
        p.add_argument("--glob", default="*.log",
                       help="names of the files to read; '*' reads every file in the tree")
        if name == "usage":
            p.add_argument("--top", type=int, default=5, help="clusters in the statistics")
        if name == "messages":
            p.add_argument("--top", type=int, default=10, help="slowest tasks and stages")
        if name == "levels":
            p.add_argument("--sample", type=int, default=10, help="lines in the sample")
            p.add_argument("--seed", type=int, default=42)
            p.add_argument("--errors", action="store_true", help="also write every ERROR line")
    p = sub.add_parser("inventory", help="figures of a tree's listing; no file is opened")
    p.add_argument("input", help="root folder of application_*/container_*.log files (any URI)")
    p.add_argument("output", help="output folder")
    p.add_argument("--glob", default="*.log")
    p.add_argument("--cluster", default=None, help="list this cluster's applications only")
    p.add_argument("--top", type=int, default=5, help="applications with the most containers")
    p = sub.add_parser("compact")
    p.add_argument("output", help="Parquet table to write")
    p.add_argument("roots", nargs="+", help="log roots or globs, one Spark job each")
    p = sub.add_parser("daily")
    p.add_argument("base", help="folder holding the monthly Parquet files")
    p.add_argument("output")
    p.add_argument("--year", type=int, required=True)
    p.add_argument("--months", default="1-12", help="e.g. 1-6 or 1,2,3")
    p.add_argument("--accuracy", type=int, default=10000, help="of the approximate percentile")
    p = sub.add_parser("daily-states", help="add months to kept daily states; write the summary of all")
    p.add_argument("base", help="folder holding the monthly Parquet files")
    p.add_argument("states", help="folder of the kept states")
    p.add_argument("output")
    p.add_argument("--year", type=int, required=True)
    p.add_argument("--months", default="1-12", help="the months to add, e.g. 1-6 or 1,2,3")
    args = ap.parse_args(argv)

    builder = SparkSession.builder.appName(f"logtide-{args.job}")
    if args.master:
        builder = builder.master(args.master)
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if args.job == "levels":
        out = jobs.levels_job(spark, args.input, args.output, errors=args.errors,
                              compacted=args.compacted, glob=args.glob, sample_k=args.sample, seed=args.seed)
    elif args.job == "usage":
        out = jobs.usage_job(spark, args.input, args.output, compacted=args.compacted, glob=args.glob,
                             top_k=args.top)
    elif args.job == "messages":
        out = jobs.messages_job(spark, args.input, args.output, compacted=args.compacted, glob=args.glob,
                                slowest_k=args.top)
    elif args.job == "inventory":
        out = jobs.inventory_job(spark, args.input, args.output, glob=args.glob, top_k=args.top, cluster=args.cluster)
    elif args.job == "compact":
        out = {"roots": compact_logs(spark, args.roots, args.output, mode="overwrite"),
               "table": args.output}
    else:
        if "-" in args.months:
            a, b = args.months.split("-")
            months = range(int(a), int(b) + 1)
        else:
            months = [int(m) for m in args.months.split(",")]
        paths = monthly_paths(args.base, args.year, months)
        if args.job == "daily":
            out = jobs.daily_job(spark, paths, args.output, year=args.year, accuracy=args.accuracy)
        else:
            out = jobs.states_job(spark, {f"{args.year:04d}-{m:02d}": p for m, p in zip(months, paths)}, args.states, args.output)
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
