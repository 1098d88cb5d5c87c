"""Run in a fresh process: results after a failed first task attempt equal a clean run."""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from logtide.operators import levels, messages, usage  # noqa: E402
from logtide.plans.session import ensure_checkpoint_dir  # noqa: E402
from logtide.sources.logs import read_log_lines  # noqa: E402
from tests.conftest import write_tree  # noqa: E402


def flaky(batches):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
        raise RuntimeError("injected task failure")
    yield from batches


def main() -> None:
    spark = (SparkSession.builder.master("local[2,4]")  # up to 4 attempts per task
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4")
             .config("spark.sql.session.timeZone", "UTC")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="logtide-ckpt-"))
    root = write_tree(tempfile.mkdtemp(prefix="logtide-tree-"))
    clean = read_log_lines(spark, root)
    broken = clean.mapInPandas(flaky, clean.schema)

    def results(lines):
        return (sorted(map(tuple, usage.app_timeline(lines).collect())),
                sorted(map(tuple, levels.level_counts(lines).collect())),
                [tuple(r) for r in levels.sample_lines(lines, ["file_path", "log_entry"], 5).collect()],
                sorted(map(tuple, messages.app_report(lines).collect())))

    assert results(broken) == results(clean)
    print("retry-ok")
    spark.stop()


if __name__ == "__main__":
    main()
