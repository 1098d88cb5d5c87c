"""Streaming log operators: results after new files arrive equal the batch results."""

from __future__ import annotations

import os

from logtide.operators import levels, usage
from logtide.sources.logs import read_log_lines
from logtide.streaming import logs as S

from .conftest import LOG_TREE, write_tree


def start_memory(df, name, checkpoint):
    """The whole result after each batch, as a table in the driver's memory."""
    return (df.writeStream.outputMode("complete").format("memory").queryName(name)
            .option("checkpointLocation", checkpoint).start())


def test_stream_tables_follow_new_files(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    items = list(LOG_TREE.items())
    write_tree(src, dict(items[:2]))
    lines = S.read_log_stream(spark, src)
    q1 = start_memory(S.level_counts_stream(lines), "levels_t", f"{tmp_dir}/ck1")
    q2 = start_memory(S.app_timeline_stream(lines), "timeline_t", f"{tmp_dir}/ck2")
    q3 = S.start_append(S.error_lines_stream(lines), "errors_t", f"{tmp_dir}/errors",
                        checkpoint=f"{tmp_dir}/ck3")
    try:
        for q in (q1, q2, q3):
            q.processAllAvailable()
        write_tree(src, dict(items[2:]))
        for q in (q1, q2, q3):
            q.processAllAvailable()
    finally:
        for q in (q1, q2, q3):
            q.stop()

    batch = read_log_lines(spark, src)
    want_levels = {r.log_level: r["count"] for r in levels.level_counts(batch).collect()}
    got_levels = {r.log_level: r["count"] for r in spark.table("levels_t").collect()}
    assert got_levels == want_levels

    cols = ["cluster_id", "app_id", "start_time", "end_time", "log_lines", "duration_sec"]
    want_tl = sorted(tuple(r) for r in usage.app_timeline(batch).select(cols).collect())
    got_tl = sorted(tuple(r) for r in spark.table("timeline_t").select(cols).collect())
    assert got_tl == want_tl

    errs = spark.read.parquet(f"{tmp_dir}/errors").collect()
    assert [r.log_entry for r in errs] == [r.log_entry for r in levels.error_lines(batch).collect()]


def test_restart_from_checkpoint_continues_state(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    items = list(LOG_TREE.items())
    write_tree(src, dict(items[:2]))
    ck = f"{tmp_dir}/ck"

    def run_once():
        q = start_memory(S.level_counts_stream(S.read_log_stream(spark, src)), "restart_t", ck)
        try:
            q.processAllAvailable()
        finally:
            q.stop()

    run_once()                        # first query, then stopped
    write_tree(src, dict(items[2:]))  # files arrive while nothing runs
    run_once()                        # a new query on the same checkpoint
    batch = read_log_lines(spark, src)
    want = {r.log_level: r["count"] for r in levels.level_counts(batch).collect()}
    got = {r.log_level: r["count"] for r in spark.table("restart_t").collect()}
    assert got == want  # old lines counted once, new lines added
