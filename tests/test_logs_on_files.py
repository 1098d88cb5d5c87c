"""Log operators on real files, checked against plain-Python brute force."""

from __future__ import annotations

import re
from collections import Counter
from datetime import datetime

from logtide.functions import parse
from logtide.functions import patterns as P
from logtide.operators import levels, messages, usage
from logtide.sources import logs as L

from .conftest import LOG_TREE, tree_lines


def _lines(spark, root):
    return L.read_log_lines(spark, root)


def test_recursive_scan_reads_every_log_line_at_any_depth(spark, log_tree):
    df = _lines(spark, log_tree)
    got = Counter((r.file_path.split(log_tree.rstrip("/") + "/")[-1], r.log_entry) for r in df.collect())
    assert got == Counter(tree_lines())
    assert all(r.file_path.startswith("file:") for r in df.select("file_path").collect())


def test_glob_filter_off_reads_other_files(spark, log_tree):
    df = L.read_log_lines(spark, log_tree, glob=None)
    assert df.count() == len(tree_lines(glob_log=False))


def test_non_recursive_glob_scan(spark, log_tree):
    df = L.read_log_glob(spark, f"{log_tree}/application_*/*.log")
    expect = [x for x in tree_lines() if x[0].startswith("application_")]
    assert df.count() == len(expect)


def test_level_counts_and_totals_match_brute_force(spark, log_tree):
    df = _lines(spark, log_tree)
    lv = [(m.group(1) if (m := re.search(P.LEVEL_WORD, ln)) else "") for _, ln in tree_lines()]
    expect = Counter(x for x in lv if x)
    got = {r.log_level: r["count"] for r in levels.level_counts(df).collect()}
    assert got == dict(expect)
    t = levels.scan_totals(df).first()
    assert (t.total_lines, t.lines_with_levels, t.unique_levels) == (
        len(lv), sum(1 for x in lv if x), len(expect))


def test_summary_text(spark, log_tree):
    assert levels.summary_text(_lines(spark, log_tree)).first().summary == """\
Total log lines processed: 23
Total lines with log levels: 20
Unique log levels found: 4

Log level distribution:
  DEBUG:          1 (  5.00%)
  ERROR:          1 (  5.00%)
  INFO :         17 ( 85.00%)
  WARN :          1 (  5.00%)"""


def test_summary_text_does_not_cut_wide_counts(spark):
    rows = [("x INFO y",)] * 3
    df = spark.createDataFrame(rows, ["log_entry"])
    assert "  INFO :          3 (100.00%)" in levels.summary_text(df).first().summary
    from pyspark.sql import functions as F
    wide = spark.range(1).select(F.format_string("%10s", F.format_number(F.lit(12345678901), 0)).alias("s"))
    assert wide.first().s == "12,345,678,901"


def test_timestamps_bad_dates_are_null_not_errors(spark):
    df = spark.createDataFrame([("17/06/09 11:29:30 INFO a",), ("17/13/45 99:00:00 INFO b",),
                                ("no stamp",)], ["log_entry"])
    got = [r.ts for r in df.select(parse.log_timestamp().alias("ts")).collect()]
    assert got == [datetime(2017, 6, 9, 11, 29, 30), None, None]
    q = messages.parse_quality(df).first()
    assert (q.total_lines, q.no_timestamp, q.bad_timestamp) == (3, 1, 1)


def test_timeline_matches_brute_force(spark, log_tree):
    df = _lines(spark, log_tree)
    apps: dict[tuple[str, str], list[datetime]] = {}
    for rel, ln in tree_lines():
        m = re.match(P.TIMESTAMP, ln)
        if not m:
            continue
        try:
            ts = datetime.strptime(m.group(1), "%y/%m/%d %H:%M:%S")
        except ValueError:
            continue
        a = re.search(P.APP_DIR, rel)
        key = (a.group(1), a.group(2)) if a else ("", "")
        apps.setdefault(key, []).append(ts)
    expect = {k: (min(v), max(v), len(v), int((max(v) - min(v)).total_seconds())) for k, v in apps.items()}
    got = {(r.cluster_id, r.app_id): (r.start_time, r.end_time, r.log_lines, r.duration_sec)
           for r in usage.app_timeline(df).collect()}
    assert got == expect
    # files outside an application folder fall into the group with empty ids
    assert ("", "") in got


def test_task_pairing_on_files(spark, log_tree):
    df = _lines(spark, log_tree)
    t = {r.tid: r for r in messages.tasks(df).collect()}
    assert t[9].start_time == datetime(2017, 3, 29, 10, 11, 10)
    assert t[9].end_time == datetime(2017, 3, 29, 10, 11, 14)
    assert t[10].end_time is None
    unfinished = [(r.tid, r.stage) for r in messages.unfinished_tasks(df).collect()]
    assert unfinished == [(10, "1.0")]
    d = messages.task_durations(df).collect()
    assert [(r.num_tasks, r.min_task_sec, r.max_task_sec) for r in d] == [(1, 4, 4)]


def test_message_figures_on_files(spark, log_tree):
    df = _lines(spark, log_tree)
    r = messages.resource_requests(df).first()
    assert (r.executors_requested, r.max_cores_per_executor, r.memory_mb_requested) == (3, 2, 3 * 4096)
    m = messages.memory_blocks(df).first()
    assert m.bytes_stored == 24
    s = messages.shuffle_blocks(df).first()
    assert (s.non_empty_blocks, s.total_blocks) == (7, 12)
    p = messages.python_timings(df).first()
    assert (p.sum_total, p.avg_boot) == (70, 40.0)
    i = messages.input_splits(df).first()
    assert (i.input_file, i.bytes_read) == ("file:/in/part.txt", 250)


def test_hosts_and_containers_on_files(spark, log_tree):
    df = _lines(spark, log_tree)
    hosts = {r.host: r.log_lines for r in usage.host_lines(df).collect()}
    assert hosts == {"mesos-master-1": 1, "mesos-slave-7": 1}
    both = spark.createDataFrame([("a", "mesos-slave-1 to mesos-slave-2"), ("a", "mesos-slave-1"), ("b", "mesos-slave-1, mesos-slave-1")],
                                 "file_path string, log_entry string")
    assert [tuple(r) for r in usage.host_lines(both).collect()] == [("mesos-slave-1", 3, 2), ("mesos-slave-2", 1, 1)]
    (c,) = messages.container_requests(df).collect()
    assert (c.host, c.requests, c.memory_mb_requested, c.cores_requested) == ("node-a", 1, 4096, 2)
    roles = {r.container_number: r.role for r in usage.container_roles(df).collect()
             if r.container_number}
    assert roles == {"000001": "ApplicationMaster", "000002": "Executor"}
    b = usage.basic_counts(df).first()
    assert (b.applications, b.containers) == (3, 4)


def test_whole_file_scan_stitches_multiline_entries(spark, log_tree):
    files = L.read_log_files(spark, log_tree)
    assert files.count() == sum(1 for k in LOG_TREE if k.endswith(".log"))
    entries = L.stitch_entries(files)
    ex = [r.log_entry for r in entries.collect() if "Exception in task" in r.log_entry]
    assert ex == ["17/03/29 10:11:15 ERROR executor.Executor: Exception in task 9.0 in stage 1.0 (TID 10)\n"
                  "java.lang.RuntimeException: boom\n\tat foo.Bar(Bar.java:1)"]
    per_file = entries.groupBy("file_path").count().collect()
    assert sum(r["count"] for r in per_file) == entries.count()


def test_error_lines_use_first_level_only(spark):
    df = spark.createDataFrame([("a", "17/01/01 00:00:00 DEBUG x: retry after ERROR",),
                                ("a", "17/01/01 00:00:00 ERROR x: real",)], ["file_path", "log_entry"])
    assert [r.log_entry for r in levels.error_lines(df).collect()] == ["17/01/01 00:00:00 ERROR x: real"]


def test_glob_of_application_folders_with_recursion(spark, log_tree):
    df = L.read_log_lines(spark, f"{log_tree}/application_*")
    expect = [x for x in tree_lines() if x[0].startswith("application_")]
    assert df.count() == len(expect)


def test_app_report_equals_single_figure_operators(spark, log_tree):
    df = _lines(spark, log_tree)
    rep = {(r.cluster_id, r.app_id): r for r in messages.app_report(df).collect()}
    for r in messages.failure_rates(df).collect():
        x = rep[(r.cluster_id, r.app_id)]
        assert (x.log_lines, x.error_lines, x.error_rate) == (r.log_lines, r.error_lines, r.error_rate)
    for r in messages.python_timings(df).collect():
        x = rep[(r.cluster_id, r.app_id)]
        assert (x.python_runs, x.avg_python_total, x.avg_python_boot) == (r.runs, r.avg_total, r.avg_boot)
    for r in messages.resource_requests(df).collect():
        x = rep[(r.cluster_id, r.app_id)]
        assert (x.executors_requested, x.memory_mb_requested, x.max_cores_per_executor) == (
            r.executors_requested, r.memory_mb_requested, r.max_cores_per_executor)
    for r in messages.shuffle_blocks(df).collect():
        x = rep[(r.cluster_id, r.app_id)]
        assert (x.shuffle_fetches, x.non_empty_blocks, x.total_blocks) == (
            r.fetches, r.non_empty_blocks, r.total_blocks)
    for r in messages.memory_blocks(df).collect():
        x = rep[(r.cluster_id, r.app_id)]
        assert (x.memory_blocks, x.bytes_stored) == (r.blocks, r.bytes_stored)


def test_failed_containers_on_files(spark, log_tree):
    df = _lines(spark, log_tree)
    got = [(r.container_id, r.role, r.error_lines, r.task_exceptions)
           for r in usage.failed_containers(df).collect()]
    assert got == [("container_1485248649253_0001_01_000002", "Executor", 1, 1)]


def test_compacted_logs_give_the_same_results(spark, log_tree, tmp_dir):
    out = f"{tmp_dir}/compact"
    n = L.compact_logs(spark, [f"{log_tree}/application_1485*", f"{log_tree}/application_1472*",
                               f"{log_tree}/nested", f"{log_tree}/stray"], out)
    assert n == 4
    comp = L.read_compacted(spark, out)
    direct = _lines(spark, log_tree)
    assert comp.count() == direct.count()
    assert sorted(map(tuple, levels.level_counts(comp).collect())) == \
        sorted(map(tuple, levels.level_counts(direct).collect()))
    assert sorted(map(tuple, usage.app_timeline(comp).collect())) == \
        sorted(map(tuple, usage.app_timeline(direct).collect()))
    pruned = comp.filter("cluster_id = '1472621869829'")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(coalesce(cluster_id" in plan
    assert comp.schema["cluster_id"].dataType.simpleString() == "string" and comp.filter("cluster_id = ''").count() == 1
    assert pruned.count() == 5


def test_tasks_of_two_attempts_and_odd_stages_stay_apart(spark):
    rows = []
    for attempt in ("01", "02"):
        path = f"application_7_0001/container_7_0001_{attempt}_000002.log"
        for h, what in ((8 + int(attempt), "Running"), (8 + int(attempt), "Finished")):
            s = 0 if what == "Running" else 5
            rows += [(path, f"17/03/29 {h:02d}:00:{s:02d} INFO e: {what} task 0.0 in stage {st} (TID 1)")
                     for st in ("03.0", "5.2000000", "5.0.2")]
    df = spark.createDataFrame(rows, "file_path string, log_entry string")
    got = messages.task_times(df).collect()
    assert {r.duration_sec for r in got} == {5}
    assert sorted((r.attempt, r.stage) for r in got) == sorted(
        (a, s) for a in ("01", "02") for s in ("03.0", "5.2000000", "5.0.2"))
    assert len(messages.stage_skew(df).collect()) == 6


def test_a_changed_folder_changes_the_answer(spark, tmp_dir):
    from pyspark.sql import functions as F

    from logtide.queries import log_scan_count

    events = spark.range(1000).select(
        F.col("id").alias("event_id"), F.lit("2020-01-01").cast("timestamp_ntz").alias("ts"), F.col("id").alias("user_id"),
        F.lit("click").alias("event_type"))
    events.write.parquet(f"{tmp_dir}/events.parquet")
    assert log_scan_count(spark, tmp_dir).first()[0] == 1000
    events.limit(100).write.mode("overwrite").parquet(f"{tmp_dir}/events.parquet")
    assert log_scan_count(spark, tmp_dir).first()[0] == 100


def test_sample_counts_repeated_lines(spark, tmp_dir):
    from logtide.plans import jobs
    from logtide.plans.sinks import read_csv

    from .conftest import write_tree

    root = write_tree(f"{tmp_dir}/in", {"application_1_0001/container_1_0001_01_000001.log":
                                        ["17/01/01 00:00:00 INFO a: same"] * 200
                                        + [f"17/01/01 00:00:01 INFO a: line {i}" for i in range(200)]})
    same = 0
    for seed in range(4):
        out = jobs.levels_job(spark, root, f"{tmp_dir}/out{seed}", seed=seed, sample_k=20)
        got = [r.log_entry for r in read_csv(spark, out["level_sample"]).collect()]
        assert len(got) == 20
        same += sum(x.endswith("same") for x in got)
    assert 20 <= same <= 60  # 40 expected
