"""End-to-end jobs: the three analyses with all their outputs.

The first aggregate of a job (level groups, application timeline, daily summary, tasks)
is stored once and its other aggregate outputs derive from it; row-level outputs
(sample, ERROR lines, application report, parse quality) scan the input again. Only
results with a row per level, cluster, day or chart point, and top-k results, are
coalesced into single files.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..operators import concurrency, daily, distribution, levels, messages, states, usage
from ..sources.logs import read_compacted, read_log_lines, with_position
from ..sources.tree import list_logs
from ..sources.trips import read_trips_unified
from .session import reuse, scratch
from .sinks import write_csv, write_text


def _lines(spark: SparkSession, input_root: str, glob: str | None, compacted: bool) -> DataFrame:
    """Log lines from a text tree, or from a table written by ``compact_logs``."""
    if compacted:
        return read_compacted(spark, input_root)
    return read_log_lines(spark, input_root, glob=glob)


def _out(root: str, name: str) -> str:
    return os.path.join(root, name) if "://" not in root else f"{root.rstrip('/')}/{name}"


def _levels_job(spark: SparkSession, input_root: str, output_root: str, *,
               sample_k: int = 10, seed: int = 42, glob: str | None = "*.log",
               errors: bool = False, compacted: bool = False) -> dict[str, str]:
    """Level counts CSV, a reproducible sample CSV, the summary (CSV cell + text)
    and, with ``errors=True``, every ERROR line as text."""
    lines = _lines(spark, input_root, glob, compacted)
    groups = reuse(levels.level_groups(lines))
    out = {k: _out(output_root, k) for k in
           ("level_counts", "level_sample", "level_summary", "level_summary_txt")}
    if errors:
        out["all_errors"] = _out(output_root, "all_errors")
        write_text(levels.error_lines(lines), out["all_errors"], column="log_entry",
                   single_file=False)
    write_csv(levels.counts_from_groups(groups), out["level_counts"], single_file=True)
    # repeated lines are lines of their own: the place they are read from tells them apart
    placed = lines if "pos" in lines.columns else with_position(lines)
    sample = levels.sample_lines(placed, key=["file_path", "block", "pos"], k=sample_k, seed=seed)
    write_csv(sample, out["level_sample"], single_file=True)
    summary = levels.summary_from_groups(groups)
    write_csv(summary, out["level_summary"], single_file=True)
    write_text(summary, out["level_summary_txt"])
    return out


def stats_text(timeline: DataFrame, top_k: int = 5) -> DataFrame:
    """The statistics report as one text cell (figures plus most used clusters)."""
    figures = ("total_clusters", "total_applications", "avg_apps_per_cluster",
               "avg_duration_sec", "min_duration_sec", "max_duration_sec")
    parts = [F.format_string(fmt, F.col(c)) for fmt, c in zip(P.STATS_LINES, figures)]
    parts += [F.lit(x) for x in P.STATS_LINES[len(figures):]]
    top = F.array_join(F.transform("most_used", lambda e: F.format_string(
        P.STATS_TOP_LINE, e["cluster_id"], e["num_applications"])), "\n")
    return usage.usage_stats(timeline, top_k).select(F.concat_ws("\n", *parts, top).alias("stats"))


def _usage_job(spark: SparkSession, input_root: str, output_root: str, *,
              glob: str | None = "*.log", top_k: int = 5,
              compacted: bool = False) -> dict[str, str]:
    """Timeline, cluster summary, statistics and the chart data (bar, histogram, density)."""
    lines = _lines(spark, input_root, glob, compacted)
    timeline = reuse(usage.app_timeline(lines, ordered=False))
    summary = usage.cluster_summary(timeline)
    names = ("app_timeline", "cluster_summary", "usage_stats",
             "cluster_bar", "duration_histogram", "duration_density")
    out = {k: _out(output_root, k) for k in names}
    write_csv(timeline.orderBy("cluster_id", "start_time"), out["app_timeline"])
    write_csv(summary, out["cluster_summary"], single_file=True)
    write_text(stats_text(timeline, top_k), out["usage_stats"])
    write_csv(distribution.bar_series(summary), out["cluster_bar"], single_file=True)
    apps = reuse(usage.largest_cluster_apps(timeline).select("duration_sec"))
    write_csv(distribution.histogram(spark, apps), out["duration_histogram"], single_file=True)
    write_csv(distribution.kde_curve(apps), out["duration_density"], single_file=True)
    return out


def _inventory_job(spark: SparkSession, input_root: str, output_root: str, *, glob: str | None = "*.log",
                   top_k: int = 5, cluster: str | None = None) -> dict[str, str]:
    """What a tree's listing tells: counts of applications and containers, the applications with
    the most containers, their sizes, an inventory and the clusters' start times. No file is opened."""
    files = reuse(list_logs(spark, input_root, glob=glob, cluster=cluster))
    out = {k: _out(output_root, k) for k in ("id_counts", "containers_per_app", "app_sizes", "inventory", "cluster_start")}
    write_csv(usage.id_counts(files), out["id_counts"], single_file=True)
    write_csv(usage.app_containers(files, top_k), out["containers_per_app"], single_file=True)
    sizes = usage.app_sizes(files)
    write_csv(sizes.orderBy("application_id"), out["app_sizes"])
    write_csv(usage.inventory(sizes), out["inventory"], single_file=True)
    write_csv(usage.cluster_starts(files).orderBy("cluster_id"), out["cluster_start"], single_file=True)
    return out


def _daily_job(spark: SparkSession, paths: list[str], output: str, *, year: int,
              accuracy: int = 10000) -> dict[str, str]:
    """Daily summaries of one year, newest day first, and their totals."""
    trips = read_trips_unified(spark, *paths)
    summary = reuse(daily.daily_summary(trips, year=year, accuracy=accuracy, ordered=False))
    out = {"daily_summary": _out(output, "daily_summary"),
           "daily_totals": _out(output, "daily_totals")}
    write_csv(summary.orderBy(F.desc("dt_year"), F.desc("dt_month"), F.desc("dt_day")),
              out["daily_summary"], single_file=True)
    write_csv(daily.daily_totals(summary), out["daily_totals"], single_file=True)
    return out


def states_job(spark: SparkSession, loads: dict[str, str], folder: str, output: str, *, k: int = states.K) -> dict[str, str]:
    """Add loads (name: trip file, e.g. a month's) to the kept daily states in ``folder`` and write the
    summary of all loads. Only the new files are scanned; a load of a known name replaces it."""
    for name, path in loads.items():
        states.keep(states.daily_states(read_trips_unified(spark, path), k=k), folder, name)
    out = {"daily_summary": _out(output, "daily_summary")}
    write_csv(states.summary_of(states.merged(states.kept(spark, folder), k=k)), out["daily_summary"], single_file=True)
    return out


def _messages_job(spark: SparkSession, input_root: str, output_root: str, *,
                 glob: str | None = "*.log", slowest_k: int = 10,
                 compacted: bool = False) -> dict[str, str]:
    """Figures read from messages in three scans: the per-application report;
    one materialised task table (one row per task) that task durations,
    unfinished tasks, stage skew, the slowest tasks and stages and the tasks that run at a
    time all read; and the parse-quality counts."""
    lines = _lines(spark, input_root, glob, compacted)
    names = ("app_report", "task_durations", "unfinished_tasks", "stage_skew", "slowest_tasks",
             "slowest_stages", "task_concurrency", "cluster_concurrency", "parse_quality")
    out = {k: _out(output_root, k) for k in names}
    write_csv(messages.app_report(lines).orderBy("cluster_id", "app_id"), out["app_report"])
    tasks = reuse(messages.tasks(lines))
    done = messages.finished(tasks)
    write_csv(messages.durations_of(done), out["task_durations"])
    write_csv(messages.unfinished_of(tasks), out["unfinished_tasks"])
    write_csv(messages.stage_skew_of(done), out["stage_skew"])
    write_csv(messages.slowest_tasks_of(done, slowest_k), out["slowest_tasks"], single_file=True)
    write_csv(messages.slowest_stages_of(done, slowest_k), out["slowest_stages"], single_file=True)
    write_csv(concurrency.concurrency(done, messages.APP), out["task_concurrency"])
    write_csv(concurrency.concurrency(done, ["cluster_id"]), out["cluster_concurrency"], single_file=True)
    write_csv(messages.parse_quality(lines), out["parse_quality"], single_file=True)
    return out


def _in_scratch(impl):
    def job(spark: SparkSession, *args, **kwargs) -> dict[str, str]:
        with scratch(spark):
            return impl(spark, *args, **kwargs)
    job.__doc__ = impl.__doc__
    job.__name__ = impl.__name__.lstrip("_")
    return job


levels_job = _in_scratch(_levels_job)
usage_job = _in_scratch(_usage_job)
inventory_job = _in_scratch(_inventory_job)
daily_job = _in_scratch(_daily_job)
messages_job = _in_scratch(_messages_job)
