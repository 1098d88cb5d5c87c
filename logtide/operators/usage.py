"""Cluster usage: application timeline, cluster summary, statistics, top clusters.

Input: lines with ``log_entry`` and ``file_path``.

Plan shape. The path is constant within a file, so per-line work is only the
timestamp regex: lines are first aggregated per file (``min``/``max``/``count``,
partial aggregation inside the scan stage), and cluster / app ids are parsed
once per file afterwards. The second aggregation runs on one row per file.
Figures that paths alone tell (``app_containers``, ``cluster_starts``, ``id_counts``,
``inventory``) take a table of files: :func:`files_of` lines, or a tree's listing
(:func:`logtide.sources.tree.list_logs`), which reads no text.
An application or a cluster holding a third of all lines is therefore no hot
spot: map-side combining leaves one row per file per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parse


def timestamped_lines(lines: DataFrame, line: str = "log_entry",
                      path: str = "file_path") -> DataFrame:
    """Lines with a parsable leading timestamp: ``file_path``, ``timestamp``.

    Lines whose leading text matches the pattern but is no date
    ('17/13/45 99:00:00') are left out here and reported by ``parse_quality``.
    """
    return (lines.select(F.col(path).alias("file_path"),
                         parse.log_timestamp(line).alias("timestamp"))
            .filter(F.col("timestamp").isNotNull()))


def per_file_times(lines: DataFrame, line: str = "log_entry", path: str = "file_path") -> DataFrame:
    """Per file: first and last parsable timestamp and the number of such lines.

    ``min``/``max``/``count`` skip NULL timestamps, so no row filter is needed
    and the timestamp regex runs once per line; files without any parsable
    timestamp are dropped after the aggregation.
    """
    ts = parse.log_timestamp(line)
    return (lines.select(F.col(path).alias("file_path"), ts.alias("timestamp"))
            .groupBy("file_path")
            .agg(F.min("timestamp").alias("start_time"),
                 F.max("timestamp").alias("end_time"),
                 F.count("timestamp").alias("log_lines"))
            .filter(F.col("log_lines") > 0))


def app_timeline(lines: DataFrame, line: str = "log_entry", path: str = "file_path",
                 ordered: bool = True) -> DataFrame:
    """One row per (cluster, app): first and last timestamp, lines, duration in seconds."""
    files = per_file_times(lines, line, path)
    t = (files.select(parse.cluster_id("file_path").alias("cluster_id"),
                      parse.app_id("file_path").alias("app_id"),
                      "start_time", "end_time", "log_lines")
         .groupBy("cluster_id", "app_id")
         .agg(F.min("start_time").alias("start_time"),
              F.max("end_time").alias("end_time"),
              F.sum("log_lines").cast("bigint").alias("log_lines"))
         .withColumn("duration_sec",
                     F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))))
    return t.orderBy("cluster_id", "start_time") if ordered else t


def cluster_summary(timeline: DataFrame, ordered: bool = True) -> DataFrame:
    """Per cluster: applications, first start, last end, min and max duration."""
    s = (timeline.groupBy("cluster_id")
         .agg(F.count("app_id").alias("num_applications"),
              F.min("start_time").alias("first_app_start"),
              F.max("end_time").alias("last_app_end"),
              F.min("duration_sec").alias("min_duration_sec"),
              F.max("duration_sec").alias("max_duration_sec")))
    return s.orderBy("cluster_id") if ordered else s


def usage_stats(timeline: DataFrame, k: int = 5) -> DataFrame:
    """One row: clusters, applications, average apps per cluster, avg/min/max duration, and the
    ``k`` most heavily used clusters as an array ``most_used`` of (cluster_id, num_applications)."""
    clusters = F.count_distinct("cluster_id")
    apps = F.count(F.lit(1))
    ranked = top_clusters(cluster_summary(timeline, ordered=False), k)
    by_rank = F.array_sort(F.collect_list(F.struct((-F.col("num_applications")).alias("rank"), "cluster_id")))  # k entries
    top = ranked.agg(F.transform(by_rank, lambda e: F.struct(
        e["cluster_id"].alias("cluster_id"), (-e["rank"]).alias("num_applications"))).alias("top")).scalar()
    return timeline.agg(
        clusters.alias("total_clusters"),
        apps.alias("total_applications"),
        F.try_divide(apps.cast("double"), clusters.cast("double")).alias("avg_apps_per_cluster"),
        F.avg("duration_sec").alias("avg_duration_sec"),
        F.min("duration_sec").alias("min_duration_sec"),
        F.max("duration_sec").alias("max_duration_sec"),
    ).withColumn("most_used", top)


def top_clusters(summary: DataFrame, k: int = 5) -> DataFrame:
    """Most heavily used clusters: by applications, ties by cluster id."""
    return (summary.select("cluster_id", "num_applications")
            .orderBy(F.desc("num_applications"), F.asc("cluster_id")).limit(k))


def largest_cluster_apps(timeline: DataFrame) -> DataFrame:
    """Applications of the cluster with most applications, positive durations only.

    The top cluster is a ``limit(1)`` result, so broadcasting it is safe; the
    timeline keeps its partitioning and is filtered by a broadcast semi-join.
    Both sides read the timeline (one row per application); its exchange is planned
    once and reused.
    """
    top1 = top_clusters(cluster_summary(timeline, ordered=False), 1).select("cluster_id")
    return (timeline.join(F.broadcast(top1), "cluster_id", "left_semi")
            .filter(F.col("duration_sec") > 0))


def timeline_contract(timeline: DataFrame) -> DataFrame:
    """Documented timeline columns: cluster_id, application_id, app_number, start, end."""
    return timeline.select(
        "cluster_id",
        F.concat(F.lit("application_"), F.col("cluster_id"), F.lit("_"), F.col("app_id"))
        .alias("application_id"),
        F.col("app_id").alias("app_number"),
        "start_time", "end_time")


def cluster_summary_contract(summary: DataFrame) -> DataFrame:
    return summary.select("cluster_id", "num_applications",
                          F.col("first_app_start").alias("cluster_first_app"),
                          F.col("last_app_end").alias("cluster_last_app"))


def cluster_lookup(timeline: DataFrame) -> DataFrame:
    """Cluster id → start time of the resource manager and application count."""
    return (timeline.groupBy("cluster_id")
            .agg(F.count("app_id").alias("cluster_apps"))
            .withColumn("cluster_started",
                        parse.epoch_millis_ntz(F.col("cluster_id").try_cast("bigint"))))


def with_cluster_lookup(timeline: DataFrame, lookup: DataFrame) -> DataFrame:
    """Timeline left-joined to ``lookup`` (cluster_id, ...). Adaptive execution broadcasts the
    lookup if its measured size allows."""
    return timeline.join(lookup, "cluster_id", "left")


def files_of(lines: DataFrame, path: str = "file_path") -> DataFrame:
    """(file_path): the files that lines were read from, as listing a tree gives them."""
    return lines.select(F.col(path).alias("file_path")).distinct()


def cluster_starts(files: DataFrame) -> DataFrame:
    """Distinct cluster ids of files with the start time their epoch-millisecond id encodes."""
    return (files.select(parse.cluster_id("file_path").alias("cluster_id"))
            .filter(F.col("cluster_id") != "")
            .distinct()
            .withColumn("cluster_started",
                        parse.epoch_millis_ntz(F.col("cluster_id").try_cast("bigint"))))


def cluster_start(lines: DataFrame, path: str = "file_path") -> DataFrame:
    """:func:`cluster_starts` of the files that lines were read from."""
    return cluster_starts(files_of(lines, path))


def per_file_lines(lines: DataFrame, path: str = "file_path") -> DataFrame:
    """``(file_path, log_lines)``: the one shuffle that per-file ids are derived from."""
    return lines.groupBy(F.col(path).alias("file_path")).agg(F.count(F.lit(1)).alias("log_lines"))


def cluster_share(lines: DataFrame, path: str = "file_path") -> DataFrame:
    """Share of applications, containers and lines per cluster."""
    files = per_file_lines(lines, path).select(
        parse.cluster_id("file_path").alias("cluster_id"),
        parse.app_id("file_path").alias("app_id"),
        parse.container_id("file_path").alias("container_id"),
        "log_lines")
    per = (files.groupBy("cluster_id")
           .agg(F.count_distinct(F.when(F.col("app_id") != "", F.col("app_id")))
                .alias("num_applications"),
                F.count_distinct(F.when(F.col("container_id") != "", F.col("container_id")))
                .alias("num_containers"),
                F.sum("log_lines").cast("bigint").alias("log_lines")))
    # totals as one scalar subquery over the same grouped plan, whose exchange is
    # reused: partial sums per task, no step moves all cluster rows into one task
    tot = per.agg(F.struct(*[F.sum(c).alias(c) for c in
                             ("num_applications", "num_containers", "log_lines")])).scalar()

    def share(c):
        return F.try_divide(F.col(c).cast("double"), tot[c].cast("double"))

    return per.select("cluster_id", "num_applications", share("num_applications").alias("app_share"),
                      "num_containers", share("num_containers").alias("container_share"),
                      "log_lines", share("log_lines").alias("line_share"))


def host_lines(lines: DataFrame, line: str = "log_entry", path: str = "file_path") -> DataFrame:
    """Per cluster host (mesos-slave-N / mesos-master-N): lines and container files that
    mention it. A line counts once for every host it names. Lines are counted per host
    and file first, so a host named in most lines is one row per task and file."""
    per_file = (lines.select(F.col(path).alias("file_path"), F.explode(parse.hosts(line)).alias("host"))
                .groupBy("host", "file_path").agg(F.count(F.lit(1)).alias("n")))
    return (per_file.groupBy("host")
            .agg(F.sum("n").alias("log_lines"), F.count(F.lit(1)).alias("containers"))
            .orderBy(F.desc("log_lines"), "host"))


def _distinct(col: str) -> Column:
    """Number of distinct texts, '' aside."""
    return F.count_distinct(F.when(F.col(col) != "", F.col(col)))


def _ids(files: DataFrame, *more: str) -> DataFrame:
    return files.select(parse.application_id("file_path").alias("application_id"),
                        parse.container_id("file_path").alias("container_id"), *more)


def basic_counts(lines: DataFrame, path: str = "file_path") -> DataFrame:
    """One row: applications, containers and log entries."""
    return _ids(per_file_lines(lines, path), "log_lines").agg(
        _distinct("application_id").alias("applications"), _distinct("container_id").alias("containers"),
        F.coalesce(F.sum("log_lines"), F.lit(0)).cast("bigint").alias("log_entries"))


def id_counts(files: DataFrame) -> DataFrame:
    """One row: applications and containers of a table of files."""
    return _ids(files).agg(_distinct("application_id").alias("applications"), _distinct("container_id").alias("containers"))


def tree_counts(files: DataFrame, lines: DataFrame) -> DataFrame:
    """:func:`basic_counts` of a tree: ids from its files, and a plain count of its lines, which
    takes no path and no shuffle but one number a task."""
    return id_counts(files).withColumn("log_entries", lines.agg(F.count(F.lit(1)).alias("n")).scalar())


def app_containers(files: DataFrame, k: int | None = 5) -> DataFrame:
    """Applications with the most containers, ties by application id; all of them without ``k``."""
    out = (_ids(files).filter(F.col("application_id") != "")
           .groupBy("application_id").agg(_distinct("container_id").alias("containers"))
           .orderBy(F.desc("containers"), "application_id"))
    return out.limit(k) if k else out


def containers_per_app(lines: DataFrame, k: int = 5, path: str = "file_path") -> DataFrame:
    """:func:`app_containers` of the files that lines were read from."""
    return app_containers(files_of(lines, path), k)


def app_sizes(files: DataFrame) -> DataFrame:
    """Per application: files, containers, bytes and newest change, for files with ``length`` and ``modified``."""
    return (_ids(files, "length", "modified").filter(F.col("application_id") != "")
            .groupBy("application_id")
            .agg(F.count(F.lit(1)).alias("files"), _distinct("container_id").alias("containers"),
                 F.sum("length").alias("bytes"), F.max("modified").alias("last_modified")))


def inventory(sizes: DataFrame) -> DataFrame:
    """One row over :func:`app_sizes`: applications, files, files per application, and the least,
    mean and largest size of an application."""
    return sizes.agg(F.count(F.lit(1)).alias("applications"), F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
                     F.avg("files").alias("files_per_app"), F.min("bytes").alias("min_app_bytes"),
                     F.avg("bytes").alias("avg_app_bytes"), F.max("bytes").alias("max_app_bytes"))


def failed_containers(lines: DataFrame, line: str = "log_entry", path: str = "file_path") -> DataFrame:
    """Containers whose log holds ERROR lines or task exceptions, with both counts.

    Counted per file first (ids are parsed once per file afterwards).
    """
    per_file = (lines.select(F.col(path).alias("file_path"),
                             (parse.level(line) == "ERROR").alias("is_error"),
                             F.col(line).contains("Exception in task").alias("is_exception"))
                .groupBy("file_path")
                .agg(F.count_if("is_error").alias("error_lines"),
                     F.count_if("is_exception").alias("task_exceptions"))
                .filter((F.col("error_lines") > 0) | (F.col("task_exceptions") > 0)))
    return per_file.select(
        parse.application_id("file_path").alias("application_id"),
        parse.container_id("file_path").alias("container_id"),
        parse.container_role("file_path").alias("role"),
        "error_lines", "task_exceptions")


def container_roles(lines: DataFrame, path: str = "file_path") -> DataFrame:
    """Per container file: application, attempt, container number, role, lines."""
    return per_file_lines(lines, path).select(
        parse.application_id("file_path").alias("application_id"),
        parse.container_id("file_path").alias("container_id"),
        parse.container_attempt("file_path").alias("attempt"),
        parse.container_number("file_path").alias("container_number"),
        parse.container_role("file_path").alias("role"),
        "log_lines")
