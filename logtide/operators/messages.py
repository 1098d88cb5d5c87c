"""Figures read from message text: tasks, resources, memory, shuffle, timings.

Input: lines with ``log_entry`` and ``file_path``.

Each operator first keeps only lines holding its message with a cheap
substring test (pushed into the scan), then extracts numbers with
``regexp_extract`` and aggregates per application. Lines whose numbers do not
parse are skipped by the null-skipping aggregates rather than by a row
filter, so each regex runs once per line; groups left empty are dropped
after the aggregation. Numbers too large for a long (a corrupt line) become
NULL through ``try_cast`` / ``try_multiply`` instead of failing the job. Lines are grouped by
file (and the task's key) first, and ids are taken from the path once per group, never per
line; partial aggregation runs before every shuffle, so one application holding most
lines is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import parse
from ..functions import patterns as P

APP = ["cluster_id", "app_id"]


def _app_cols(path: str = "file_path"):
    return [parse.cluster_id(path).alias("cluster_id"), parse.app_id(path).alias("app_id")]


def _by_app(m: DataFrame, aggs: dict, keys: tuple = ()) -> DataFrame:
    """Aggregate ``m`` (file_path, ...) per application: name -> (aggregate of lines, how the
    files' figures are combined). The path is constant within a file, so lines are first
    aggregated per file and the ids are taken from the path once per file, not per line."""
    per_file = m.groupBy("file_path", *keys).agg(*[of_lines.alias(n) for n, (of_lines, _) in aggs.items()])
    return (per_file.select(*_app_cols("file_path"), *keys, *aggs)
            .groupBy(*APP, *keys).agg(*[combine(n).alias(n) for n, (_, combine) in aggs.items()]))


# --- tasks --------------------------------------------------------------------

def tasks(lines: DataFrame, line: str = "log_entry", path: str = "file_path") -> DataFrame:
    """One row per task: first start, last finish.

    Task ids restart with each attempt of an application, so a task is (cluster, app,
    attempt, tid, stage text); both messages carry the stage and the attempt is in the
    file name. Start and finish lines are paired with one aggregation on this key
    instead of a self-join: conditional ``min``/``max`` pick the start and
    finish times, so the input is shuffled once and no pair is ever emitted.
    ``start_time`` / ``end_time`` are NULL when the task has no such line.
    """
    started_in = F.regexp_extract(F.col(line), P.TASK_START, 2)
    finished_in = F.regexp_extract(F.col(line), P.TASK_FINISH, 2)
    ev = (lines.filter(F.col(line).contains("(TID "))
          .select(F.col(path).alias("file_path"),
                  parse.log_timestamp(line).alias("ts"),
                  parse.extract_long(line, P.TASK_START, 3).alias("start_tid"),
                  F.concat(started_in, finished_in).alias("stage"),  # a line has one of them at most
                  parse.extract_long(line, P.TASK_FINISH, 3).alias("finish_tid"))
          .withColumn("tid", F.coalesce("start_tid", "finish_tid")))
    started = F.col("start_tid").isNotNull()
    finished = F.col("finish_tid").isNotNull()
    # lines that are neither start nor finish form one NULL-tid group per file,
    # dropped after the aggregation (on an aggregate, so the optimizer does not
    # push it back below as a second regex evaluation per line)
    per_file = (ev.groupBy("file_path", "tid", "stage")
                .agg(F.min(F.when(started, F.col("ts"))).alias("start_time"),
                     F.max(F.when(finished, F.col("ts"))).alias("end_time"),
                     F.count_if(started).alias("start_lines"),
                     F.count_if(finished).alias("finish_lines"))
                .filter(F.col("start_lines") + F.col("finish_lines") > 0))
    return (per_file.select(*_app_cols(), parse.container_attempt("file_path").alias("attempt"), "tid", "stage",
                            "start_time", "end_time", "start_lines", "finish_lines")
            .groupBy(*APP, "attempt", "tid", "stage")
            .agg(F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"),
                 F.sum("start_lines").alias("start_lines"), F.sum("finish_lines").alias("finish_lines")))


def finished(tasks_df: DataFrame) -> DataFrame:
    """Tasks (from :func:`tasks`) with both a start and a finish, with ``duration_sec``."""
    return (tasks_df
            .filter(F.col("start_time").isNotNull() & F.col("end_time").isNotNull())
            .withColumn("duration_sec",
                        F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time"))))


def task_times(lines: DataFrame, line: str = "log_entry", path: str = "file_path") -> DataFrame:
    """Tasks with both a start and a finish, with ``duration_sec``."""
    return finished(tasks(lines, line, path))


def durations_of(times: DataFrame) -> DataFrame:
    return (times.groupBy(*APP)
            .agg(F.count(F.lit(1)).alias("num_tasks"),
                 F.avg("duration_sec").alias("avg_task_sec"),
                 F.min("duration_sec").alias("min_task_sec"),
                 F.max("duration_sec").alias("max_task_sec")))


def unfinished_of(tasks_df: DataFrame) -> DataFrame:
    return (tasks_df.filter((F.col("start_lines") > 0) & (F.col("finish_lines") == 0))
            .select(*APP, "attempt", "tid", "stage", "start_time"))


def slowest_tasks_of(times: DataFrame, k: int = 10) -> DataFrame:
    return (times.select(*APP, "attempt", "tid", "stage", "duration_sec")
            .orderBy(F.desc("duration_sec"), *APP, "attempt", "tid", "stage").limit(k))


def slowest_stages_of(times: DataFrame, k: int = 10) -> DataFrame:
    return (times.groupBy(*APP, "attempt", "stage")
            .agg(F.count(F.lit(1)).alias("num_tasks"),
                 F.sum("duration_sec").alias("task_sec"),
                 F.timestamp_diff("SECOND", F.min("start_time"), F.max("end_time")).alias("span_sec"))
            .orderBy(F.desc("span_sec"), *APP, "attempt", "stage").limit(k))


def stage_skew_of(times: DataFrame) -> DataFrame:
    return (times.groupBy(*APP, "attempt", "stage")
            .agg(F.count(F.lit(1)).alias("num_tasks"),
                 F.max("duration_sec").alias("max_task_sec"),
                 F.percentile("duration_sec", 0.5).alias("median_task_sec"))
            .withColumn("skew", F.try_divide(F.col("max_task_sec").cast("double"),
                                             F.col("median_task_sec"))))


def task_durations(lines: DataFrame, line: str = "log_entry", path: str = "file_path") -> DataFrame:
    """Per application: finished tasks and their average, min and max duration."""
    return durations_of(task_times(lines, line, path))


def unfinished_tasks(lines: DataFrame, line: str = "log_entry", path: str = "file_path") -> DataFrame:
    """Tasks that started and never logged a finish (failed or lost)."""
    return unfinished_of(tasks(lines, line, path))


def slowest_tasks(lines: DataFrame, k: int = 10, line: str = "log_entry",
                  path: str = "file_path") -> DataFrame:
    """The ``k`` longest finished tasks (top-k, ties by cluster, app, attempt, tid, stage)."""
    return slowest_tasks_of(task_times(lines, line, path), k)


def slowest_stages(lines: DataFrame, k: int = 10, line: str = "log_entry",
                   path: str = "file_path") -> DataFrame:
    """The ``k`` stages with the longest span (first task start to last finish),
    with their finished tasks and summed task seconds; ties by cluster, app, attempt, stage."""
    return slowest_stages_of(task_times(lines, line, path), k)


def stage_skew(lines: DataFrame, line: str = "log_entry", path: str = "file_path") -> DataFrame:
    """Per (cluster, app, attempt, stage): tasks, max and median duration, max / median.

    The exact median keeps a value → count map per stage, so its memory grows
    with the distinct durations (whole seconds), not with the task count.
    A zero median gives a NULL ratio instead of a division error.
    """
    return stage_skew_of(task_times(lines, line, path))


# --- message figures ----------------------------------------------------------

def python_timings(lines: DataFrame, line: str = "log_entry", path: str = "file_path", k: int = 4096) -> DataFrame:
    """PythonRunner phase times per application (values as logged; boot may be
    negative): runs, sum, averages, maximum, median and 95th percentile of ``total``.

    Times are summed up per file, quantiles as KLL sketches, and the files' figures are merged
    per application. Sketches are exact up to ``k`` runs and of bounded size beyond
    (:func:`logtide.operators.states.rank_error`).
    """
    times = ("total", "boot", "init", "finish")
    m = (lines.filter(F.col(line).contains("PythonRunner: Times:"))
         .select(F.col(path).alias("file_path"),
                 *[parse.extract_long(line, P.PYTHON_TIMES, i).alias(n) for i, n in enumerate(times, 1)]))
    found = _by_app(m, {
        "runs": (F.count("total"), F.sum),
        **{f"sum_{n}": (F.sum(n), F.sum) for n in times},
        **{f"n_{n}": (F.count(n), F.sum) for n in times[1:]},
        "max_total": (F.max("total"), F.max),
        "sketch": (F.kll_sketch_agg_bigint("total", F.lit(k)), lambda c: F.kll_merge_agg_bigint(c, F.lit(k))),
    }).filter(F.col("runs") > 0)

    def mean(total, n):
        return F.try_divide(F.col(total).cast("double"), F.col(n).cast("double"))

    return found.select(
        *APP, "runs", "sum_total", mean("sum_total", "runs").alias("avg_total"),
        *[mean(f"sum_{n}", f"n_{n}").alias(f"avg_{n}") for n in times[1:]], "max_total",
        F.kll_sketch_get_quantile_bigint("sketch", F.lit(0.5)).alias("p50_total"),
        F.kll_sketch_get_quantile_bigint("sketch", F.lit(0.95)).alias("p95_total"))


def resource_requests(lines: DataFrame, line: str = "log_entry", path: str = "file_path") -> DataFrame:
    """Executor requests per application: executors, cores and memory asked for."""
    m = (lines.filter(F.col(line).contains("Will request"))
         .select(F.col(path).alias("file_path"),
                 parse.extract_long(line, P.RESOURCE_REQUEST, 1).alias("executors"),
                 parse.extract_long(line, P.RESOURCE_REQUEST, 2).alias("cores"),
                 parse.extract_long(line, P.RESOURCE_REQUEST, 3).alias("memory_mb")))
    return _by_app(m, {
        "requests": (F.count("executors"), F.sum),
        "executors_requested": (F.sum("executors"), F.sum),
        "max_cores_per_executor": (F.max("cores"), F.max),
        "max_memory_mb_per_executor": (F.max("memory_mb"), F.max),
        "cores_requested": (F.sum(F.try_multiply("executors", "cores")), F.sum),
        "memory_mb_requested": (F.sum(F.try_multiply("executors", "memory_mb")), F.sum),
    }).filter(F.col("requests") > 0)


def container_requests(lines: DataFrame, line: str = "log_entry", path: str = "file_path") -> DataFrame:
    """Container requests per application and asked-for host: requests, memory and cores."""
    m = (lines.filter(F.col(line).contains("Container request (host:"))
         .select(F.col(path).alias("file_path"),
                 F.regexp_extract(F.col(line), P.CONTAINER_REQUEST, 1).alias("host"),
                 parse.extract_long(line, P.CONTAINER_REQUEST, 2).alias("memory_mb"),
                 parse.extract_long(line, P.CONTAINER_REQUEST, 3).alias("cores")))
    return _by_app(m, {
        "requests": (F.count("memory_mb"), F.sum),
        "memory_mb_requested": (F.sum("memory_mb"), F.sum),
        "max_memory_mb": (F.max("memory_mb"), F.max),
        "cores_requested": (F.sum("cores"), F.sum),
    }, keys=("host",)).filter(F.col("requests") > 0)


def failure_rates(lines: DataFrame, line: str = "log_entry", path: str = "file_path") -> DataFrame:
    """Per application: lines, ERROR lines and their share."""
    m = lines.select(F.col(path).alias("file_path"), (parse.level(line) == "ERROR").alias("is_error"))
    return (_by_app(m, {"log_lines": (F.count(F.lit(1)), F.sum), "error_lines": (F.count_if("is_error"), F.sum)})
            .withColumn("error_rate", F.try_divide(F.col("error_lines").cast("double"),
                                                   F.col("log_lines").cast("double"))))


def shuffle_blocks(lines: DataFrame, line: str = "log_entry", path: str = "file_path") -> DataFrame:
    """Shuffle fetches per application: non-empty and total blocks."""
    m = (lines.filter(F.col(line).contains("non-empty blocks"))
         .select(F.col(path).alias("file_path"),
                 parse.extract_long(line, P.SHUFFLE_FETCH, 1).alias("non_empty"),
                 parse.extract_long(line, P.SHUFFLE_FETCH, 2).alias("blocks")))
    return (_by_app(m, {"fetches": (F.count("blocks"), F.sum), "non_empty_blocks": (F.sum("non_empty"), F.sum),
                        "total_blocks": (F.sum("blocks"), F.sum)})
            .filter(F.col("fetches") > 0)
            .withColumn("non_empty_share",
                        F.try_divide(F.col("non_empty_blocks").cast("double"),
                                     F.col("total_blocks").cast("double"))))


def memory_blocks(lines: DataFrame, line: str = "log_entry", path: str = "file_path") -> DataFrame:
    """Blocks stored in memory per application, sizes normalised to bytes."""
    unit = F.regexp_extract(F.col(line), P.MEMORY_BLOCK, 3)
    mult = F.when(unit == "B", F.lit(P.UNIT_BYTES["B"]))
    for u in ("KB", "MB", "GB"):
        mult = mult.when(unit == u, F.lit(P.UNIT_BYTES[u]))
    size = F.regexp_extract(F.col(line), P.MEMORY_BLOCK, 2).try_cast("double")
    m = (lines.filter(F.col(line).contains("stored as bytes in memory"))
         .select(F.col(path).alias("file_path"), F.round(size * mult).try_cast("bigint").alias("bytes")))
    return _by_app(m, {"blocks": (F.count("bytes"), F.sum), "bytes_stored": (F.sum("bytes"), F.sum),
                       "max_block_bytes": (F.max("bytes"), F.max)}).filter(F.col("blocks") > 0)


def input_splits(lines: DataFrame, line: str = "log_entry", path: str = "file_path") -> DataFrame:
    """Input splits read per application and input file: splits and bytes."""
    m = (lines.filter(F.col(line).contains("Input split:"))
         .select(F.col(path).alias("file_path"),
                 F.regexp_extract(F.col(line), P.INPUT_SPLIT, 1).alias("input_file"),
                 parse.extract_long(line, P.INPUT_SPLIT, 3).alias("length")))
    return _by_app(m, {"splits": (F.count("length"), F.sum), "bytes_read": (F.sum("length"), F.sum)},
                   keys=("input_file",)).filter(F.col("splits") > 0)


# --- parsing ------------------------------------------------------------------

def parsed_log(lines: DataFrame, line: str = "log_entry") -> DataFrame:
    """The documented record parse: timestamp text, level, component, message."""
    return lines.select(parse.timestamp_text(line).alias("timestamp"),
                        parse.level_loose(line).alias("level"),
                        parse.component(line).alias("component"),
                        F.col(line).alias("message"))


def parse_quality(lines: DataFrame, line: str = "log_entry") -> DataFrame:
    """One row of counts: which part of the line failed to parse."""
    ts_text = parse.timestamp_text(line)
    m = lines.select(
        (parse.level(line) == "").alias("no_level"),
        (ts_text == "").alias("no_timestamp"),
        ((ts_text != "") & parse.to_log_timestamp(ts_text).isNull()).alias("bad_timestamp"),
        (parse.component(line) == "").alias("no_component"))
    return m.agg(F.count(F.lit(1)).alias("total_lines"),
                 F.count_if("no_level").alias("no_level"),
                 F.count_if("no_timestamp").alias("no_timestamp"),
                 F.count_if("bad_timestamp").alias("bad_timestamp"),
                 F.count_if("no_component").alias("no_component"))


# --- all per-application figures in one pass ---------------------------------

def app_report(lines: DataFrame, line: str = "log_entry", path: str = "file_path") -> DataFrame:
    """Failure rate, PythonRunner timings, resource requests, shuffle fetches and
    memory blocks per application, from one scan and one shuffle.

    Each figure's regex runs only on lines holding its message (a cheap
    substring test guards it), and the per-figure operators' groups are
    reproduced by conditional, null-skipping aggregates. Counts, sums and
    maxima of a message that never occurs in an application are 0 there; its
    averages are NULL.
    """
    L = F.col(line)

    def guarded(marker: str, pattern: str, idx: int) -> F.Column:
        return F.when(L.contains(marker), parse.extract_long(L, pattern, idx))

    unit = F.regexp_extract(L, P.MEMORY_BLOCK, 3)
    mult = F.when(unit == "B", F.lit(P.UNIT_BYTES["B"]))
    for u in ("KB", "MB", "GB"):
        mult = mult.when(unit == u, F.lit(P.UNIT_BYTES[u]))
    size = F.regexp_extract(L, P.MEMORY_BLOCK, 2).try_cast("double")
    block_bytes = F.when(L.contains("stored as bytes in memory"),
                         F.round(size * mult).try_cast("bigint"))
    m = lines.select(
        F.col(path).alias("file_path"),
        (parse.level(line) == "ERROR").alias("is_error"),
        guarded("PythonRunner: Times:", P.PYTHON_TIMES, 1).alias("py_total"),
        guarded("PythonRunner: Times:", P.PYTHON_TIMES, 2).alias("py_boot"),
        guarded("Will request", P.RESOURCE_REQUEST, 1).alias("executors"),
        guarded("Will request", P.RESOURCE_REQUEST, 2).alias("cores"),
        guarded("Will request", P.RESOURCE_REQUEST, 3).alias("memory_mb"),
        guarded("non-empty blocks", P.SHUFFLE_FETCH, 1).alias("non_empty"),
        guarded("non-empty blocks", P.SHUFFLE_FETCH, 2).alias("blocks"),
        block_bytes.alias("block_bytes"))
    found = _by_app(m, {
        "log_lines": (F.count(F.lit(1)), F.sum),
        "error_lines": (F.count_if("is_error"), F.sum),
        "python_runs": (F.count("py_total"), F.sum),
        "python_total": (F.sum("py_total"), F.sum),
        "python_boots": (F.count("py_boot"), F.sum),
        "python_boot": (F.sum("py_boot"), F.sum),
        "executors_requested": (F.sum("executors"), F.sum),
        "memory_mb_requested": (F.sum(F.try_multiply("executors", "memory_mb")), F.sum),
        "max_cores_per_executor": (F.max("cores"), F.max),
        "shuffle_fetches": (F.count("blocks"), F.sum),
        "non_empty_blocks": (F.sum("non_empty"), F.sum),
        "total_blocks": (F.sum("blocks"), F.sum),
        "memory_blocks": (F.count("block_bytes"), F.sum),
        "bytes_stored": (F.sum("block_bytes"), F.sum),
    })

    def zero(c):
        return F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)

    def mean(total, n):
        return F.try_divide(F.col(total).cast("double"), F.col(n).cast("double"))

    return found.select(
        *APP, "log_lines", "error_lines", "python_runs",
        mean("python_total", "python_runs").alias("avg_python_total"), mean("python_boot", "python_boots").alias("avg_python_boot"),
        zero("executors_requested"), zero("memory_mb_requested"), zero("max_cores_per_executor"), "shuffle_fetches",
        zero("non_empty_blocks"), zero("total_blocks"), "memory_blocks", zero("bytes_stored"),
        mean("error_lines", "log_lines").alias("error_rate"))
