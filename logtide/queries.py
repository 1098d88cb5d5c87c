"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Log queries read the ``log_lines`` stand-in rendered from ``events``; trip
queries read the ``trips`` stand-in renamed from ``lineitem``. Every query
runs over the whole table; a ``limit`` appears only where top-k is the
feature.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import basics, concurrency, daily, distribution, entries, levels, messages, states, usage
from .sources.standins import log_lines_from_events, trips_from_lineitem
from .sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``log_lines`` stand-in, rendered row by row from ``events`` as it is read."""
    return log_lines_from_events(table(spark, sf_dir, "events"))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_from_lineitem(table(spark, sf_dir, "lineitem"))


# --- log levels ---------------------------------------------------------------

@register
def log_level_counts(spark, sf_dir):
    return levels.level_counts(logs(spark, sf_dir))


@register
def log_scan_count(spark, sf_dir):
    return levels.total_lines(logs(spark, sf_dir))


@register
def lines_with_levels(spark, sf_dir):
    return levels.lines_with_levels(logs(spark, sf_dir))


@register
def log_scan_totals(spark, sf_dir):
    return levels.scan_totals(logs(spark, sf_dir))


@register
def log_level_pct(spark, sf_dir):
    return levels.level_pct(logs(spark, sf_dir))


@register
def log_summary_text(spark, sf_dir):
    return levels.summary_text(logs(spark, sf_dir))


@register
def log_sample(spark, sf_dir):
    return levels.sample_lines(logs(spark, sf_dir), key="event_id", k=10, seed=42)


@register
def component_top20(spark, sf_dir):
    return levels.component_counts(logs(spark, sf_dir), k=20)


@register
def level_counts_unbounded(spark, sf_dir):
    return levels.level_counts_loose(logs(spark, sf_dir))


@register
def level_occurrences(spark, sf_dir):
    return levels.level_occurrences(logs(spark, sf_dir))


@register
def distinct_levels(spark, sf_dir):
    return levels.distinct_levels(logs(spark, sf_dir))


@register
def error_lines(spark, sf_dir):
    return levels.error_lines(logs(spark, sf_dir))


# --- parsing and files --------------------------------------------------------

@register
def parsed_log(spark, sf_dir):
    return messages.parsed_log(logs(spark, sf_dir))


@register
def parse_quality(spark, sf_dir):
    return messages.parse_quality(logs(spark, sf_dir))


@register
def basic_counts(spark, sf_dir):
    return usage.basic_counts(logs(spark, sf_dir))


@register
def containers_per_app(spark, sf_dir):
    return usage.containers_per_app(logs(spark, sf_dir), k=5)


@register
def container_roles(spark, sf_dir):
    return usage.container_roles(logs(spark, sf_dir))


@register
def failed_containers(spark, sf_dir):
    return usage.failed_containers(logs(spark, sf_dir))


@register
def cluster_start(spark, sf_dir):
    return usage.cluster_start(logs(spark, sf_dir))


@register
def log_entries(spark, sf_dir):
    """Multi-line entries; a block is what a file split would be."""
    lines = logs(spark, sf_dir).withColumn("block", F.floor(F.col("event_id") / F.lit(4096)))
    return entries.split_entries(lines, pos="event_id").drop("entry_block", "entry_k")


# --- cluster usage ------------------------------------------------------------

def _timeline(spark, sf_dir, ordered=False):
    return usage.app_timeline(logs(spark, sf_dir), ordered=ordered)


@register
def timestamped_lines(spark, sf_dir):
    return daily.row_count(usage.timestamped_lines(logs(spark, sf_dir)), "timestamped_lines")


@register
def app_timeline(spark, sf_dir):
    return _timeline(spark, sf_dir, ordered=True)


@register
def cluster_summary(spark, sf_dir):
    return usage.cluster_summary(_timeline(spark, sf_dir))


@register
def usage_stats(spark, sf_dir):
    stats = usage.usage_stats(_timeline(spark, sf_dir))
    # as text, which both engines write alike
    return stats.withColumn("most_used", F.array_join(F.transform("most_used", lambda e: F.concat_ws(
        ":", e["cluster_id"], e["num_applications"].cast("string"))), ","))


@register
def top_cluster(spark, sf_dir):
    return usage.top_clusters(usage.cluster_summary(_timeline(spark, sf_dir), ordered=False), 1)


@register
def top_clusters(spark, sf_dir):
    return usage.top_clusters(usage.cluster_summary(_timeline(spark, sf_dir), ordered=False), 5)


@register
def largest_cluster_apps(spark, sf_dir):
    return usage.largest_cluster_apps(_timeline(spark, sf_dir))


@register
def app_timeline_contract(spark, sf_dir):
    return usage.timeline_contract(_timeline(spark, sf_dir, ordered=True))


@register
def cluster_summary_contract(spark, sf_dir):
    return usage.cluster_summary_contract(usage.cluster_summary(_timeline(spark, sf_dir)))


@register
def cluster_lookup_join(spark, sf_dir):
    timeline = _timeline(spark, sf_dir)
    return usage.with_cluster_lookup(timeline, usage.cluster_lookup(timeline))


@register
def cluster_share(spark, sf_dir):
    return usage.cluster_share(logs(spark, sf_dir))


@register
def distinct_ids_from_states(spark, sf_dir):
    """Clusters from days' sketches: whether the estimates lie within the sketch's error of the exact counts."""
    lines = logs(spark, sf_dir)
    found = states.distinct_ids(states.id_states(lines))
    exact = usage.cluster_share(lines).select("cluster_id", "num_applications", "num_containers", F.col("log_lines").alias("n"))
    off = F.lit(states.distinct_error())
    return found.join(exact, "cluster_id").select(
        "cluster_id", "log_lines", (F.col("log_lines") == F.col("n")).alias("same_lines"),
        (F.abs(F.col("applications") - F.col("num_applications")) <= off * F.col("num_applications")).alias("applications_within"),
        (F.abs(F.col("containers") - F.col("num_containers")) <= off * F.col("num_containers")).alias("containers_within"))


@register
def containers_carried_over(spark, sf_dir):
    """Exact while a day has 4,096 containers at most, as it has in the supplied tables."""
    return states.carried_over(states.id_states(logs(spark, sf_dir)))


@register
def host_lines(spark, sf_dir):
    return usage.host_lines(logs(spark, sf_dir))


@register
def cluster_bar(spark, sf_dir):
    return distribution.bar_series(usage.cluster_summary(_timeline(spark, sf_dir), ordered=False))


def _largest_durations(spark, sf_dir):
    """Durations of the largest cluster's applications."""
    return usage.largest_cluster_apps(_timeline(spark, sf_dir)).select("duration_sec")


@register
def duration_histogram(spark, sf_dir):
    return distribution.histogram(spark, _largest_durations(spark, sf_dir), "duration_sec")


@register
def duration_kde(spark, sf_dir):
    # rounded for the comparison only: the last bits of a sum depend on its order
    curve = distribution.kde_curve(_largest_durations(spark, sf_dir), "duration_sec")
    return curve.select("point", F.round("x", 3).alias("x"), F.round("density", 12).alias("density"))


# --- messages -----------------------------------------------------------------

@register
def task_durations(spark, sf_dir):
    return messages.task_durations(logs(spark, sf_dir))


@register
def unfinished_tasks(spark, sf_dir):
    return messages.unfinished_tasks(logs(spark, sf_dir))


@register
def slowest_tasks(spark, sf_dir):
    return messages.slowest_tasks(logs(spark, sf_dir), k=10)


@register
def slowest_stages(spark, sf_dir):
    return messages.slowest_stages(logs(spark, sf_dir), k=10)


@register
def stage_skew(spark, sf_dir):
    return messages.stage_skew(logs(spark, sf_dir))


@register
def python_timings(spark, sf_dir):
    return messages.python_timings(logs(spark, sf_dir))


@register
def resource_requests(spark, sf_dir):
    return messages.resource_requests(logs(spark, sf_dir))


@register
def container_requests(spark, sf_dir):
    return messages.container_requests(logs(spark, sf_dir))


@register
def failure_rates(spark, sf_dir):
    return messages.failure_rates(logs(spark, sf_dir))


@register
def shuffle_blocks(spark, sf_dir):
    return messages.shuffle_blocks(logs(spark, sf_dir))


@register
def memory_blocks(spark, sf_dir):
    return messages.memory_blocks(logs(spark, sf_dir))


@register
def input_splits(spark, sf_dir):
    return messages.input_splits(logs(spark, sf_dir))


@register
def app_report(spark, sf_dir):
    return messages.app_report(logs(spark, sf_dir))


@register
def task_concurrency(spark, sf_dir):
    return concurrency.concurrency(messages.task_times(logs(spark, sf_dir)), ("cluster_id", "app_id"))


@register
def cluster_concurrency(spark, sf_dir):
    return concurrency.concurrency(messages.task_times(logs(spark, sf_dir)), ("cluster_id",))


# --- daily trip summaries -----------------------------------------------------

TRIP_YEAR = 1997  # the stand-in's year for the reference's year filter


@register
def trip_row_count(spark, sf_dir):
    return daily.row_count(trips(spark, sf_dir), "total_rows")


@register
def year_filter_count(spark, sf_dir):
    return daily.row_count(daily.year_range(trips(spark, sf_dir), TRIP_YEAR), "filtered_rows")


@register
def date_parts(spark, sf_dir):
    return daily.date_parts(trips(spark, sf_dir))


@register
def daily_summary(spark, sf_dir):
    return daily.daily_summary(trips(spark, sf_dir), year=TRIP_YEAR)


@register
def daily_summary_all_years(spark, sf_dir):
    return daily.daily_summary(trips(spark, sf_dir), year=None)


@register
def daily_totals(spark, sf_dir):
    return daily.daily_totals(daily.daily_summary(trips(spark, sf_dir), year=TRIP_YEAR,
                                                  ordered=False))


@register
def daily_summary_from_states(spark, sf_dir):
    """Four loads, each with some of every day's trips, summed up on their own and merged."""
    parts = trips(spark, sf_dir)
    parts = parts.withColumn("load", F.pmod(F.xxhash64(*parts.columns), F.lit(4)))
    return states.summary_of(states.merged(states.daily_states(parts, keys=("load",))))


@register
def yearly_quantile_ranks(spark, sf_dir):
    """Years from days' states: whether the true ranks enclose 0.95, within the sketch's error."""
    rows = trips(spark, sf_dir)
    years = states.summary_of(states.merged(states.daily_states(rows), keys=("dt_year",)), keys=("dt_year",), ordered=False)
    ranks = states.quantile_ranks(rows, years, F.year(daily.TS), "dt_year")
    off = F.lit(0.95) * F.col("num_trips")
    error = F.ceil(F.lit(states.rank_error()) * F.col("num_trips")) + 1
    return ranks.select("dt_year", "num_trips",
                        ((F.col("below") <= off + error) & (F.col("upto") >= off - error)).alias("within_error"))


# --- installation checks -------------------------------------------------------

@register
def sql_count(spark, sf_dir):
    return basics.sql_count(spark, logs(spark, sf_dir), view="log_lines")


@register
def even_doubled(spark, sf_dir):
    return basics.even_doubled(table(spark, sf_dir, "events"), "event_id")
