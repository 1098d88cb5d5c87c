"""Figures that are kept and added to: daily trip summaries, and distinct ids of log lines.

A state is a row per day whose figures combine: counts, sums, extremes and a KLL sketch of the
fares. States of one month's files are stored once; a new month's are stored beside them,
and the summary of everything is a merge of states, a few hundred bytes to 32 KB each, instead of a
second scan of all trips. Days that several files hold (trips that begin before midnight of
a month's first day, say) merge like any others, and so do months and years.

A sketch of ``K`` keeps every value of up to ``K`` trips, so their quantiles are exact; beyond
that the rank of a quantile is off by ``rank_error(K)`` of the trips at most, however often
sketches are merged. Larger sketches draw at random which values they keep, so building one again
gives another quantile within the same error; a stored state stays what it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import parse
from .daily import TS, with_date_parts

K = 4096
#: Distinct ids that a theta sketch keeps one by one, as a power of two.
LG_K = 12
DAY = ("dt_year", "dt_month", "dt_day")


def rank_error(k: int = K) -> float:
    """Share of the values that the rank of a quantile may be off by: twice the error that holds with
    99 % confidence, which is five standard deviations."""
    # fixed values: the published error of KLL sketches
    return 2 * 2.296 / k ** 0.9723


def daily_states(trips: DataFrame, keys: tuple[str, ...] = (), k: int = K, ts: str = TS) -> DataFrame:
    """One row per day (and ``keys``, columns of the trips): a state of the day's trips. Partial sketches
    merge in the shuffle, so a day with a third of all trips is one small row a task."""
    used = trips.select(ts, "trip_distance", "mta_tax", "fare_amount", "tip_amount", "passenger_count", *keys)
    return with_date_parts(used, ts).groupBy(*keys, *DAY).agg(
        F.count(F.lit(1)).alias("num_trips"),
        F.sum(F.col("trip_distance").cast("double")).alias("distance"), F.count("trip_distance").alias("distances"),
        F.max("mta_tax").alias("max_mta_tax"), F.min("tip_amount").alias("min_tip_amount"),
        F.sum(F.col("passenger_count").cast("double")).alias("passengers"), F.count("passenger_count").alias("passenger_counts"),
        F.kll_sketch_agg_double(F.col("fare_amount").cast("double"), F.lit(k)).alias("fares"))


def merged(states: DataFrame, keys: tuple[str, ...] = DAY, k: int = K) -> DataFrame:
    """One state per ``keys``, of states with these columns."""
    return states.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("num_trips", "distance", "distances")],
        F.max("max_mta_tax").alias("max_mta_tax"), F.min("min_tip_amount").alias("min_tip_amount"),
        *[F.sum(c).alias(c) for c in ("passengers", "passenger_counts")],
        F.kll_merge_agg_double("fares", F.lit(k)).alias("fares"))


def quantile(sketch: str, q: float) -> F.Column:
    """A sketch's quantile; NULL where it holds no values."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(q)))


def summary_of(states: DataFrame, keys: tuple[str, ...] = DAY, ordered: bool = True) -> DataFrame:
    """The columns of :func:`logtide.operators.daily.daily_summary` from one state per ``keys``."""
    out = states.select(
        *keys, "num_trips", F.try_divide("distance", "distances").alias("mean_trip_distance"), "max_mta_tax",
        quantile("fares", 0.95).alias("q95_fare_amount"), "min_tip_amount",
        F.ceil(F.try_divide("passengers", "passenger_counts")).alias("mean_passenger_count"))
    return out.orderBy(*[F.desc(c) for c in keys]) if ordered else out


def quantile_ranks(trips: DataFrame, summary: DataFrame, key: F.Column, name: str) -> DataFrame:
    """(name, num_trips, below, upto): how many fares lie below a group's ``q95_fare_amount``, and
    below or at it. ``key`` tells a trip's group, ``name`` the summary's column of it. Lets anyone see
    what a sketch's quantile is worth: rank 0.95 should lie between the two shares."""
    return (trips.select(key.alias(name), F.col("fare_amount").cast("double").alias("fare"))
            .join(summary.select(name, "q95_fare_amount"), name)
            .groupBy(name).agg(F.count(F.lit(1)).alias("num_trips"),
                               F.count_if(F.col("fare") < F.col("q95_fare_amount")).alias("below"),
                               F.count_if(F.col("fare") <= F.col("q95_fare_amount")).alias("upto")))


def keep(states: DataFrame, folder: str, load: str) -> None:
    """Store the states of a load (a month, say) beside those of others; a load that is stored
    again replaces itself."""
    states.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/load={load}")


def kept(spark: SparkSession, folder: str) -> DataFrame:
    """The states of all loads."""
    return spark.read.parquet(folder).drop("load")


# --- distinct ids ---------------------------------------------------------------


def distinct_error(lg_k: int = LG_K) -> float:
    """Share that an estimate beyond 2^lg_k distinct ids may be off by: five standard deviations."""
    return 5 / 2 ** (lg_k / 2)


def id_states(lines: DataFrame, line: str = "log_entry", path: str = "file_path", lg_k: int = LG_K) -> DataFrame:
    """One row per cluster and day (NULL: lines without a timestamp): its lines, and theta sketches of the
    applications and containers that wrote them. Unlike counts of distinct ids, sketches of two days
    can be united and intersected later. Lines are counted per file and day first; ids are taken from
    the path once for each."""
    per_file = (lines.select(F.col(path).alias("file_path"), parse.log_timestamp(line).cast("date").alias("day"))
                .groupBy("file_path", "day").agg(F.count(F.lit(1)).alias("log_lines")))
    return (per_file.select(parse.cluster_id("file_path").alias("cluster_id"), "day", "log_lines",
                            parse.application_id("file_path").alias("application_id"),
                            parse.container_id("file_path").alias("container_id"))
            .groupBy("cluster_id", "day")
            .agg(F.sum("log_lines").alias("log_lines"),
                 *[F.theta_sketch_agg(F.when(F.col(c) != "", F.col(c)), F.lit(lg_k)).alias(n)
                   for c, n in (("application_id", "applications"), ("container_id", "containers"))]))


def distinct_ids(states: DataFrame, keys: tuple[str, ...] = ("cluster_id",), lg_k: int = LG_K) -> DataFrame:
    """Per ``keys`` of the states: lines, and the estimated numbers of distinct applications and containers."""
    return states.groupBy(*keys).agg(
        F.sum("log_lines").alias("log_lines"),
        *[F.theta_sketch_estimate(F.theta_union_agg(c, F.lit(lg_k))).alias(c) for c in ("applications", "containers")])


def carried_over(states: DataFrame) -> DataFrame:
    """Per cluster and day: containers that also wrote on the cluster's day before (the last one with
    lines), by intersecting the two days' sketches."""
    days = Window.partitionBy("cluster_id").orderBy("day")
    pairs = states.filter("day is not null").select("cluster_id", "day", "containers", F.lag("containers").over(days).alias("before"))
    return pairs.select("cluster_id", "day", F.theta_sketch_estimate("containers").alias("containers"), F.when(
        F.col("before").isNotNull(), F.theta_sketch_estimate(F.theta_intersection("containers", "before"))).alias("carried_over"))
