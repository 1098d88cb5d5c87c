"""Daily trip summaries over a trip table (pickup time plus five numeric columns).

Plan shape: the year filter is written as a half-open range on the raw pickup
timestamp, so it reaches the Parquet scan as pushed filters (row-group
skipping); ``year(ts) = Y`` would only push ``IsNotNull``. Only the six used
columns are read. The daily aggregate is partial + final: each task sends at
most one buffer per day, and ``percentile_approx`` buffers are mergeable
sketches of bounded size, so a day holding a third of all trips is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TS = "tpep_pickup_datetime"


def _ts_literal(df: DataFrame, ts: str, text: str):
    """A literal of the column's own timestamp type, folded before pushdown."""
    return F.lit(text).cast(df.schema[ts].dataType)


def year_range(df: DataFrame, year: int, ts: str = TS) -> DataFrame:
    """Rows whose ``ts`` falls in ``year`` (same rows as ``year(ts) = year``)."""
    lo = _ts_literal(df, ts, f"{year:04d}-01-01 00:00:00")
    hi = _ts_literal(df, ts, f"{year + 1:04d}-01-01 00:00:00")
    return df.filter((F.col(ts) >= lo) & (F.col(ts) < hi))


def with_date_parts(df: DataFrame, ts: str = TS) -> DataFrame:
    return df.withColumns({"dt_year": F.year(ts), "dt_month": F.month(ts),
                           "dt_day": F.dayofmonth(ts)})


def date_parts(df: DataFrame, ts: str = TS) -> DataFrame:
    return with_date_parts(df.select(ts), ts).select(ts, "dt_year", "dt_month", "dt_day")


def daily_summary(trips: DataFrame, year: int | None = None, accuracy: int = 10000,
                  ts: str = TS, ordered: bool = True) -> DataFrame:
    """Per day: trips, mean distance, max MTA tax, ~95th percentile fare, min tip,
    mean passengers rounded up; newest day first."""
    df = trips.select(ts, "trip_distance", "mta_tax", "fare_amount", "tip_amount",
                      "passenger_count")
    if year is not None:
        df = year_range(df, year, ts)
    out = (with_date_parts(df, ts)
           .groupBy("dt_year", "dt_month", "dt_day")
           .agg(F.count(F.lit(1)).alias("num_trips"),
                F.avg("trip_distance").alias("mean_trip_distance"),
                F.max("mta_tax").alias("max_mta_tax"),
                F.percentile_approx("fare_amount", 0.95, accuracy).alias("q95_fare_amount"),
                F.min("tip_amount").alias("min_tip_amount"),
                F.ceil(F.avg("passenger_count")).alias("mean_passenger_count")))
    if ordered:
        out = out.orderBy(F.desc("dt_year"), F.desc("dt_month"), F.desc("dt_day"))
    return out


def daily_totals(daily: DataFrame) -> DataFrame:
    """One row over the daily result: days, first and last day (midnight, as a
    timestamp like the other time columns), total and mean trips."""
    d = F.make_date("dt_year", "dt_month", "dt_day").cast("timestamp_ntz")
    return daily.agg(F.count(F.lit(1)).alias("num_days"),
                     F.min(d).alias("first_date"),
                     F.max(d).alias("last_date"),
                     F.sum("num_trips").alias("total_trips"),
                     F.avg("num_trips").alias("avg_daily_trips"))


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))
