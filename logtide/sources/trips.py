"""Trip tables in monthly Parquet files.

A list of monthly files read together acts as their union; Spark plans one
scan over all files, so column pruning and pushed filters apply to every
month. Any Hadoop file system URI works (local, HDFS, ``s3a://``); access
settings such as ``spark.hadoop.fs.s3a.*`` belong to the session config.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# FIXED VALUES: file name pattern of the monthly trip files, and the columns
# the daily summary reads with the type each is read as
MONTHLY_FILE = "yellow_tripdata_{year:04d}-{month:02d}.parquet"
TRIP_COLUMNS = {
    "tpep_pickup_datetime": None,  # kept as the first file's timestamp type
    "trip_distance": "double",
    "passenger_count": "double",
    "fare_amount": "double",
    "tip_amount": "double",
    "mta_tax": "double",
}


def monthly_paths(base: str, year: int, months, template: str = MONTHLY_FILE) -> list[str]:
    """``base/yellow_tripdata_YYYY-MM.parquet`` for each month."""
    base = base.rstrip("/")
    return [f"{base}/{template.format(year=year, month=m)}" for m in months]


def read_trips(spark: SparkSession, *paths: str) -> DataFrame:
    """One table from several Parquet files or globs (e.g. ``.../yyyy=2021/*.parquet``)."""
    return spark.read.parquet(*paths)


def read_trips_unified(spark: SparkSession, *paths: str) -> DataFrame:
    """Monthly files whose column types differ (e.g. ``passenger_count`` as
    long in some months, double in others) read as one table.

    A file's footer tells its types; files whose used columns have the same types are one
    scan, so there are as many scans as distinct schemas, a few, however many months. Only
    the used columns are read and cast to one type; each scan still takes pushed filters.
    """
    same: dict[tuple, list[str]] = {}
    for p in paths:
        schema = spark.read.parquet(p).schema
        same.setdefault(tuple(schema[c].dataType for c in TRIP_COLUMNS), []).append(p)
    ts_type = next(iter(same))[0]  # the first file's
    cols = [(c, t or ts_type) for c, t in TRIP_COLUMNS.items()]
    parts = [spark.read.parquet(*files).select(*[F.col(c).cast(t).alias(c) for c, t in cols]) for files in same.values()]
    return reduce(lambda a, b: a.unionByName(b), parts)
