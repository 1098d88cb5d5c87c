"""Writers for job outputs: CSV directories with a header, and text files.

Results written here are aggregates (one row per level, app, cluster, day or
bin); ``single_file`` coalesces to one part file only for such bounded
results. Large row-level outputs keep their partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def zoned(df: DataFrame) -> DataFrame:
    """Wall-clock (``TIMESTAMP_NTZ``) columns as session-zone timestamps, which
    CSV prints with their zone (``2017-03-29T10:04:41.000Z`` in UTC)."""
    return df.select(*[F.col(f.name).cast("timestamp").alias(f.name)
                       if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)
                       for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Directory of CSV part files with a header, replacing what was there.

    Timestamps are written with their zone (see :func:`zoned`). A multi-line
    string cell is quoted, so read it back with ``multiLine``.
    """
    df = zoned(df)
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_text(df: DataFrame, path: str, column: str | None = None,
               single_file: bool = True) -> None:
    """Text files, one line per row of a single string column.

    ``single_file`` is for one-row reports; row-level outputs (e.g. every
    ERROR line) keep their partitioning and are written in parallel.
    """
    col = column or df.columns[0]
    out = df.select(F.col(col).cast("string"))
    (out.coalesce(1) if single_file else out).write.mode("overwrite").text(path)


def read_csv(spark, path: str) -> DataFrame:
    return spark.read.option("header", True).option("multiLine", True).csv(path)
