"""Installation-check operations: range source, SQL over a temp view, filter + projection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def range_count(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).agg(F.count(F.lit(1)).alias("total"))


def sql_count(spark: SparkSession, df: DataFrame, view: str = "test_table") -> DataFrame:
    """``SELECT COUNT(*) AS total`` over ``df`` registered as a temp view."""
    df.createOrReplaceTempView(view)
    return spark.sql(f"SELECT COUNT(*) AS total FROM {view}")


def even_doubled(df: DataFrame, col: str = "id") -> DataFrame:
    """Keep even values and double them (``filter(x % 2 == 0).select(x * 2)``)."""
    return df.filter(F.col(col) % 2 == 0).select((F.col(col) * 2).alias("doubled"))
