"""Data behind the usage charts: bar series, duration histogram, density curve.

Plan shape: durations are first reduced to distinct values with weights (a
partial aggregate), the few global figures (n, min, max, standard deviation)
enter as one scalar subquery, and the histogram / curve are group sums over
that reduced set. Nothing is collected to the driver and no join pairs the
durations with anything; the density curve does grid-points × distinct
durations work, with the 500-point grid fixed by definition.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P


def bar_series(summary: DataFrame) -> DataFrame:
    """(cluster_id, num_applications) per cluster."""
    return summary.select("cluster_id", "num_applications").orderBy("cluster_id")


def _weighted(values: DataFrame, col: str) -> DataFrame:
    return (values.select(F.col(col).cast("double").alias("x"))
            .filter(F.col("x").isNotNull())
            .groupBy("x").agg(F.count(F.lit(1)).alias("w")))


def _stats(values: DataFrame, col: str):
    x = F.col(col).cast("double")
    return values.filter(F.col(col).isNotNull()).agg(F.struct(
        F.count(F.lit(1)).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"),
        F.stddev_samp(x).alias("sd")).alias("s")).scalar()


def histogram(spark: SparkSession, values: DataFrame, col: str = "duration_sec",
              bins: int = P.HIST_BINS) -> DataFrame:
    """Equal-width density histogram over [min, max] with the last bin closed.

    Bin edges are ``lo + i·(hi − lo)/bins`` (the last edge is ``hi``); a value
    goes to ``floor((x − lo)/(hi − lo)·bins)``, one bin lower when it lies
    below that bin's first edge, one higher when it reaches the next edge
    (never past the last bin). ``density = count / width / n``. Empty bins
    are kept. No rows when n < 2 or all values are equal.
    """
    # the figures enter once, as a column beside the values and beside the bins
    figures = _stats(values, col)
    lo, hi, n = F.col("s.lo"), F.col("s.hi"), F.col("s.n")
    span = hi - lo
    step = span / F.lit(float(bins))

    def edge(i):
        return F.when(i >= bins, hi).otherwise(i.cast("double") * step + lo)

    x = F.col("x")
    guess = F.least(F.floor((x - lo) / span * F.lit(float(bins))).cast("int"), F.lit(bins - 1))
    below = (x < edge(F.col("i0"))).cast("int")
    above = ((x >= edge(F.col("i0") + 1)) & (F.col("i0") != bins - 1)).cast("int")
    counts = (_weighted(values, col).withColumn("s", figures).filter(span > 0)
              .select("w", guess.alias("i0"), "x", "s")
              .select("w", (F.col("i0") - below + above).alias("bin"))
              .groupBy("bin").agg(F.sum("w").alias("count")))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = (grid.join(counts, "bin", "left").withColumn("s", figures)
           .filter((n >= 2) & (span > 0))
           .select("bin",
                   edge(F.col("bin")).alias("bin_start"),
                   edge(F.col("bin") + 1).alias("bin_end"),
                   F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
                   n.alias("n")))
    return (out.withColumn("density", F.col("count").cast("double")
                           / (F.col("bin_end") - F.col("bin_start")) / F.col("n").cast("double"))
            .orderBy("bin"))


def kde_curve(values: DataFrame, col: str = "duration_sec", points: int = P.KDE_POINTS) -> DataFrame:
    """Gaussian kernel density on ``points`` log-spaced points from min to max.

    Bandwidth by Scott's rule, ``h = sd · n^(-1/5)`` with the sample standard
    deviation. Values must be positive (log grid). No rows when n < 2 or
    sd = 0. The kernel sum is a floating-point sum, so its last bits depend on the
    order in which Spark adds partitions.
    """
    lo, hi, n, sd = F.col("s.lo"), F.col("s.hi"), F.col("s.n"), F.col("s.sd")
    h = sd * F.pow(n.cast("double"), F.lit(-0.2))
    a, b = F.log10(lo), F.log10(hi)
    step = (b - a) / F.lit(float(points - 1))
    i = F.col("point")
    y = F.when(i == points - 1, b).otherwise(i.cast("double") * step + a)
    z = (F.col("grid_x") - F.col("x")) / h
    norm = n.cast("double") * h * F.lit(math.sqrt(2.0 * math.pi))
    d = _weighted(values, col).withColumn("s", _stats(values, col)).filter((n >= 2) & (sd > 0))
    return (d.select("x", "w", "s", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
            .withColumn("grid_x", F.pow(F.lit(10.0), y))
            .withColumn("k", F.col("w") * F.exp(F.lit(-0.5) * z * z) / norm)
            .groupBy("point", "grid_x").agg(F.sum("k").alias("density"))
            .select("point", F.col("grid_x").alias("x"), "density")
            .orderBy("point"))
