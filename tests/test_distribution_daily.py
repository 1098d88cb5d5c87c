"""Histogram / density curve against numpy; daily summaries against pandas."""

from __future__ import annotations

import math
from datetime import datetime

import numpy as np
import pandas as pd
import pytest

from logtide.operators import daily, distribution


@pytest.fixture(scope="module")
def durations():
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.integers(10, 400, 300), rng.integers(2000, 56000, 40), [10, 55957]])
    return [int(v) for v in vals]


def test_histogram_matches_numpy(spark, durations):
    df = spark.createDataFrame([(v,) for v in durations], ["duration_sec"])
    got = distribution.histogram(spark, df).collect()
    counts, edges = np.histogram(np.array(durations, dtype=float), bins=30)
    dens, _ = np.histogram(np.array(durations, dtype=float), bins=30, density=True)
    assert [r["count"] for r in got] == counts.tolist()
    assert [r.bin_start for r in got] == edges[:-1].tolist()
    assert [r.bin_end for r in got] == edges[1:].tolist()
    assert np.allclose([r.density for r in got], dens, rtol=1e-12, atol=0)


def test_histogram_degenerate_inputs_give_no_rows(spark):
    one = spark.createDataFrame([(5,)], ["duration_sec"])
    same = spark.createDataFrame([(5,), (5,), (5,)], ["duration_sec"])
    assert distribution.histogram(spark, one).count() == 0
    assert distribution.histogram(spark, same).count() == 0
    assert distribution.kde_curve(same).count() == 0


def test_kde_matches_direct_formula(spark, durations):
    df = spark.createDataFrame([(v,) for v in durations], ["duration_sec"])
    got = distribution.kde_curve(df).collect()
    x = np.array(durations, dtype=float)
    n = len(x)
    h = x.std(ddof=1) * n ** (-0.2)
    grid = np.logspace(np.log10(x.min()), np.log10(x.max()), 500)
    dens = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(axis=1) / (n * h * math.sqrt(2 * math.pi))
    assert len(got) == 500
    assert np.allclose([r.x for r in got], grid, rtol=1e-12)
    assert np.allclose([r.density for r in got], dens, rtol=1e-8, atol=1e-15)


def _trips(spark):
    rows = []
    for day in range(1, 4):
        for k in range(5):
            rows.append((datetime(2021, 1, day, k, 0), float(k + day), float(k % 2) * 0.5,
                         float(10 * k + day), float(k) / 10, float(1 + k % 3)))
    rows.append((datetime(2020, 12, 31, 23, 59), 1.0, 0.5, 3.0, 0.0, 1.0))
    rows.append((datetime(2022, 1, 1, 0, 0), 1.0, 0.5, 3.0, 0.0, 1.0))
    return spark.createDataFrame(rows, "tpep_pickup_datetime timestamp, trip_distance double, "
                                       "mta_tax double, fare_amount double, tip_amount double, "
                                       "passenger_count double")


def test_daily_summary_matches_pandas(spark):
    df = _trips(spark)
    got = daily.daily_summary(df, year=2021).toPandas()
    pdf = df.toPandas()
    pdf = pdf[pdf.tpep_pickup_datetime.dt.year == 2021]
    g = pdf.groupby(pdf.tpep_pickup_datetime.dt.day)
    assert list(got.dt_day) == [3, 2, 1]
    for _, r in got.iterrows():
        part = g.get_group(r.dt_day)
        assert r.num_trips == len(part)
        assert r.mean_trip_distance == pytest.approx(part.trip_distance.mean())
        assert r.max_mta_tax == part.mta_tax.max()
        assert r.min_tip_amount == part.tip_amount.min()
        assert r.mean_passenger_count == math.ceil(part.passenger_count.mean())
        # exact for small groups: the smallest value with at least 95% of rows at or below it
        assert r.q95_fare_amount == sorted(part.fare_amount)[math.ceil(0.95 * len(part)) - 1]
    tot = daily.daily_totals(daily.daily_summary(df, year=2021, ordered=False)).first()
    assert (tot.num_days, tot.total_trips, tot.first_date, tot.last_date) == (
        3, 15, datetime(2021, 1, 1), datetime(2021, 1, 3))


def test_year_filter_reaches_the_parquet_scan(spark, tmp_dir):
    path = f"{tmp_dir}/trips.parquet"
    _trips(spark).write.parquet(path)
    df = daily.year_range(spark.read.parquet(path), 2021)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(tpep_pickup_datetime" in plan
    assert "LessThan(tpep_pickup_datetime" in plan
    assert df.count() == 15


def test_monthly_paths_read_as_one_table(spark, tmp_dir):
    from logtide.sources.trips import monthly_paths, read_trips

    df = _trips(spark)
    paths = monthly_paths(tmp_dir, 2021, [1, 2])
    df.limit(5).write.parquet(paths[0])
    df.limit(3).write.parquet(paths[1])
    assert paths[0].endswith("yellow_tripdata_2021-01.parquet")
    assert read_trips(spark, *paths).count() == 8
    # a stray reader option is ignored by the Parquet source
    assert spark.read.parquet(paths[0], header=True).count() == 5
    assert pd.Series(read_trips(spark, f"{tmp_dir}/*.parquet").columns).tolist() == df.columns


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_histogram_matches_numpy_on_random_floats(spark, seed):
    rng = np.random.default_rng(seed)
    vals = np.concatenate([rng.lognormal(5, 1.5, 400), rng.uniform(0, 1, 50)])
    lo, hi = vals.min(), vals.max()
    # values exactly on inner bin edges test the one-bin corrections
    vals = np.concatenate([vals, np.linspace(lo, hi, 31)[1:-1]])
    df = spark.createDataFrame([(float(v),) for v in vals], ["duration_sec"])
    got = distribution.histogram(spark, df).collect()
    counts, edges = np.histogram(vals, bins=30)
    assert [r["count"] for r in got] == counts.tolist()
    assert [r.bin_start for r in got] == edges[:-1].tolist()


def test_months_with_different_column_types_read_as_one(spark, tmp_dir):
    from pyspark.sql import functions as F

    from logtide.sources.trips import monthly_paths, read_trips_unified

    df = _trips(spark)
    p1, p2 = monthly_paths(tmp_dir, 2021, [1, 2])
    df.limit(5).write.parquet(p1)
    df.limit(4).withColumn("passenger_count", F.col("passenger_count").cast("long")).write.parquet(p2)
    both = read_trips_unified(spark, p1, p2)
    assert dict(both.dtypes)["passenger_count"] == "double"
    assert both.count() == 9
    got = daily.daily_summary(both, year=2021).collect()
    assert sum(r.num_trips for r in got) == 9
