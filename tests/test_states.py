"""Kept daily states: merged loads equal one pass, and quantiles lie within the stated error."""

from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from logtide.operators import daily, states
from logtide.plans import jobs
from logtide.plans.sinks import read_csv
from logtide.sources.trips import monthly_paths


def _trips(spark, days: int, each: int, seed: int = 1):
    rng = random.Random(seed)
    rows = [(datetime(2021, 1, 1) + timedelta(days=d, seconds=rng.randrange(86400)), rng.choice([None, float(rng.randrange(40))]),
             rng.choice([None, 1.0, 2.0, 3.0]), round(rng.lognormvariate(2, 1), 2), rng.random(), rng.choice([0.0, 0.5]))
            for d in range(days) for _ in range(each)]
    return spark.createDataFrame(rows, "tpep_pickup_datetime timestamp_ntz, trip_distance double, passenger_count double, "
                                       "fare_amount double, tip_amount double, mta_tax double")


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_months_added_one_by_one_equal_one_pass(spark, tmp_dir):
    trips = _trips(spark, 90, 30).cache()
    paths = monthly_paths(tmp_dir, 2021, [1, 2, 3])
    # a month's file also holds the last trips of the day before
    cuts = [datetime(2021, 1, 1), datetime(2021, 1, 31, 18), datetime(2021, 2, 28, 18), datetime(2021, 5, 1)]
    for path, low, high in zip(paths, cuts, cuts[1:]):
        trips.filter((F.col(daily.TS) >= F.lit(low)) & (F.col(daily.TS) < F.lit(high))).write.parquet(path)
    folder = f"{tmp_dir}/states"
    jobs.states_job(spark, {"2021-01": paths[0], "2021-02": paths[1]}, folder, tmp_dir + "/out")
    read = spark.read.parquet(folder).select("load").distinct().count()
    out = jobs.states_job(spark, {"2021-03": paths[2]}, folder, tmp_dir + "/out")
    again = jobs.states_job(spark, {"2021-03": paths[2]}, folder, tmp_dir + "/again")  # a load replaces itself
    assert read == 2 and _rows(read_csv(spark, out["daily_summary"])) == _rows(read_csv(spark, again["daily_summary"]))
    assert states.kept(spark, folder).count() == 90 + 2  # two days are in two loads
    merged = states.summary_of(states.merged(states.kept(spark, folder)))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert _rows(merged) == _rows(daily.daily_summary(trips))
    assert plan.count("FileScan") == 1 and tmp_dir + "/states" in plan and "SortAggregate" not in plan


def test_quantiles_of_large_groups_lie_within_the_error(spark):
    trips = _trips(spark, 40, 500, seed=2).cache()
    k = 256
    parts = trips.withColumn("load", F.pmod(F.hash(*trips.columns), F.lit(7)))
    one = states.summary_of(states.merged(states.daily_states(parts, ("load",), k=k), ("dt_year",), k=k), ("dt_year",), ordered=False)
    one = spark.createDataFrame(one.collect(), one.schema)  # a sketch draws at random: another run gives another value
    (r,) = states.quantile_ranks(trips, one, F.year(daily.TS), "dt_year").collect()
    fares = sorted(x.fare_amount for x in trips.select("fare_amount").collect())
    q95 = one.first().q95_fare_amount
    assert r.num_trips == len(fares) == 20_000
    assert (r.below, r.upto) == (sum(f < q95 for f in fares), sum(f <= q95 for f in fares))
    error = states.rank_error(k) * len(fares) + 1
    assert r.below <= 0.95 * len(fares) + error and r.upto >= 0.95 * len(fares) - error
    size = states.merged(states.daily_states(trips, k=k), ("dt_year",), k=k).select(F.length("fares").alias("n")).first().n
    assert size < 30 * k  # bytes; the trips would take 625 times k


def test_states_without_values(spark):
    empty = _trips(spark, 1, 1).filter("1 = 0")
    assert states.summary_of(states.merged(states.daily_states(empty))).count() == 0
    nulls = _trips(spark, 2, 3).select(daily.TS, *[F.lit(None).cast("double").alias(c) for c in (
        "trip_distance", "mta_tax", "fare_amount", "tip_amount", "passenger_count")])
    got = states.summary_of(states.merged(states.daily_states(nulls))).collect()
    assert [tuple(r)[3:] for r in got] == [(3, None, None, None, None, None)] * 2


def test_exact_up_to_k_values(spark):
    for n in (1, 2, 19, 20, 21, 400):
        rows = spark.range(1, n + 1).select(F.lit(datetime(2021, 1, 1)).cast("timestamp_ntz").alias(daily.TS),
                                            *[F.col("id").cast("double").alias(c) for c in (
                                                "trip_distance", "mta_tax", "fare_amount", "tip_amount", "passenger_count")])
        parts = rows.withColumn("load", F.col("fare_amount") % 3)
        (r,) = states.summary_of(states.merged(states.daily_states(parts, ("load",)))).collect()
        assert r.q95_fare_amount == math.ceil(0.95 * n)


def test_distinct_ids_of_merged_days(spark):
    rows = [(f"application_9_000{a}/container_9_000{a}_01_{c:06d}.log", f"17/03/{d:02d} 10:00:00 INFO X: y")
            for d in (1, 2, 4) for a in (1, 2) for c in range(d, d + 30)]
    rows += [("application_9_0001/container_9_0001_01_000900.log", "no time"), ("stray/notes.log", "17/03/01 10:00:00 INFO X: z")]
    lines = spark.createDataFrame(rows * 2, "file_path string, log_entry string")
    kept = states.id_states(lines).cache()
    got = {r.cluster_id: tuple(r)[1:] for r in states.distinct_ids(kept).collect()}
    assert got == {"9": (2 * 181, 2, 2 * 33 + 1), "": (2, 0, 0)}
    over = {(r.cluster_id, r.day.day): (r.containers, r.carried_over) for r in states.carried_over(kept).collect()}
    assert over == {("9", 1): (60, None), ("9", 2): (60, 58), ("9", 4): (60, 56), ("", 1): (0, None)}


def test_estimates_beyond_the_sketch_lie_within_the_error(spark):
    lines = spark.range(60_000).select(
        F.format_string("application_7_%04d/container_7_%04d_01_%06d.log", F.col("id") % 3, F.col("id") % 3, "id").alias("file_path"),
        F.format_string("17/03/%02d 10:00:00 INFO X: y", F.col("id") % 20 + 1).alias("log_entry"))
    (r,) = states.distinct_ids(states.id_states(lines)).collect()
    assert r.log_lines == 60_000 and r.applications == 3
    assert 0 < abs(r.containers - 60_000) <= states.distinct_error() * 60_000
