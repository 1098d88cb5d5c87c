"""How many tasks run at a time: a sweep over their starts and ends.

A start counts +1 and an end -1 at its second; the sum up to a moment is the number of tasks that
run from then on. Starts and ends of one second are added up before the sweep, so an application
has a row per second at most, however many tasks it runs. The sweep is cut by the hour: each
(application, hour) is summed on its own, and what the hours before leave running, a row
per hour, is added. No task holds more than the seconds of an hour in a window, be the
application or cluster as large as it may.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running(times: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, ts, next_ts, running): the tasks that run from ``ts`` to before ``next_ts`` (NULL after the last end).

    ``times``: tasks with ``start_time`` and ``end_time``. A task runs from its start to before
    its end; one that ends in the second it starts in, or earlier, never runs. ``times`` is read twice
    (:func:`concurrency` reads it once more): pass a stored table, as the messages job does.
    """
    ran = times.filter(F.col("end_time") > F.col("start_time"))
    steps = (ran.select(*keys, F.explode(F.array(F.struct(F.col("start_time").alias("ts"), F.lit(1).alias("d")),
                                                 F.struct(F.col("end_time").alias("ts"), F.lit(-1).alias("d")))).alias("e"))
             .groupBy(*keys, F.col("e.ts").alias("ts")).agg(F.sum("e.d").alias("d"))
             .filter(F.col("d") != 0).withColumn("hour", F.date_trunc("HOUR", F.col("ts").cast("timestamp_ntz"))))
    hours = steps.groupBy(*keys, "hour").agg(F.sum("d").alias("left"), F.min("ts").alias("first_ts"))
    by_hour = Window.partitionBy(*keys).orderBy("hour")
    before = hours.select(*keys, "hour", F.coalesce(F.sum("left").over(by_hour.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                          .alias("carried"), F.lead("first_ts").over(by_hour).alias("next_hour"))
    inside = Window.partitionBy(*keys, "hour").orderBy("ts")
    return (steps.join(before, [*keys, "hour"])
            .select(*keys, "ts", F.coalesce(F.lead("ts").over(inside), F.col("next_hour")).alias("next_ts"),
                    (F.col("carried") + F.sum("d").over(inside)).alias("running")))


def concurrency(times: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per ``keys``: tasks, their seconds, the seconds in which any ran (``busy_sec``), the most that ran
    at a time and the mean while any ran. ``times`` as :func:`logtide.operators.messages.task_times` gives them."""
    tasks = times.groupBy(*keys).agg(F.count(F.lit(1)).alias("num_tasks"),
                                     F.sum(F.greatest("duration_sec", F.lit(0))).cast("bigint").alias("task_sec"))
    busy = F.when(F.col("running") > 0, F.timestamp_diff("SECOND", F.col("ts"), F.col("next_ts")))
    swept = running(times, keys).groupBy(*keys).agg(F.sum(busy).alias("busy"), F.max("running").alias("peak"))
    return tasks.join(swept, list(keys), "left").select(
        *keys, "num_tasks", "task_sec", F.coalesce("busy", F.lit(0)).cast("bigint").alias("busy_sec"),
        F.coalesce("peak", F.lit(0)).cast("bigint").alias("peak_tasks"),
        F.try_divide(F.col("task_sec").cast("double"), F.col("busy").cast("double")).alias("mean_tasks"))
