"""Stand-in inputs derived from the supplied tables.

The supplied parquet tables hold no log files and no taxi trips, so both are
rendered from tables with Spark expressions (row-local, no shuffle); their
size grows with the source table.

``log_lines``: one log line per ``events`` row, with a file path of the
``application_*/container_*.log`` layout. It yields three clusters (one much
larger), two application attempts whose task ids repeat, lines naming two hosts, application durations that grow with the app number, task start /
finish / exception pairs, resource, memory, shuffle, input-split and
PythonRunner messages, one line in ten without timestamp and DEBUG lines
that carry the word ERROR later on.

``trips``: ``lineitem`` columns renamed to the trip schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# FIXED VALUES: cluster ids used by the stand-in log view
CLUSTER_MAIN = "1485248649253"
CLUSTER_MID = "1472621869829"
CLUSTER_SMALL = "1448006111297"


def _s(c: Column) -> Column:
    return c.cast("string")


def log_lines_from_events(events: DataFrame) -> DataFrame:
    """``events`` → ``(event_id, file_path, log_entry)``."""
    g = F.floor(F.col("event_id") / F.lit(2.0)).cast("bigint")
    base = events.select(
        "event_id", "ts", "user_id", "event_type",
        g.alias("g"), (F.col("event_id") % 10).alias("r"))
    app = F.floor(F.sqrt(F.col("g").cast("double"))).cast("bigint")
    base = base.withColumn("app", app)
    cluster = (F.when(F.col("app") % 16 < 14, F.lit(CLUSTER_MAIN))
               .when(F.col("app") % 16 == 14, F.lit(CLUSTER_MID))
               .otherwise(F.lit(CLUSTER_SMALL)))
    g_s = _s(F.col("g"))
    u = F.col("user_id")
    # every other task is the same task of the second attempt
    m = F.floor(F.col("g") / F.lit(5.0)).cast("bigint")
    base = base.withColumns({"attempt": 1 + m % 2, "tid": F.floor(m / F.lit(2.0)).cast("bigint")})
    base = base.withColumns({
        "ca": F.concat(cluster, F.lit("_"), F.lpad(_s(F.col("app")), 4, "0")),
        "t": F.date_format("ts", "yy/MM/dd HH:mm:ss"),
        "task": F.concat(_s(F.col("tid") % 8), F.lit(".0 in stage "), _s(F.col("tid") % 16),
                         F.lit(".0 (TID "), _s(F.col("tid")), F.lit(")")),
    })
    t, task = F.col("t"), F.col("task")
    r = F.col("r")
    mem = _s(1024 * (1 + u % 28))
    entry = (
        F.when(r == 0, F.concat(t, F.lit(" INFO executor.Executor: Running task "), task))
        .when(r == 1, F.when(F.col("event_type") == "error",
                             F.concat(t, F.lit(" ERROR executor.Executor: Exception in task "), task))
              .otherwise(F.concat(t, F.lit(" INFO executor.Executor: Finished task "), task,
                                  F.lit(". 2364 bytes result sent to driver"))))
        .when(r == 2, F.concat(t, F.lit(" INFO python.PythonRunner: Times: total = "),
                               _s(u * 10 + 20), F.lit(", boot = -12, init = 50, finish = "), _s(u)))
        .when(r == 3, F.concat(t, F.lit(" INFO YarnAllocator: Will request "), _s(1 + u % 16),
                               F.lit(" executor containers, each with 5 cores and "), mem,
                               F.lit(" MB memory including 2560 MB overhead")))
        .when(r == 4, F.concat(t, F.lit(" INFO storage.MemoryStore: Block rdd_"), g_s,
                               F.lit("_25 stored as bytes in memory (estimated size "), _s(u),
                               F.lit(".0 "), F.when(u % 2 == 0, F.lit("KB")).otherwise(F.lit("MB")),
                               F.lit(", free 4.5 GB)")))
        .when(r == 5, F.concat(t, F.lit(" WARN YarnAllocator: Container request (host: Any, capability: <memory:"),
                               mem, F.lit(", vCores:5>)")))
        .when(r == 6, F.concat(t, F.lit(" INFO storage.ShuffleBlockFetcherIterator: Getting "), _s(u),
                               F.lit(" non-empty blocks out of "), _s(u + 50), F.lit(" blocks")))
        .when(r == 7, F.concat(t, F.lit(" INFO rdd.HadoopRDD: Input split: hdfs://namenode.example/in/f.txt:"),
                               _s(F.col("g") * 1024), F.lit("+1024")))
        .when(r == 8, F.lit("    at foo.Bar(INFORMATION.java:1)"))
        .otherwise(F.concat(t, F.lit(" DEBUG broadcast.TorrentBroadcast: retry after ERROR in variable "), g_s,
                            F.lit(" from mesos-slave-"), _s(F.col("g") % 20), F.lit(" via mesos-master-1")))
    )
    ca = F.col("ca")
    path = F.concat(F.lit("application_"), ca, F.lit("/container_"), ca, F.lit("_0"), _s(F.col("attempt")), F.lit("_"),
                    F.lpad(_s(1 + F.col("g") % 7), 6, "0"), F.lit(".log"))
    # generated, so that a filter on the line isn't moved below and each line is rendered
    # once, as a line is read once from a file
    return base.select("event_id", path.alias("file_path"), F.explode(F.array(entry)).alias("log_entry"))


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` → the six trip columns the daily summary reads."""
    return lineitem.select(
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_quantity").alias("passenger_count"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("tip_amount"),
        F.col("l_tax").alias("mta_tax"),
    )
