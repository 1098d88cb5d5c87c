"""The log operators over a folder that keeps receiving log files.

The parse expressions are row-local, so they run unchanged on a streaming
DataFrame. Stateful parts are Structured Streaming aggregations whose state
is bounded by the number of groups (levels, applications), not by lines,
and every query keeps its offsets and state in a checkpoint folder under
``spark.checkpoint.dir``, so a restarted query, or one that lost executors,
continues where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import parse
from ..plans.session import checkpoint_dir


def read_log_stream(spark: SparkSession, root: str, *, glob: str | None = "*.log",
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(log_entry, file_path)`` of new files under ``root`` (any depth)."""
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(root).select(F.col("value").alias("log_entry"),
                                    F.col("_metadata.file_path").alias("file_path"))


def level_counts_stream(lines: DataFrame) -> DataFrame:
    """Running lines per level (state: one row per level)."""
    return (lines.select(parse.level("log_entry").alias("log_level"))
            .filter(F.col("log_level") != "")
            .groupBy("log_level").agg(F.count(F.lit(1)).alias("count")))


def app_timeline_stream(lines: DataFrame) -> DataFrame:
    """Running first / last timestamp and lines per application (state: one row per app)."""
    t = (lines.select(parse.cluster_id("file_path").alias("cluster_id"),
                      parse.app_id("file_path").alias("app_id"),
                      parse.log_timestamp("log_entry").alias("timestamp"))
         .filter(F.col("timestamp").isNotNull())
         .groupBy("cluster_id", "app_id")
         .agg(F.min("timestamp").alias("start_time"),
              F.max("timestamp").alias("end_time"),
              F.count(F.lit(1)).alias("log_lines")))
    return t.withColumn("duration_sec",
                        F.timestamp_diff("SECOND", F.col("start_time"), F.col("end_time")))


def error_lines_stream(lines: DataFrame) -> DataFrame:
    """ERROR lines as they arrive (stateless, append)."""
    return lines.filter(parse.level("log_entry") == "ERROR").select("file_path", "log_entry")


def stream_checkpoint(spark: SparkSession, name: str, location: str | None = None) -> str:
    if location:
        return location
    root = checkpoint_dir(spark)
    if not root:
        raise ValueError("set spark.checkpoint.dir or pass a checkpoint location")
    return f"{root.rstrip('/')}/logtide_streams/{name}"


def start_append(df: DataFrame, name: str, path: str, *, fmt: str = "parquet",
                 checkpoint: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Append a stateless stream to files (exactly once through the file sink log)."""
    w = (df.writeStream.outputMode("append").format(fmt)
         .option("path", path)
         .option("checkpointLocation", stream_checkpoint(df.sparkSession, name, checkpoint))
         .queryName(name))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
