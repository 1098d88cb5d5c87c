"""Log-file sources: trees of container logs read as DataFrames.

Layout: ``<root>/application_<cluster>_<app>/container_<cluster>_<app>_<attempt>_<n>.log``.
Every reader returns ``log_entry`` (the text line) and ``file_path`` (origin),
which is all the parse expressions in :mod:`logtide.functions.parse` need.

Scale notes: plain text is splittable, so one large log file spreads over
several tasks; many small files are packed into splits by
``spark.sql.files.maxPartitionBytes`` / ``openCostInBytes``. ``file_path`` comes
from the hidden ``_metadata`` column, which costs nothing per row beyond a
constant per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import patterns as P


def _with_path(df: DataFrame) -> DataFrame:
    return df.select(F.col("value").alias("log_entry"),
                     F.col("_metadata.file_path").alias("file_path"))


def read_log_lines(spark: SparkSession, root: str, *, recursive: bool = True,
                   glob: str | None = "*.log") -> DataFrame:
    """One row per line of every log file under ``root`` (any depth).

    ``glob`` keeps archives or other files lying in the same tree out of the
    scan; pass ``None`` to read every file as the plain recursive scan does.
    """
    reader = spark.read
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return _with_path(reader.text(root))


def with_position(lines: DataFrame) -> DataFrame:
    """Lines straight from a file scan with ``block`` (where in the file the split they
    were read from begins) and ``pos`` (grows along a split)."""
    return lines.withColumns({"block": F.col("_metadata.file_block_start"), "pos": F.monotonically_increasing_id()})


def read_log_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """Non-recursive glob scan, e.g. ``data/application_*/*.log``."""
    return _with_path(spark.read.text(pattern))


def read_log_files(spark: SparkSession, root: str, *, glob: str | None = "*.log") -> DataFrame:
    """One row per file: ``file_path``, ``content`` (whole text).

    A whole file must fit in one task's memory; container logs are KB to tens
    of MB. ``wholetext`` is passed as the method argument because the method's
    default would reset an ``.option("wholetext", ...)`` set before it.
    """
    reader = spark.read.option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.text(root, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("file_path"),
                     F.col("value").alias("content"))


def stitch_entries(files: DataFrame, content: str = "content") -> DataFrame:
    """Multi-line entries from whole files: lines without a leading timestamp
    join the entry above.

    Input one row per file; output ``file_path``, ``entry_no`` (0-based order
    in the file) and ``log_entry`` (possibly multi-line). Text before the first
    timestamped line forms entry 0. For files of bounded size only, since each
    file is one row in one task; for trees whose files may be arbitrarily
    large use :func:`logtide.operators.entries.number_entries`, which works
    per split.
    """
    body = F.regexp_replace(F.col(content), r"\n$", "")
    parts = F.split(body, P.ENTRY_BREAK)
    return (files
            .select("file_path", F.posexplode(parts).alias("entry_no", "log_entry"))
            .filter(F.col("log_entry") != ""))


def compact_logs(spark: SparkSession, roots, out: str, *, glob: str | None = "*.log",
                 mode: str = "append") -> int:
    """Copy log trees into one Parquet table ``(log_entry, file_path, block, pos)`` partitioned
    by ``cluster_id``; returns the number of roots written.

    A tree of many small container logs is listed on the driver when it is
    scanned; reading it in batches of roots (e.g. ``[".../application_14*",
    ".../application_15*"]``) bounds each listing, and every later query reads
    a columnar, splittable table where a filter on ``cluster_id`` prunes whole
    folders. Each root is one Spark job; the data never passes the driver.
    """
    from ..functions import parse

    n = 0
    for root in roots:
        lines = with_position(read_log_lines(spark, root, glob=glob))
        first_mode = mode if n == 0 else "append"  # later roots add to the first
        (lines.withColumn("cluster_id", parse.cluster_id("file_path"))
         .write.mode(first_mode).partitionBy("cluster_id").parquet(out))
        n += 1
    return n


def read_compacted(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a table written by :func:`compact_logs`: log_entry, file_path, block and
    pos, and ``cluster_id`` as text ('' outside an application folder). A filter on
    ``cluster_id`` prunes folders; operators that parse ids from the path do not."""
    df = spark.read.schema("log_entry string, file_path string, block long, pos long, cluster_id string").parquet(path)
    return df.withColumn("cluster_id", F.coalesce("cluster_id", F.lit("")))
