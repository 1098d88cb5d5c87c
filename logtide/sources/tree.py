"""A log tree by its listing: what paths, sizes and times tell, without reading any text.

The ``binaryFile`` source lists files and, as ``content`` is never selected, opens none, on
any file system that Spark reads. Application and cluster ids are parts of folder names, so asking for some
of them becomes a folder pattern: other applications' folders are not even listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def app_folders(root: str, cluster: str | None = None, app: str | None = None) -> str:
    """``root``, or the pattern of the folders of a cluster (``app``: of one of its applications)
    directly below it."""
    if cluster is None and app is None:
        return root
    return f"{root.rstrip('/')}/application_{cluster or '*'}_{app or '*'}"


def list_logs(spark: SparkSession, root: str, *, glob: str | None = "*.log", cluster: str | None = None,
              app: str | None = None) -> DataFrame:
    """(file_path, length, modified) of the log files under ``root``, at any depth.

    The files are those that a scan finds lines in: an empty file has none and is left out.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(app_folders(root, cluster, app))
    return files.filter("length > 0").select(F.col("path").alias("file_path"), "length",
                                             F.col("modificationTime").alias("modified"))
