"""Source probe: what lies under a path, without reading file contents.

The ``binaryFile`` source lists files in parallel and, when ``content`` is not
selected, never opens them; the listing is an ordinary DataFrame, so the
per-directory figures are a distributed aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "modificationTime")


def source_probe(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Per directory: files, bytes, newest modification time."""
    files = list_files(spark, path, glob)
    parent = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return (files.groupBy(parent.alias("directory"))
            .agg(F.count(F.lit(1)).alias("files"),
                 F.sum("length").alias("bytes"),
                 F.max("modificationTime").alias("last_modified"))
            .orderBy("directory"))


def describe_source(spark: SparkSession, path: str, fmt: str = "parquet",
                    preview: int = 5, names: int = 10) -> dict:
    """Diagnostic of one source, with bounded results only.

    ``exists``; up to ``names`` file names; the row count and schema; up to
    ``preview`` rows; on failure the error class instead of an exception.
    """
    from pyspark.errors import PySparkException

    from ..plans.session import path_exists

    out: dict = {"path": path, "exists": False}
    try:
        out["exists"] = path_exists(spark, path)
        files = list_files(spark, path)
        out["files"] = [r.path for r in files.select("path").orderBy("path").limit(names).collect()]
        df = spark.read.format(fmt).load(path)
        out["schema"] = df.schema.simpleString()
        out["rows"] = df.agg(F.count(F.lit(1)).alias("n")).first().n
        out["preview"] = [r.asDict() for r in df.limit(preview).collect()]
    except PySparkException as e:
        out["error"] = e.getCondition() or type(e).__name__
    return out
