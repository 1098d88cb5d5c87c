"""Session settings the operators rely on, and materialisation helpers.

Lineage is cut by writing to the shared folder the cluster names in
``spark.checkpoint.dir`` (read from the session). A folder is set here only
when the session has none, as in local tests.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings for a large cluster run. AQE re-plans joins on measured sizes,
# coalesces small shuffle partitions and splits skewed ones.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # percentile sketches: hash aggregation for this many groups a task, not 128
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
}


def checkpoint_dir(spark: SparkSession) -> str | None:
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. a Connect session)
        return None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Use the session's checkpoint folder; set ``fallback`` only when none is set."""
    d = checkpoint_dir(spark)
    if d:
        return d
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def local_checkpoint_dir(spark: SparkSession) -> str:
    """A new machine-local checkpoint folder, for a session in one process only."""
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="logtide-ckpt-"))


_SCRATCH: list[str] = []


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Tables made by :func:`reuse` inside the block go to one folder that is
    deleted when the block ends (a job's intermediates, not its outputs)."""
    root = checkpoint_dir(spark)
    if not root:
        root = local_checkpoint_dir(spark)
    folder = f"{root.rstrip('/')}/logtide_reuse/job-{uuid.uuid4().hex}"
    _SCRATCH.append(folder)
    try:
        yield folder
    finally:
        _SCRATCH.pop()
        p, fs = _fs(spark, folder)
        if fs.exists(p):
            fs.delete(p, True)


def reuse(df: DataFrame) -> DataFrame:
    """Materialise a small result that several branches of a plan read.

    Written once as a Parquet table in the checkpoint folder and read back:
    one job computes it (``Dataset.checkpoint`` on an unpersisted plan would
    compute it twice), later readers survive executor loss without
    recomputation, and the lineage is cut. Used inside :func:`scratch` only, which
    deletes the table.
    """
    spark = df.sparkSession
    if not _SCRATCH:
        raise ValueError("results are kept for a job only")
    path = f"{_SCRATCH[-1]}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path, or anything that a glob stands for, exists."""
    p, fs = _fs(spark, path)
    return bool(fs.globStatus(p))
