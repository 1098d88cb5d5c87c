from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from logtide.plans.session import ensure_checkpoint_dir

    s = (SparkSession.builder.master("local[4]")
         .appName("logtide-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.maxMetadataStringLength", "4000")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="logtide-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="logtide-test-")


# a small invented log tree covering the cases the stand-in view lacks
CLUSTER = "1485248649253"
LOG_TREE = {
    f"application_{CLUSTER}_0001/container_{CLUSTER}_0001_01_000001.log": [
        "17/03/29 10:04:41 INFO ApplicationMaster: started",
        "17/03/29 10:04:43 INFO YarnAllocator: Will request 3 executor containers, each with 2 cores and 4096 MB memory including 384 MB overhead",
        "17/03/29 10:04:44 WARN YarnAllocator: Container request (host: node-a, capability: <memory:4096, vCores:2>)",
        "17/03/29 10:04:45 INFO BlockManagerInfo: Added broadcast_1_piece0 in memory on mesos-master-1:7001 (size: 1.5 MB, free: 2.0 GB)",
        "",
        "17/03/29 10:15:23 INFO ApplicationMaster: Final app status: SUCCEEDED",
    ],
    f"application_{CLUSTER}_0001/container_{CLUSTER}_0001_01_000002.log": [
        "17/03/29 10:11:10 INFO executor.Executor: Running task 2.0 in stage 1.0 (TID 9)",
        "17/03/29 10:11:10 INFO rdd.HadoopRDD: Input split: file:/in/part.txt:100+250",
        "17/03/29 10:11:13 INFO python.PythonRunner: Times: total = 70, boot = 40, init = 10, finish = 20",
        "17/03/29 10:11:14 INFO executor.Executor: Finished task 2.0 in stage 1.0 (TID 9). 100 bytes result sent to driver",
        "17/03/29 10:11:15 ERROR executor.Executor: Exception in task 9.0 in stage 1.0 (TID 10)",
        "java.lang.RuntimeException: boom",
        "\tat foo.Bar(Bar.java:1)",
        "17/03/29 10:11:16 INFO executor.Executor: Running task 9.0 in stage 1.0 (TID 10)",
        "17/13/45 99:00:00 INFO executor.Executor: impossible date",
        "17/03/29 10:11:20 INFO storage.MemoryStore: Block rdd_3_1 stored as bytes in memory (estimated size 24.0 B, free 1.0 MB)",
        "17/03/29 10:11:21 INFO mesos-slave-7 heartbeat received on mesos-slave-7",
    ],
    "application_1472621869829_0003/container_1472621869829_0003_01_000001.log": [
        "16/09/09 07:43:47 INFO ApplicationMaster: Registered",
        "16/09/09 07:44:20 INFO storage.ShuffleBlockFetcherIterator: Getting 7 non-empty blocks out of 12 blocks",
        "16/09/09 07:44:20 DEBUG broadcast.TorrentBroadcast: retry after ERROR in variable 5",
    ],
    "nested/deeper/application_1472621869829_0004/container_1472621869829_0004_01_000001.log": [
        "16/09/09 08:00:00 INFO ApplicationMaster: Registered",
        "16/09/09 08:00:10 INFO ApplicationMaster: done",
    ],
    "stray/notes.log": [
        "17/01/01 00:00:00 INFO Loose: file outside an application folder",
    ],
    "Spark.tar.gz.txt": [
        "17/01/01 00:00:00 ERROR this archive stand-in must not be read",
    ],
}


def write_tree(root: str, tree: dict[str, list[str]] = LOG_TREE) -> str:
    for rel, lines in tree.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write("\n".join(lines) + "\n")
    return root


def tree_lines(tree: dict[str, list[str]] = LOG_TREE, glob_log: bool = True):
    """(relative path, line) for every line Spark's text reader yields."""
    out = []
    for rel, lines in tree.items():
        if glob_log and not rel.endswith(".log"):
            continue
        out.extend((rel, ln) for ln in lines)
    return out


@pytest.fixture(scope="session")
def log_tree():
    return write_tree(tempfile.mkdtemp(prefix="logtide-tree-"))
