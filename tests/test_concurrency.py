"""Tasks that run at a time, against counting second by second."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from logtide.operators import concurrency, messages
from logtide.plans import jobs
from logtide.plans.sinks import read_csv
from logtide.sources.logs import read_log_lines

SCHEMA = "cluster_id string, app_id string, start_time timestamp_ntz, end_time timestamp_ntz, duration_sec long"


def _task(app, a, b, zero=datetime(2017, 3, 29, 22, 59, 0)):
    return ("c", app, zero + timedelta(seconds=a), zero + timedelta(seconds=b), b - a)


def _plain(tasks):
    out = {}
    for app in {t[1] for t in tasks}:
        mine = [t for t in tasks if t[1] == app]
        seconds = {}
        for t in mine:
            s = t[2]
            while s < t[3]:
                seconds[s] = seconds.get(s, 0) + 1
                s += timedelta(seconds=1)
        total = sum(max(t[4], 0) for t in mine)
        out[app] = (len(mine), total, len(seconds), max(seconds.values(), default=0), total / len(seconds) if seconds else None)
    return out


def test_sweep_equals_counting(spark):
    rng = random.Random(3)
    tasks = [_task("0001", a, a + rng.randrange(0, 900)) for a in (rng.randrange(0, 9000) for _ in range(300))]
    tasks += [_task("0002", a, a + 5) for a in (0, 0, 5, 5, 10, 7200)]  # gaps, and one ends where the next begins
    tasks += [_task("0003", 10, 10), _task("0003", 20, 15)]  # never run
    tasks += [_task("0004", 0, 20_000)]  # hours without a start or an end
    times = spark.createDataFrame(tasks, SCHEMA)
    got = {r.app_id: tuple(r)[2:] for r in concurrency.concurrency(times, messages.APP).collect()}
    assert got == _plain(tasks)
    whole = [("c", "all", *t[2:]) for t in tasks]
    (r,) = concurrency.concurrency(times, ["cluster_id"]).collect()
    assert tuple(r)[1:] == _plain(whole)["all"]


def test_steps_join_up(spark):
    times = spark.createDataFrame([_task("1", 0, 100), _task("1", 30, 4000), _task("1", 9000, 9001)], SCHEMA)
    steps = concurrency.running(times, messages.APP).orderBy("ts").collect()
    assert [r.running for r in steps] == [1, 2, 1, 0, 1, 0]
    assert [r.next_ts for r in steps[:-1]] == [r.ts for r in steps[1:]] and steps[-1].next_ts is None


def test_job_writes_it(spark, log_tree, tmp_dir):
    out = jobs.messages_job(spark, log_tree, tmp_dir)
    want = concurrency.concurrency(messages.task_times(read_log_lines(spark, log_tree)), messages.APP)
    assert len(read_csv(spark, out["task_concurrency"]).collect()) == want.count() > 0
    assert read_csv(spark, out["cluster_concurrency"]).count() > 0
