"""Figures of a tree's listing against those of its lines."""

from __future__ import annotations

import json
import os

from logtide.operators import usage
from logtide.plans import jobs
from logtide.plans.sinks import read_csv
from logtide.sources.logs import read_log_lines
from logtide.sources.tree import list_logs

from .conftest import LOG_TREE, write_tree


def _tree(tmp_dir):
    """The shared tree with empty files, other files, and an application of empty files only."""
    root = write_tree(os.path.join(tmp_dir, "logs"), LOG_TREE)
    for rel in ("application_1485248649253_0001/container_1485248649253_0001_01_000099.log",
                "application_1485248649253_0077/container_1485248649253_0077_01_000001.log"):
        os.makedirs(os.path.dirname(f"{root}/{rel}"), exist_ok=True)
        open(f"{root}/{rel}", "w").close()
    with open(f"{root}/application_1485248649253_0001/archive.tar.gz", "w") as f:
        f.write("no log")
    with open(f"{root}/application_1485248649253_0001/container_1485248649253_0001_01_000050.log", "w") as f:
        f.write("\n")  # one empty line
    return root


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_listing_gives_what_lines_give_without_reading_them(spark, tmp_dir):
    root = _tree(tmp_dir)
    files, lines = list_logs(spark, root), read_log_lines(spark, root)
    strip = lambda df: {r.file_path.split(root)[-1] for r in df.collect()}
    assert strip(files) == strip(usage.files_of(lines))
    (counts,) = usage.basic_counts(lines).collect()
    assert tuple(usage.id_counts(files).first()) == (counts.applications, counts.containers)
    assert usage.tree_counts(files, lines).collect() == [counts]
    assert usage.app_containers(files, 5).collect() == usage.containers_per_app(lines, 5).collect()
    assert _rows(usage.cluster_starts(files)) == _rows(usage.cluster_start(lines))
    for df in (usage.id_counts(files), usage.app_containers(files), usage.cluster_starts(files), usage.app_sizes(files)):
        plan = _plan(df)
        assert "FileScan binaryFile" in plan and "FileScan text" not in plan and "content" not in plan
    assert "hashpartitioning(file_path" not in _plan(usage.tree_counts(files, lines))  # lines are not dealt by path


def test_sizes_and_inventory(spark, tmp_dir):
    root = _tree(tmp_dir)
    sizes = usage.app_sizes(list_logs(spark, root))
    want: dict[str, list[int]] = {}
    for folder, _, names in os.walk(root):
        app = os.path.basename(folder)
        for n in names:
            size = os.path.getsize(os.path.join(folder, n))
            if n.endswith(".log") and size and app.startswith("application_"):
                want.setdefault(app, []).append(size)
    got = {r.application_id: (r.files, r.bytes) for r in sizes.collect()}
    assert got == {a: (len(s), sum(s)) for a, s in want.items()}
    (row,) = usage.inventory(sizes).collect()
    each = [sum(s) for s in want.values()]
    assert (row.applications, row.files, row.min_app_bytes, row.max_app_bytes) == (
        len(want), sum(map(len, want.values())), min(each), max(each))
    assert row.files_per_app == row.files / len(want) and row.avg_app_bytes == sum(each) / len(each)


def test_other_clusters_are_not_listed(spark, tmp_dir):
    root = _tree(tmp_dir)
    files = list_logs(spark, root, cluster="1472621869829")
    assert "application_1472621869829" in _plan(files)
    assert [r.cluster_id for r in usage.cluster_starts(files).collect()] == ["1472621869829"]
    every = usage.app_containers(list_logs(spark, root), None).collect()
    below = [r for r in every if "_1472621869829_" in r.application_id and os.path.isdir(f"{root}/{r.application_id}")]
    assert below and usage.app_containers(files, None).collect() == below
    one = list_logs(spark, root, app="0001")
    assert {r.application_id[-4:] for r in usage.app_sizes(one).collect()} == {"0001"}


def test_inventory_job(spark, tmp_dir):
    root = _tree(tmp_dir)
    out = jobs.inventory_job(spark, root, tmp_dir + "/out")
    (row,) = read_csv(spark, out["id_counts"]).collect()
    counts = usage.id_counts(list_logs(spark, root)).first()
    assert (int(row.applications), int(row.containers)) == tuple(counts)
    assert json.loads(json.dumps(out)) == out
    assert len(read_csv(spark, out["app_sizes"]).collect()) == int(read_csv(spark, out["inventory"]).first().applications)
