"""Multi-line entries numbered per split, checked against plain Python on one stream."""

from __future__ import annotations

import os
import random
import re

import pytest

from logtide.functions import patterns as P
from logtide.operators import entries
from logtide.sources.logs import compact_logs, read_compacted, read_log_lines

from .conftest import write_tree


def _python_entries(tree):
    """(file name, line) -> (entry rank within file, head ts text, head level).

    Text before a file's first timestamp is an entry of its own, without head.
    """
    out = {}
    for rel, lines in tree.items():
        seen, head, ids = 0, (None, None), []
        for ln in lines:
            m = re.match(P.TIMESTAMP, ln)
            if m:
                seen += 1
                lv = re.search(P.LEVEL_WORD, ln)
                head = (m.group(1), lv.group(1) if lv else "")
            ids.append((seen, head))
        rank = {v: i for i, v in enumerate(sorted({i for i, _ in ids}))}
        for n, (i, h) in enumerate(ids):
            out[(rel, n)] = (rank[i], h)
    return out


@pytest.fixture()
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes",
            "spark.sql.execution.arrow.maxRecordsPerBatch")
    old = {k: spark.conf.get(k) for k in keys}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    # several Arrow batches per split: the numbering must carry across them
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _tree():
    rng = random.Random(5)
    tree = {}
    for f in range(3):
        lines = []
        if f == 1:
            lines += ["leading text before any timestamp", "more of it"]
        for e in range(60):
            lv = rng.choice(["INFO", "WARN", "ERROR"])
            lines.append(f"17/03/{1 + f:02d} 10:{e // 60:02d}:{e % 60:02d} {lv} c.X: entry {e}")
            for t in range(rng.choice([0, 0, 1, 3, 12])):
                lines.append(f"\tat frame{t}(F.java:{e})")
        tree[f"application_1_000{f}/container_1_000{f}_01_000001.log"] = lines
    return tree


@pytest.mark.parametrize("compacted", [False, True])
def test_entries_match_sequential_numbering(spark, tmp_dir, small_splits, compacted):
    tree = _tree()
    root = write_tree(os.path.join(tmp_dir, "logs"), tree)
    lines = entries.with_split_position(read_log_lines(spark, root))
    assert lines.rdd.getNumPartitions() > 6  # files really are split
    if compacted:
        compact_logs(spark, [root], f"{tmp_dir}/compact")
        got = entries.number_entries(read_compacted(spark, f"{tmp_dir}/compact"), pos="pos").collect()
    else:
        got = entries.number_entries(lines).collect()
    assert len(got) == sum(len(v) for v in tree.values())

    by_file = {}
    for r in got:
        name = r.file_path.split(root.rstrip("/") + "/")[-1]
        by_file.setdefault(name, []).append(r)
    want = _python_entries(tree)
    for name, rows in by_file.items():
        rows.sort(key=lambda r: (r.block, r.seq))
        assert [r.log_entry for r in rows] == tree[name]
        # entry keys are ordered like the entries, one key per entry
        keys = [(r.entry_block, r.entry_k) for r in rows]
        ranks = {k: i for i, k in enumerate(sorted(set(keys)))}
        for i, r in enumerate(rows):
            idx, head = want[(name, i)]
            assert ranks[(r.entry_block, r.entry_k)] == idx, (name, i)
            assert (r.entry_ts_text, r.entry_level) == head, (name, i)
            assert r.continuation == (re.match(P.TIMESTAMP, r.log_entry) is None)


def test_entry_summary_counts_lines(spark, tmp_dir, small_splits):
    tree = _tree()
    root = write_tree(os.path.join(tmp_dir, "logs"), tree)
    lines = entries.with_split_position(read_log_lines(spark, root))
    summ = entries.entry_summary(entries.number_entries(lines)).collect()
    n_entries = sum(sum(1 for ln in v if re.match(P.TIMESTAMP, ln)) for v in tree.values()) + 1
    assert len(summ) == n_entries
    assert sum(r.lines for r in summ) == sum(len(v) for v in tree.values())
    assert sorted(map(tuple, entries.split_entries(lines).collect()), key=repr) == sorted(map(tuple, summ), key=repr)
    errors = [r for r in summ if r.entry_level == "ERROR"]
    assert all(r.first_line.split(" ")[2] == "ERROR" for r in errors)
    plan = entries.entry_summary(entries.number_entries(lines))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_lines_without_positions_are_refused(spark):
    df = spark.createDataFrame([("f", 0, "x")], "file_path string, block long, log_entry string")
    with pytest.raises(ValueError):
        entries.number_entries(df)
