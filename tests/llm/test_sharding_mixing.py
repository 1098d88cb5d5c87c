from __future__ import annotations

import zlib

import pytest
from pyspark.sql import functions as F

from logtide.llm import mixing, sharding
from logtide.llm.queries import QUERIES

from . import cases


def jump(key: int, n: int) -> int:
    key &= 2**64 - 1
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_jumps_equal_the_published_loop(spark):
    keys = [*range(-20, 200), 2**63 - 1, -2**63, 123456789012345678]
    counts = [1, 2, 7, 16, 17, 100]
    got = spark.createDataFrame([(k,) for k in keys], "k long").select(
        "k", sharding.jump_shards(F.col("k"), counts).alias("r")).select("k", "r.*").collect()
    for r in got:
        assert [r[f"n{n}"] for n in counts] == [jump(r.k, n) for n in counts]


def check_shards(docs, got, shards):
    assert len(got) == len(docs)
    for r in got:
        text = docs[r.doc_id] if r.doc_id in docs else None
        assert r.law == "key" and r.shard == jump(r.doc_id or 0, shards)
        assert r.grown_shard == jump(r.doc_id or 0, shards + 1) and r.grown_shard in (r.shard, shards)
        if r.doc_id is not None:
            assert (r["size"], r.text_crc32) == (len((text or "").encode()) + 1, zlib.crc32((text or "").encode()))
    for s in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))


def test_documents_with_odd_rows(spark):
    got = sharding.shard_documents(cases.documents(spark), 4).collect()
    docs = {i: t for i, t, _ in cases.texts()}
    assert len(got) == len(cases.texts())
    check_shards({**docs, **{("copy", n): None for n in range(len(got) - len(docs))}}, got, 4)
    assert sharding.shard_documents(cases.nothing(spark)).collect() == []


def test_extra_columns_are_carried_and_result_names_replaced(spark):
    df = spark.createDataFrame([(1, "a", 7, "old"), (2, "b", 8, "old"), (None, None, None, None)],
                               "doc_id long, _group string, _place int, shard string")
    got = sharding.assign_shards(df, "doc_id", 3).orderBy("doc_id").collect()
    assert [(r._group, r._place) for r in got] == [(None, None), ("a", 7), ("b", 8)]
    assert [r.shard for r in got] == [jump(0, 3), jump(1, 3), jump(2, 3)]


def test_rerun_agrees(spark):
    a, b = (sorted(map(tuple, QUERIES["op1_sharding"](spark, "/root/testdata/sf0.001").collect())) for _ in range(2))
    assert a == b


def test_mix_equals_the_plain_version(spark):
    rows = [r for r in {r[0]: r for r in cases.texts()}.values() if r[0] is not None]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = cases.plain_mix(rows)
    for r in mixing.mix_documents(df).collect():
        size, held, target, taken = want[r.doc_id]
        assert (r["size"], r.source_size, r.taken) == (size, held, taken) and r.target == pytest.approx(target, rel=1e-12)


def test_mix_of_a_whole_table_is_near_its_targets_and_repeats(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = cases.plain_mix([(r.doc_id, r.text, r.source) for r in df.collect()])
    got = mixing.mix_documents(df).collect()
    assert {r.doc_id: r.taken for r in got} == {i: w[3] for i, w in want.items()}
    assert all(r.taken <= 3 * r["size"] for r in got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, mixing.mix_documents(df).collect()))


def test_targets_stop_at_three_times_the_source(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 1), (None, 0)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got == {"a": pytest.approx(978.0), "b": 30.0, "c": 3.0, None: 0.0}


def test_mix_with_odd_rows(spark):
    got = mixing.mix_documents(cases.documents(spark)).collect()
    assert len(got) == len(cases.texts()) and all(0 <= r.taken <= 3 * r["size"] for r in got)
    assert {r["size"] for r in got if r.doc_id in (60, 61, 62)} == {0}
    assert mixing.mix_documents(cases.nothing(spark)).collect() == []
    docs = cases.documents(spark)
    copies = mixing.mixed_copies(docs)
    assert copies.columns == docs.columns and copies.filter("doc_id in (60, 61, 62)").count() == 0
    more = [(1, cases.sentence(1, 40), "a"), (1, cases.sentence(2, 9), "a"), (1, cases.sentence(2, 9), "b"), (None, "x y z", "a"),
            (None, "x y z", "a"), (None, "x y z", "a"), (None, "u v", "b"), (5, cases.sentence(3, 300), "b")]
    docs = docs.select("doc_id", "text", "source").unionByName(spark.createDataFrame(more, "doc_id long, text string, source string"))
    own = docs.select("doc_id", "text", "source", F.length("text").alias("_copies"))
    want: dict = {}
    narrow = own.select("doc_id", "source", "text", mixing.word_count(F.col("text")).alias("w"), mixing.quality_weight(F.col("text")).alias("q"))
    for r in mixing.mix(narrow, F.col("w"), F.col("q")).collect():
        want[r.doc_id, r.source, r.text] = want.get((r.doc_id, r.source, r.text), 0) + r.taken
    found: dict = {}
    for r in mixing.mixed_copies(own).collect():
        found[r.doc_id, r.source, r.text] = found.get((r.doc_id, r.source, r.text), 0) + len(cases.words(r.text))
    assert found == {k: v for k, v in want.items() if v}  # each row keeps its own decision
    blank = spark.createDataFrame([(1, None, "a"), (2, " ", "b")], "doc_id long, text string, source string")
    assert {(r.target, r.taken) for r in mixing.mix_documents(blank).collect()} == {(0.0, 0)}


def test_native_operators_run_no_python(spark):
    for q in ("op1_sharding", "op4_quality_rules", "op7_mixing"):
        plan = QUERIES[q](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
