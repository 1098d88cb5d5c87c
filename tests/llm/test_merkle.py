"""The Merkle manifest against a plain tree."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from logtide.llm import merkle
from logtide.llm.queries import QUERIES

from . import cases

SF = "/root/testdata/sf0.001"


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(*values) -> str:
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(leaves: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and for each leaf its path of (before, after)."""
    paths: list[list[tuple[str, str]]] = [[] for _ in leaves]
    below = [[i] for i in range(len(leaves))]
    while len(leaves) > 1:
        up, held = [], []
        for i in range(0, len(leaves), 3):
            run = leaves[i:i + 3]
            for j in range(len(run)):
                for leaf in below[i + j]:
                    paths[leaf].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(sha(*run))
            held.append([x for b in below[i:i + 3] for x in b])
        leaves, below = up, held
    return leaves[0], paths


def plain_manifest(rows: list[tuple]) -> Counter:
    """Rows of the query for rows (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, plain_leaf(*r), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [plain_tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order]
    if not order:
        return Counter()
    root, tops = plain_tree([t[0] for t in trees])
    out = Counter()
    for s, (subroot, paths), top in zip(order, trees, tops):
        for (_, _, leaf, r), path in zip(sorted(groups[s], key=lambda x: x[:3]), paths):
            whole = path + top
            text = r[4]
            if text is not None and zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            x = plain_leaf(*r[:4], text)
            for before, after in whole:
                x = sha(before, x, after)
            out[r[0], leaf, subroot, root, sha(*[b + a for b, a in whole]), x, x == root] += 1
    return out


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def found(df) -> Counter:
    return Counter(tuple(r) for r in df.select(*COLUMNS).collect())


def of(docs) -> Counter:
    return plain_manifest([tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()])


def test_query_equals_the_plain_tree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = found(QUERIES["op11_merkle"](spark, SF))
    assert got == of(docs)
    assert {v[6] for v in got} == {True, False}  # some texts hold line feeds


@pytest.mark.parametrize("levels", [1, 2])
def test_odd_rows_and_many_passes(spark, monkeypatch, levels):
    monkeypatch.setattr(merkle, "LEVELS", levels)
    docs = cases.documents(spark)
    # a source that holds most rows, repeated rows in the same places, many sources of one row
    more = spark.range(100, 160).select(F.col("id").alias("doc_id"), F.lit("a\nb").alias("text"), F.lit(None).cast("string").alias("lang"),
                                        F.lit("s1").alias("source"), F.lit(3).cast("long").alias("n_chars"))
    lone = spark.range(200, 230).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("en").alias("lang"),
                                        F.concat(F.lit("é"), F.col("id")).alias("source"), F.lit(1).cast("long").alias("n_chars"))
    rows = docs.select(*more.columns).unionByName(more).unionByName(more.limit(5)).unionByName(lone)
    assert found(merkle.verified_documents(rows)) == of(rows)


def test_small_datasets(spark):
    assert found(merkle.verified_documents(cases.nothing(spark))) == Counter()
    one = cases.documents(spark).filter("doc_id = 80")
    assert found(merkle.verified_documents(one)) == of(one)
    (row,) = merkle.verified_documents(one).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == sha()


def test_paths_prove_rows_and_nothing_else(spark):
    rows = cases.documents(spark).select("doc_id", "source", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("digest"))
    listed = merkle.manifest(rows, "source", ["doc_id"], "digest", ["doc_id", "source"])
    assert listed.columns == ["doc_id", "source", "leaf", "place", "subroot", "root", "path"]
    other = listed.agg(F.max(F.struct("place", "leaf"))["leaf"]).first()[0]
    got = listed.select((merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).alias("own"), (F.col("leaf") == other).alias("same"),
                        (merkle.fold(F.lit(other), F.col("path")) == F.col("root")).alias("others")).collect()
    assert all(r.own for r in got) and all(r.others == r.same for r in got)
