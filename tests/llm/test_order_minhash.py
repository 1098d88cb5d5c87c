"""Order MinHash against a plain version."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from logtide.llm import order_minhash
from logtide.llm.queries import QUERIES

from . import cases

SF = "/root/testdata/sf0.001"
AROUND = (1 << 36) - 1


def spark_hash(values) -> int:
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else v.to_bytes(8, "little"), seed)
    return seed


def plain_sketches(text: str | None) -> list[int]:
    """By numbering occurrences in the order of the text, and a full sort for every sketch."""
    units = re.findall(r"[^ \t\n\x0b\f\r]{1,6}[ \t\n\x0b\f\r]*|[ \t\n\x0b\f\r]+", text or "")
    kmers = [spark_hash(units[i:i + 2]) & AROUND for i in range(max(0, len(units) - 2) + 1)] if units else []
    seen: Counter = Counter()
    items = []
    for place, k in enumerate(kmers):
        items.append((k ^ (seen[k] * order_minhash._STEP & AROUND), place))
        seen[k] += 1
    out = []
    for j in range(64 if items else 0):
        point = j * (1 << 36) // 64
        least = sorted(items, key=lambda x: ((x[0] - point) & AROUND, x[1]))[:2]
        out.append(spark_hash([kmers[p] << 27 for p in sorted(p for _, p in least)]) & 0xFFFF)
    return out or [0] * 64


def plain_rows(rows: list[tuple]) -> Counter:
    """Rows of the query for rows (doc_id, text), which ascend by doc_id."""
    out = Counter()
    texts = [t or "" for _, t in rows]
    for n, (i, _) in enumerate(rows):
        text, following = texts[n], texts[(n + 1) % len(rows)]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        prints = [plain_sketches(t) for t in (text, edited, following)]
        share = [sum(x == y for x, y in zip(prints[0], p)) / 64 for p in prints]
        text_of = ["".join(f"{s:04x}" for s in p) for p in prints]
        out[i, len(text), hashlib.sha256(edited.encode()).hexdigest(), *text_of[:2], share[1], share[2]] += 1
    return out


def test_query_equals_the_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain_rows([(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()])
    assert Counter(tuple(r) for r in QUERIES["op13_order_minhash"](spark, SF).collect()) == want


def test_odd_rows(spark):
    docs = cases.documents(spark).select("doc_id", "text")
    more = ["x" * 5000, "ab " * 900, "日本語のテキスト" * 40, "naïve 😀 text", " ", "one", "\n\n one two"]
    docs = docs.unionByName(spark.createDataFrame(list(enumerate(more, 900)), "doc_id long, text string"))
    rows = [tuple(r) for r in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    got = order_minhash.fingerprint_documents(docs)
    assert Counter(tuple(r) for r in got.collect()) == plain_rows([r[:2] for r in rows])
    assert order_minhash.fingerprint_documents(cases.nothing(spark)).count() == 0


@pytest.mark.parametrize("n", [1, 2])
def test_few_documents(spark, n):
    rows = [(i, cases.sentence(i, 20 + i)) for i in range(n)]
    got = order_minhash.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(tuple(r) for r in got.collect()) == plain_rows(rows)


def test_carried_columns_and_order(spark):
    words = cases.sentence(7, 400).split()
    texts = {"same": " ".join(words) + " ", "turned": " ".join(words[200:] + words[:200]) + " ",
             "edited": " ".join(["other" if i % 100 == 50 else w for i, w in enumerate(words)]) + " ", "else": cases.sentence(8, 400)}
    df = spark.createDataFrame([(k, t, 1) for k, t in texts.items()], "name string, text string, _items int")
    out = order_minhash.order_minhash(df, "text", "sketches")
    assert out.columns == ["name", "text", "_items", "sketches"]
    got = {r["name"]: r.sketches for r in out.collect()}
    share = {k: sum(x == y for x, y in zip(got["same"], s)) / 64 for k, s in got.items()}
    assert share["same"] == 1 and share["else"] == 0
    # all units are the same after the turn, but pairs across it change places
    assert 0.2 < share["turned"] < 0.8 < share["edited"] < 1
