from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from logtide.llm import quality_rules, simhash
from logtide.llm.queries import QUERIES

from . import cases


def plain_counts(text: str | None) -> tuple:
    w = cases.words(text)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = set()
    for i in range(len(w) - 7):
        if windows[tuple(w[i:i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if cases.WORD.search(x)]
    failed = len(w) < 20 or 100 * len(covered) > 30 * len(w)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed)


def rule_texts() -> list[str | None]:
    r = random.Random(4)
    out = [t for _, t, _ in cases.texts()]
    out += ["a " * n for n in (7, 8, 9, 25)] + ["a b " * 12, "x\n\nx\n x\nx\r\n", "\x0b\x0c|é日本 <b>"]
    out += [" ".join(r.choice("ab") for _ in range(r.randint(0, 60))) + r.choice(["", "\n", "\na\na"]) for _ in range(60)]
    return out


def test_base_counts_equal_the_plain_version(spark):
    texts = rule_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality_rules.base_counts(df).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == plain_counts(texts[r.doc_id]), texts[r.doc_id]


def test_score_is_the_mean_log_ratio(spark):
    rows = [(1, "a b c " * 20), (2, "a b d " * 20), (3, "z z z " * 20), (4, "q"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = spark.createDataFrame([(1,), (2,), (99,), (None,)], "doc_id long")

    def grams(text):
        w = cases.words(text)
        return [(x,) for x in w] + [("=",) if a == b else (a, b) for a, b in zip(w, w[1:])]

    corpus = Counter(g for _, t in rows for g in grams(t))
    target = Counter(g for i, t in rows if i < 3 for g in grams(t))
    prior, n, m = quality_rules.PRIOR, corpus.total(), target.total()
    for r in quality_rules.judge(df, trusted).collect():
        found = grams(dict(rows)[r.doc_id])
        if not found:
            assert r.score is None and not r.kept
            continue
        want = np.mean([np.log((target[g] + prior * corpus[g] / n) / (m + prior)) - np.log(corpus[g] / n) for g in found])
        assert r.score == pytest.approx(want, abs=1e-9)
        assert r.kept == (not r.base_failed and want >= quality_rules.THRESHOLD)


def test_all_trusted_documents_count(spark):
    n = 12_000
    docs = spark.range(n).selectExpr("id AS doc_id", "concat('w', id) AS text")
    got = quality_rules.bucket_scores(docs, docs.select("doc_id")).collect()
    assert max(abs(r.llr) for r in got) < 1e-9  # the target is the corpus


def test_rules_with_odd_rows(spark):
    docs = cases.documents(spark)
    got = quality_rules.judge(docs, docs.select("doc_id")).collect()
    assert len(got) == len(cases.texts())
    assert not any(r.kept for r in got if r.n_words < 20)
    assert all(r.kept for r in quality_rules.judge(docs, docs.select("doc_id").limit(0)).collect() if not r.base_failed)
    assert quality_rules.judge(cases.nothing(spark), docs.select("doc_id")).collect() == []


def test_rules_keep_the_good_and_drop_the_bad(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = QUERIES["op4_quality_rules"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").collect()
    good = [r for r in got if r.quality == 1 and not r.base_failed]
    bad = [r for r in got if r.quality == 0]
    assert np.mean([r.kept for r in good]) >= 0.99 and np.mean([r.kept for r in bad]) <= 0.05


def test_components_equal_all_pairs(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    prints = {r.doc_id: cases.simhash(r.text) for r in df.collect()}
    want = cases.simhash_components(sorted(prints.items()))
    for r in simhash.components(df).collect():
        assert (r.fingerprint, r.component_id) == (format(prints[r.doc_id], "016x"), want[r.doc_id])


def test_components_with_odd_rows(spark):
    docs = cases.documents(spark)
    rows = sorted({(i, cases.simhash(t)) for i, t, _ in cases.texts() if i is not None})
    want = cases.simhash_components(rows)
    got = simhash.components(docs).collect()
    assert len(got) == len(cases.texts())
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert r.component_id == want[r.doc_id] and r.fingerprint == format(dict(rows)[r.doc_id], "016x")
    assert simhash.components(cases.nothing(spark)).collect() == []
    assert simhash.keep_first(cases.nothing(spark)).collect() == []


def test_one_row_of_each_component_stays(spark):
    """Rows that share a doc_id and rows without one are judged by their own texts."""
    more = [(1, cases.sentence(901, 60), "a"), (1, cases.sentence(902, 60), "a"), (1, cases.sentence(903, 60), "b"),
            (2, cases.sentence(902, 60), "b"), (None, cases.sentence(904, 60), "a"), (None, cases.sentence(904, 60), "b"),
            (None, cases.sentence(901, 60), "b"), (3, cases.sentence(905, 60), "a"), (3, cases.sentence(905, 60), "a")]
    rows = cases.texts() + more
    docs = spark.createDataFrame([(i, t, s, 7) for i, t, s in rows], "doc_id long, text string, source string, _missing int")
    roots = cases.simhash_components([(n, cases.simhash(t)) for n, (_, t, _) in enumerate(rows)])
    kept = simhash.keep_first(docs)
    got = kept.collect()
    assert kept.columns == docs.columns
    place = {(i, t): n for n, (i, t, _) in enumerate(rows)}
    assert sorted(roots[place[r.doc_id, r.text]] for r in got) == sorted(set(roots.values()))  # one of each component
    for r in got:  # the one with the smallest id
        ids = [rows[n][0] for n, root in roots.items() if root == roots[place[r.doc_id, r.text]]]
        assert r.doc_id == min((i for i in ids if i is not None), default=None)
    assert sum(r.doc_id == 1 for r in got) == 4 and sum(r.doc_id is None for r in got) == 2


def test_dense_groups_are_linked_in_chunks(spark, monkeypatch):
    """Chains of close fingerprints around two centres, many more than a chunk holds."""
    monkeypatch.setattr(simhash, "CHUNK", 16)
    r = random.Random(5)
    near = [c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))) for c in (r.getrandbits(64), r.getrandbits(64))
            for _ in range(150)]
    prints = sorted(set(near + [r.getrandbits(64) for _ in range(200)]))
    signed = [f - (1 << 64) if f >> 63 else f for f in prints]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    edges = simhash.links(df, 4, 7)
    got = {x.node: x.root for x in simhash.star_components(edges).collect()}
    want = simhash_roots(prints)
    for f, s in zip(prints, signed):
        for g, t in zip(prints, signed):
            assert (want[f] == want[g]) == (got.get(s, s) == got.get(t, t))


def simhash_roots(prints: list[int]) -> dict[int, int]:
    found = cases.simhash_components(list(enumerate(prints)))
    return {f: found[i] for i, f in enumerate(prints)}


def test_masks_cover_every_choice_of_differing_bits():
    masks = [m % (1 << 64) for m in simhash.block_masks(7, 4)]
    r = random.Random(6)
    for _ in range(500):
        flips = sum(1 << b for b in r.sample(range(64), 4))
        assert any(not flips & m for m in masks)
    with pytest.raises(ValueError):
        simhash.block_masks(4, 4)


def test_star_components_of_a_path_a_star_and_a_cycle(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    got = {r.node: r.root for r in simhash.star_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}, 200: 200, 201: 200, 202: 200}
