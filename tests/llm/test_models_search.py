from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from logtide.llm import quality_gam, topk_search, toxicity
from logtide.llm.queries import QUERIES

from . import cases

SF = "/root/testdata/sf0.01"


# --- exact search -------------------------------------------------------------

def plain_top(ids, vectors, asked, k):
    x = np.floor(256 * vectors).astype(object)
    out = []
    for i in asked:
        scores = [(-int(sum(a * b for a, b in zip(x[i], y))), j) for j, y in zip(ids, x) if j != ids[i]]
        out += [(ids[i], n + 1, j, -s) for n, (s, j) in enumerate(sorted(scores)[:k])]
    return out


@pytest.mark.parametrize("scale, blocks", [(1.0, (1024, 8192)), (0.01, (3, 17)), (1e5, (4, 40))])
def test_search_equals_all_pairs(spark, monkeypatch, scale, blocks):
    monkeypatch.setattr(topk_search, "QUERIES", blocks[0])
    monkeypatch.setattr(topk_search, "CANDIDATES", blocks[1])
    r = np.random.default_rng(10)
    x = r.normal(0, 0.1 * scale, (150, 40))
    x[50:80] = x[0]  # ties
    ids = list(range(150))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, x)], "vec_id long, v array<double>")
    got = topk_search.top_k(df, "vec_id", "v", F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == sorted(plain_top(ids, x, range(0, 150, 10), 5))


def test_search_with_odd_rows(spark):
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (1, None, 1), (2, [float("nan"), 1.0], 1), (3, [float("inf")], 1), (4, [], 1),
            (5, [1.0], 1), (None, [9.0, 9.0], 1), (6, [None, 1.0], 1), (50, [2.0, 1.0, 4.0], 1), (7, [1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>, id int")
    got = sorted(map(tuple, topk_search.top_k(df, "vec_id", "v", F.col("vec_id") % 50 == 0).collect()))
    s = 256 * 256
    assert got == [(0, 1, 50, 4 * s), (0, 2, 5, s), (0, 3, 7, s), (0, 4, 4, 0), (50, 1, 0, 4 * s), (50, 2, 5, 2 * s), (50, 3, 7, 2 * s),
                   (50, 4, 4, 0)]
    assert topk_search.top_k(df.limit(0), "vec_id", "v", F.col("vec_id") % 50 == 0).collect() == []
    assert topk_search.top_k(df.filter("vec_id = 0"), "vec_id", "v", F.lit(True)).collect() == []


# --- classifiers --------------------------------------------------------------

def held_out(spark, query, label):
    got = QUERIES[query](spark, SF).collect()
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.7) for r in got)
    return [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]


def test_quality_held_out(spark):
    found = held_out(spark, "op6_quality", "quality")
    assert np.mean([p == y for p, y in found]) >= 0.95


def test_toxicity_held_out(spark):
    found = held_out(spark, "op8_toxicity", "toxic")
    assert np.mean([p for p, y in found if not y]) <= 0.02 and np.mean([p for p, y in found if y]) >= 0.7


def test_folds_follow_the_checksum(spark):
    import zlib

    docs = cases.documents(spark)
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    for module, parts, part in ((quality_gam, 4, 2), (toxicity, 3, 1)):
        known = {r.doc_id for r in module.training_labels(labels).collect() if r.doc_id is not None}
        assert known == {i for i, _, _ in cases.texts() if i is not None and zlib.crc32(str(i).encode()) % parts != part}


def test_one_kind_of_label_gives_a_constant(spark):
    docs = cases.documents(spark)
    labels = docs.select("doc_id", F.lit(1).alias("label"))
    assert len({round(r.score, 9) for r in toxicity.score(docs, "text", toxicity.fit(docs, labels)).collect()}) == 1
    assert len({round(r.score, 9) for r in quality_gam.score(docs, "text", quality_gam.fit(docs, labels)).collect()}) == 1
    none = labels.limit(0)
    assert {r.score for r in toxicity.score(docs, "text", toxicity.fit(docs, none)).collect()} == {0.5}
    assert {r.score for r in quality_gam.score(docs, "text", quality_gam.fit(docs, none)).collect()} == {0.5}


def test_models_with_odd_rows(spark):
    docs = cases.documents(spark)
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("label"))
    for module in (toxicity, quality_gam):
        model = module.fit(docs, labels)
        got = module.score(docs, "text", model)
        assert got.columns.count("score") == 1 and got.count() == len(cases.texts())
        assert all(0 <= r.score <= 1 for r in got.collect())
        assert module.score(cases.nothing(spark), "text", model).collect() == []
        assert module.score(docs, "text", module.fit(cases.nothing(spark), labels)).count() == len(cases.texts())


def test_features_of_odd_texts():
    rows = quality_gam.feature_rows(["", " \n", "a", "A!! B!!", "x" * 10_000, "é日 1"])
    assert rows.shape == (6, len(quality_gam.FEATURES)) and np.isfinite(rows).all() and not rows[:2].any()


def test_additive_scores_are_sums_of_table_entries():
    """Scores row by row from the tables, without vectors."""
    r = np.random.default_rng(21)
    x = r.integers(0, 9, (500, 4)).astype(float)  # values on the cuts themselves, too
    y = (x[:, 0] + x[:, 1] * (x[:, 2] > 4) + r.random(500) > 6).astype(float)
    model = quality_gam.learn(x, y, rounds=20, pairs=2)
    assert len(model.pairs) == 2 and any(t.any() for t in model.pairs.values())
    for row, got in zip(x, model.score(x)):
        bins = [sum(v >= c for c in cuts) for v, cuts in zip(row, model.cuts)]
        total = model.constant + sum(t[b] for t, b in zip(model.tables, bins))
        total += sum(t[bins[j], bins[k]] for (j, k), t in model.pairs.items())
        assert got == pytest.approx(1 / (1 + math.exp(-total)))


def test_trees_equal_trying_all_cuts():
    r = np.random.default_rng(22)

    def gain(g, h):
        return g.sum() ** 2 / (h.sum() + 1)

    def value(g, h):
        return np.full(g.shape, g.sum() / (h.sum() + 1))

    for n in (1, 2, 3, 7, 12):
        g, h = r.normal(size=n), r.random(n)
        parts = [(0, n)]
        for _ in range(2):  # greedy: the cut of any leaf that gains most
            cuts = [(gain(g[a:c], h[a:c]) + gain(g[c:b], h[c:b]) - gain(g[a:b], h[a:b]), c) for a, b in parts for c in range(a + 1, b)]
            best = max(cuts, default=(0, 0))
            if best[0] > 1e-9:
                ends = sorted({0, n, best[1], *(e for p in parts for e in p)})
                parts = list(zip(ends, ends[1:]))
        assert quality_gam._tree(g, h) == pytest.approx(np.concatenate([value(g[a:b], h[a:b]) for a, b in parts]))
        m = n + 1
        g, h = r.normal(size=(n, m)), r.random((n, m))
        found, values = quality_gam._quarters(g, h)
        best, want = (0.0, np.zeros((n, m))) if n < 2 else (-math.inf, None)
        for i in range(1, n):
            for j in range(1, m):
                quarters = [(slice(a, b), slice(c, d)) for a, b in ((0, i), (i, n)) for c, d in ((0, j), (j, m))]
                here = sum(gain(g[q], h[q]) for q in quarters) - gain(g, h)
                if here > best:
                    best, want = here, np.empty((n, m))
                    for q in quarters:
                        want[q] = value(g[q], h[q])
        assert found == pytest.approx(best) and values == pytest.approx(want)


def test_additive_model_learns_a_pair():
    r = np.random.default_rng(11)
    x = r.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality_gam.learn(x[:3000], y[:3000], pairs=1)
    assert list(model.pairs) == [(0, 1)]
    assert ((model.score(x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    assert ((quality_gam.learn(x[:3000], y[:3000], pairs=0).score(x[3000:]) > 0.5) == y[3000:]).mean() < 0.7


def test_index_equals_all_cosines(monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK", 8)
    r = np.random.default_rng(12)
    vectors = []
    for _ in range(200):
        v = {int(t): float(r.integers(1, 4)) for t in r.choice(20, r.integers(1, 6), replace=False)}
        n = np.sqrt(sum(w * w for w in v.values()))
        vectors.append({t: w / n for t, w in v.items()})
    index = toxicity.Index(vectors)
    for q in vectors[:60]:
        every = [(round(sum(w * v.get(t, 0) for t, w in q.items()), 12), i) for i, v in enumerate(vectors)]
        want = sorted(((-s, i) for s, i in every if s > 0 and i != 3))[:7]
        got = index.nearest(q, 7, without=3)
        assert [i for _, i in got] == [i for _, i in want] and [-s for s, _ in got] == pytest.approx([s for s, _ in want])
    assert index.nearest({99: 1.0}, 5) == []


def test_index_orders_only_the_first_blocks(monkeypatch):
    """The k-th similarity comes from the blocks visited first, never from an order of all examples' scores."""
    monkeypatch.setattr(toxicity, "BLOCK", 4)
    monkeypatch.setattr(toxicity, "FIRST", 2)
    ordered, partition = [], np.partition
    monkeypatch.setattr(toxicity.np, "partition", lambda a, *x, **y: (ordered.append(a.shape), partition(a, *x, **y))[1])
    r = np.random.default_rng(5)
    vectors = []
    for _ in range(90):
        terms = r.choice(60, 6, replace=False)
        vectors.append({int(t): float(w) for t, w in zip(terms, r.integers(1, 3, 6) / 8)})  # many ties
    index = toxicity.Index(vectors)
    for k in (1, 5, 8, 9, 200):  # up to more than the first blocks hold
        ordered.clear()
        got = index.nearest_of([toxicity._vector(v) for v in vectors], k, without=list(range(len(vectors))))
        assert all(shape[-1] <= 8 for shape in ordered if len(shape) > 1)
        for i, v in enumerate(vectors):
            alike = [(sum(w * u.get(t, 0) for t, w in v.items()), j) for j, u in enumerate(vectors) if j != i]
            want = sorted((-round(x, 12), j) for x, j in alike if x > 0)[:k]
            assert [(-x, j) for x, j in got[i]] == want


@pytest.mark.parametrize("dense", [1, 16, 64, 10**9])
def test_index_leaves_blocks_unvisited(monkeypatch, dense):
    monkeypatch.setattr(toxicity, "BLOCK", 8)
    monkeypatch.setattr(toxicity, "FIRST", 2)
    monkeypatch.setattr(toxicity, "DENSE", dense)  # few terms, some or none in lists
    r = np.random.default_rng(13)
    vectors = []
    for i in range(400):  # eight kinds of examples, each with words of its own and some of all
        own = 100 * (i % 8) + r.choice(30, 8, replace=False)
        v = {int(t): float(w) for t, w in zip([*own, *(1000 + r.choice(10, 3, replace=False))], [*r.integers(2, 6, 8), 1, 1, 1])}
        n = np.sqrt(sum(w * w for w in v.values()))
        vectors.append({t: w / n for t, w in v.items()})
    vectors += [dict(vectors[5])] * 12  # ties
    index = toxicity.Index(vectors)
    got = index.nearest_of([toxicity._vector(v) for v in vectors], 7, without=list(range(len(vectors))))
    for i, (q, near) in enumerate(zip(vectors, got)):
        every = [(-round(sum(w * v.get(t, 0) for t, w in q.items()), 12), j) for j, v in enumerate(vectors) if j != i]
        assert [(j, pytest.approx(-s)) for s, j in sorted(e for e in every if e[0] < 0)[:7]] == [(j, s) for s, j in near]
    assert 0 < index.visited < index.possible
    if dense == 64:  # blocks are put together by the words of a kind
        assert index.visited < 0.6 * index.possible


def test_steps_rise_and_are_smoothed():
    steps, chances = toxicity.steps_of([0.1, 0.2, 0.2, 0.5, 0.6, 0.9], [0, 1, 0, 0, 1, 1])
    assert steps[0] == -1.0 and steps == sorted(steps) and chances == sorted(chances) and 0 < chances[0] and chances[-1] < 1


def test_toxicity_similarity_is_over_all_words(spark):
    import math
    from collections import Counter

    texts = [cases.sentence(700 + i, 12) + (" slur" if i in (3, 4) else "") for i in range(40)] + ["", "zzz Été 2x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 3 or i == 4)) for i in range(30)], "doc_id long, label int")
    bags = [Counter(toxicity.WORDS.findall(t.lower())) for t in texts]
    toxic = {i for i in range(30) if i % 5 == 3 or i == 4}
    df, n, p = Counter(), Counter(), Counter()
    for i, bag in enumerate(bags):
        df.update(bag.keys())
        n.update(bag.keys() if i < 30 else ())
        p.update(bag.keys() if i in toxic else ())

    def weight(w):
        if not n[w]:
            return math.log((1 + len(texts)) / 2) + 1
        a, b, c, d = p[w], n[w] - p[w], len(toxic) - p[w], 30 - len(toxic) - n[w] + p[w]
        want = [(a, n[w] * len(toxic) / 30), (b, n[w] * (1 - len(toxic) / 30)),
                (c, (30 - n[w]) * len(toxic) / 30), (d, (30 - n[w]) * (1 - len(toxic) / 30))]
        ratio = 2 * sum(have * math.log(have / of) for have, of in want if have)
        return (math.log((1 + len(texts)) / (1 + df[w])) + 1) * (1 + ratio / toxicity.EVIDENCE)

    unit = []
    for bag in bags:
        v = {w: (1 + math.log(c)) * weight(w) for w, c in bag.items()}
        unit.append({w: x / math.sqrt(sum(y * y for y in v.values())) for w, x in v.items()})
    got = {r.doc_id: r for r in toxicity.score(docs, "text", toxicity.fit(docs, labels)).collect()}
    for i, v in enumerate(unit):
        want = sorted(((-round(s, 9), j) for j in range(30) if (s := sum(x * unit[j].get(w, 0) for w, x in v.items())) > 0))
        want = want[:toxicity.K]
        assert [e.doc_id for e in got[i].evidence] == [j for _, j in want], i
        assert [e.similarity for e in got[i].evidence] == pytest.approx([-s for s, _ in want], abs=1e-8)
        assert got[i].evidence or i >= 30
    assert toxicity.words_of("Ünï_x2y ª²µ ß") == toxicity.WORDS.findall("ünï_x2y ª²µ ß")
