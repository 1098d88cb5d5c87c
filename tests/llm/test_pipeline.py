"""The pipeline against plain versions of its stages, each on the stage's own input."""

from __future__ import annotations

import math
import re
from collections import Counter

import corpus_pipeline
import pytest
import sentencepiece
from logtide.llm import pii, toxicity
from logtide.llm.common import stored
from logtide.llm.queries import vocabulary

from . import cases

SF = "/root/testdata/sf0.001"


def plain_scores(docs: list, labels: list) -> dict[str, float]:
    """Text -> score by plain TF-IDF: documents (doc_id, text) and labels (doc_id, label), all few
    enough to be learned from; weights, cosines, votes and steps are computed here."""
    def words(text):
        return re.findall(r"[^\W\d_]+", (text or "").lower())

    label = {i: max(x for j, x in labels if j == i) for i in {j for j, _ in labels}}
    known = {}
    for i, text in sorted(docs):
        if i in label:
            first, toxic = known.get(text or "", (i, 0))
            known[text or ""] = first, max(toxic, label[i])
    held = {t: set(words(t)) for t in {t or "" for _, t in docs}}
    frequency = Counter(w for _, t in docs for w in held[t or ""])
    n, p = len(known), sum(x for _, x in known.values())
    having = Counter((w, x) for t, (_, x) in known.items() for w in held[t])
    raised = {}
    for w in {w for w, _ in having}:
        table = [(having[w, 1], p), (having[w, 0], n - p), (p - having[w, 1], p), (n - p - having[w, 0], n - p)]
        with_word = having[w, 1] + having[w, 0]
        expected = [with_word * p / n, with_word * (n - p) / n, (n - with_word) * p / n, (n - with_word) * (n - p) / n]
        ratio = 2 * sum(o * math.log(o / e) for (o, _), e in zip(table, expected) if o)
        raised[w] = 1 + max(ratio, 0.0) / toxicity.EVIDENCE

    def vector(text):
        idf = {w: (math.log((1 + len(docs)) / (1 + (frequency[w] if w in raised else 1))) + 1) * raised.get(w, 1.0) for w in set(words(text))}
        tf = {w: (1 + math.log(c)) * idf[w] for w, c in Counter(words(text)).items()}
        length = math.sqrt(sum(v * v for v in tf.values()))
        return {w: v / length for w, v in tf.items()}

    examples = [(vector(t), x) for t, (_, x) in sorted(known.items(), key=lambda e: e[1][0]) if held[t]]
    bare = [x for t, (_, x) in known.items() if not held[t]]
    alone = (sum(bare) + 2 * p / n) / (len(bare) + 2)

    def vote(v, without=-1):
        near = sorted((-round(sum(x * e.get(w, 0.0) for w, x in v.items()), 12), j) for j, (e, _) in enumerate(examples) if j != without)
        near = [(-c, examples[j][1]) for c, j in near[:toxicity.K] if c < 0]
        return sum(c * x for c, x in near) / (1 + sum(c for c, _ in near)), bool(near)

    steps, chances = toxicity.steps_of([vote(e, j)[0] for j, (e, _) in enumerate(examples)], [x for _, x in examples])
    out = {}
    for text in held:
        share, any_near = vote(vector(text)) if held[text] else (0.0, False)
        # a hair's breadth, as sums are taken in another order
        out[text] = chances[max(i for i, s in enumerate(steps) if s <= share + 1e-9)] if any_near else alone
    return out


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_each_stage_equals_its_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "near copies", "pii", "mixing", "encoding"]

    before = docs.collect()
    labels = [tuple(r) for r in toxicity.training_labels(spark.read.parquet(f"{SF}/labels.parquet")).collect()]
    scores = plain_scores([(r.doc_id, r.text) for r in before], labels)
    for r in toxicity.judge_documents(docs, spark.read.parquet(f"{SF}/labels.parquet")).join(docs, "doc_id").collect():
        assert r.score == pytest.approx(scores[r.text or ""], abs=1e-9)
    clean = stored(stages["toxicity"](spark, docs, SF))
    assert clean.columns == columns
    assert rows_of(clean) == sorted(tuple(r) for r in before if scores[r.text or ""] < toxicity.TOXIC_FROM)

    before = clean.collect()
    roots = cases.simhash_components(sorted((r.doc_id, cases.simhash(r.text)) for r in before))
    single = stored(stages["near copies"](spark, clean, SF))
    assert rows_of(single) == sorted(tuple(r) for r in before if roots[r.doc_id] == r.doc_id)

    before = single.collect()
    safe = stored(stages["pii"](spark, single, SF))
    want = [(r.doc_id, pii.redacted(r.text), r.lang, r.source, len(pii.redacted(r.text))) for r in before]
    assert safe.columns == columns and rows_of(safe.select("doc_id", "text", "lang", "source", "n_chars")) == sorted(want)

    before = safe.collect()
    taken = cases.plain_mix([(r.doc_id, r.text, r.source) for r in before])
    mixed = stored(stages["mixing"](spark, safe, SF))
    assert mixed.columns == columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(
        {i: t[3] // t[0] for i, t in taken.items() if t[0] and t[3]})

    sp = sentencepiece.SentencePieceProcessor(model_proto=vocabulary("piece_bpe_32k.model"))
    want = sorted((r.doc_id, r.source, r.lang, len(sp.encode(r.text)), sp.encode(r.text)) for r in mixed.collect())
    assert rows_of(stages["encoding"](spark, mixed, SF)) == want
    assert rows_of(corpus_pipeline.run(spark, SF)) == want


@pytest.mark.parametrize("which", ["odd", "empty"])
def test_stages_with_odd_rows(spark, which):
    docs = stored(cases.documents(spark) if which == "odd" else cases.nothing(spark))
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF))
        if name != "encoding":
            assert out.columns == docs.columns
        if which == "empty":
            assert out.count() == 0
        docs = out
    assert which == "empty" or docs.count() > 0
