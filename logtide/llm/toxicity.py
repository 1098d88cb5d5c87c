"""Toxicity by nearest labelled examples: the cosine of label-weighted TF-IDF vectors over all
words, searched exactly by a block-max inverted index.

Fitting, on a bounded sample of labelled documents (LABELLED):

* every word of the sample is a term, and every example with a word is indexed;
* document frequencies of the terms are counted over all documents;
* a term's idf is raised by how much the labels depend on it (likelihood ratio of presence
  against label, over EVIDENCE): under the plain idf a toxic word is lost among hundreds of
  harmless ones. No word is left out;
* the examples' unit vectors go into an inverted index in blocks with block maxima
  (:class:`Index`).

Scoring a document visits the blocks of examples whose bound reaches its K-th similarity, so
the K nearest are exact.
Their votes are weighted by similarity, and a monotone step function, fitted on the
sample with every example left out of its own neighbours, turns the vote into a
probability. The neighbours are returned as evidence.

Defined results: a word that no example has counts towards a document's length as a word of
one document. A document without a word of the examples (a null or empty text, too) has no
neighbours and gets the toxic share of wordless examples, smoothed by the share of all. Without
labelled documents of both kinds every score is the smoothed share of all. Very long texts
are scored whole, and an empty table gives an empty table. Ties of
similarity go to the smaller example id. Repeated texts are one example; repeated rows are
scored alike. Labels, languages, sources and ids are no inputs of a score; extra columns are
kept as asked, ``score`` and ``evidence`` replace columns of these names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_fold, labelled_sample, map_texts, text_slices

WORDS = re.compile(r"[^\W\d_]+")
#: Labelled documents that are learned from, neighbours.
LABELLED = 6000
K = 15
#: Examples of a block, blocks that a query visits first, documents scored together.
BLOCK = 64
FIRST = 8
BATCH = 128
#: Likelihood ratio that doubles a term's weight.
EVIDENCE = 4.0
#: Terms that one in so many examples has are rows of the dense matrix.
DENSE = 16
TOXIC_FROM = 0.7

#: Latin-1 with all but the characters of words blank.
_BLANKED = bytes(c if WORDS.match(chr(c)) else 32 for c in range(256))

Vector = tuple[np.ndarray, np.ndarray]  # terms and their weights


def words_of(text: str) -> list[str]:
    """What WORDS finds in the text in small letters; Latin-1 texts the fast way."""
    small = text.lower()
    try:
        return small.encode("latin-1").translate(_BLANKED).decode("latin-1").split()
    except UnicodeEncodeError:
        return WORDS.findall(small)


def _alike(common: np.ndarray, size: int) -> np.ndarray:
    """An order of the columns of ``common`` that puts similar ones into blocks of ``size``: halves by the
    strongest directions in turn. Which columns share a block affects no result, only how many are visited."""
    _, directions = np.linalg.eigh(common @ common.T) if len(common) else (None, np.zeros((0, 0)))
    places = directions[:, ::-1][:, :8].T @ common
    parts, depth = [np.arange(common.shape[1])], 0
    while len(places) and any(len(p) > size for p in parts):
        halves = []
        for p in parts:
            if len(p) > size:
                p = p[np.argsort(places[depth % len(places), p], kind="stable")]
                half = -(-len(p) // (2 * size)) * size
                halves += [p[:half], p[half:]]
            else:
                halves.append(p)
        parts, depth = halves, depth + 1
    return np.concatenate(parts)


class Index:
    """Unit vectors of examples, by term, in blocks of BLOCK similar examples.

    A term's posting list is cut where a block ends, and each part knows its largest weight. A query's
    weights times these bound its similarity to any example of a block. The blocks with the highest
    bounds are visited first, then those whose bound reaches the K-th similarity found; postings of
    other blocks are never read. Terms that many examples have are rows of a dense matrix, with a
    matrix of their block maxima.
    """

    def __init__(self, vectors: Iterable[dict[int, float] | Vector]):
        pairs = [_vector(v) for v in vectors]
        self.size = len(pairs)
        self.blocks = -(-self.size // BLOCK)
        #: Blocks that queries visited, and could have.
        self.visited = self.possible = 0
        terms = np.concatenate([t for t, _ in pairs] or [np.zeros(0, np.int32)]).astype(np.int64)
        weights = np.concatenate([w for _, w in pairs] or [np.zeros(0)])
        ids = np.repeat(np.arange(self.size), [len(t) for t, _ in pairs])
        counts = np.bincount(terms, minlength=1)
        common = np.flatnonzero(counts * DENSE >= max(self.size, 1))
        self.row = np.full(len(counts), -1, np.int32)
        self.row[common] = np.arange(len(common))
        held = self.row[terms] >= 0
        dense = np.zeros((len(common), self.size))
        dense[self.row[terms[held]], ids[held]] = weights[held]
        #: The example at each place, and the place of each example.
        self.order = _alike(dense, BLOCK)
        self.place = np.argsort(self.order)
        self.dense = np.zeros((len(common), self.blocks * BLOCK))
        self.dense[:, :self.size] = dense[:, self.order]
        self.dense_most = self.dense.reshape(len(common), self.blocks, BLOCK).max(axis=2) if self.size else self.dense
        # the other terms' postings, by term and place, and where a term's part in a block begins
        terms, at, weights = terms[~held], self.place[ids[~held]], weights[~held]
        by_term = np.lexsort((at, terms))
        terms, self.at, self.weights = terms[by_term], at[by_term], weights[by_term]
        first = np.flatnonzero(np.diff(terms * max(self.blocks, 1) + self.at // BLOCK, prepend=-1))
        self.part_block = self.at[first] // BLOCK
        self.part_most = np.maximum.reduceat(self.weights, first) if len(first) else np.zeros(0)
        self.part_begin = np.append(first, len(terms))
        self.starts = np.searchsorted(terms[first], np.arange(len(counts) + 1))

    def nearest_of(self, queries: list[Vector], k: int, without: list[int] | None = None) -> list[list[tuple[float, int]]]:
        """For each query the k (similarity, example) with the largest similarity over zero, ties to the smaller example."""
        found: list[list[tuple[float, int]]] = []
        if not self.size:
            return [[] for _ in queries]
        for begin in range(0, len(queries), BATCH):
            batch = queries[begin:begin + BATCH]
            n, most = len(batch), min(k, self.size)
            terms = np.concatenate([t for t, _ in batch])
            weights = np.concatenate([w for _, w in batch])
            of = np.repeat(np.arange(n), [len(t) for t, _ in batch])
            known = (terms >= 0) & (terms < len(self.row))
            terms, weights, of = terms[known], weights[known], of[known]
            rows = self.row[terms]
            common = np.zeros((n, len(self.dense)))
            common[of[rows >= 0], rows[rows >= 0]] = weights[rows >= 0]
            first, last = (self.starts[terms[rows < 0] + i] for i in (0, 1))
            parts = _ranges(first, last)
            sizes = last - first
            part_weight = np.repeat(weights[rows < 0], sizes)
            part_row = np.repeat(of[rows < 0], sizes)
            part_at = part_row * self.blocks + self.part_block[parts]  # query and block
            bounds = common @ self.dense_most + np.bincount(
                part_at, self.part_most[parts] * part_weight, minlength=n * self.blocks).reshape(n, self.blocks)

            scores = np.zeros((n, self.blocks * BLOCK))
            visited = np.zeros(bounds.shape, bool)
            first_blocks = min(FIRST, self.blocks)
            highest = np.argpartition(bounds, self.blocks - first_blocks, axis=1)[:, self.blocks - first_blocks:]
            which = np.zeros(bounds.shape, bool)
            np.put_along_axis(which, highest, True, axis=1)
            which &= bounds > 0
            for again in (False, True):  # the highest bounds, then all that reach the k-th similarity among these
                for block in np.flatnonzero(which.any(axis=0)).tolist():
                    some = np.flatnonzero(which[:, block])
                    columns = slice(block * BLOCK, (block + 1) * BLOCK)
                    scores[some, columns] = common[some] @ self.dense[:, columns]
                keep = np.flatnonzero(which.ravel().take(part_at))
                lists = parts.take(keep)
                begin_at = self.part_begin.take(lists)
                sizes = self.part_begin.take(lists + 1) - begin_at
                # places in the flat scores, and weights
                postings = np.repeat(begin_at - (np.cumsum(sizes) - sizes), sizes)
                postings += np.arange(len(postings))
                place = np.repeat(part_row.take(keep) * scores.shape[1], sizes)
                place += self.at.take(postings)
                weight = np.repeat(part_weight.take(keep), sizes)
                weight *= self.weights.take(postings)
                scores += np.bincount(place, weight, minlength=scores.size).reshape(scores.shape)
                if without is not None:
                    left = without[begin:begin + n]
                    scores[np.arange(len(left)), self.place[left]] = 0
                visited |= which
                if not again:
                    seen = np.take_along_axis(scores.reshape(n, self.blocks, BLOCK), highest[:, :, None], axis=1).reshape(n, -1)
                    least = (np.partition(seen, seen.shape[1] - most, axis=1)[:, seen.shape[1] - most]
                             if most <= seen.shape[1] else np.zeros(n))
                    which = ~visited & (bounds > 0) & (bounds >= least[:, None] - 1e-9)
            self.visited += int(visited.sum())
            self.possible += visited.size
            for row, lowest in zip(scores, least):
                hits = np.flatnonzero(row >= max(lowest - 1e-11, 1e-12))  # the k nearest are among these
                reached = row[hits]
                if len(hits) > most:
                    some = reached >= np.partition(reached, len(hits) - most)[len(hits) - most] - 1e-11
                    hits, reached = hits[some], reached[some]
                best = sorted(zip((-np.round(reached, 12)).tolist(), self.order[hits].tolist()))[:k]
                found.append([(-s, i) for s, i in best])
        return found

    def nearest(self, query: dict[int, float], k: int, without: int = -1) -> list[tuple[float, int]]:
        return self.nearest_of([_vector(query)], k, [without] if without >= 0 else None)[0]


def _ranges(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """begin, ..., end - 1 of each range, one after the other."""
    sizes = end - begin
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(begin - before, sizes)


def _vector(v: dict[int, float] | Vector) -> Vector:
    return v if isinstance(v, tuple) else (np.array(list(v), np.int32), np.array(list(v.values()), np.float64))


@dataclass
class Model:
    #: The number of each term; its weight, and at the end that of a word no example has.
    number: dict[str, int]
    weights: np.ndarray
    ids: list[int] = field(default_factory=list)
    toxic: list[int] = field(default_factory=list)
    index: Index | None = None
    #: Vote from which a probability holds, rising, and that of documents without neighbours.
    steps: list[float] = field(default_factory=list)
    chances: list[float] = field(default_factory=list)
    alone: float = 0.5

    def vector(self, text: str) -> Vector:
        """The unit vector of a text; words that no example has are term -1."""
        counts = Counter(words_of(text))
        terms = np.fromiter(map(self.number.get, counts, repeat(-1)), np.int32, len(counts))
        order = np.argsort(terms, kind="stable")
        often = np.fromiter(counts.values(), np.float64, len(counts))
        weights = ((1 + np.log(often)) * self.weights[terms])[order]
        return terms[order], weights / max(math.sqrt(weights @ weights), 1e-300)

    def vote(self, near: list[tuple[float, int]]) -> float:
        """Weighted share of toxic neighbours, held back by one vote against."""
        return sum(s * self.toxic[i] for s, i in near) / (1 + sum(s for s, _ in near))

    def judge(self, texts: list[str]) -> list[tuple[float, list[tuple[float, int]]]]:
        if self.index is None:
            return [(self.alone, [])] * len(texts)
        found = []
        for begin in range(0, len(texts), BATCH):
            vectors = [self.vector(t) for t in texts[begin:begin + BATCH]]
            found += [(self.chance(near), near) for near in self.index.nearest_of(vectors, K)]
        return found

    def chance(self, near: list[tuple[float, int]]) -> float:
        if not near:
            return self.alone
        return self.chances[int(np.searchsorted(self.steps, self.vote(near), side="right")) - 1]


def steps_of(votes: list[float], labels: list[int]) -> tuple[list[float], list[float]]:
    """Pooled adjacent violators: rising steps, each with its smoothed share of positives."""
    pools: list[list[float]] = []  # first vote, positives, all
    for vote, label in sorted(zip(votes, labels)):
        if pools and pools[-1][0] == vote:
            pools[-1][1] += label
            pools[-1][2] += 1
        else:
            pools.append([vote, label, 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            _, p, n = pools.pop()
            pools[-1][1] += p
            pools[-1][2] += n
    chances = np.maximum.accumulate([(p + 1) / (n + 2) for _, p, n in pools]).tolist()
    return [-1.0, *[v for v, _, _ in pools[1:]]], chances


def _dependence(p: np.ndarray, n: np.ndarray, positives: int, total: int) -> np.ndarray:
    """Likelihood ratio of presence against label for terms that ``p`` of the ``positives``
    and ``n`` of all ``total`` examples have."""
    def part(have, of):  # have * log(have / expected), 0 for none
        return np.where(have > 0, have * np.log(np.maximum(have, 1) / np.where(have > 0, of, 1)), 0.0)

    share, q, m = positives / total, positives - p, total - n
    ratio = part(p, n * share) + part(n - p, n * (1 - share)) + part(q, m * share) + part(m - q, m * (1 - share))
    return np.maximum(2 * ratio, 0.0)


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Model:
    """``docs`` (doc_id, text); ``labels`` (doc_id, label: 1 for toxic)."""
    spark = docs.sparkSession
    sample = labelled_sample(docs, labels, labelled)
    total, positives = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < positives < total:
        return Model({}, np.zeros(1), alone=(positives + 1) / (total + 2))

    def words(texts: list[str]) -> list[pa.Array]:
        return [pa.array([sorted(set(words_of(t))) for t in texts], pa.list_(pa.string()))]

    seen = (map_texts(sample, "text", ["label"], "terms array<string>", words)
            .select("label", F.explode("terms").alias("term"))
            .groupBy("term").agg(F.sum("label").alias("p"), F.count(F.lit(1)).alias("n")).toArrow().sort_by("term"))
    names = seen.column("term").to_pylist()  # the words of the sample
    number = {t: i for i, t in enumerate(names)}
    shipped = spark.sparkContext.broadcast(number)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = frozenset(shipped.value)
        found: Counter = Counter()
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for part in text_slices(batch, "text"):
                for text in part.column("text").to_pylist():
                    if text:
                        found.update(terms.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array([-1, *(shipped.value[t] for t in found)], pa.int32()),
                                          pa.array([rows, *found.values()], pa.int64())], names=["term", "n"])

    counted = (docs.select("text").mapInArrow(frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
               .toArrow())  # a row for each word of the sample at most, and one
    df = np.ones(len(names) + 1)
    df[counted.column("term").to_numpy()] = counted.column("n").to_numpy()
    rows, df[-1] = df[-1], 1  # the last is the number of documents; for a word no example has, one
    raised = 1 + _dependence(seen.column("p").to_numpy().astype(float), seen.column("n").to_numpy().astype(float),
                             positives, total) / EVIDENCE
    model = Model(number, (np.log((1 + rows) / (1 + df)) + 1) * np.append(raised, 1.0))

    examples = sample.orderBy("doc_id", "text").toLocalIterator()  # the sample: LABELLED at most
    unit, bare = [], []
    for r in examples:
        vector = model.vector(r.text)
        if len(vector[0]):
            unit.append(vector)
            model.ids.append(r.doc_id)
            model.toxic.append(r.label)
        else:
            bare.append(r.label)
    model.alone = (sum(bare) + 2 * positives / total) / (len(bare) + 2)
    if unit:
        model.index = Index(unit)
        near = model.index.nearest_of(unit, K, without=list(range(len(unit))))
        model.steps, model.chances = steps_of([model.vote(x) for x in near], model.toxic)
    return model


_EVIDENCE = pa.list_(pa.struct([("doc_id", pa.int64()), ("similarity", pa.float64()), ("label", pa.int32())]))


def score(df: DataFrame, column: str, model: Model, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default), ``score`` and ``evidence``, the nearest examples."""
    shipped = df.sparkSession.sparkContext.broadcast(model)  # bounded by LABELLED texts

    def judged(texts: list[str]) -> list[pa.Array]:
        m = shipped.value
        found = m.judge(texts)
        return [pa.array([s for s, _ in found], pa.float64()),
                pa.array([[{"doc_id": m.ids[i], "similarity": s, "label": m.toxic[i]} for s, i in near]
                          for _, near in found], _EVIDENCE)]

    return map_texts(df, column, df.columns if keep is None else keep,
                     "score double, evidence array<struct<doc_id: bigint, similarity: double, label: int>>", judged)


def training_labels(labels: DataFrame) -> DataFrame:
    """Toxicity labels outside the held-out fold."""
    return labels.filter(~in_fold(F.col("doc_id"), 3, 1)).select("doc_id", F.col("toxic").alias("label"))


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and the evidence of every document."""
    judged = score(docs.select("doc_id", "text"), "text", fit(docs, training_labels(labels)), keep=["doc_id"])
    return judged.select("doc_id", in_fold(F.col("doc_id"), 3, 1).alias("held_out"), "score",
                         (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "evidence")
