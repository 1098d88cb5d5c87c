"""Quality classifier: a generalised additive model with pairwise interactions.

Each text has a row of features (FEATURES). The model is a constant, a lookup table for each
feature and one for each of a few pairs of features, all over the same bins: the score is
the logistic function of the sum of the table entries, so it is scored by adding what the
bins hold and read by looking at the tables.

Tables are learned by cyclic boosting: round after round, feature after feature, a tree of
at most three leaves over the feature's bins is fitted to the current gradients and a small
part of it is added to the feature's table. Then the pairs whose residuals a cut in both
features explains best are chosen and their tables are boosted alike by trees of four
leaves. All of it happens on a bounded sample of labelled rows (LABELLED).

Defined results: a null or empty text has features of zero and the score that these get; a
very long text is scored whole.
Without labels of both kinds every score is the smoothed share of good ones. Rows are
independent, an empty table stays empty. Labels, languages, sources and ids are no inputs of
a score; extra columns are kept as asked, a column named ``score`` is replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations, islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_fold, labelled_sample, map_texts

#: Labelled documents that are learned from, bins of a feature, rounds, part of a tree that
#: is added, pairs of features.
LABELLED = 8000
BINS = 32
ROUNDS = 200
RATE = 0.1
PAIRS = 6
GOOD_FROM = 0.7

FEATURES = ("log words", "mean word length", "log longest word", "distinct words", "commonest word", "repeated word",
            "upper case", "digits", "exclamation", "symbols", "stops and commas", "other punctuation", "lines", "repeated lines")

_UPPER, _DIGITS = slice(65, 91), slice(48, 58)
_LOWER = slice(97, 123)
_SYMBOLS = [ord(c) for c in "#*$%&|<>"]
_MARKS = [ord(c) for c in "!?"]
_STOPS = [ord(c) for c in ".,"]
_BLANKS = [9, 10, 11, 12, 13, 32]


def features(text: str) -> list[float]:
    """The row of a text. Characters are counted as bytes, words cut at ASCII white space."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    visible = int(counts.sum() - counts[_BLANKS].sum())
    each = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    upper, lower, digits = (int(counts[s].sum()) for s in (_UPPER, _LOWER, _DIGITS))
    symbols, marks, stops = (int(counts[s].sum()) for s in (_SYMBOLS, _MARKS, _STOPS))
    other = visible - upper - lower - digits - symbols - marks - stops - int(counts[128:].sum())
    return [np.log1p(n), visible / n, np.log1p(max(map(len, words))), len(each) / n, max(each.values()) / n,
            sum(map(eq, words, islice(words, 1, None))) / n, upper / visible, digits / visible, marks / visible,
            symbols / visible, stops / visible, other / visible, len(lines) / n, 1 - len(set(lines)) / len(lines)]


def feature_rows(texts: Sequence[str]) -> np.ndarray:
    return np.array([features(t) for t in texts], np.float64).reshape(-1, len(FEATURES))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


@dataclass
class Additive:
    """Cuts, tables and pair tables; without tables a constant."""

    constant: float
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, rows: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, rows[:, j], side="right") for j, c in enumerate(self.cuts)])

    def raw(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.constant)
        for j, table in enumerate(self.tables):
            out += table[bins[:, j]]
        for (j, k), table in self.pairs.items():
            out += table[bins[:, j], bins[:, k]]
        return out

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not self.tables:
            return np.full(len(rows), _logistic(np.float64(self.constant)))
        return _logistic(self.raw(self.bins(rows)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + 1.0)


def _tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values of a tree of at most three leaves over ordered bins with gradient and curvature sums."""
    ends = [0, len(g)]
    for _ in range(2):
        best = (1e-9, None)
        for a, b in zip(ends, ends[1:]):
            if b - a < 2:
                continue
            cg, ch = np.cumsum(g[a:b]), np.cumsum(h[a:b])
            gains = _gain(cg[:-1], ch[:-1]) + _gain(cg[-1] - cg[:-1], ch[-1] - ch[:-1]) - _gain(cg[-1], ch[-1])
            i = int(np.argmax(gains))
            best = max(best, (float(gains[i]), a + i + 1), key=lambda x: x[0])
        if best[1] is None:
            break
        ends = sorted([*ends, best[1]])
    return np.concatenate([np.full(b - a, g[a:b].sum() / (h[a:b].sum() + 1.0)) for a, b in zip(ends, ends[1:])])


def _quarters(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain and values of the best cut of a grid of bins into four parts."""
    cg, ch = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def parts(c):
        whole, upper, left, corner = c[-1, -1], c[:-1, -1:], c[-1:, :-1], c[:-1, :-1]
        return corner, upper - corner, left - corner, whole - upper - left + corner

    if min(g.shape) < 2:
        return 0.0, np.zeros_like(g)
    gains = sum(_gain(x, y) for x, y in zip(parts(cg), parts(ch))) - _gain(cg[-1, -1], ch[-1, -1])
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    values = np.empty_like(g)
    for rows in (slice(0, i + 1), slice(i + 1, None)):
        for cols in (slice(0, j + 1), slice(j + 1, None)):
            values[rows, cols] = g[rows, cols].sum() / (h[rows, cols].sum() + 1.0)
    return float(gains[i, j]), values


def learn(rows: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS) -> Additive:
    """Boost the tables on features and 0/1 labels."""
    good, n = float(labels.sum()), len(labels)
    constant = float(np.log((good + 1) / (n - good + 1)))
    if good in (0, n):
        return Additive(constant)
    model = Additive(constant)
    for j in range(rows.shape[1]):
        model.cuts.append(np.unique(np.quantile(rows[:, j], np.linspace(0, 1, BINS + 1)[1:-1])))
        model.tables.append(np.zeros(len(model.cuts[-1]) + 1))
    bins = model.bins(rows)
    raw = model.raw(bins)
    for _ in range(rounds):
        for j, table in enumerate(model.tables):
            p = _logistic(raw)
            g, h = (np.bincount(bins[:, j], w, len(table)) for w in (labels - p, p * (1 - p)))
            step = RATE * _tree(g, h)
            table += step
            raw += step[bins[:, j]]

    def grid(j: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        p = _logistic(raw)
        a, b = len(model.tables[j]), len(model.tables[k])
        place = bins[:, j] * b + bins[:, k]
        return tuple(np.bincount(place, w, a * b).reshape(a, b) for w in (labels - p, p * (1 - p)))

    ranked = sorted(combinations(range(rows.shape[1]), 2), key=lambda jk: -_quarters(*grid(*jk))[0])
    model.pairs = {jk: np.zeros((len(model.tables[jk[0]]), len(model.tables[jk[1]]))) for jk in ranked[:pairs]}
    for _ in range(rounds // 2):
        for (j, k), table in model.pairs.items():
            step = RATE * _quarters(*grid(j, k))[1]
            table += step
            raw += step[bins[:, j], bins[:, k]]
    return model


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Additive:
    """``docs`` (doc_id, text); ``labels`` (doc_id, label: 1 for good). The sample's features,
    LABELLED rows at most, come to the driver."""
    sample = map_texts(labelled_sample(docs, labels, labelled), "text", ["doc_id", "label"], "features array<double>",
                       lambda texts: [pa.array(feature_rows(texts).tolist(), pa.list_(pa.float64()))]).collect()
    sample.sort(key=lambda r: r.doc_id)
    return learn(np.array([r.features for r in sample], np.float64).reshape(-1, len(FEATURES)),
                 np.array([r.label for r in sample], np.float64))


def score(df: DataFrame, column: str, model: Additive, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) and ``score``, the probability of a good text."""
    shipped = df.sparkSession.sparkContext.broadcast(model)  # tables of BINS entries
    return map_texts(df, column, df.columns if keep is None else keep, "score double",
                     lambda texts: [pa.array(shipped.value.score(feature_rows(texts)))])


def training_labels(labels: DataFrame) -> DataFrame:
    """Quality labels outside the held-out fold."""
    return labels.filter(~in_fold(F.col("doc_id"), 4, 2)).select("doc_id", F.col("quality").alias("label"))


def judge_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    judged = score(docs.select("doc_id", "text"), "text", fit(docs, training_labels(labels)), keep=["doc_id"])
    return judged.select("doc_id", in_fold(F.col("doc_id"), 4, 2).alias("held_out"), "score",
                         (F.col("score") >= GOOD_FROM).cast("int").alias("predicted"))
