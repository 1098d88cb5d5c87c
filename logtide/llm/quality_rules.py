"""Quality rules: counting rules and a hashed n-gram log-likelihood ratio.

Words and pairs of neighbouring words are hashed into BUCKETS buckets; all pairs of a word
with itself are one gram, since stuttering is a trait of the text, whatever the word. Their counts over
the whole corpus and over the trusted target documents give two multinomials; the target's
is smoothed by ``PRIOR`` grams of the corpus's. A document's score is the mean over its
grams of ``log p_target - log p_corpus``, so it doesn't grow with the length, and every
document is kept or dropped by the same fixed threshold.

All of it is built-in functions. Repeated 8-word windows are found by hashes that double
their reach (1, 2, 4, 8 words), sorted within the document only where some window repeats.

Defined results: a null or wordless text has zero words, fails the base rules and is
dropped with a null score. Rows that share a doc_id are scored one by one. Without trusted
documents every score is 0, which keeps what the base rules keep. A score equal to the threshold
is kept. Very long texts are judged whole; an empty table gives an empty table. The results depend on
doc_id only to find the trusted documents; extra columns are ignored. Windows are compared
by 64-bit hashes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, WORD, stored

#: Hash buckets of the multinomials; the broadcast table has a row for each.
BUCKETS = 1 << 16
#: Bits of the filter of trusted ids: 1 MB.
FILTER_BITS = 1 << 23
#: Grams of the corpus that the target's counts are smoothed with.
PRIOR = 65536.0
#: The lowest mean log-likelihood ratio that is kept.
THRESHOLD = -0.12
WINDOW = 8

SYMBOLS = "#*$%&|<>"


def _neighbours(hashes: Column, step: int, gram=lambda a, b: F.xxhash64(a, b)) -> Column:
    """Hashes of each element with the one ``step`` places on."""
    n = F.size(hashes) - step
    return F.when(n > 0, F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(1 + step), n),
                                    gram)).otherwise(F.array().cast("array<bigint>"))


def _with_words(df: DataFrame) -> DataFrame:
    words = df.withColumn("_words", F.regexp_extract_all(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD), F.lit(0)))
    return words.withColumn("_h1", F.transform("_words", lambda w: F.xxhash64(w)))


def _buckets() -> Column:
    pairs = _neighbours(F.col("_h1"), 1, lambda a, b: F.when(a == b, F.lit(0).cast("long")).otherwise(F.xxhash64(a, b)))
    return F.transform(F.concat("_h1", pairs), lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))


def _repeat_words(df: DataFrame) -> DataFrame:
    """``n_repeat_words``: words in windows of 8 that are found twice or more in the text."""
    df = df.withColumn("_h2", _neighbours(F.col("_h1"), 1))
    df = df.withColumn("_h4", _neighbours(F.col("_h2"), 2))
    df = df.withColumn("_h8", _neighbours(F.col("_h4"), 4))
    df = df.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_h8")) < F.size("_h8"),
        F.sort_array(F.transform("_h8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    n = F.size("_sorted") - 1
    # places of windows that equal the one before or behind in the sorted order
    same = F.filter(F.zip_with(F.slice("_sorted", F.lit(1), n), F.slice("_sorted", F.lit(2), n),
                               lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))), lambda x: x.isNotNull())
    places = F.sort_array(F.array_distinct(F.flatten(same)))
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda s, p: F.struct((p + WINDOW).alias("end"), (s["n"] + p + WINDOW - F.greatest(s["end"], p)).alias("n")),
        lambda s: s["n"])
    return df.withColumn("n_repeat_words", F.when(F.col("_sorted").isNotNull(), covered).otherwise(F.lit(0)).cast("long"))


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, the counts of the base rules, base_failed and the buckets of the grams."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.rlike(x, F.lit(f"[^{SPACES}]")))
    df = docs.select("doc_id", "text").withColumn("_lines", lines)
    df = df.select(
        "doc_id", "text",
        F.length(F.regexp_replace(text, f"[{SPACES}]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"))
    df = _repeat_words(_with_words(df))
    return df.select("doc_id", F.size("_words").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
                     "n_repeat_words", _buckets().alias("_buckets")).withColumn(
        "base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def _maybe_in(doc_id: Column, ids: DataFrame) -> Column:
    """False only for ids that are not in ``ids`` (doc_id): a Bloom filter of FILTER_BITS bits, built by
    aggregation and held by every task as one array of longs. Its size is fixed; the more ids, the more others pass."""
    def places(c: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(c, F.lit(i)), F.lit(FILTER_BITS)) for i in range(3)]

    def bit(place: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))

    held = (ids.select(F.explode(F.array(*places(F.col("doc_id")))).alias("place"))
            .groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(bit(F.col("place"))).alias("bits")))
    every = ids.sparkSession.range(FILTER_BITS // 64).select(F.col("id").alias("word"))
    words = every.join(held, "word", "left").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")))),
        lambda w: w["bits"])).scalar()
    tests = [F.get(words, F.shiftright(p, 6).cast("int")).bitwiseAND(bit(p)) != 0 for p in places(doc_id)]
    return tests[0] & tests[1] & tests[2]


def bucket_scores(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """(bucket, llr) of every bucket that the corpus has. ``trusted`` (doc_id): documents of
    the target, all of which are counted. The corpus is counted without a join; only texts that pass a
    filter of the trusted ids are shuffled to meet these, in the same way at every size."""
    ids = stored(trusted.filter("doc_id is not null").select("doc_id").distinct())
    rows = docs.select("doc_id", "text")
    near = rows.filter(_maybe_in(F.col("doc_id"), ids)).join(ids.hint("merge"), "doc_id")

    def grams(texts: DataFrame, name: str) -> DataFrame:
        each = _with_words(texts).select(F.explode(_buckets()).alias("bucket"))
        return each.groupBy("bucket").agg(F.count(F.lit(1)).alias(name))

    counts = stored(grams(rows, "corpus").join(grams(near, "target"), "bucket", "left")
                    .select("bucket", "corpus", F.coalesce("target", F.lit(0).cast("long")).alias("target")))
    corpus, target = counts.agg(F.sum("corpus"), F.sum("target")).first()
    share = F.col("corpus") / F.lit(float(corpus or 1))
    smoothed = (F.col("target") + F.lit(PRIOR) * share) / F.lit((target or 0) + PRIOR)
    return counts.select("bucket", (F.log(smoothed) - F.log(share)).alias("llr"))


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the base counts, base_failed, the mean
    log-likelihood ratio ``score`` and ``kept``."""
    scores = bucket_scores(docs, trusted)
    counted = base_counts(docs).withColumn("_row", F.monotonically_increasing_id())
    keys = ["_row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    grams = counted.select(*keys, F.explode_outer("_buckets").alias("bucket"))
    # a row for each bucket at most
    scored = grams.join(F.broadcast(scores), "bucket", "left").groupBy(*keys).agg(F.avg("llr").alias("score"))
    return scored.drop("_row").withColumn("kept", ~F.col("base_failed") & (F.coalesce("score", F.lit(-math.inf)) >= threshold))
