"""Corpus pipeline: documents to token ids.

Each stage takes ``(spark, docs, sf_dir)`` and works on everything that the one before has
kept; what it returns is written as Parquet and read again. All stages but the last return
the columns of ``documents``. A null text is treated as empty and stays null until it is
encoded; the stages' other cases are those of the operators they call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logtide.llm import mixing, pii, sentencepiece_codec, simhash, toxicity
from logtide.llm.common import free_name, read_table, stored
from logtide.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold. The classifier learns from the labels outside
    the held-out fold."""
    model = toxicity.fit(docs, toxicity.training_labels(read_table(spark, sf_dir, "labels")))
    kept = {c: free_name(docs, f"_{c}") for c in docs.columns if c in ("score", "evidence")}  # clashing names
    judged = toxicity.score(docs.withColumnsRenamed(kept), "text", model)
    judged = judged.filter(F.col("score") < toxicity.TOXIC_FROM).drop("score", "evidence")
    return judged.withColumnsRenamed({v: k for k, v in kept.items()}).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: 4-word shingles, 4 differing bits at most."""
    return simhash.keep_first(docs, words=4, distance=4)


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers, plain or disguised, replaced by their kinds."""
    clean = pii.redact(docs, "text")
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it."""
    return mixing.mixed_copies(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens and ids of every document."""
    coded = sentencepiece_codec.encode_decode(docs.select("doc_id", "source", "lang", "text"), "text",
                                              vocabulary("piece_bpe_32k.model"), keep=["doc_id", "source", "lang"])
    return coded.select("doc_id", "source", "lang", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("toxicity", drop_toxic), ("near copies", drop_near_copies), ("pii", redact_pii),
          ("mixing", mix_sources), ("encoding", encode)]

#: The stages hash, learn and encode in ways that SQL doesn't express; tests compare them
#: with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
