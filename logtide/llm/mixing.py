"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every source gets a token target: sources by code point, null last, weigh 1, 2, 3,
repeating, and share the size of the whole corpus; a target stops at ``most`` times its
source's size and the excess is shared again by weight, which is the level at which
``sum(min(most * size, level * weight))`` is the corpus size. A source's complete epochs
take every document; for the rest, documents are sorted by exponential keys
``-ln(u) / quality`` (u: a hash of doc_id, so reruns agree), their sizes are summed in that
order and taken whole as long as they fit. The one place left at the boundary goes to the
untaken document whose size is nearest to what is missing, if that is nearer than none.

A source may hold any share of the rows: keys are cut into GROUPS ranges by their
distribution function, each (source, range) is sorted and summed on its own, and a range
starts at the sum of the ranges before it.

Defined results: a null text has size 0 and is taken 0 words; a null source is a source of
its own; a very long text counts with all its words; rows that share doc_id, source and text get equal keys and are taken in any order
(they are the same document); a null doc_id is the key of the empty string. A source
without words has the target 0. Extra columns are carried by :func:`mix`; result names that
the input has already are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, free_name, stored, word_count

#: Ranges a source's keys are cut into; a source's rows are sorted by this many tasks.
GROUPS = 512


def quality_weight(text: Column) -> Column:
    """Weight from 0.25 to 1 by the share of letters among the text's visible characters.
    Any positive column can take its place."""
    visible = F.length(F.regexp_replace(text, f"[{SPACES}]+", ""))
    letters = visible - F.length(F.regexp_replace(text, rf"[\p{{L}}{SPACES}]+", ""))
    return F.coalesce(F.lit(0.25) + F.lit(0.75) * letters / F.nullif(visible, F.lit(0)), F.lit(0.25))


def uniform(doc_id: Column) -> Column:
    """A number in (0, 1) from 48 bits of the id's hash."""
    bits = F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 12), 16, 10)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))


def source_targets(sizes: DataFrame, most: int = 3) -> DataFrame:
    """``sizes`` (source, source_size: one row per source) with ``target``.

    Sources in the order of ``most * size / weight`` reach their limits one after the other as the
    level rises; the level is what the uncapped ones share once the ones before are full.
    One row per source passes through one sort; rows of documents never do.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = (sizes.withColumn("weight", F.pmod(F.row_number().over(order) - 1, F.lit(3)) + 1)
              .withColumn("cap", F.col("source_size") * F.lit(most)))
    full = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = full.rowsBetween(Window.unboundedPreceding, -1), full.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(0))
    level = ((F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / F.sum("weight").over(after))
    # the first level that its own source doesn't cap is the level of all that follow
    leveled = ranked.withColumn("level", level).withColumn(
        "free", F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level")))
    return (leveled.withColumn("level", F.first("free", ignorenulls=True).over(full.rowsBetween(Window.unboundedPreceding, 0)))
            .select("source", "source_size", F.coalesce(
                F.least(F.col("level") * F.col("weight"), F.col("cap").cast("double")), F.col("cap").cast("double")).alias("target")))


def mix(docs: DataFrame, size: Column, quality: Column, most: int = 3) -> DataFrame:
    """The rows of ``docs`` (doc_id, source, ...) with size, source_size, target and taken.

    The rows are written once, so pass the columns that are needed afterwards only."""
    (key, g, n, start, fits, missing, off, last, s_source, s_range, m_source, m_range, m_place) = (
        free_name(docs, c) for c in ("_key", "_range", "_place", "_start", "_fits", "_missing", "_off", "_last",
                                     "_s_source", "_s_range", "_m_source", "_m_range", "_m_place"))
    kept = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    exponential = -F.log(uniform(F.col("doc_id")))
    rows = stored(docs.select(*kept, size.cast("long").alias("size"), (exponential / quality).alias(key))
                  # 1 - exp(-key) grows with the key and spreads the keys over (0, 1)
                  .withColumn(g, F.floor((F.lit(1.0) - F.exp(-F.col(key))) * F.lit(float(GROUPS))).cast("int")))
    ranges = stored(rows.groupBy("source", g).agg(F.sum("size").alias("size")))
    targets = source_targets(ranges.groupBy("source").agg(F.sum("size").alias("source_size")), most)
    targets = stored(targets.withColumnRenamed("source", s_source))

    earlier = Window.partitionBy("source").orderBy(g).rowsBetween(Window.unboundedPreceding, -1)
    starts = (ranges.select("source", F.col(g).alias(s_range), F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias(start))
              .join(targets, F.col("source").eqNullSafe(F.col(s_source))).drop("source"))
    within = Window.partitionBy("source", g).orderBy(key, "doc_id", "size")
    placed = (rows.withColumn(n, F.row_number().over(within))
              .withColumn(fits, F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)))
              .join(starts, F.col("source").eqNullSafe(F.col(s_source)) & (F.col(g) == F.col(s_range)))
              .drop(s_source, s_range))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    budget = F.col("target") - epochs * F.col("source_size")
    placed = stored(placed.withColumn(fits, F.col(start) + F.col(fits) <= budget)
                    .withColumn("taken", F.col("size") * (epochs + F.when(F.col(fits), F.lit(1)).otherwise(F.lit(0)))))

    # what each source misses, and the untaken document that comes nearest to it
    gaps = stored(placed.groupBy(F.col("source").alias(m_source)).agg((F.max("target") - F.sum("taken")).alias(missing)))
    near = (placed.filter(~F.col(fits) & (F.col("size") > 0)).join(gaps, F.col("source").eqNullSafe(F.col(m_source)))
            .withColumn(off, F.abs(F.col("size") - F.col(missing))).filter(F.col(off) < F.col(missing))
            .groupBy(m_source).agg(F.min(F.struct(off, g, n)).alias(last)))
    near = near.select(m_source, F.col(last)[g].alias(m_range), F.col(last)[n].alias(m_place))
    return (placed.join(near, F.col("source").eqNullSafe(F.col(m_source)) & (F.col(g) == F.col(m_range))
                        & (F.col(n) == F.col(m_place)), "left")
            .withColumn("taken", F.col("taken") + F.when(F.col(m_place).isNotNull(), F.col("size")).otherwise(F.lit(0)))
            .select(*kept, "size", "source_size", "target", "taken"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size (words), source_size, target and taken of every document."""
    narrow = docs.select("doc_id", "source", word_count(F.col("text")).alias("_words"),
                         quality_weight(F.col("text")).alias("_quality"))
    mixed = mix(narrow, F.col("_words"), F.col("_quality"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def mixed_copies(docs: DataFrame) -> DataFrame:
    """The mix as rows of ``docs``: each row as often as it is taken, the columns unchanged. Rows
    that share doc_id, source and text share what they are taken, as evenly as it goes."""
    missing, known, sourced, source, text, copies, place = (free_name(docs, c) for c in (
        "_missing", "_known", "_sourced", "_source", "_hash", "_copies", "_place"))
    key = {missing: F.col("doc_id").isNull(), known: F.coalesce("doc_id", F.lit(0)), sourced: F.col("source").isNotNull(),
           source: F.coalesce("source", F.lit("")), text: F.xxhash64(F.coalesce("text", F.lit("")))}
    narrow = docs.select("doc_id", "source", *[c.alias(n) for n, c in key.items()], word_count(F.col("text")).alias("_words"),
                         quality_weight(F.col("text")).alias("_quality"))
    taken = (mix(narrow, F.col("_words"), F.col("_quality")).filter("size > 0")
             .groupBy(*key).agg(F.sum(F.col("taken") / F.col("size")).cast("int").alias(copies), F.count(F.lit(1)).alias(place)))
    alike = Window.partitionBy(*key).orderBy(*[c for c in docs.columns if c not in ("doc_id", "source", "text")])
    own = F.floor(F.col(copies) / F.col(place)) + F.when(F.row_number().over(alike) <= F.col(copies) % F.col(place), 1).otherwise(0)
    rows = docs.withColumns(key).join(taken.filter(F.col(copies) > 0), list(key)).withColumn(copies, own.cast("int"))
    return (rows.filter(F.col(copies) > 0)
            .withColumn(place, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns))
