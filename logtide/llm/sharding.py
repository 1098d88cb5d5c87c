"""Jump consistent hashing (Lamping and Veach, 2014): rows to shards without a ring table.

The published loop draws from a linear congruential generator seeded by the key and
jumps from bucket to bucket; the last one below the shard count is the shard. A larger
count only continues the same jumps, so rows move only into appended shards. The loop is
a fold over longs: the generator's 64-bit product is put together from 16- and 32-bit
parts, so no step overflows under ANSI arithmetic.

Defined results: a null key is the key 0; equal keys share a shard; an empty table gives
an empty table; text length plays no part. Extra columns are carried, and columns of the
input that have a result's name are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, stored

#: The generator of the published algorithm (fixed values).
MULTIPLIER = 2862933555777941757
MASK32 = 0xFFFFFFFF

#: Groups a shard's rows are numbered in. Slots are counted per group, so a shard of any
#: size is numbered by this many tasks; the table of group sizes has shards x GROUPS rows.
GROUPS = 1024


def _low_product(x: Column, y: int) -> Column:
    """x * y, right in its lowest 32 bits, for x and y below 2^32."""
    y = F.lit(y)
    return x.bitwiseAND(0xFFFF) * y + F.shiftleft((F.shiftright(x, 16) * y).bitwiseAND(0xFFFF), 16)


def _next_state(hi: Column, lo: Column) -> tuple[Column, Column]:
    """Key * MULTIPLIER + 1 modulo 2^64, as two halves."""
    m_hi, m_lo = MULTIPLIER >> 32, MULTIPLIER & MASK32
    upper = F.shiftright(lo, 16) * F.lit(m_lo)
    lower = lo.bitwiseAND(0xFFFF) * F.lit(m_lo) + F.shiftleft(upper.bitwiseAND(0xFFFF), 16) + F.lit(1)
    high = F.shiftright(lower, 32) + F.shiftright(upper, 16) + _low_product(lo, m_hi) + _low_product(hi, m_lo)
    return high.bitwiseAND(MASK32), lower.bitwiseAND(MASK32)


def jump_shards(key: Column, counts: Sequence[int]) -> Column:
    """A struct with one int field ``n<count>`` per shard count: the key's shard.

    ``key`` is a long (hash other keys first, e.g. with ``xxhash64``). The jumps for the
    largest count pass through those for the smaller ones, so all come from one fold of at
    most max(counts) steps.
    """
    if not counts or min(counts) < 1:
        raise ValueError("shard counts start at 1")
    most = max(counts)
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    hi, lo = _next_state(F.shiftrightunsigned(key, 32), key.bitwiseAND(MASK32))
    begin = F.struct(hi.alias("hi"), lo.alias("lo"), F.lit(0).cast("long").alias("j"),
                     *[F.lit(0).cast("long").alias(f"n{n}") for n in counts])

    def step(s: Column, _: Column) -> Column:
        j = s["j"]
        hi, lo = _next_state(s["hi"], s["lo"])
        draw = F.lit(2147483648.0) / (F.shiftright(s["hi"], 1) + F.lit(1)).cast("double")
        jumped = F.struct(hi.alias("hi"), lo.alias("lo"), F.floor((j + F.lit(1)).cast("double") * draw).alias("j"),
                          *[F.when(j < n, j).otherwise(s[f"n{n}"]).alias(f"n{n}") for n in counts])
        return F.when(j < most, jumped).otherwise(s)

    steps = F.array(*[F.lit(i) for i in range(most)]) if most <= 64 else F.sequence(F.lit(1), F.lit(most))
    return F.aggregate(steps, begin, step, lambda s: F.struct(*[s[f"n{n}"].cast("int").alias(f"n{n}") for n in counts]))


def assign_shards(df: DataFrame, key: str, shards: int, tie: Column | None = None) -> DataFrame:
    """``df`` with ``shard`` (of ``shards``), ``slot`` (the row's place in its shard, gapless
    from 0) and ``grown_shard`` (with one shard more).

    Rows of a shard are numbered in groups by the hash of the key and ``tie`` (a column
    that tells rows of one key apart), each sorted on its own; a group's first slot is the
    sum of the sizes before it. The numbered rows are stored before the groups are
    counted, so both see the same numbers. Carry narrow rows: they are written once.
    """
    g, i, first, n = (free_name(df, c) for c in ("_group", "_place", "_first", "_n"))
    tie = F.lit(0) if tie is None else tie
    jumps = free_name(df, "_jumps")
    placed = (df.withColumn(jumps, jump_shards(F.col(key), [shards, shards + 1]))
              .withColumn("shard", F.col(jumps)[f"n{shards}"]).withColumn("grown_shard", F.col(jumps)[f"n{shards + 1}"])
              .drop(jumps)
              .withColumn(g, F.pmod(F.xxhash64(F.col(key), tie), F.lit(GROUPS)).cast("int")))
    numbered = stored(placed.withColumn(i, F.row_number().over(Window.partitionBy("shard", g).orderBy(F.col(key), tie))))
    sizes = numbered.groupBy("shard", g).agg(F.count(F.lit(1)).alias(n))
    before = Window.partitionBy("shard").orderBy(g).rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("shard", g, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(first))
    # at most shards x GROUPS rows
    return (numbered.join(F.broadcast(firsts), ["shard", g])
            .withColumn("slot", (F.col(first) + F.col(i) - F.lit(1)).cast("long")).drop(g, i, first))


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Documents to shards by ``doc_id``: doc_id, size (UTF-8 bytes + 1), text_crc32, law,
    shard, slot, grown_shard. A null text has no bytes: size 1, the checksum of nothing."""
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text).cast("long") + F.lit(1)).alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"))
    out = assign_shards(narrow, "doc_id", shards, tie=F.col("text_crc32"))
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
