"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint is 64 bits: bit i is set if it is set in over half of the XXH64 hashes (seed
42) of the text's word shingles, repeats included. Two fingerprints link at ``distance``
or fewer differing bits; documents form the connected components of these links.

Fingerprints are cut into ``blocks`` blocks. Two that differ in at most ``distance`` bits
differ in at most so many blocks, so they agree on ``blocks - distance`` of them at least:
for every choice of that many blocks, the fingerprints are grouped by the bits there, and
the Hamming distance is verified within each group. Copies are one fingerprint from the
start. A group of two is checked as it is counted. A larger group is dealt out in pairs of
chunks of at most about CHUNK fingerprints, so no group meets in one task, and from each
pair of chunks only its components are returned, a pair for each member, never all pairs.
Components come from alternating large-star and small-star rounds over stored tables.

Defined results: a null or wordless text has the fingerprint 0, linked like any other. A
text with fewer words than a shingle has one shingle, all its words; a very long text all
of its shingles. In :func:`components` a row without a doc_id gets its fingerprint, takes no part in linking
and has no component; :func:`keep_first` links it. Rows that share a doc_id keep their own
fingerprints; ties of ids go to the smallest. An empty table gives an empty table. Extra columns
are ignored by :func:`components` and kept by :func:`keep_first`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, stored

SEED = 42
BITS = 64

#: Fingerprints of a group that one task compares with each other or with as many others.
CHUNK = 2048


def fingerprint(text: str | None, words: int) -> int:
    """The fingerprint of one text, as an unsigned integer."""
    tokens = (text or "").encode().lower().split()  # bytes: ASCII letters and ASCII white space only
    if not tokens:
        return 0
    k = min(words, len(tokens))
    joined = b" ".join(tokens)
    ends = list(accumulate(len(t) + 1 for t in tokens))
    starts = [0, *ends]
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[s:e - 1], SEED) for s, e in zip(starts, ends[k - 1:])])
    n = len(hashes) // 8
    ones = np.zeros(BITS, np.int64)
    for part in range(0, n, 4096):  # 64 bytes for each hash of a part
        rows = np.frombuffer(hashes, np.uint8, count=8 * min(4096, n - part), offset=8 * part).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(text: Column, words: int) -> Column:
    """Fingerprint column, as a signed long of the same bits."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

    return of(text)


def block_masks(blocks: int, distance: int) -> list[int]:
    """For every choice of ``blocks - distance`` blocks, a mask of their bits (signed)."""
    if not 0 <= distance < blocks <= BITS:
        raise ValueError("more blocks are needed than bits may differ")
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:])]
    masks = (sum(c) for c in combinations(parts, blocks - distance))
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _near(f: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """The components of the links among the fingerprints ``f``, as pairs (first, other): of
    the first with each other one that links lead to."""
    left = np.arange(len(f))
    while len(left):
        root, left, front = left[0], left[1:], [left[0]]
        while front and len(left):
            hit = np.bitwise_count(f[left] ^ f[front.pop()]) <= distance
            if hit.any():
                found, left = left[hit], left[~hit]
                front.extend(found.tolist())
                for x in found.tolist():
                    yield root, x


def _link_runs(distance: int):
    """Batches sorted by (k, lo, hi) to edges; a run of equal keys is one pair of chunks."""

    def edges(run: np.ndarray) -> Iterator[tuple[int, int]]:
        f = np.unique(run)
        signed = f.view(np.int64)
        for a, b in _near(f, distance):
            yield int(signed[a]), int(signed[b])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)])
            fps = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(fps)]
            out: list[tuple[int, int]] = []
            for lo, hi in zip(cuts, cuts[1:]):
                now = tuple(keys[lo])
                if now != key:
                    if held:
                        out.extend(edges(np.concatenate(held)))
                    held, key = [], now
                held.append(fps[lo:hi])
            if out:
                yield _edge_batch(out)
        if held:
            yield _edge_batch(list(edges(np.concatenate(held))))

    return link


def _edge_batch(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    cols = np.array(rows, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(cols[:, 0]), pa.array(cols[:, 1])], names=["a", "b"])


def links(fps: DataFrame, distance: int, blocks: int) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fp`` whose components are those of all links."""
    masks = block_masks(blocks, distance)
    keyed = fps.select("fp", F.explode(F.array(*[
        F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m).cast("long"))) for i, m in enumerate(masks)])).alias("k"))
    groups = stored(keyed.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
                    .filter("n > 1"))
    twos = groups.filter("n = 2").filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).select("a", "b")
    chunks = F.ceil(F.col("n") / F.lit(CHUNK)).cast("int")
    dealt = (keyed.join(groups.filter("n > 2").select("k", chunks.alias("c")), "k")
             .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("c")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("c") - 1)))
             .select("k", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp"))
    runs = dealt.repartition("k", "lo", "hi").sortWithinPartitions("k", "lo", "hi")
    return twos.unionByName(runs.mapInArrow(_link_runs(distance), "a long, b long"))


def star_components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): a table (node, root), root the smallest node of
    the component, for every node that has an edge.

    Each round links every node's larger neighbours to the smallest node it sees, then its
    smaller ones; both steps keep the components, and at the fixed point every node points
    to its root. Minima are combined before they are shuffled and stored before they are
    joined, so a node with very many edges is an ordinary skewed join.
    """
    now = stored(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = None
    while True:
        both = now.select("a", "b").unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")))
        large = stored(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a")
        now = stored(small.select("a", F.col("m").alias("b"))
                     .unionByName(small.filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct())
        # hashes are summed as decimals: no overflow, and equal sums mean equal sets
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        state = seen


def _roots(rows: DataFrame, distance: int, blocks: int) -> DataFrame:
    """(fp, root) of every fingerprint of ``rows`` (fp, ...): equal roots are one component."""
    fps = rows.select("fp").distinct()
    roots = star_components(links(fps, distance, blocks))
    return fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def components(docs: DataFrame, words: int = 4, distance: int = 4, blocks: int = 7) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the smallest doc_id of the
    component) of every row of ``docs`` (doc_id, text)."""
    rows = stored(docs.select("doc_id", fingerprints(F.col("text"), words).alias("fp")))
    fps = rows.filter("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = star_components(links(fps.select("fp"), distance, blocks))
    placed = stored(fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                    .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    firsts = stored(placed.groupBy("root").agg(F.min("first").alias("component_id")))
    named = stored(placed.join(firsts, "root").select("fp", "component_id"))
    return (rows.join(named, "fp", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                    F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))


def keep_first(docs: DataFrame, words: int = 4, distance: int = 4, blocks: int = 7) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id's, rows without one last; of
    rows that share it the first by hash of the text. Every row is judged by its own text, so rows that
    share a doc_id but don't resemble each other all stay, and rows without a doc_id are linked as well."""
    missing, known, text, place = (free_name(docs, c) for c in ("_missing", "_known", "_text", "_place"))
    key = {missing: F.col("doc_id").isNull(), known: F.coalesce("doc_id", F.lit(0)),
           text: F.xxhash64(F.coalesce("text", F.lit("")))}
    rows = stored(docs.select(*[c.alias(n) for n, c in key.items()], fingerprints(F.col("text"), words).alias("fp")))
    firsts = rows.groupBy("fp").agg(F.min(F.struct(*key)).alias("first"))
    stay = stored(firsts.join(stored(_roots(rows, distance, blocks)), "fp")
                  .groupBy("root").agg(F.min("first").alias("first")).select("first.*"))
    # rows alike in doc_id and text are one; the window's filter leaves one a task before the shuffle
    one = Window.partitionBy(*key).orderBy(*[c for c in docs.columns if c not in ("doc_id", "text")])
    return (docs.withColumns(key).join(stay, list(key), "left_semi")
            .withColumn(place, F.row_number().over(one)).filter(F.col(place) == 1).select(*docs.columns))
