"""Exact top-k search by columnar branch and bound.

Vectors are rounded down to integers (``floor(scale * x)``) and compared by inner product.
Queries and candidates are dealt into blocks of bounded size by the hash of their ids; every
pair of blocks is one group, in which candidates lie column by column. For each query the
products are added up a few columns at a time. What the remaining columns can still add is
at most the product of the remaining lengths of both vectors, so after each step the k-th
best lower bound is known, and the candidates whose upper bound is below it are left out of
the columns to come. The best of each group meet per query at the end.

Columns with the most mass come first. Bounds get a margin over rounding, sums are exact
integers, so the result is exact, ties to the smaller id included.

Defined results: vectors that are null or hold a null or non-finite component take no part,
nor do rows without an id. Rows that share an id are one vector, the smallest of them.
Shorter vectors count as padded with zeros. A query has fewer than k rows if there are fewer
others; an empty table gives an empty table. Extra columns are ignored. Sums beyond a long
fail.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Vectors of a block, and columns added at a time.
QUERIES = 1024
CANDIDATES = 8192
COLUMNS = 16
#: Largest integer component whose products are summed as doubles without loss.
PLAIN = 1 << 20


def _matrix(column: pa.ChunkedArray, width: int, scale: int) -> np.ndarray:
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((len(sizes), width))
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def best(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query, candidate, score) of the k best candidates with another id for each query."""
    if not len(q) or not len(c) or not c.shape[1]:
        zero = [(int(a), int(b), 0) for a in q_ids for b in sorted(x for x in c_ids.tolist() if x != a)[:k]]
        return zero
    if max(np.abs(q).max(), np.abs(c).max()) > PLAIN or c.shape[1] > 8192:
        whole = [[int(x) for x in row] for row in c]
        out = []
        for a, row in zip(q_ids.tolist(), q):
            mine = [int(x) for x in row]
            ranked = sorted((-sum(x * y for x, y in zip(mine, other)), b) for b, other in zip(c_ids.tolist(), whole) if b != a)
            out += [(a, b, -s) for s, b in ranked[:k]]
        return out
    order = np.argsort(-np.square(c).sum(axis=0), kind="stable")
    q, columns = q[:, order], np.ascontiguousarray(c[:, order].T)
    steps = range(0, len(columns), COLUMNS)

    def lengths(squares: np.ndarray) -> list[np.ndarray]:  # of what is left after each step
        return [np.sqrt(squares[s + COLUMNS:].sum(axis=0)) for s in steps]

    q_left, c_left = lengths(np.square(q.T)), lengths(np.square(columns))
    out = []
    for i, a in enumerate(q_ids.tolist()):
        alive = np.flatnonzero(c_ids != a)
        sums = np.zeros(len(alive))
        everyone = len(alive) == len(c_ids)
        for n, s in enumerate(steps):
            block = columns[s:s + COLUMNS]
            sums += q[i, s:s + COLUMNS] @ (block if everyone else block[:, alive])
            if len(alive) <= k or s + COLUMNS >= len(columns):
                continue
            reach = q_left[n][i] * c_left[n][alive] * (1 + 1e-9) + 1e-6
            floor = np.partition(sums - reach, len(alive) - k)[len(alive) - k]
            stay = sums + reach >= floor
            if not stay.all():
                alive, sums, everyone = alive[stay], sums[stay], False
        for j in np.lexsort((c_ids[alive], -sums))[:k]:
            out.append((a, int(c_ids[alive[j]]), int(sums[j])))
    return out


def top_k(df: DataFrame, id_column: str, vector: str, queries: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows to every row where ``queries`` holds."""
    finite = F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = stored(df.filter(F.col(id_column).isNotNull() & finite).select(F.col(id_column).cast("long").alias("id"), F.col(vector).alias("v"), queries.alias("q"))
                  .groupBy("id").agg(F.min("v").alias("v"), F.max("q").alias("q")))
    n, asked, width = rows.agg(F.count(F.lit(1)), F.count_if("q"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    q_blocks, c_blocks = -(-asked // QUERIES) or 1, -(-n // CANDIDATES) or 1
    asks = rows.filter("q").select("id", "v", F.pmod(F.xxhash64("id"), F.lit(q_blocks)).cast("int").alias("qb"),
                                   F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("cb"))
    offers = rows.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(c_blocks)).cast("int").alias("cb"),
                         F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("qb"))

    def group(a: pa.Table, b: pa.Table) -> pa.Table:
        found = best(a["id"].to_numpy(), _matrix(a["v"], width, scale), b["id"].to_numpy(), _matrix(b["v"], width, scale), k) \
            if a.num_rows and b.num_rows else []
        cols = list(zip(*found)) or [(), (), ()]
        return pa.table({name: pa.array(x, pa.int64()) for name, x in zip(("query_id", "vec_id", "score"), cols)})

    found = asks.groupBy("qb", "cb").cogroup(offers.groupBy("qb", "cb")).applyInArrow(group, "query_id long, vec_id long, score long")
    ranked = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", ranked).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
