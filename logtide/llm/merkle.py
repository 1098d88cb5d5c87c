"""Merkle manifest of a dataset: digests by which any row proves that it belongs to it.

Every row is a leaf. The leaves of a group (a source, say) ascend by their order columns;
while several nodes remain, every FAN consecutive ones become their common digest, a last
run of fewer, even of one, as well. What remains is the group's subroot; the subroots,
ascending by group, give the root in the same way. A row's path holds, level by level, the
digests of the others of its run, before and after it; folding a leaf with its path gives
the root, if neither was touched.

LEVELS levels at a time are built by windows over blocks of FAN^LEVELS neighbours: a node is
held by the row of its first leaf, so at level j the siblings are the lag and lead columns of
the fixed offsets FAN^j, 2 FAN^j, ..., masked by the node's slot and the length of its run,
and the row of the first child hashes the parent. The blocks' digests are the leaves of the
next LEVELS levels. No window is larger than a block, so a source that holds most of the rows
is as many tasks as it has blocks; rows get their places by a range shuffle of digests
alone. Texts are read once and never shuffled.

Defined results: null fields are ``-``; a null group is a group of its own and comes first;
null order columns come first. Rows that share group and order columns ascend by digest, and
rows that are alike in these as well are equal leaves in adjacent places. A group of one row has
its leaf as subroot, a dataset of one group its subroot as root, an empty dataset no rows. Empty and
very long texts are hashed like others. Columns other than the named ones play no part
and may have any name; only ``keep`` is carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_fold, stored

#: Children of a node, and levels that are built by one shuffle.
FAN = 3
LEVELS = 6

#: Low bits of ``monotonically_increasing_id`` that number the rows of a partition.
_ROW_BITS = 33
PATH = "array<struct<before: string, after: string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, strings, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(c: Column) -> Column:
    """A value with its length in bytes in front, ``-`` for null: no two rows write the same."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return digest(*[field(c) for c in fields])


def fold(start: Column, path: Column) -> Column:
    """The root that a leaf's digest gives with a path."""
    return F.aggregate(path, start, lambda x, s: F.sha2(F.concat(s["before"], x, s["after"]).cast("binary"), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, left to right, level by level."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def _placed(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """``rows`` (_group, digest, ...) with _place (gapless from 0 in the group, by ``order``) and
    _n (the group's rows), and the largest _n.

    The rows are dealt by ranges of (group, order) and stored as they lie; a range's first place
    is the sum of the rows that its group has in the ranges before. The last sort key
    only parts rows that are alike, so that any number of them is dealt evenly.
    """
    low = F.lit((1 << _ROW_BITS) - 1)
    dealt = (rows.withColumn("_alike", F.monotonically_increasing_id())
             .repartitionByRange("_group", *order, "digest", "_alike").sortWithinPartitions("_group", *order, "digest", "_alike")
             .drop("_alike").withColumn("_id", F.monotonically_increasing_id()))
    lying = stored(dealt.withColumns({"_part": F.shiftright("_id", _ROW_BITS), "_at": F.col("_id").bitwiseAND(low)}).drop("_id"))
    runs = lying.groupBy("_group", "_part").agg(F.min("_at").alias("_low"), F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy("_group")
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # a row for each group and each range at most
    firsts = stored(runs.select("_group", "_part", "_low", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
                                F.sum("_rows").over(group).alias("_n")))
    placed = (lying.join(firsts, ["_group", "_part"])
              .withColumn("_place", F.col("_at") - F.col("_low") + F.col("_before")).drop("_part", "_at", "_low", "_before"))
    return placed, firsts.agg(F.max("_n").alias("n")).first().n or 0


def _climbed(nodes: DataFrame) -> DataFrame:
    """``nodes`` (_group, _place, _n, digest, ...) with _block, and the LEVELS steps above each
    node: _path (its ancestors' siblings) and _top (in a block's first row, the block's digest)."""
    block = FAN ** LEVELS
    near = Window.partitionBy("_group", "_block").orderBy("_place")
    out = nodes.withColumns({"_block": F.floor(F.col("_place") / block), "_h": F.col("digest")})
    steps = []
    for level in range(LEVELS):
        stride = FAN ** level
        at = F.floor(F.col("_place") / stride)  # the node's place in its level
        slot = at % FAN
        held = (F.col("_place") % stride == 0) & (F.col("_n") > stride)  # a node among several
        length = F.least(F.lit(FAN), F.ceil(F.col("_n") / stride) - (at - slot))  # of its run
        out = out.withColumns({f"_{side}{d}": move("_h", d * stride).over(near)
                               for d in range(1, FAN) for side, move in (("lag", F.lag), ("lead", F.lead))})
        before = [F.when(slot >= d, F.col(f"_lag{d}")).otherwise("") for d in range(FAN - 1, 0, -1)]
        after = [F.when(slot + d < length, F.col(f"_lead{d}")).otherwise("") for d in range(1, FAN)]
        steps.append(f"_step{level}")
        out = out.withColumn(steps[-1], F.when(held, F.struct(F.concat(*before).alias("before"), F.concat(*after).alias("after"))))
        parent = F.when(F.col("_n") > stride, digest(F.col("_h"), *after)).otherwise(F.col("_h"))
        out = (out.withColumn("_h", F.when(F.col("_place") % (stride * FAN) == 0, parent))
               .drop(*[f"_{side}{d}" for d in range(1, FAN) for side in ("lag", "lead")]))
    # a level's node is in its first leaf's row: the last one at or before a row is its own ancestor
    upto = near.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    path = F.filter(F.array(*[F.last(s, ignorenulls=True).over(upto) for s in steps]), lambda s: s.isNotNull())
    return out.withColumns({"_path": path, "_top": F.col("_h")}).drop("_h", *steps)


def _ascend(nodes: DataFrame, most: int) -> list[DataFrame]:
    """Tables of nodes, each the blocks of the one before; in the last, a row for each group."""
    tables = [nodes]
    while most > 1:
        tops = _climbed(tables[-1]).filter(F.col("_place") % (FAN ** LEVELS) == 0)
        tables.append(stored(tops.select("_group", F.col("_block").alias("_place"), F.ceil(F.col("_n") / FAN ** LEVELS).alias("_n"),
                                         F.col("_top").alias("digest"))))
        most = -(-most // FAN ** LEVELS)
    return tables


def _descend(tables: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The first table with the path of each node; ``tops`` (_group, _path, and columns to carry
    down) tells the paths of the last table's nodes."""
    carried = [c for c in tops.columns if c not in ("_group", "_path")]
    above = tables[-1].join(tops, "_group")
    for table in reversed(tables[:-1]):
        up = stored(above.select("_group", F.col("_place").alias("_block"), F.col("_path").alias("_up"), *carried))
        nodes = table.withColumn("_block", F.floor(F.col("_place") / FAN ** LEVELS)).join(up, ["_group", "_block"])
        above = _climbed(nodes).withColumn("_path", F.concat("_path", "_up")).drop("_up", "_block", "_top")
    return above


def manifest(rows: DataFrame, group: str, order: Sequence[str], leaf: str, keep: Sequence[str]) -> DataFrame:
    """``keep``, ``leaf``, ``place`` (in the group, from 0), ``subroot``, ``root`` and ``path``, an array of
    (before, after), for ``rows`` whose leaf digests are in the column ``leaf``.

    Carry narrow rows: they are shuffled once by range and twice by block, and stored.
    """
    names = [f"_keep{i}" for i in range(len(keep))]
    keys = [f"_order{i}" for i in range(len(order))]
    group_text = F.col(group).cast("string")
    narrow = stored(rows.select(F.coalesce(F.concat(F.lit("="), group_text), F.lit("")).alias("_group"),  # null: first
                                *[F.col(c).alias(k) for c, k in zip(order, keys)], F.col(leaf).alias("digest"),
                                *[F.col(c).alias(n) for c, n in zip(keep, names)]))
    nodes, most = _placed(narrow, keys)
    tables = _ascend(nodes, most)

    subroots = tables[-1].select(F.lit("").alias("_group"), F.col("_group").alias("_name"), "digest")
    groups, count = _placed(subroots, ["_name"])
    upper = _ascend(groups, count)
    root = upper[-1].select("_group", F.col("digest").alias("_root"), F.array().cast(PATH).alias("_path"))
    tops = stored(_descend(upper, root).select(F.col("_name").alias("_group"), "_path", "_root", F.col("digest").alias("_subroot")))
    whole = _descend(tables, tops)
    return whole.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], F.col("digest").alias("leaf"),
                        F.col("_place").alias("place"), F.col("_subroot").alias("subroot"), F.col("_root").alias("root"),
                        F.col("_path").alias("path"))


def tampered(text: Column, doc_id: Column) -> Column:
    """The text without its line feeds where 2 divides the crc32 of the id as text."""
    return F.when(in_fold(doc_id, 2, 0), F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def verified_documents(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root and proof_sha256 of every document, and what the tampered copy's
    leaf folds to: folded_root, verified. A null doc_id is the empty text where ids are drawn by hash."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = tampered(F.col("text"), F.col("doc_id"))
    rows = docs.select("doc_id", "source", leaf([*fields, F.col("text")]).alias("whole"),
                       leaf([*fields, changed]).alias("found"))
    listed = manifest(rows, "source", ["doc_id"], "whole", ["doc_id", "source", "found"])
    return (listed.withColumns({"proof_sha256": proof_digest(F.col("path")), "folded_root": fold(F.col("found"), F.col("path"))})
            .select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified"), "source", "place"))


#: The same rows in DuckDB.
ORACLE_SQL = r"""
    WITH RECURSIVE crc AS (
        SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1
                   THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS entries
    ), d AS (
        SELECT *, doc_id IS NULL OR (
                   SELECT list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
                       lambda c, b: xor(c // 256, entries[CAST(xor(c, b) % 256 AS INTEGER) + 1]), 4294967295) FROM crc) % 2 = 1 AS bared, coalesce('=' || source, '') AS s, concat(
                   coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-'),
                   coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
                   coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-')) AS front
        FROM documents
    ), l AS (
        SELECT doc_id, source, s, bared, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
               sha256(front || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) AS bare
        FROM d
    ), p AS (
        SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
               count(*) OVER (PARTITION BY s) AS n
        FROM l
    ), node AS (
        SELECT s, 0 AS level, place, n, leaf AS digest FROM p
        UNION ALL
        SELECT s, level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
        FROM node WHERE n > 1 GROUP BY s, level, place // 3, n
    ), sub AS (
        SELECT s, level AS height, digest AS subroot, row_number() OVER (ORDER BY s) - 1 AS ordinal, count(*) OVER () AS n_groups
        FROM node WHERE n = 1
    ), top AS (
        SELECT 0 AS level, ordinal AS place, n_groups AS n, subroot AS digest FROM sub
        UNION ALL
        SELECT level + 1, place // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
        FROM top WHERE n > 1 GROUP BY level, place // 3, n
    ), step AS (
        SELECT p.s, p.place AS leaf_place, a.level, coalesce(string_agg(b.digest, '' ORDER BY b.place)
                   FILTER (WHERE b.place < a.place), '') AS before,
               coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS after
        FROM p JOIN node a ON a.s = p.s AND a.n > 1 AND a.place = p.place // CAST(3 ** a.level AS BIGINT)
        JOIN node b ON b.s = a.s AND b.level = a.level AND b.place // 3 = a.place // 3
        GROUP BY p.s, p.place, a.level, a.place
        UNION ALL
        SELECT p.s, p.place, sub.height + a.level, coalesce(string_agg(b.digest, '' ORDER BY b.place)
                   FILTER (WHERE b.place < a.place), ''),
               coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '')
        FROM p JOIN sub ON sub.s = p.s JOIN top a ON a.n > 1 AND a.place = sub.ordinal // CAST(3 ** a.level AS BIGINT)
        JOIN top b ON b.level = a.level AND b.place // 3 = a.place // 3
        GROUP BY p.s, p.place, sub.height + a.level, a.place
    ), proof AS (
        SELECT s, leaf_place, sha256(string_agg(before || after, '' ORDER BY level)) AS proof_sha256 FROM step GROUP BY ALL
    ), folded AS (
        SELECT s, place, 0 AS level, CASE WHEN bared THEN bare ELSE leaf END AS x FROM p
        UNION ALL
        SELECT f.s, f.place, f.level + 1, sha256(step.before || f.x || step.after)
        FROM folded f JOIN step ON step.s = f.s AND step.leaf_place = f.place AND step.level = f.level
    ), last AS (
        SELECT s, place, arg_max(x, level) AS folded_root FROM folded GROUP BY ALL
    )
    SELECT p.doc_id, p.leaf, sub.subroot, root.digest AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
           folded_root = root.digest AS verified, p.source, p.place
    FROM p JOIN sub ON sub.s = p.s JOIN last ON last.s = p.s AND last.place = p.place LEFT JOIN proof ON proof.s = p.s AND proof.leaf_place = p.place
    CROSS JOIN (SELECT digest FROM top WHERE n = 1) root
"""
