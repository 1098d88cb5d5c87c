"""Multi-line log entries: a line without a leading timestamp continues the entry above.

A large file is read as several splits, and one file may hold a large share of all lines,
so no file is gathered into one task. A line carries its split (``block``) and a position that
grows along it (``pos``); lines are brought together per split, which is as large as a scan
task at most, and sorted by position once. Everything inside a split is a window over that
sort: the line's number ``seq``, ``k`` = the timestamped lines so far, and the last
timestamped line's head (timestamp text and level, as a long).

Lines with ``k > 0`` know their entry, ``(split, k)``. Lines with ``k = 0`` sit before the
first timestamp of their split and continue the last entry of the nearest earlier split that
has one:

* :func:`number_entries` joins all lines to a table with a row per split that says so;
* :func:`split_entries` needs no join: an entry's length within a split is the distance to the next
  one's first line, and only the first and the last entry of each split meet again, per file.

An entry is identified by ``(file_path, entry_block, entry_k)``; text before a file's first
timestamp forms the entry ``(first split, 0)``. No entry's lines are ever collected.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parse


def with_split_position(lines: DataFrame) -> DataFrame:
    """Add ``block`` (start offset of the split a line was read from).

    Call directly on a file scan (e.g. ``read_log_lines``) before any shuffle,
    so each partition still holds whole splits in file order.
    """
    return lines.withColumn("block", F.col("_metadata.file_block_start"))


def _placed(lines: DataFrame, line: str, path: str, block: str, pos: str | None) -> DataFrame:
    """file_path, block, pos, log_entry, ts_text and level; without a ``pos`` column the position
    is ``monotonically_increasing_id``, which grows with the read order of a scan."""
    if pos is None and not _is_scan(lines):
        raise ValueError("lines that are not a file scan need a position column")
    return lines.select(F.col(path).alias("file_path"), F.col(block).cast("long").alias("block"),
                        (F.col(pos) if pos else F.monotonically_increasing_id()).alias("pos"),
                        F.col(line).alias("log_entry"), parse.timestamp_text(line).alias("ts_text"),
                        parse.level(line).alias("level"))


def _in_split() -> tuple:
    """The window of a split's lines in order, and up to the current one."""
    split = Window.partitionBy("file_path", "block").orderBy("pos")
    return split, split.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _starts() -> Column:
    return F.col("ts_text") != ""


def split_table(placed: DataFrame) -> DataFrame:
    """One row per split: entries starting in it and the head of its last entry. A pass with
    partial aggregation; the head travels as a long code so the aggregate stays hash-based."""
    return (placed.groupBy("file_path", "block")
            .agg(F.count_if(_starts()).alias("n_starts"),
                 F.max_by(parse.head_code("ts_text", "level"), F.when(_starts(), F.col("pos"))).alias("last_head")))


def carry_table(splits: DataFrame) -> DataFrame:
    """Per split: the entry its head lines continue (last entry of the nearest
    earlier split of the file that has one) and the file's first split."""
    w = Window.partitionBy("file_path").orderBy("block")
    prev = F.last(F.when(F.col("n_starts") > 0,
                         F.struct(F.col("block").alias("b"), F.col("n_starts").alias("k"),
                                  F.col("last_head").alias("head"))),
                  ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    first_block = F.min("block").over(Window.partitionBy("file_path"))
    return splits.select("file_path", "block", prev.alias("prev"), first_block.alias("first_block"))


def number_entries(lines: DataFrame, line: str = "log_entry", path: str = "file_path",
                   block: str = "block", pos: str | None = None) -> DataFrame:
    """Every line with the entry it belongs to.

    Input: lines with ``block`` telling the split. Without ``pos`` they must come straight from
    a file scan (see :func:`with_split_position`); with it, a column that grows along a block,
    any order will do. Output columns: ``file_path, entry_block, entry_k, block, seq,
    log_entry, entry_ts_text, entry_level, continuation`` (``continuation`` is true for lines
    without their own timestamp).
    """
    placed = _placed(lines, line, path, block, pos)
    split, upto = _in_split()
    numbered = placed.select(
        "file_path", "block", "log_entry", (~_starts()).alias("continuation"),
        (F.row_number().over(split) - 1).cast("long").alias("seq"), F.count_if(_starts()).over(upto).alias("k"),
        F.last(parse.head_code("ts_text", "level"), ignorenulls=True).over(upto).alias("own_head"))
    own = F.col("k") > 0
    whose = numbered.join(carry_table(split_table(placed)), ["file_path", "block"], "left").withColumns({
        "entry_block": F.when(own, F.col("block")).otherwise(F.coalesce(F.col("prev.b"), F.col("first_block"))),
        "entry_k": F.when(own, F.col("k")).otherwise(F.coalesce(F.col("prev.k"), F.lit(0).cast("long"))),
        "head": F.when(own, F.col("own_head")).otherwise(F.col("prev.head"))})
    return whose.select("file_path", "entry_block", "entry_k", "block", "seq", "log_entry",
                        parse.head_ts_text("head").alias("entry_ts_text"), parse.head_level("head").alias("entry_level"),
                        "continuation")


def split_entries(lines: DataFrame, line: str = "log_entry", path: str = "file_path",
                  block: str = "block", pos: str | None = None) -> DataFrame:
    """One row per entry: first line, timestamp text, level and line counts, as
    :func:`entry_summary` of :func:`number_entries` gives them, from one shuffle of the lines.

    Input as in :func:`number_entries`. Within a split an entry reaches to the next one's first
    line. Entries that may go on in another split, a split's last one and the lines before
    its first one, are two rows per split at most; only these are brought together per file.
    """
    split, upto = _in_split()
    whole = split.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = (_placed(lines, line, path, block, pos)
             .withColumns({"seq": F.row_number().over(split) - 1, "k": F.count_if(_starts()).over(upto),
                           "n": F.count(F.lit(1)).over(whole), "n_starts": F.count_if(_starts()).over(whole)})
             .filter(_starts() | (F.col("seq") == 0))
             .withColumn("lines", (F.lead("seq").over(split) - F.col("seq"))))
    lines_here = F.coalesce(F.col("lines"), F.col("n") - F.col("seq")).cast("long")
    heads = heads.select("file_path", "block", "k", "n_starts", "log_entry", "ts_text", "level", lines_here.alias("lines"),
                         (lines_here - F.when(_starts(), 1).otherwise(0)).alias("continuation_lines"))
    edge = (F.col("k") == 0) | (F.col("k") == F.col("n_starts"))
    in_file = Window.partitionBy("file_path").orderBy("block", "k")
    entry = Window.partitionBy("file_path", "entry").orderBy("block", "k")
    parts = entry.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = (heads.filter(edge)
             .withColumn("entry", F.count_if(F.col("k") > 0).over(in_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
             .withColumns({"lines": F.sum("lines").over(parts), "continuation_lines": F.sum("continuation_lines").over(parts),
                           "part": F.row_number().over(entry)})
             .filter("part = 1").drop("entry", "part"))
    return heads.filter(~edge).unionByName(edges).select(
        "file_path", F.col("block").alias("entry_block"), F.col("k").alias("entry_k"), F.col("log_entry").alias("first_line"),
        F.when(_starts(), F.col("ts_text")).alias("entry_ts_text"), F.when(_starts(), F.col("level")).alias("entry_level"),
        "lines", "continuation_lines")


def _is_scan(lines: DataFrame) -> bool:
    """Whether the lines come straight from a file scan."""
    try:
        lines.select("_metadata.file_block_start")
    except AnalysisException:
        return False
    return True


def entry_summary(numbered: DataFrame) -> DataFrame:
    """One row per entry: first line, timestamp text, level and line count.

    The counts are a hash aggregate; first lines, one per entry, are joined to them
    instead of being aggregated as strings, for which Spark would sort every line.
    """
    key = ["file_path", "entry_block", "entry_k"]
    counts = numbered.groupBy(*key).agg(F.count(F.lit(1)).alias("lines"),
                                        F.count_if("continuation").alias("continuation_lines"))
    # an entry begins with its timestamped line, text before the first one with the file
    first = ~F.col("continuation") | ((F.col("entry_k") == 0) & (F.col("block") == F.col("entry_block")) & (F.col("seq") == 0))
    heads = numbered.filter(first).select(*key, F.col("log_entry").alias("first_line"), "entry_ts_text", "entry_level")
    return heads.join(counts, key).select(*key, "first_line", "entry_ts_text", "entry_level", "lines", "continuation_lines")
