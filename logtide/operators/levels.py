"""Log-level distribution: counts, shares, summary text, sample, components.

Input: a DataFrame with ``log_entry`` (and ``file_path`` where noted), e.g.
from :func:`logtide.sources.logs.read_log_lines`.

Plan shape: every aggregate here first reduces the scan to one row per level
(or component) with a partial hash aggregate inside the scan stage, so the
shuffle carries a handful of rows per task whatever the input size, and a
level holding most of the lines is no hot spot. Totals are taken from that
small grouped result instead of re-scanning the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parse
from ..functions import patterns as P


def level_groups(lines: DataFrame, line: str = "log_entry") -> DataFrame:
    """``(log_level, count)`` for every level incl. '' (no level); one scan."""
    return (lines.select(parse.level(line).alias("log_level"))
            .groupBy("log_level").agg(F.count(F.lit(1)).alias("count")))


def level_counts(lines: DataFrame, line: str = "log_entry", ordered: bool = True) -> DataFrame:
    """Lines per level, levels found only, ordered by level."""
    out = (lines.select(parse.level(line).alias("log_level"))
           .filter(F.col("log_level") != "")
           .groupBy("log_level").agg(F.count(F.lit(1)).alias("count")))
    return out.orderBy("log_level") if ordered else out


def scan_totals(lines: DataFrame, line: str = "log_entry") -> DataFrame:
    """One row: ``total_lines``, ``lines_with_levels``, ``unique_levels`` in one scan."""
    g = level_groups(lines, line)
    has = F.col("log_level") != ""
    return g.agg(
        F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("total_lines"),
        F.coalesce(F.sum(F.when(has, F.col("count"))), F.lit(0)).cast("bigint").alias("lines_with_levels"),
        F.count_if(has).cast("bigint").alias("unique_levels"),
    )


def total_lines(lines: DataFrame) -> DataFrame:
    return lines.agg(F.count(F.lit(1)).alias("total_lines"))


def lines_with_levels(lines: DataFrame, line: str = "log_entry") -> DataFrame:
    return lines.agg(F.count_if(parse.level(line) != "").alias("lines_with_levels"))


def level_pct(lines: DataFrame, line: str = "log_entry") -> DataFrame:
    """``(log_level, count, pct)``; pct = count / lines-with-levels × 100.

    The per-level rows (at most four: the level pattern has four words) are
    gathered by one global aggregate next to their total, and the shares are
    computed in that row; no window over the whole result is needed.
    """
    counts = level_counts(lines, line, ordered=False)
    agg = counts.agg(F.collect_list(F.struct("log_level", "count")).alias("levels"),
                     F.sum("count").alias("total"))
    rows = F.transform("levels", lambda e: F.struct(
        e["log_level"].alias("log_level"), e["count"].alias("count"),
        (F.try_divide(e["count"].cast("double"), F.col("total").cast("double"))
         * F.lit(100.0)).alias("pct")))
    return agg.select(F.inline(rows)).orderBy("log_level")


def _thousands(n: Column) -> Column:
    return F.format_number(n, 0)


def summary_text(lines: DataFrame, line: str = "log_entry") -> DataFrame:
    """One row, one column ``summary``: the five header lines plus one line per level.

    Built from the per-level groups (at most four rows), so ``collect_list``
    here gathers four short strings, never input rows.
    """
    return summary_from_groups(level_groups(lines, line))


def counts_from_groups(g: DataFrame) -> DataFrame:
    return g.filter(F.col("log_level") != "").orderBy("log_level")


def summary_from_groups(g: DataFrame) -> DataFrame:
    """``summary_text`` from the output of :func:`level_groups`.

    One global aggregate over the per-level groups (at most five rows: four
    levels and '') yields the totals and the level entries; each level line
    is formatted in that row with the leveled total, so no window is used.
    """
    has = F.col("log_level") != ""
    agg = g.agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(has, F.col("count"))), F.lit(0)).alias("leveled"),
        F.count_if(has).alias("levels"),
        F.array_sort(F.collect_list(F.when(has, F.struct("log_level", "count")))).alias("entries"),
    )
    figures = (_thousands(F.col("total")), _thousands(F.col("leveled")),
               F.col("levels").cast("string"))
    labels = P.SUMMARY_LABELS
    header = F.concat_ws(
        "\n",
        *[F.concat(F.lit(lab), fig) for lab, fig in zip(labels, figures)],
        *[F.lit(lab) for lab in labels[len(figures):]],
    )

    def level_line(e):
        pct = F.try_divide(e["count"].cast("double"), F.col("leveled").cast("double")) * F.lit(100.0)
        # '%10s' pads without cutting (lpad would truncate wide counts)
        return F.format_string(P.SUMMARY_LEVEL_FORMAT, e["log_level"], _thousands(e["count"]), pct)

    body = F.array_join(F.transform("entries", level_line), "\n")
    text = F.when(F.size("entries") > 0, F.concat_ws("\n", header, body)).otherwise(header)
    return agg.select(text.alias("summary"))


def sample_lines(lines: DataFrame, key: str | list[str], k: int = 10, seed: int = 42,
                 line: str = "log_entry") -> DataFrame:
    """``k`` lines with a level, in a reproducible pseudo-random order.

    Rows are ranked by ``md5('<seed>|<key>')``; ``key`` must identify a line
    (an id, or file path plus text). The limit is the feature: Spark runs this
    as a top-k per task and a merge of k rows each, never a full sort.
    """
    keys = [key] if isinstance(key, str) else list(key)
    keytext = F.concat_ws("|", *[F.col(c).cast("string") for c in keys])
    h = F.md5(F.concat(F.lit(f"{seed}|"), keytext))
    return (lines.select(F.col(line).alias("log_entry"), parse.level(line).alias("log_level"),
                         h.alias("_h"))
            .filter(F.col("log_level") != "")
            .orderBy("_h").limit(k)
            .select("log_entry", "log_level"))


def component_counts(lines: DataFrame, k: int | None = 20, line: str = "log_entry") -> DataFrame:
    """Lines per component (logger name), most frequent first, ties by name."""
    out = (lines.select(parse.component(line).alias("component"))
           .groupBy("component").agg(F.count(F.lit(1)).alias("count"))
           .orderBy(F.desc("count"), F.asc("component")))
    return out.limit(k) if k else out


def level_counts_loose(lines: DataFrame, line: str = "log_entry") -> DataFrame:
    """Lines per level without word boundaries; lines with no level form ''."""
    return (lines.select(parse.level_loose(line).alias("level"))
            .groupBy("level").agg(F.count(F.lit(1)).alias("count"))
            .orderBy("level"))


def level_occurrences(lines: DataFrame, line: str = "log_entry") -> DataFrame:
    """Every level word in every line is counted (not only the first per line)."""
    words = F.regexp_extract_all(F.col(line), F.lit(P.LEVEL_LOOSE), 1)
    return (lines.select(F.explode(words).alias("level"))
            .groupBy("level").agg(F.count(F.lit(1)).alias("occurrences"))
            .orderBy("level"))


def distinct_levels(lines: DataFrame, line: str = "log_entry") -> DataFrame:
    return (lines.select(parse.level(line).alias("log_level"))
            .filter(F.col("log_level") != "")
            .distinct()
            .orderBy("log_level"))


def error_lines(lines: DataFrame, line: str = "log_entry") -> DataFrame:
    """Lines whose level (first word-bounded match) is ERROR."""
    keep = [c for c in ("file_path",) if c in lines.columns]
    return lines.filter(parse.level(line) == "ERROR").select(*keep, line)
