"""Row-local parse expressions over log lines and file paths.

Every function returns a ``Column`` built from Spark built-ins, so the parse
stays inside whole-stage codegen and never leaves the JVM. None of them
shuffles; they work unchanged on batch and streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def level(line: str | Column = "log_entry") -> Column:
    """First word-bounded INFO/WARN/ERROR/DEBUG in the line, '' when none."""
    return F.regexp_extract(_c(line), P.LEVEL_WORD, 1)


def level_loose(line: str | Column = "log_entry") -> Column:
    """First level word without word boundaries ('INFORMATION' gives INFO)."""
    return F.regexp_extract(_c(line), P.LEVEL_LOOSE, 1)


def component(line: str | Column = "log_entry") -> Column:
    return F.regexp_extract(_c(line), P.COMPONENT, 2)


def timestamp_text(line: str | Column = "log_entry") -> Column:
    """Leading 'yy/MM/dd HH:mm:ss' text, '' when the line has none."""
    return F.regexp_extract(_c(line), P.TIMESTAMP, 1)


def to_log_timestamp(text: str | Column) -> Column:
    """'yy/MM/dd HH:mm:ss' text → TIMESTAMP_NTZ; NULL for '' or impossible dates.

    The two-digit year is read as 20yy. The value has no zone, so it is the
    same wall-clock time whatever the session time zone is, and a bad date
    such as '17/13/45 99:00:00' gives NULL instead of failing the job.
    """
    iso = F.regexp_replace(_c(text), r"^(\d{2})/(\d{2})/(\d{2}) ", "20$1-$2-$3 ")
    return iso.try_cast("timestamp_ntz")


def log_timestamp(line: str | Column = "log_entry") -> Column:
    return to_log_timestamp(timestamp_text(line))


def cluster_id(path: str | Column = "file_path") -> Column:
    return F.regexp_extract(_c(path), P.APP_DIR, 1)


def app_id(path: str | Column = "file_path") -> Column:
    """Zero-padded application number, kept as a string ('0039')."""
    return F.regexp_extract(_c(path), P.APP_DIR, 2)


def application_id(path: str | Column = "file_path") -> Column:
    """'application_<cluster>_<app>' (whole match)."""
    return F.regexp_extract(_c(path), P.APPLICATION_ID, 0)


def container_id(path: str | Column = "file_path") -> Column:
    return F.regexp_extract(_c(path), P.CONTAINER_ID, 1)


def container_attempt(path: str | Column = "file_path") -> Column:
    return F.regexp_extract(_c(path), P.CONTAINER_PARTS, 3)


def container_number(path: str | Column = "file_path") -> Column:
    return F.regexp_extract(_c(path), P.CONTAINER_PARTS, 4)


def container_role(path: str | Column = "file_path") -> Column:
    num = container_number(path)
    return (F.when(num == P.AM_CONTAINER, F.lit("ApplicationMaster"))
            .when(num != "", F.lit("Executor"))
            .otherwise(F.lit("")))


def hosts(line: str | Column = "log_entry") -> Column:
    """Every host a line names, once each."""
    return F.array_distinct(F.regexp_extract_all(_c(line), F.lit(P.HOST), F.lit(1)))


def epoch_millis_ntz(millis: Column) -> Column:
    """Epoch milliseconds → TIMESTAMP_NTZ in UTC wall-clock time (zone-free)."""
    return F.timestamp_add("MILLISECOND", millis,
                           F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def extract_long(line: str | Column, pattern: str, idx: int) -> Column:
    """Integer capture group; NULL when the pattern does not match."""
    s = F.regexp_extract(_c(line), pattern, idx)
    return F.when(s != "", s.try_cast("bigint"))


# --- fixed-width codes ---------------------------------------------------------
# Aggregation buffers of strings are not fixed-width, so Spark would aggregate
# them by sorting. The codes below pack a short text into a long that decodes
# back exactly, keeping aggregates on hash tables.

def head_code(ts_text: str | Column, level_text: str | Column) -> Column:
    """Entry head (timestamp text, level) → its 12 digits·8 + level number.

    The timestamp text matched the timestamp pattern, so it has exactly 12
    digits (even when it is no valid date); the level is one of the four
    words or ''.
    """
    digits = F.regexp_replace(_c(ts_text), r"\D", "").try_cast("bigint")
    lv = _c(level_text)
    idx = F.lit(0)
    for i, name in enumerate(P.LEVELS, 1):
        idx = F.when(lv == name, F.lit(i)).otherwise(idx)
    return F.when(_c(ts_text) != "", digits * 8 + idx)


def head_ts_text(code: str | Column) -> Column:
    d = F.lpad(F.shiftright(_c(code), 3).cast("string"), 12, "0")
    part = [F.substring(d, i, 2) for i in range(1, 13, 2)]
    return F.when(_c(code).isNotNull(), F.concat(part[0], F.lit("/"), part[1], F.lit("/"), part[2],
                                                 F.lit(" "), part[3], F.lit(":"), part[4],
                                                 F.lit(":"), part[5]))


def head_level(code: str | Column) -> Column:
    names = F.array(*[F.lit(x) for x in ("",) + tuple(P.LEVELS)])
    return F.when(_c(code).isNotNull(),
                  F.element_at(names, (_c(code).bitwiseAND(7) + 1).cast("int")))
