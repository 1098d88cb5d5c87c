"""Personal data: identifiers in plain and in disguised form, at their source offsets.

Plain (base) identifiers are e-mail and IP addresses, card numbers and phone numbers as
their patterns find them. For disguised ones the text runs through a chain of transducers,
each a rewriting that keeps for every character the span of the source it stands for:

1. look-alike letters, wide and foreign digits, dashes and spaces become ASCII, invisible
   characters go;
2. spelled digits become digits, ``double`` and ``triple`` included, ``plus`` before a digit ``+``;
3. ``(dot)``, ``[dot]`` and a bare ``dot`` between words become ``.``;
4. ``(at)``, ``[at]`` and a bare ``at`` before a domain with a disguised dot and a common last label become ``@``.

The detectors then read the normalised text, and what they find is mapped back. Only finds
with at least one rewritten character that don't lie within a base span of their kind are
added. Offsets are code points, the end exclusive.

Defined results: a null text is empty and has no spans. Every detector takes time in
proportion to the text, also on long runs of letters, digits or dots. Rows are independent
(repeats repeat, empty tables stay empty); extra columns are kept as asked, and a column
named ``pii`` is replaced.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, map_texts

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, place in KINDS, end

# --- detectors ----------------------------------------------------------------

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``: from each @
    back over its local part, no further than the last match, and on over the domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        domain = DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            yield begin, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def ips(text: str) -> Iterator[tuple[int, int]]:
    """Runs of dotted numbers taken four by four; parts over 255 drop the four."""
    for run in DOTTED.finditer(text):
        if "." not in (found := run.group()):
            continue
        parts, begin = found.split("."), run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = begin + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in four):
                yield begin, end
            begin = end + 1


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m.group())) <= 15:
            yield m.span()


def detect(text: str) -> list[Span]:
    found = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    found += [(s, 1, e) for s, e in ips(text)]
    found += [(s, 2, e) for s, e in cards(text)]
    if "+" in text:
        found += [(s, 3, e) for s, e in phones(text)]
    return sorted(found)


# --- transducers --------------------------------------------------------------

# FIXED VALUES: letters of other scripts and the ASCII letters that they look like
LOOKALIKES = dict(zip("аеорсухіјѕԁһԛԝкмтвАВЕКМНОРСТУХІЈЅԚԜ", "aeopcyxijsdhqwkmtbABEKMHOPCTYXIJSQW")) | dict(
    zip("αορνικυχτΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aopvikuxtABEZHIKMNOPTYX"))
INVISIBLE = "­​‌‍⁠﻿"
DASHES = "‐‑‒–—―−"
BLANKS = "            　"
# FIXED VALUES: spelled digits
DIGITS = dict(zip("zero oh one two three four five six seven eight nine".split(), "00123456789"))
TIMES = {"double": 2, "triple": 3}
# FIXED VALUES: last labels of domains after a bare "at", where any word may follow "dot"
TOP_LEVELS = frozenset("com net org edu gov mil info biz io co uk us eu de fr es nl ch ru cn jp br au ca dev app ai".split())

_FOLDED = {**LOOKALIKES, **dict.fromkeys(INVISIBLE, ""), **dict.fromkeys(DASHES, "-"), **dict.fromkeys(BLANKS, " ")}


def fold(c: str) -> str:
    """What a character reads as: itself, an ASCII character, or nothing."""
    if c < "\x80":
        return c
    if c in _FOLDED:
        return _FOLDED[c]
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    plain = unicodedata.normalize("NFKC", c)
    return plain if len(plain) == 1 and plain < "\x80" else c


class Mapped:
    """A text whose characters know the source span they stand for and whether they are rewritten."""

    def __init__(self, text: str, starts: list[int], ends: list[int], changed: list[bool]):
        self.text, self.starts, self.ends, self.changed = text, starts, ends, changed

    @classmethod
    def folded(cls, text: str) -> Mapped:
        read = [fold(c) for c in text] if not text.isascii() else list(text)
        kept = [i for i, r in enumerate(read) if r]
        # a character next to one that went stands for a rewritten place
        return cls("".join(read), kept, [i + 1 for i in kept],
                   [read[i] != text[i] or (i + 1 < len(read) and not read[i + 1]) for i in kept])

    def rewritten(self, pattern: re.Pattern, reading) -> Mapped:
        """Each match becomes ``reading(self, match)``, unless that is None."""
        text, starts, ends, changed, done = [], [], [], [], 0
        for m in pattern.finditer(self.text):
            new = reading(self, m)
            if new is None or m.start() == m.end():
                continue
            a, b = m.span()
            text += self.text[done:a], new
            starts += self.starts[done:a] + [self.starts[a]] * len(new)
            ends += self.ends[done:a] + [self.ends[b - 1]] * len(new)
            changed += self.changed[done:a] + [True] * len(new)
            done = b
        if not done:
            return self
        return Mapped("".join([*text, self.text[done:]]), starts + self.starts[done:], ends + self.ends[done:],
                      changed + self.changed[done:])


_WORD = "|".join([*DIGITS, *TIMES])
SPELLED = re.compile(rf"(?<![A-Za-z0-9])(?:{_WORD})(?:[ \t\n,-]{{1,3}}(?:{_WORD}))*(?![A-Za-z0-9])", re.I)
PLUS = re.compile(r"(?<![A-Za-z0-9])plus[ \t\n]{1,3}(?=[0-9])", re.I)
DOT = re.compile(r"\s{0,3}[(\[{<]\s?(?:dot|\.)\s?[)\]}>]\s{0,3}|(?<=[A-Za-z0-9])\s{1,3}dot\s{1,3}(?=[A-Za-z0-9])", re.I)
AT = re.compile(r"\s{0,3}[(\[{<]\s?(?:at|@)\s?[)\]}>]\s{0,3}|(?<=[A-Za-z0-9])\s{1,3}at\s{1,3}(?=[A-Za-z0-9])", re.I)
#: A text without any of these reads as itself: CUE finds all that the transducers start from
#: (a bare "at" needs a rewritten dot).
ODD = re.compile("[^\x00-\x7fÀ-ÖØ-öø-ÿ]")
CUE = re.compile(rf"(?<![A-Za-z0-9])(?:{_WORD})(?![A-Za-z0-9])"
                 r"|(?<![A-Za-z0-9])plus[ \t\n]{1,3}[0-9]|[(\[{<]\s?(?:dot|\.|at|@)\s?[)\]}>]|\sdot\s", re.I)


def _digits(_: Mapped, m: re.Match) -> str:
    out, times = [], 1
    for word in re.findall("[A-Za-z]+", m.group().lower()):
        if word in TIMES:
            times = TIMES[word]
        else:
            out.append(DIGITS[word] * times)
            times = 1
    return "".join(out) or None


def _at(text: Mapped, m: re.Match) -> str | None:
    if m.group().strip().lower() != "at":
        return "@"
    domain = DOMAIN.match(text.text, m.end())
    if not domain or domain.group().rpartition(".")[2].lower() not in TOP_LEVELS:
        return None
    return "@" if any(text.text[i] == "." and text.changed[i] for i in range(*domain.span())) else None


def normalise(text: str) -> Mapped:
    out = Mapped.folded(text).rewritten(SPELLED, _digits).rewritten(PLUS, lambda *_: "+")
    return out.rewritten(DOT, lambda *_: ".").rewritten(AT, _at)


def disguised(text: str, base: list[Span]) -> list[Span]:
    """Spans that only the normalised text shows."""
    if (text.isascii() or not ODD.search(text)) and not CUE.search(text):
        return []
    read = normalise(text)
    out = set()
    for s, kind, e in detect(read.text):
        if any(read.changed[s:e]):
            begin, end = read.starts[s], read.ends[e - 1]
            if not any(k == kind and b <= begin and end <= f for b, k, f in base):
                out.add((begin, kind, end))
    return sorted(out)


# --- on tables ----------------------------------------------------------------

_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
_DDL = "pii array<struct<kind: string, start: int, end: int, base: boolean>>"


def spans_of(text: str) -> list[dict]:
    base = detect(text)
    found = sorted([(s, True) for s in base] + [(s, False) for s in disguised(text, base)])
    return [{"kind": KINDS[k], "start": s, "end": e, "base": plain} for (s, k, e), plain in found]


def find(df: DataFrame, column: str, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (all columns by default) and ``pii``: the spans of the text column by start,
    then kind, ``base`` where the plain pattern finds them."""
    return map_texts(df, column, df.columns if keep is None else keep, _DDL,
                     lambda texts: [pa.array([spans_of(t) for t in texts], _TYPE)])


def redacted(text: str) -> str:
    """The text with every stretch of spans replaced by its first span's kind, as [EMAIL]."""
    out, done = [], 0
    for s in spans_of(text):
        if s["start"] >= done:  # else it goes on where the last one is
            out += text[done:s["start"]], f"[{s['kind'].upper()}]"
        done = max(done, s["end"])
    return "".join([*out, text[done:]])


def redact(df: DataFrame, column: str) -> DataFrame:
    """``df`` with the spans of its text column replaced by their kinds; null stays null."""
    clean = free_name(df, "_clean")
    marked = map_texts(df, column, df.columns, f"{clean} string",
                       lambda texts: [pa.array([redacted(t) for t in texts], pa.string())])
    return marked.select(*[F.when(F.col(c).isNotNull(), F.col(clean)).alias(c) if c == column else F.col(c) for c in df.columns])


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts per kind, the hash of the base spans and all spans as text."""
    found = find(docs.select("doc_id", "text"), "text", keep=["doc_id"])
    base = F.filter("pii", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
                        _joined(F.col("pii")).alias("spans"))
