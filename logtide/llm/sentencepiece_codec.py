"""SentencePiece encoding and decoding for merge-type vocabularies.

A text is escaped (a space becomes U+2581, one is put before the text) and split into
characters. An agenda holds the adjacent pairs whose join is a piece, best score first and
leftmost among equals; the best pair is joined, its new neighbours enter, and entries whose
symbols have changed are skipped as they surface. Characters that are no piece become byte
pieces. No piece of the vocabulary has U+2581 after another character (checked as the model
is loaded), so no pair across such a place is ever joined and the text is encoded segment by
segment. In the same way a long segment falls into parts wherever no piece has its two
neighbouring characters next to each other. Segments are remembered, up to REMEMBERED of them;
those of a batch not met before go through their agendas together, one join of each at a time,
as columns of arrays.

The ids of every document are compared with the sentencepiece library's in the same Arrow
batch, and a difference fails the task. Decoding is the library's.

Defined results: a null or empty text has no ids and decodes to the empty text. Rows are
independent: repeated rows give repeated results, an empty table an empty table. Extra
columns are kept as asked; ``ids`` and ``decoded`` replace columns of these names. Text of
any length is encoded whole, in n log n steps for a segment of n characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

SPACE = "▁"
SEGMENT = re.compile(f"{SPACE}+[^{SPACE}]*")
_SPACED = re.compile(" ( *[^ ]*)")
#: Segments whose ids a worker remembers.
REMEMBERED = 600_000
#: Characters of a segment whose agenda is scanned; a longer one has a heap.
SHORT = 48
#: So many short segments or parts at least have their agendas together, in columns of that many.
FEW, COLUMNS = 64, 8192
NEVER = float("inf")
_LAST = np.int32(2**31 - 1)


class Joins:
    """Which symbol two symbols join to: an open hash table in arrays, asked for many pairs at once."""

    def __init__(self, pairs: dict[tuple[int, int], int], span: int):
        keys = np.array([a * span + b for a, b in pairs], np.int64)
        values = np.array(list(pairs.values()), np.int32)
        self.span = np.int64(span)  # over any symbol by two, so that -1 makes no key
        bits = max(len(pairs), 1).bit_length() + 3
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -(1 << 62), np.int64)
        self.values = np.full(1 << bits, -1, np.int32)
        slots = self._slots(keys)
        while len(keys):
            free = self.values[slots] < 0
            _, first = np.unique(slots[free], return_index=True)
            put = np.flatnonzero(free)[first]
            self.keys[slots[put]], self.values[slots[put]] = keys[put], values[put]
            left = np.delete(np.arange(len(keys)), put)
            keys, values, slots = keys[left], values[left], (slots[left] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The joined symbols, -1 for pairs that don't join."""
        keys = left * self.span + right
        slots = self._slots(keys)
        there = self.keys[slots]
        found = self.values[slots]
        other = np.flatnonzero(there != keys)
        found[other] = -1
        other = other[self.values[slots[other]] >= 0]
        while len(other):  # another pair's slot: the next one
            slots[other] = (slots[other] + 1) & self.mask
            same = self.keys[slots[other]] == keys[other]
            found[other[same]] = self.values[slots[other[same]]]
            other = other[~same & (self.values[slots[other]] >= 0)]
        return found


class Codec(dict):
    """Encoder for one model; as a dict, from a segment without its first space to its ids as bytes."""

    def __init__(self, model: bytes):
        super().__init__()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        sp = self.library
        ids = range(sp.get_piece_size())
        plain = [i for i in ids if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        self.pieces = {sp.id_to_piece(i): i for i in plain}
        self.scores = {sp.id_to_piece(i): -sp.get_score(i) for i in plain}
        #: Characters that are next to each other in some piece, with their score if they are one.
        self.near = {a + b: NEVER for p in self.pieces for a, b in zip(p, p[1:])}
        self.near |= {p: s for p, s in self.scores.items() if len(p) == 2}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces) or any(sp.is_unused(i) for i in plain):
            raise ValueError("this vocabulary has pieces across words, or unused ones")
        # symbols: the pieces and their characters, then any other character by its code point
        names = [*self.pieces, *sorted({c for p in self.pieces for c in p} - self.pieces.keys())]
        number = {p: i for i, p in enumerate(names)}
        self._loose = names[len(self.pieces):]  # characters of pieces that are none themselves
        self.symbol_id = np.array([self.pieces.get(p, -1) for p in names], np.int32)
        self.symbols = len(names)
        self.of_character = np.arange(0x110000, dtype=np.int32) + self.symbols
        for p, i in number.items():
            if len(p) == 1:
                self.of_character[ord(p)] = i
        self.of_character[ord(" ")] = self.of_character[ord(SPACE)]
        self.joins = Joins({(number[p[:i]], number[p[i:]]): number[p] for p in self.pieces for i in range(1, len(p))
                            if p[:i] in number and p[i:] in number}, self.symbols + 0x110000 + 1)
        #: Place of a symbol's score among all scores, equal ones alike.
        self.rank = np.unique([self.scores.get(p, NEVER) for p in names], return_inverse=True)[1].astype(np.int32)

    def _parts(self, segment: str) -> list[str]:
        near = self.near
        cuts = [0, *(i + 1 for i in range(len(segment) - 1) if segment[i:i + 2] not in near), len(segment)]
        return [segment[a:b] for a, b in zip(cuts, cuts[1:])]

    def _learn(self, keys: list[str]) -> None:
        """Remember the ids of segments."""
        long = [k for k in keys if len(k) >= SHORT]
        if long:
            keys = [k for k in keys if len(k) < SHORT]
            parts = [self._parts(SPACE + k.replace(" ", SPACE)) for k in long]
            found = {p: b"" for p in chain.from_iterable(parts)}
            found.update(self._joined([p for p in found if len(p) <= SHORT], ""))
            for p in found:
                if len(p) > SHORT:
                    found[p] = np.array(self._ids(self._joined_long(p)), np.int32).tobytes()
            self.update((k, b"".join([found[p] for p in x])) for k, x in zip(long, parts))
        self.update(self._joined(keys, SPACE))

    def _joined(self, short: list[str], first: str) -> Iterator[tuple[str, bytes]]:
        """Each text and the ids of ``first`` and the text."""
        if len(short) < FEW:
            for k in short:
                p = first + k.replace(" ", SPACE)
                pairs = [self.scores.get(p[i:i + 2], NEVER) for i in range(len(p) - 1)]
                yield k, np.array(self._ids(self._joined_short(p, pairs)), np.int32).tobytes()
            return
        short.sort(key=len)
        for begin in range(0, len(short), COLUMNS):
            columns = short[begin:begin + COLUMNS]
            yield from zip(columns, self._joined_columns([first + k for k in columns]))

    def _joined_columns(self, parts: list[str]) -> list[bytes]:
        """The ids of each part. A column has a part's symbols, neighbours and agenda, whose entries hold
        a pair's rank and place: a column's smallest is its best pair, leftmost among equals."""
        n, sizes = len(parts), np.array([len(p) for p in parts])
        width = int(sizes.max())
        columns = np.repeat(np.arange(n), sizes)
        places = np.arange(len(columns)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
        symbols = np.full((width + 2, n), -1, np.int32)  # nothing on either side
        symbols[places, columns] = self.of_character[np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")]
        after = np.repeat(np.arange(1, width + 3)[:, None], n, axis=1)
        before = after - 2
        joined = np.full((width + 2, n), -1, np.int32)
        joined[1:-1] = self.joins(symbols[1:-1].ravel(), symbols[2:].ravel()).reshape(width, n)
        agenda = np.where(joined >= 0, self.rank[joined] * 64 + np.arange(width + 2, dtype=np.int32)[:, None], _LAST)
        flat_symbols, flat_after, flat_before, flat_joined, flat_agenda = (
            x.reshape(-1) for x in (symbols, after, before, joined, agenda))

        def enter(at: np.ndarray, place: np.ndarray, found: np.ndarray) -> None:
            flat_joined[at] = found
            flat_agenda[at] = np.where(found >= 0, self.rank[found] * 64 + place, _LAST)

        while True:
            best = agenda.min(axis=0)
            column = np.flatnonzero(best < _LAST)
            if not len(column):
                break
            i = best[column].astype(np.int64) & 63
            at = i * n + column
            symbol = flat_joined[at]
            gone = flat_after[at] * n + column
            next_place = flat_after[gone]
            flat_symbols[at], flat_symbols[gone], flat_agenda[gone] = symbol, -1, _LAST
            behind = next_place * n + column
            flat_after[at], flat_before[behind] = next_place, i
            enter(at, i, self.joins(symbol, flat_symbols[behind]))
            ahead = flat_before[at]
            at = ahead * n + column
            enter(at, ahead, self.joins(flat_symbols[at], symbol))
        rows = symbols.T
        kept = rows >= 0
        return self._bytes(rows[kept], kept.sum(axis=1))

    def _bytes(self, symbols: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """Ids of parts from their symbols, one part after the other; characters that are no piece as bytes."""
        ids = np.where(symbols < self.symbols, self.symbol_id[np.minimum(symbols, self.symbols - 1)], -1)
        ends = np.cumsum(sizes)
        odd = np.flatnonzero(ids < 0)
        if len(odd):
            kinds, kind = np.unique(symbols[odd], return_inverse=True)
            characters = {int(self.of_character[ord(p)]): p for p in self._loose}
            coded = [self._ids([chr(k - self.symbols) if k >= self.symbols else characters[k]]) for k in kinds.tolist()]
            counts = np.ones(len(ids), np.int64)
            counts[odd] = np.array([len(c) for c in coded])[kind]
            out = np.repeat(ids, counts)
            out[out < 0] = np.fromiter(chain.from_iterable([coded[k] for k in kind.tolist()]), np.int32)
            ids, ends = out, np.append(0, np.cumsum(counts))[ends]
        raw, ends = ids.astype(np.int32).tobytes(), (4 * ends).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _ids(self, symbols: list[str]) -> list[int]:
        out: list[int] = []
        for s in symbols:
            piece = self.pieces.get(s)
            if piece is None:
                out.extend(self.bytes[b] for b in s.encode())
            else:
                out.append(piece)
        return out

    def _joined_short(self, segment: str, agenda: list[float]) -> list[str]:
        """The agenda, the scores of all pairs, as a list in text order: its best entry,
        leftmost among equals, is found by a scan, which is the fastest for words."""
        get = self.scores.get
        symbols = list(segment)
        while agenda:
            best = min(agenda)
            if best == NEVER:
                break
            i = agenda.index(best)
            joined = symbols[i] + symbols[i + 1]
            symbols[i:i + 2] = [joined]
            del agenda[i]
            if i < len(agenda):
                agenda[i] = get(joined + symbols[i + 1], NEVER)
            if i:
                agenda[i - 1] = get(symbols[i - 1] + joined, NEVER)
        return symbols

    def _joined_long(self, segment: str) -> list[str]:
        """The agenda as a heap."""
        scores = self.scores
        symbols: list[str | None] = list(segment)
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []
        for i in range(n - 1):
            score = scores.get(segment[i:i + 2])
            if score is not None:
                agenda.append((score, i, 2))
        heapify(agenda)
        while agenda:
            _, i, size = heappop(agenda)
            left, j = symbols[i], after[i]
            if left is None or j == n:
                continue
            joined = left + symbols[j]
            if len(joined) != size:
                continue  # one of the two has grown since
            symbols[i], symbols[j] = joined, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                score = scores.get(joined + symbols[k])
                if score is not None:
                    heappush(agenda, (score, i, size + len(symbols[k])))
            h = before[i]
            if h >= 0:
                score = scores.get(symbols[h] + joined)
                if score is not None:
                    heappush(agenda, (score, h, len(symbols[h]) + size))
        return [x for x in symbols if x is not None]

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's ids end."""
        if len(self) > REMEMBERED:
            self.clear()
        cut = []
        for t in texts:
            t = t.replace(SPACE, " ")
            if "  " in t or t[:1] == " ":
                cut.append(_SPACED.findall(" " + t))
            else:
                cut.append(t.split(" ") if t else [])
        segments = list(chain.from_iterable(cut))
        found = list(map(self.get, segments))
        missing = [i for i, x in enumerate(found) if x is None]
        if missing:
            self._learn(list(dict.fromkeys([segments[i] for i in missing])))
            for i in missing:
                found[i] = self[segments[i]]
        ends = np.cumsum([0, *map(len, cut)]).tolist()
        raw = [b"".join(found[a:b]) for a, b in zip(ends, ends[1:])]
        return np.frombuffer(b"".join(raw), np.int32), np.cumsum([len(r) for r in raw], dtype=np.int64) // 4

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0].tolist()


_CODECS: dict[bytes, Codec] = {}


def codec(model: bytes) -> Codec:
    """The worker's codec for a model, kept between tasks."""
    if model not in _CODECS:
        _CODECS.clear()
        _CODECS[model] = Codec(model)
    return _CODECS[model]


def encode_decode(df: DataFrame, column: str, model: bytes, keep: list[str] | None = None, check: bool = True) -> DataFrame:
    """``keep`` (all columns by default), ``ids`` of the text column and ``decoded``, the
    text that the library decodes them to. ``model``: the model file's content."""
    shipped = df.sparkSession.sparkContext.broadcast(model)  # a vocabulary file, of fixed size

    def make(texts: list[str]) -> list[pa.Array]:
        c = codec(shipped.value)
        flat, ends = c.encode_all(texts)
        if check:
            ids = c.library.encode(texts, num_threads=1)
            same = np.array_equal(ends, np.cumsum([len(x) for x in ids], dtype=np.int64))
            if not same or not np.array_equal(flat, np.fromiter(chain.from_iterable(ids), np.int32, len(flat))):
                raise ValueError("the ids differ from the sentencepiece library's")
        else:
            ids = [x.tolist() for x in np.split(flat, ends[:-1])] if texts else []
        return [pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat)),
                pa.array(c.library.decode(ids, num_threads=1) if ids else [], pa.string())]

    return map_texts(df, column, df.columns if keep is None else keep, "ids array<int>, decoded string", make)


def digests(docs: DataFrame, model: bytes) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    coded = encode_decode(docs.select("doc_id", "text"), "text", model, keep=["doc_id"])
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
