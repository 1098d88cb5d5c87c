"""Token ids in wavelet-matrix shards.

Documents are sorted by id, encoded, and packed in runs of about SHARD_TOKENS ids. A shard's
file is a wavelet matrix: the ids' bits from the highest to the lowest, one bit-plane each,
where before every plane the ids are parted stably by the bit of the plane before, zeros
first. With counts of ones every 512 bits it answers from the one file which id stands at a
place, how often an id occurs before a place, and where its n-th occurrence is. The file is
compressed with zstandard and kept as a row of a Parquet table, since a table is what Spark
can write to any store; readers need nothing but the row.

Encoding goes by pre-tokens. Texts whose characters are all below U+0180 are lower-cased and cut
into pre-tokens by the tokenizer's own rules as arrays of bytes, about 4 MB of text at a time, and
each different pre-token among these is looked up once. Those not met before are encoded by the
library's model, in the characters that its byte-level step makes of them, and remembered: twice
REMEMBERED and those of one step at most, and what is met again stays. Any other text is encoded by
the library as a whole.

Defined results: a null text is empty and has the end id only. Rows without a doc_id come
first, rows that share one stand together in any order. An empty table has no shards. Extra
columns are ignored. A document is never split, so a very long one makes a longer shard.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from .common import stored, text_slices

SHARD_TOKENS = 1 << 19
#: Pre-tokens whose ids a worker remembers: so many met lately, and as many from before them.
REMEMBERED = 600_000
END_ID = 1

# --- the file -----------------------------------------------------------------

MAGIC = b"WMX1"
_HEAD = struct.Struct("<4sIIQQ")  # magic, planes, longest count step in bits, ids, documents
STEP = 512


class WaveletMatrix:
    """Ids of a shard; ``ends`` and ``docs`` say which document has which of them."""

    def __init__(self, planes: list[np.ndarray], n: int, docs: np.ndarray, ends: np.ndarray):
        self.planes, self.n, self.docs, self.ends = planes, n, docs, ends
        self.counts = []  # ones before every STEP bits
        for p in planes:
            ones = np.bitwise_count(np.pad(p, (0, -len(p) % 64)).view(np.uint64)).reshape(-1, 8).sum(1, dtype=np.int64)
            self.counts.append(np.concatenate([[0], np.cumsum(ones)]))
        self.zeros = [n - int(c[-1]) for c in self.counts]

    @classmethod
    def build(cls, ids: np.ndarray, docs: np.ndarray, ends: np.ndarray) -> WaveletMatrix:
        planes = []
        for bit in range(int(ids.max()).bit_length() - 1 if len(ids) else -1, -1, -1):
            ones = (ids & ids.dtype.type(1 << bit)) != 0
            planes.append(np.packbits(ones, bitorder="little"))
            ids = np.concatenate([ids.take(np.flatnonzero(~ones)), ids.take(np.flatnonzero(ones))])
        return cls(planes, len(ids), docs, ends)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (i & 7) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        begin = i // STEP
        part = self.planes[level][begin * STEP // 8:(i + 7) // 8]
        inside = int(np.bitwise_count(part).sum())
        if i & 7:
            inside -= (int(part[-1]) >> (i & 7)).bit_count()
        return int(self.counts[level][begin]) + inside

    def access(self, i: int) -> int:
        """The id at place i."""
        value = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, i), self._ones(level, i)
            value = value << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _range(self, token: int, begin: int, end: int) -> tuple[int, int]:
        for level in range(len(self.planes)):
            a, b = self._ones(level, begin), self._ones(level, end)
            if token >> (len(self.planes) - 1 - level) & 1:
                begin, end = self.zeros[level] + a, self.zeros[level] + b
            else:
                begin, end = begin - a, end - b
        return begin, end

    def rank(self, token: int, i: int) -> int:
        """How often an id stands among the first i."""
        if token < 0 or token >> len(self.planes):
            return 0
        begin, end = self._range(token, 0, i)
        return end - begin

    def select(self, token: int, k: int) -> int:
        """The place of an id's occurrence number k, from 0; -1 if there are fewer."""
        if not 0 <= k < self.rank(token, self.n):
            return -1
        i = self._range(token, 0, 0)[0] + k
        for level in range(len(self.planes) - 1, -1, -1):
            i = self._select(level, token >> (len(self.planes) - 1 - level) & 1, i)
        return i

    def _select(self, level: int, bit: int, i: int) -> int:
        """Where the element at place i of the next level stands in this one."""
        k = i - self.zeros[level] if bit else i
        counts = self.counts[level]
        before = counts if bit else np.minimum(np.arange(len(counts)) * STEP, self.n) - counts
        block = int(np.searchsorted(before, k, side="right")) - 1
        part = np.unpackbits(self.planes[level][block * STEP // 8:(block + 1) * STEP // 8], bitorder="little")
        part = part[:self.n - block * STEP]
        return block * STEP + int(np.flatnonzero(part == bit)[k - int(before[block])])

    def decode(self) -> np.ndarray:
        """All ids in order."""
        out = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level in range(len(self.planes) - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            back = np.empty_like(out)
            back[np.flatnonzero(~ones)] = out[:self.zeros[level]]
            back[np.flatnonzero(ones)] = out[self.zeros[level]:] | out.dtype.type(1 << (len(self.planes) - 1 - level))
            out = back
        return out

    def to_bytes(self) -> bytes:
        parts = [_HEAD.pack(MAGIC, len(self.planes), STEP, self.n, len(self.docs)), np.ma.filled(self.docs.astype("<i8")).tobytes(),
                 self.ends.astype("<i8").tobytes(), *(p.tobytes() for p in self.planes)]
        return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        raw = zstandard.ZstdDecompressor().decompress(raw)
        magic, planes, _, n, docs = _HEAD.unpack_from(raw)
        if magic != MAGIC:
            raise ValueError("not a wavelet matrix")
        at, width = _HEAD.size + 16 * docs, -(-n // 8)
        return cls([np.frombuffer(raw, np.uint8, width, at + i * width) for i in range(planes)], n,
                   np.frombuffer(raw, "<i8", docs, _HEAD.size), np.frombuffer(raw, "<i8", docs, _HEAD.size + 8 * docs))


# --- encoding -----------------------------------------------------------------

_LOW = [chr(c) for c in range(0x180) if c != 0x130]
_SPACES = "\t\n\x0b\x0c\r \x85\xa0"


def _class(kind: str) -> str:
    return "".join(re.escape(c) for c in _LOW if unicodedata.category(c)[0] == kind)


#: The tokenizer's pattern (fixed), its classes written out for characters below U+0180.
PRETOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_class('L')}]+|[{_class('N')}]"
                      rf"|[^{re.escape(_SPACES)}{_class('L')}{_class('N')}]+")
#: What the rules above stand for; another tokenizer's texts all go to its library.
RULES = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
_KINDS = np.array([_SPACE if c in _SPACES else {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(c)[0], _OTHER)
                   for c in map(chr, range(0x180))], np.uint8)


def pretokens(texts: pa.LargeStringArray) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The pre-tokens of all texts, as PRETOKEN finds them, and how many there are up to each
    text's end. The texts are lower-cased, of characters below U+0180 and not null."""
    ends, raw = _bytes(texts)
    begins = ends[:-1][ends[:-1] < len(raw)]
    ends = ends[1:]
    kind = _KINDS[raw]
    lead = np.flatnonzero(raw >= 0x80)[::2]  # of characters of two bytes
    kind[lead] = kind[lead + 1] = _KINDS[(raw[lead] & 0x1F).astype(np.intp) << 6 | raw[lead + 1] & 0x3F]
    first = np.zeros(len(raw) + 2, bool)  # bytes that begin a text, or stand after the last
    first[begins], first[len(raw):] = True, True
    starts = first[:-2] | (kind == _NUMBER)  # bytes that begin a pre-token, or a run of spaces
    starts[1:] |= kind[1:] != kind[:-1]
    starts[lead + 1] = False
    mark = np.flatnonzero(raw == ord("'"))
    mark = mark[starts[mark] & ~first[mark + 1]]
    for end in (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d"):
        at = mark[raw[mark + 1] == end[0]]
        if len(end) > 1:
            at = at[~first[at + 2]]
            at = at[raw[at + 2] == end[1]]
        starts[at + 1] = False
        after = at + 1 + len(end)
        starts[after[after < len(raw)]] = True
    kept = np.flatnonzero(kind != _SPACE)
    begins = np.flatnonzero(starts.take(kept))
    offsets = np.append(begins, len(kept)).astype(np.int64, copy=False)
    found = pa.LargeStringArray.from_buffers(len(begins), pa.py_buffer(offsets), pa.py_buffer(raw.take(kept)))
    return found, np.searchsorted(kept.take(begins), ends)


def _bytes(texts: pa.LargeStringArray | pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Where the values begin and end in their joined bytes, and these."""
    _, ends, raw = texts.buffers()
    ends = np.frombuffer(ends, np.int64, len(texts) + 1, 8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    return ends - ends[0], np.frombuffer(raw or b"", np.uint8)[ends[0]:ends[-1]]


class Encoder:
    def __init__(self, model: bytes):
        self.library = Tokenizer.from_str(model.decode())
        spec = json.loads(model)
        kinds = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        self.by_rules = (spec["model"]["type"] == "BPE" and kinds == ["NFC", "Replace", "Lowercase"]
                         and [x["type"] for x in steps] == ["Split", "ByteLevel"]
                         and (steps[0]["pattern"], steps[0]["behavior"], steps[0]["invert"]) == ({"Regex": RULES}, "Removed", True)
                         and not steps[1]["add_prefix_space"] and not steps[1].get("use_regex", True))
        marks = [x["content"] for x in spec.get("added_tokens", [])]
        self.marks = re.compile(b"|".join(re.escape(m.encode()) for m in marks) or b"(?!)")
        self.kind = np.dtype(np.uint16 if max(self.library.get_vocab().values()) < 1 << 16 else np.uint32)
        self.end = np.array([END_ID], self.kind).tobytes()
        self.tokens: dict[str, bytes] = {}  # the ids of pre-tokens met lately
        self.known: dict[str, bytes] = {}  # and from before them
        self.model = self.library.model
        of_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_level = {ord(c): of_bytes.pre_tokenize_str(c)[0][0] for c in _LOW}

    def _ids(self, tokens: list[str]) -> list[bytes]:
        """The ids of different pre-tokens."""
        if len(self.tokens) > REMEMBERED:
            self.known = dict(islice(self.tokens.items(), REMEMBERED))  # frequent ones come early
            self.tokens = {}
        found = list(map(self.tokens.get, tokens))
        absent = [i for i, x in enumerate(found) if x is None]
        new = []
        for i in absent:
            found[i] = self.known.get(tokens[i])
            if found[i] is None:
                new.append(i)
        ids, ends = [], [0]
        for i in new:
            ids.extend([x.id for x in self.model.tokenize(tokens[i].translate(self.byte_level))])
            ends.append(len(ids) * self.kind.itemsize)
        raw = np.array(ids, self.kind).tobytes()
        for i, a, b in zip(new, ends, ends[1:]):
            found[i] = raw[a:b]
        self.tokens.update(zip([tokens[i] for i in absent], [found[i] for i in absent]))
        return found

    def _odd(self, texts: pa.LargeStringArray) -> np.ndarray:
        """Whether a text has characters (not below U+0180, or U+0130) or marks that the rules
        written out here are not for."""
        if not self.by_rules:
            return np.ones(len(texts), bool)
        ends, raw = _bytes(texts)
        at = [np.flatnonzero(raw >= 0xC6), np.flatnonzero((raw[:-1] == 0xC4) & (raw[1:] == 0xB0)),
              np.array([m.start() for m in self.marks.finditer(raw)], np.int64)]
        odd = np.zeros(len(texts), bool)
        odd[np.searchsorted(ends, np.concatenate(at), side="right") - 1] = True
        return odd

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (null: empty), END_ID after each, and where each text's ids end."""
        column = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        column = column.fill_null("")
        odd = self._odd(column)
        cut, upto = pretokens(pc.utf8_lower(column.filter(pa.array(~odd))))
        cut = cut.dictionary_encode()
        ids = self._ids(cut.dictionary.to_numpy(zero_copy_only=False).tolist())
        ends, raw = _bytes(pa.array(ids, pa.large_binary()).take(cut.indices))
        ends, raw = [0, *ends[upto].tolist()], raw.tobytes()
        simple = (raw[a:b] for a, b in zip(ends, ends[1:]))
        whole = (self.library.encode(t, add_special_tokens=False).ids for t in column.filter(pa.array(odd)).to_pylist())
        parts = [np.array(next(whole), self.kind).tobytes() if x else next(simple) for x in odd.tolist()]
        sizes = [len(p) // self.kind.itemsize + 1 for p in parts]
        joined = b"".join([x for p in parts for x in (p, self.end)])
        return np.frombuffer(joined, self.kind), np.cumsum(sizes, dtype=np.int64)


_ENCODERS: dict[bytes, Encoder] = {}


def encoder(model: bytes) -> Encoder:
    """The worker's encoder, kept between tasks."""
    if model not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[model] = Encoder(model)
    return _ENCODERS[model]


# --- tables -------------------------------------------------------------------

NO_ID = -(1 << 63)  # stands for a missing doc_id in a file


def write_shards(docs: DataFrame, model: bytes) -> DataFrame:
    """The stored table of shards: part, shard (its order within the part), n_docs, n_tokens
    and file. Parts and shards ascend with doc_id."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # a vocabulary file, of fixed size

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard = TaskContext.get().partitionId(), 0
        ids, sizes, docs, held = [], [], [], 0

        def close() -> pa.RecordBatch:
            whole = np.concatenate(ids)
            whole = whole.astype(np.uint16 if whole.max() < 1 << 16 else np.uint32, copy=False)
            names = np.concatenate(docs)
            file = WaveletMatrix.build(whole, names, np.cumsum(np.concatenate(sizes))).to_bytes()
            return pa.RecordBatch.from_pydict({"part": [part], "shard": [shard], "n_docs": [len(names)],
                                               "n_tokens": [len(whole)], "file": [file]}, _SHARDS)

        for batch in batches:
            for rows in text_slices(batch, "text"):
                coded, ends = encoder(shipped.value).encode(rows.column("text"))
                names = rows.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
                begin, done = 0, 0  # documents, and their ids, that are in a shard
                while begin < len(names):
                    end = min(int(np.searchsorted(ends, done + SHARD_TOKENS - held)) + 1, len(names))
                    ids.append(coded[done:ends[end - 1]])
                    sizes.append(np.diff(ends[begin:end], prepend=done))
                    docs.append(names[begin:end])
                    held += len(ids[-1])
                    begin, done = end, int(ends[end - 1])
                    if held >= SHARD_TOKENS:
                        yield close()
                        ids, sizes, docs, held, shard = [], [], [], 0, shard + 1
        if ids:
            yield close()

    in_order = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                .repartitionByRange("doc_id").sortWithinPartitions("doc_id"))
    return stored(in_order.mapInArrow(pack, "part int, shard int, n_docs long, n_tokens long, file binary"))


_SHARDS = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()),
                     ("file", pa.binary())])
_READ = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("doc_id", pa.int64()), ("begin", pa.int64()),
                   ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read_documents(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, decoded from the files."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, file in zip(*(batch.column(i).to_pylist() for i in range(3))):
                matrix = WaveletMatrix.from_bytes(file)
                raw = matrix.decode().astype("<u4").tobytes()
                ends = matrix.ends.tolist()
                begins = [0, *ends][:-1]
                docs = matrix.docs
                yield pa.RecordBatch.from_arrays([
                    pa.array([part] * len(ends), pa.int32()), pa.array([shard] * len(ends), pa.int32()),
                    pa.array(docs, mask=docs == NO_ID), pa.array(begins, pa.int64()),
                    pa.array([e - b for b, e in zip(begins, ends)], pa.int64()),
                    pa.array([zlib.crc32(raw[4 * b:4 * e]) for b, e in zip(begins, ends)], pa.int64())], schema=_READ)

    read = shards.select("part", "shard", "file").mapInArrow(
        unpack, "part int, shard int, doc_id long, begin long, n_tokens long, ids_crc32 long")
    # ids before each part (a row for each task that wrote), then before each shard of a part
    sizes = shards.select("part", "shard", "n_tokens")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before_part"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.withColumn("before", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(parts, "part").select(
        "part", "shard", (F.col("before") + F.col("before_part")).alias("first"))
    return read.join(firsts, ["part", "shard"]).select(
        "doc_id", (F.col("first") + F.col("begin")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, model: bytes) -> DataFrame:
    """Write the shards of ``docs`` (doc_id, text) and read every document back."""
    return read_documents(write_shards(docs, model))
