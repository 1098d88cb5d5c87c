"""Cross-tokenizer alignment: which tokens of one vocabulary stand where those of another do.

Every text is encoded by A (byte-level merges) and B (a piece model). The byte offsets where
tokens of both end cut them into groups; an A and a B token of one group are linked. How many
documents hold a pair of ids linked says how well the two ids translate each other.

Most groups are one A token and one B token of the same bytes. An array from each A id to the
B id of its bytes recognises them, and vectors as long as A's vocabulary count them, so they
are never pairs: only the other, irregular groups' pairs are shuffled to be counted. Scoring works
the same way: the vectors, and the FREQUENT pairs that most documents hold, are looked up in
arrays of bounded size; the links of rarer pairs are joined to their counts. Whatever pair the corpus
is full of is among the frequent ones, so the join has no hot key. All counts are exact.

A's ids are those of its library. Where the two libraries' rules for cutting words agree for
certain (characters below U+0250, no endless words), a faster one makes them: merging by rank
equals merging by A's list of merges if that list turns every token's own bytes into the token, which is
checked for the whole vocabulary on the driver.

Defined results: a text that is null or empty, or that either tokenizer doesn't give back
byte by byte, has no tokens, groups or links. Repeated rows and repeated texts count as documents of
their own. Ties for the highest count are all best. An empty table gives an empty table. A
group of x and y tokens has x times y links, but each pair of ids in it is one entry with the
number of its links; a text's memory grows with its distinct pairs. Of other columns only
``keep`` is carried; results replace columns of the same name.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, stored

#: Fixed value: how byte-level BPE cuts a text into words.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts that the library itself encodes: characters from U+0250, or a run without a change of kind.
OTHER = re.compile("[^\x00-ɏ]|[^\\s]{400}|\\s{400}")
#: Pairs whose counts are looked up in arrays; links that are spread out at once.
FREQUENT = 1 << 18
SPREAD = 1 << 20


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable Latin-1 ones for
    themselves, U+0100 and up for the others in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def same_by_rank(spec: bytes) -> bool:
    """Whether merging by rank (a token's id) gives what merging by the file's list does: every
    token's bytes become the token, and the list is in the order of the ids."""
    content = json.loads(spec)
    vocabulary, merges = content["model"]["vocab"], content["model"]["merges"]
    made = [vocabulary.get("".join(m if isinstance(m, list) else m.split(" "))) for m in merges]
    model = tokenizers.Tokenizer.from_str(spec.decode()).model
    special = {t["content"] for t in content["added_tokens"]}
    return (None not in made and made == sorted(made)
            and all([x.id for x in model.tokenize(t)] == [i] for t, i in vocabulary.items() if t not in special))


class Tokenizers:
    """A and B with the bytes of their tokens."""

    def __init__(self, a: bytes, b: bytes, by_rank: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        self.a = tokenizers.Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        special = {t["content"] for t in json.loads(a)["added_tokens"]}
        known, value = self.a.get_vocab(), byte_characters()
        self.a_bytes = [b""] * (max(known.values()) + 1)
        for t, i in known.items():
            self.a_bytes[i] = t.encode() if t in special else bytes(value[c] for c in t)
        ids = range(self.b.get_piece_size())
        pieces = [self.b.id_to_piece(i) for i in ids]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in zip(ids, pieces)]
        plain = {self.b_bytes[i]: i for i in reversed(ids) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))}
        single = {self.b_bytes[i]: i for i in ids if self.b.is_byte(i)}
        #: The B id of an A id's bytes, or -1.
        self.same = np.array([plain.get(x, single.get(x, -1)) for x in self.a_bytes], np.int64)
        self.fast = tiktoken.Encoding("A", pat_str=WORDS, special_tokens={}, mergeable_ranks={
            self.a_bytes[i]: i for t, i in known.items() if t not in special}) if by_rank else None
        self.a_table, self.b_table = pa.array(self.a_bytes, pa.binary()), pa.array(self.b_bytes, pa.binary())
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        #: An id's text within its group and at the end of its side: A's ids, then B's.
        self.texts = pa.array([f"{i}{c}" for i in range(len(self.a_bytes)) for c in ",|"]
                              + [f"{i}{c}" for i in ids for c in ",;"], pa.string())

    def encode_a(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        if self.fast is not None:
            for i, t in enumerate(texts):
                if not OTHER.search(t):
                    out[i] = self.fast.encode_to_numpy(t, disallowed_special=())
        left = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(left, self.a.encode_batch_fast([texts[i] for i in left], add_special_tokens=False)):
            out[i] = np.array(e.ids, np.uint32)
        return out


_MADE: dict[bytes, Tokenizers] = {}


def made(a: bytes, b: bytes, by_rank: bool) -> Tokenizers:
    """The worker's tokenizers, kept between tasks."""
    key = hashlib.sha256(a + b + bytes([by_rank])).digest()
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = Tokenizers(a, b, by_rank)
    return _MADE[key]


def _joined(table: pa.Array, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The table's entries of the ids, joined for each text; ``ends``: where its ids end, 0 first."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), table.take(pa.array(ids))), _empty(table))


def _empty(table: pa.Array) -> pa.Scalar:
    return pa.scalar(b"" if pa.types.is_binary(table.type) else "", table.type)


def _lists(values: np.ndarray, owner: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """For each of n owners the list of its values; owners ascend."""
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _summed(keys: list[np.ndarray], numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and the sums of their numbers."""
    key, place = np.unique(np.concatenate(keys or [np.zeros(0, np.int64)]), return_inverse=True)
    total = np.zeros(len(key), np.int64)
    np.add.at(total, place, np.concatenate(numbers or [np.zeros(0, np.int64)]))
    return key, total


def _spread(a: np.ndarray, b: np.ndarray, a_first: np.ndarray, b_first: np.ndarray, na: np.ndarray, nb: np.ndarray,
            doc: np.ndarray, width: int, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """The links of groups (first tokens and numbers of tokens on both sides, document) as distinct
    keys ``doc * wide + a * width + b`` with their numbers, SPREAD links or distinct pairs at a time."""
    keys, numbers = [], []

    def flush(key: np.ndarray, n: np.ndarray | None = None) -> None:
        if n is None:
            k, c = np.unique(key, return_counts=True)
        else:
            k, c = key, n
        keys.append(k)
        numbers.append(c.astype(np.int64))
        if len(keys) > 64:
            keys[:], numbers[:] = ([x] for x in _summed(keys, numbers))

    links = na * nb
    large = links > SPREAD
    for g in np.flatnonzero(large).tolist():
        xs, xn = np.unique(a[a_first[g]:a_first[g] + na[g]], return_counts=True)
        ys, yn = np.unique(b[b_first[g]:b_first[g] + nb[g]], return_counts=True)
        step = max(1, SPREAD // len(ys))
        for i in range(0, len(xs), step):
            flush((doc[g] * wide + xs[i:i + step, None] * width + ys).ravel(), (xn[i:i + step, None] * yn).ravel())
    small = np.flatnonzero(~large)
    before = np.concatenate([[0], np.cumsum(links[small])])
    begin = 0
    while begin < len(small):
        end = max(begin + 1, int(np.searchsorted(before, before[begin] + SPREAD, side="right")) - 1)
        part = small[begin:end]
        each = np.repeat(part, links[part])
        at = np.arange(len(each)) - np.repeat(before[begin:end] - before[begin], links[part])
        flush(doc[each] * wide + a[a_first[each] + at // nb[each]] * width + b[b_first[each] + at % nb[each]])
        begin = end
    return _summed(keys, numbers)


COLUMNS = ("n_a long, n_b long, n_groups long, n_links long, groups string, "
           "same array<int>, same_links array<long>, pairs array<long>, pair_links array<long>")


def align_texts(t: Tokenizers, texts: list[str], detail: bool) -> list[pa.Array]:
    """COLUMNS of the texts. ``groups``: ``a1,a2|b1;a3|b2,b3``, or its sha256; ``same``: the
    distinct A ids linked with the B id of their bytes; ``pairs``: the other linked pairs of ids, a * |B| + b;
    and how often each is linked."""
    n = len(texts)
    fronted = [" " + x if x else "" for x in texts]
    of_a = t.encode_a(fronted)
    of_b = [np.array(x, np.int64) for x in t.b.encode(texts, num_threads=1)] if n else []

    def flat(ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        ends = np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)])
        return np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int64), ends

    (a, a_ends), (b, b_ends) = flat(of_a), flat(of_b)
    whole = [x.encode() for x in fronted]
    kept = [x and x == y == z for x, y, z in zip(whole, _joined(t.a_table, a, a_ends).to_pylist(),
                                                 _joined(t.b_table, b, b_ends).to_pylist())]
    if not all(kept):
        none = np.zeros(0, np.int64)
        (a, a_ends), (b, b_ends) = (flat([x if k else none for x, k in zip(ids, kept)]) for ids in (of_a, of_b))

    # texts lie one after the other, and both sides have the same bytes
    a_stop, b_stop = np.cumsum(t.a_size[a]), np.cumsum(t.b_size[b])
    a_cut = np.isin(a_stop, b_stop, assume_unique=True)
    b_cut = np.isin(b_stop, a_stop, assume_unique=True)
    a_last, b_last = np.flatnonzero(a_cut), np.flatnonzero(b_cut)
    a_first, b_first = (np.concatenate([[0], x[:-1] + 1]) if len(x) else x for x in (a_last, b_last))
    na, nb = a_last + 1 - a_first, b_last + 1 - b_first
    doc = np.searchsorted(a_ends, a_last, side="right") - 1

    # the text of the groups: each side's ids go behind the other side's of the groups before
    order = np.empty(len(a) + len(b), np.int64)
    a_group, b_group = (np.repeat(np.arange(len(x)), x) for x in (na, nb))
    order[np.arange(len(a)) + b_first[a_group]] = 2 * a + a_cut
    order[np.arange(len(b)) + a_last[b_group] + 1] = 2 * len(t.a_bytes) + 2 * b + b_cut
    text = [x[:-1] for x in _joined(t.texts, order, a_ends + b_ends).to_pylist()]
    if not detail:
        text = [hashlib.sha256(x.encode()).hexdigest() if x else "" for x in text]

    single = (na == 1) & (nb == 1)
    alike = single.copy()
    alike[single] = t.same[a[a_first[single]]] == b[b_first[single]]
    width = len(t.b_bytes)
    wide = len(t.a_bytes) * width
    rest = ~alike
    key, links = _spread(a, b, a_first[rest], b_first[rest], na[rest], nb[rest], doc[rest], width, wide)
    pair = key % wide
    also = t.same[pair // width] == pair % width  # the same bytes, but in an irregular group
    same, same_links = _summed([doc[alike] * wide + a[a_first[alike]], key[also] // wide * wide + pair[also] // width],
                               [np.ones(int(alike.sum()), np.int64), links[also]])
    own = ~also
    return [pa.array(np.diff(a_ends)), pa.array(np.diff(b_ends)), pa.array(np.bincount(doc, minlength=n)),
            pa.array(np.bincount(doc, na * nb, minlength=n).astype(np.int64)), pa.array(text, pa.string()),
            _lists(same % wide, same // wide, n, pa.int32()), _lists(same_links, same // wide, n, pa.int64()),
            _lists(pair[own], key[own] // wide, n, pa.int64()), _lists(links[own], key[own] // wide, n, pa.int64())]


def align(df: DataFrame, column: str, a: bytes, b: bytes, keep: list[str] | None = None, detail: bool = True) -> DataFrame:
    """``keep`` (all columns by default) and COLUMNS of the text column; without ``detail``, ``groups``
    is the sha256 of the text. ``a``, ``b``: content of A's JSON file and B's model file."""
    shipped = df.sparkSession.sparkContext.broadcast((a, b, same_by_rank(a)))  # vocabulary files, of fixed size
    return map_texts(df, column, df.columns if keep is None else keep, COLUMNS,
                     lambda texts: align_texts(made(*shipped.value), texts, detail))


def same_counts(aligned: DataFrame, size: int) -> DataFrame:
    """(a, n): documents that link A id ``a`` with the B id of its bytes; a vector a task, ``size`` rows at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["a", "n"])

    return aligned.select("same").mapInArrow(count, "a int, n long").groupBy("a").agg(F.sum("n").alias("n"))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): documents that link each other pair."""
    return aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))


def _vector(rows: DataFrame, size: int) -> np.ndarray:
    """(a, n) as a vector: at most a row for each A id."""
    table = rows.toArrow()
    out = np.zeros(size, np.int64)
    out[table.column("a").to_numpy()] = table.column("n").to_numpy()
    return out


def _frequent_from(pairs: DataFrame) -> int:
    """The least power of two for which FREQUENT pairs at most have so many documents."""
    rows = pairs.groupBy(F.length(F.bin("n")).alias("bits")).agg(F.count(F.lit(1)).alias("pairs")).collect()  # 63 at most
    held, bits = 0, 63
    for r in sorted(rows, reverse=True):
        held += r.pairs
        if held > FREQUENT:
            break
        bits = r.bits
    return 1 << (bits - 1)


def score(aligned: DataFrame, a_ids: int, b_ids: int) -> tuple[DataFrame, DataFrame]:
    """``aligned``, stored and with a unique long ``_row``: without its lists, but with ``n_best`` (links
    whose pair most documents hold among the pairs of its A id) and ``count_sum``; and the table
    of pairs (pair, n, best) that are not of the same bytes."""
    spark = aligned.sparkSession
    same = _vector(same_counts(aligned, a_ids), a_ids)
    counted = stored(pair_counts(aligned))
    highest = _vector(counted.groupBy((F.col("pair") / F.lit(b_ids)).cast("int").alias("a")).agg(F.max("n").alias("n")), a_ids)
    highest = np.maximum(highest, same)
    limits = spark.createDataFrame(pa.table({"a": np.arange(a_ids, dtype=np.int32), "most": highest}))
    pairs = (counted.join(F.broadcast(limits), (F.col("pair") / F.lit(b_ids)).cast("int") == F.col("a"))  # a row for each A id
             .select("pair", "n", (F.col("n") == F.col("most")).alias("best")))
    least = _frequent_from(counted)
    held = counted.filter(F.col("n") >= least).orderBy("pair").toArrow()  # FREQUENT at most
    shipped = spark.sparkContext.broadcast((same, highest, held.column("pair").to_numpy(), held.column("n").to_numpy()))
    kept = [c for c in aligned.columns if c not in ("same", "same_links", "pairs", "pair_links")]
    lists = pa.list_(pa.int64())

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same, highest, known, numbers = shipped.value
        for batch in batches:
            n = batch.num_rows

            def of(name: str) -> tuple[np.ndarray, np.ndarray]:
                c = batch.column(name)
                lengths = pc.list_value_length(c).to_numpy(zero_copy_only=False)
                return c.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(n), lengths)

            a, owner = of("same")
            links = of("same_links")[0]
            pair, doc = of("pairs")
            pair_links = of("pair_links")[0]
            at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            found = numbers[at[hit]] if len(known) else np.zeros(0, np.int64)

            def total(*parts: tuple[np.ndarray, np.ndarray]) -> pa.Array:
                out = np.zeros(n, np.int64)
                for where, x in parts:
                    np.add.at(out, where, x)
                return pa.array(out)

            best_same = same[a] == highest[a]
            best_pair = found == highest[pair[hit] // b_ids]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept),
                 total((owner, links * same[a]), (doc[hit], pair_links[hit] * found)),
                 total((owner[best_same], links[best_same]), (doc[hit][best_pair], pair_links[hit][best_pair])),
                 _lists(pair[~hit], doc[~hit], n, pa.int64()).cast(lists), _lists(pair_links[~hit], doc[~hit], n, pa.int64()).cast(lists)],
                names=[*kept, "_sum", "_best", "_pairs", "_links"])

    added = "_sum long, _best long, _pairs array<long>, _links array<long>"
    looked = stored(aligned.mapInArrow(look, T.StructType(list(aligned.select(*kept).schema) + list(T.StructType.fromDDL(added)))))
    rare = (looked.select("_row", F.explode(F.arrays_zip("_pairs", "_links")).alias("x"))
            .select("_row", F.col("x._pairs").alias("pair"), F.col("x._links").alias("links"))
            .join(pairs.filter(F.col("n") < least), "pair")
            .groupBy("_row").agg(F.sum(F.col("links") * F.col("n")).alias("_more"),
                                 F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("_more_best")))
    out = looked.join(rare, "_row", "left").select(
        *kept, (F.col("_best") + F.coalesce("_more_best", F.lit(0))).alias("n_best"),
        (F.col("_sum") + F.coalesce("_more", F.lit(0))).alias("count_sum"))
    return out, pairs


def align_documents(docs: DataFrame, a: bytes, b: bytes) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    aligned = stored(align(docs.select("doc_id", "text"), "text", a, b, keep=["doc_id"], detail=False)
                     .withColumn("_row", F.monotonically_increasing_id()))
    sizes = made(a, b, False)
    scored, _ = score(aligned, len(sizes.a_bytes), len(sizes.b_bytes))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
