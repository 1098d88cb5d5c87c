from __future__ import annotations

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from logtide.llm import pii, sentencepiece_codec, token_store
from logtide.llm.queries import QUERIES, vocabulary

from . import cases

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"


# --- personal data ------------------------------------------------------------

def plain_spans(text: str) -> list[tuple[int, int, int]]:
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()][::-1]
        if 12 <= len(d) <= 19 and sum(d[::2]) % 10 == -sum(2 * x - 9 * (x > 4) for x in d[1::2]) % 10:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


@pytest.mark.parametrize("letters", ["a.@-b1 ", "0123456789. ", "01 -+(.)5", "ab@..@c+%", "é9. +1"])
def test_detectors_equal_the_patterns(letters):
    r = random.Random(7)
    for _ in range(5000):
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 40)))
        assert pii.detect(text) == plain_spans(text), text


@pytest.mark.parametrize("text, kind, found", [
    ("mail john (at) example (dot) com now", "email", "john (at) example (dot) com"),
    ("john dot smith at example dot co dot uk!", "email", "john dot smith at example dot co dot uk"),
    ("usеr@exаmple.com x", "email", "usеr@exаmple.com"),
    ("j​oe@ex​ample.com", "email", "j​oe@ex​ample.com"),
    ("ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ", "email", "ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("joe [@] example [.] org", "email", "joe [@] example [.] org"),
    ("plus one five five five one two three four five six seven", "phone", "plus one five five five one two three four five six seven"),
    ("pay four" + " one" * 15 + " ok", "card", "four" + " one" * 15),
    ("pay 4111–1111–1111–1111", "card", "4111–1111–1111–1111"),
    ("é one nine two dot one six eight dot zero dot one", "ip", "one nine two dot one six eight dot zero dot one"),
])
def test_disguises_are_mapped_back(text, kind, found):
    spans = pii.spans_of(text)
    assert [(s["kind"], text[s["start"]:s["end"]], s["base"]) for s in spans if not s["base"]] == [(kind, found, False)]
    assert f"[{kind.upper()}]" in pii.redacted(text) and found not in pii.redacted(text)


@pytest.mark.parametrize("text, kind, found", [
    ("call plus 49 30 12345678 now", "phone", "plus 49 30 12345678"),
    ("pay 4111 1111 1111 111 one", "card", "4111 1111 1111 111 one"),
    ("host 192.168.1.one", "ip", "192.168.1.one"),
])
def test_lone_disguises_are_found(text, kind, found):
    assert [(s["kind"], text[s["start"]:s["end"]]) for s in pii.spans_of(text) if not s["base"]] == [(kind, found)]


def test_gate_hides_nothing(monkeypatch):
    r = random.Random(14)
    parts = ("plus one two double zero dot at (at) [dot] < . > @ joe example com 4111 1111 111 192.168.1. 49 + - , x é\n . \t"
             .split(" ") + [" "] * 12)
    texts = ["".join(r.choice(parts) for _ in range(r.randint(2, 14))) for _ in range(20_000)]
    texts += ["plus 49 30 12345678", "pay 4111 1111 1111 111 one", "host 192.168.1.one", "PLUS\t1 555 123 4567"]
    gated = [pii.disguised(t, pii.detect(t)) for t in texts]
    monkeypatch.setattr(pii, "CUE", pii.re.compile(""))
    assert gated == [pii.disguised(t, pii.detect(t)) for t in texts] and any(gated)


@pytest.mark.parametrize("text", ["meet me at example.com", "look at the dot on it", "one two three", "double four one one",
                                  "the red dot is at home", "née à (at) la", "one (1) two", ""])
def test_clean_text_stays(text):
    assert pii.spans_of(text) == [] and pii.redacted(text) == text


@pytest.mark.parametrize("unit", ["a", "1", "1.", "@", "one ", "( ", "a@", "+", "1 ", " ", "+1(", "dot "])
def test_long_runs_take_linear_time(unit):
    begun = time.process_time()
    pii.spans_of(unit * (200_000 // len(unit)))
    assert time.process_time() - begun < 5


def test_overlaps_are_redacted_once():
    assert pii.redacted("x a@1.2.3.4 y 1.2.3.4") == "x [EMAIL] y [IP]"
    assert pii.redacted("4111 1111 1111 1111.2.3.4") == "[CARD].2.3.4"  # 1111 is no part of an address


def test_pii_query_equals_the_plain_version(spark):
    for df, texts in ((spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), None), (cases.documents(spark), cases.texts())):
        got = pii.digests(df).collect()
        plain = {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}
        assert len(got) == df.count()
        for r in got:
            if r.doc_id is None:
                continue
            want = plain_spans(plain[r.doc_id] or "")
            joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in want)
            assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(x[1] == i for x in want) for i in range(4)]
            assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest() and set(joined.split(",")) <= {*r.spans.split(","), ""}
    assert pii.digests(cases.nothing(spark)).collect() == []


def test_redact_keeps_columns_and_nulls(spark):
    docs = cases.documents(spark)
    got = pii.redact(docs, "text")
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect() if r.doc_id} == {i: t for i, t, _ in cases.texts() if i}


# --- sentencepiece ------------------------------------------------------------

def test_agenda_equals_the_library():
    codec = sentencepiece_codec.Codec(vocabulary(PIECES))
    r = random.Random(8)
    letters = "  \t\n▁abcdeothing.,<>0x日é𝔘​/s"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 80))) for _ in range(4000)]
    texts += ["", " ", "▁", "a" * 5000, " " * 5000, "<0x0A>", "\x00a", "<unk><s></s>", "ab" * 3000]
    assert [codec.encode(t) for t in texts] == codec.library.encode(texts)
    for t in texts[:500]:
        for s in sentencepiece_codec.SEGMENT.findall(sentencepiece_codec.SPACE + t):
            pairs = [codec.scores.get(s[i:i + 2], sentencepiece_codec.NEVER) for i in range(len(s) - 1)]
            assert codec._joined_short(s, pairs) == codec._joined_long(s)


def test_agendas_of_a_batch_together(monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "COLUMNS", 300)  # several groups of columns
    codec = sentencepiece_codec.Codec(vocabulary(PIECES))
    r = random.Random(18)
    letters = "  \t\n▁abcdeothing.,<>0x日é𝔘​/s"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 120))) for _ in range(3000)]
    texts += ["", " ", "▁", " a", "a ", "  a  b", "▁ a▁", "a" * 47, "a" * 48, "b" * 49, "日" * 200, "é日" * 40, " " * 60 + "x", "<s>"]
    for batch in (texts, texts[::-1], [], [""]):
        ids, ends = codec.encode_all(batch)
        assert [x.tolist() for x in np.split(ids, ends)[:-1]] == codec.library.encode(batch)


def test_new_segments_cost_little_over_the_library():
    codec = sentencepiece_codec.Codec(vocabulary(PIECES))
    r = random.Random(19)
    texts = [" ".join("".join(r.choice("etaoinshr") for _ in range(r.randint(6, 12))) for _ in range(200)) for _ in range(200)]
    began = time.process_time()
    ids, _ = codec.encode_all(texts)
    own = time.process_time() - began
    assert ids.tolist() == sum(codec.library.encode(texts, num_threads=1), [])
    began = time.process_time()
    codec.library.encode(texts, num_threads=1)
    assert own < 3 * (time.process_time() - began)  # 40,000 agendas one after the other take five times as long


def test_memory_of_segments_is_bounded(monkeypatch):
    monkeypatch.setattr(sentencepiece_codec, "REMEMBERED", 50)
    codec = sentencepiece_codec.Codec(vocabulary(PIECES))
    for i in range(200):
        text = cases.sentence(i, 10)
        assert codec.encode(text) == codec.library.encode(text)
        assert len(codec) <= 200


def test_sentencepiece_query_equals_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_proto=vocabulary(PIECES))
    for df in (spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), cases.documents(spark)):
        plain = {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}
        got = sentencepiece_codec.digests(df, vocabulary(PIECES)).collect()
        assert len(got) == df.count()
        for r in got:
            if r.doc_id is not None:
                ids = sp.encode(plain[r.doc_id])
                assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()
    assert sentencepiece_codec.digests(cases.nothing(spark), vocabulary(PIECES)).collect() == []


def test_encode_replaces_clashing_names(spark):
    df = sentencepiece_codec.encode_decode(cases.documents(spark), "text", vocabulary(PIECES))
    assert df.columns.count("ids") == 1 and df.filter("doc_id = 63").first().decoded == "one two three"
    assert df.filter("doc_id = 60").first().ids == []


# --- token store --------------------------------------------------------------

def test_encoder_equals_the_library():
    e = token_store.Encoder(vocabulary(WORDS))
    r = random.Random(9)
    letters = "".join(map(chr, range(0x180))) + "   aabbce''stdrvml!!<|>-é１日̈Σσ​"
    texts = ["".join(r.choice(a) for _ in range(r.randint(0, 40))) for a in (letters, "ab'stdrevlm <|!9 é") for _ in range(3000)]
    texts += ["<|endoftext|> a", "x<|startoftext|>", "İ", "'S 'RE", "", ""]
    ids, ends = e.encode(texts)
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [
        e.library.encode(t, add_special_tokens=False).ids + [token_store.END_ID] for t in texts]
    assert e.encode([])[1].tolist() == []


def test_encoder_cuts_words_where_the_rules_do(monkeypatch):
    e = token_store.Encoder(vocabulary(WORDS))
    r = random.Random(20)
    pieces = ["it's", "'S", "a,b", "...", "1984", "ªº", "ÿ÷", "\x1c", "a\x1db", "\x1e", "x\x1f", "\x85", "\xa0", "\x7f", "\x00", "é!", "'", "日", "é", "<|", "ab"]
    texts = [r.choice(["", " ", "\n"]).join(r.choice(pieces) for _ in range(r.randint(0, 12))) for _ in range(3000)]
    want = [e.library.encode(t, add_special_tokens=False).ids + [token_store.END_ID] for t in texts]
    for _ in range(2):  # new, then remembered
        ids, ends = e.encode(texts)
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == want
    monkeypatch.setattr(token_store, "REMEMBERED", 50)
    for t, w in zip(texts[:300], want):
        assert e.encode([t])[0].tolist() == w and len(e.known) <= 100 and len(e.tokens) <= 100


def test_remembered_words_cost_little():
    e = token_store.Encoder(vocabulary(WORDS))
    r = random.Random(21)
    words = ["".join(r.choice("etaoinshr") for _ in range(r.randint(3, 9))) + r.choice(["", "", ",", "."]) for _ in range(3000)]
    texts = [" ".join(r.choices(words, k=1000)) for _ in range(400)]
    e.encode(texts)
    spent = []
    for work in (lambda: e.encode(texts), lambda: [token_store.PRETOKEN.findall(t) for t in texts]):
        began = time.process_time()
        work()
        spent.append(time.process_time() - began)
    assert spent[0] < spent[1]  # less than cutting the texts by the rules, which it did before


@pytest.mark.parametrize("letters", ["'stdrevlm a", "''aé5 .\n", "".join(map(chr, range(0x180)))])
def test_pretokens_are_those_of_the_pattern(letters):
    r = random.Random(22)
    texts = ["".join(r.choice(letters) for _ in range(r.randint(0, 30))).replace("İ", "").lower() for _ in range(5000)] + ["'", "s", "'r", "e", "x'", ""]
    for part in (texts, texts[:1], [""], []):
        found, upto = token_store.pretokens(pa.array(part, pa.large_string()))
        assert found.to_pylist() == [t for x in part for t in token_store.PRETOKEN.findall(x)]
        assert np.diff(upto, prepend=0).tolist() == [len(token_store.PRETOKEN.findall(x)) for x in part]


def test_frequent_pretokens_are_encoded_once(monkeypatch):
    monkeypatch.setattr(token_store, "REMEMBERED", 600)
    e = token_store.Encoder(vocabulary(WORDS))
    model, asked = e.model, []
    e.model = type("Counted", (), {"tokenize": lambda _, t: asked.append(t) or model.tokenize(t)})()
    r = random.Random(23)
    often = ["".join(r.choice("etaoin") for _ in range(9)) for _ in range(200)]
    for i in range(30):
        seldom = ["zq" + "".join(r.choice("hrdlu") for _ in range(12)) for _ in range(200)]
        text = " ".join(w + end for w in often + seldom for end in ("", ",", "...", "'s"))
        got, _ = e.encode([text])
        assert got.tolist() == [*e.library.encode(text, add_special_tokens=False).ids, token_store.END_ID]
    assert len([t for t in asked if t in set(often)]) == len(set(often))


def test_shards_are_closed_at_documents(spark, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_TOKENS", 100)
    docs = spark.createDataFrame([(i, "word " * (i % 7 * 20)) for i in range(50)], "doc_id long, text string").coalesce(1)
    shards = token_store.write_shards(docs, vocabulary(WORDS))
    rows = shards.collect()
    assert sum(r.n_docs for r in rows) == 50 and max(r.n_tokens for r in rows) < 100 + 121
    last = {max(r.shard for r in rows if r.part == p) for p in {r.part for r in rows}}
    assert all(r.n_tokens >= 100 or r.shard in last for r in rows)
    got = sorted(token_store.read_documents(shards).collect())
    assert [r.n_tokens for r in got] == [i % 7 * 20 + 1 for i in range(50)]
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]


@pytest.mark.parametrize("n", [0, 1, 7, 64, 511, 512, 513, 5000])
@pytest.mark.parametrize("top", [1, 2, 50, 70_000])
def test_wavelet_matrix(n, top):
    r = np.random.default_rng(n + top)
    a = r.integers(0, top, n).astype(np.uint16 if top < 1 << 16 else np.uint32)
    built = token_store.WaveletMatrix.build(a, np.array([5]), np.array([n]))
    w = token_store.WaveletMatrix.from_bytes(built.to_bytes())
    assert (w.decode() == a).all() and w.docs.tolist() == [5] and w.ends.tolist() == [n]
    for i in r.integers(0, n, 10).tolist() if n else []:
        t = int(a[i])
        assert w.access(i) == t and w.rank(t, i) == (a[:i] == t).sum()
        assert w.select(t, w.rank(t, i)) == i
    assert w.rank(1 << 20, n) == 0 and w.select(0, n) == -1


def test_token_store_query_equals_the_library(spark, monkeypatch):
    library = Tokenizer.from_str(vocabulary(WORDS).decode())
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    got = {r.doc_id: r for r in QUERIES["op10_token_store"](spark, "/root/testdata/sf0.001").collect()}
    start = 0
    for i, t in rows:
        ids = library.encode(t, add_special_tokens=False).ids + [1]
        assert (got[i].start, got[i].n_tokens) == (start, len(ids))
        assert got[i].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_token_store_with_odd_rows(spark):
    docs = cases.documents(spark)
    shards = token_store.write_shards(docs, vocabulary(WORDS))
    got = token_store.read_documents(shards).collect()
    assert len(got) == len(cases.texts()) and sum(r.doc_id is None for r in got) == 2
    runs = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(runs, runs[1:])) and runs[0][0] == 0
    in_order = [r.doc_id for r in sorted(got, key=lambda r: r.start) if r.doc_id is not None]
    assert in_order == sorted(in_order)
    assert {r.n_tokens for r in got if r.doc_id in (60, 61, 62)} == {1}
    assert token_store.round_trip(cases.nothing(spark), vocabulary(WORDS)).collect() == []
