"""Cross-tokenizer alignment against a plain version."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
import tokenizers

from logtide.llm import alignment
from logtide.llm.queries import QUERIES, vocabulary

from . import cases

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def files():
    return vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


class Plain:
    def __init__(self, a: bytes, b: bytes):
        self.a = tokenizers.Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        plain = [c for c in range(256) if 0x21 <= c <= 0x7E or 0xA1 <= c <= 0xAC or c >= 0xAE]
        value = {chr(c): c for c in plain} | {chr(256 + i): c for i, c in enumerate(c for c in range(256) if c not in plain)}
        self.a_bytes = {i: bytes(value[c] for c in t) for t, i in self.a.get_vocab().items() if i != 50256}
        self.b_bytes = {}
        for i in range(self.b.get_piece_size()):
            p = self.b.id_to_piece(i)
            self.b_bytes[i] = bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def groups(self, text: str | None) -> list[tuple[list[int], list[int]]]:
        whole = f" {text or ''}".encode()
        a, b = (self.a.encode(f" {text}", add_special_tokens=False).ids, self.b.encode(text)) if text else ([], [])
        if not text or b"".join(map(self.a_bytes.get, a)) != whole or b"".join(map(self.b_bytes.get, b)) != whole:
            return []
        out, i, j, at_a, at_b = [([], [])], 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if at_a <= at_b and i < len(a):
                out[-1][0].append(a[i])
                at_a += len(self.a_bytes[a[i]])
                i += 1
            else:
                out[-1][1].append(b[j])
                at_b += len(self.b_bytes[b[j]])
                j += 1
            if at_a == at_b:
                out.append(([], []))
        return out[:-1]


def text_of(groups) -> str:
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def links_of(groups) -> Counter:
    return Counter((x, y) for a, b in groups for x in a for y in b)


def plain_rows(plain: Plain, rows: list[tuple]) -> Counter:
    found = [(i, plain.groups(t)) for i, t in rows]
    linked = [(i, g, links_of(g)) for i, g in found]
    count = Counter(p for _, _, links in linked for p in links)
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return Counter((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(links.values()),
                    sum(n for p, n in links.items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in links.items()),
                    hashlib.sha256(text_of(g).encode()).hexdigest() if g else "") for i, g, links in linked)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 40, 0])
def test_query_equals_the_plain_version(spark, files, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)  # with few or none, links are counted by the join
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain_rows(Plain(*files), [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert Counter(tuple(r) for r in QUERIES["op12_alignment"](spark, SF).select(*COLUMNS).collect()) == want


def test_odd_rows(spark, files):
    odd = ["<|endoftext|> and <s> are text", "a▁b is not given back", "naïve 日本語 😀", "tabs\tand\r\nlines\n\n\n", "\x00\x1f\x85\xa0", "1234567 0x" * 30]
    docs = cases.documents(spark).select("doc_id", "text").unionByName(spark.createDataFrame(list(enumerate(odd, 900)), "doc_id long, text string"))
    want = plain_rows(Plain(*files), [tuple(r) for r in docs.collect()])
    got = alignment.align_documents(docs, *files)
    assert Counter(tuple(r) for r in got.select(*COLUMNS).collect()) == want
    assert (901, 0, 0, 0, 0, 0, 0, "") in want
    assert alignment.align_documents(cases.nothing(spark), *files).count() == 0


def test_lists_and_groups_of_random_texts(files, monkeypatch):
    monkeypatch.setattr(alignment, "SPREAD", 50)  # groups and texts are larger
    plain, tools = Plain(*files), alignment.Tokenizers(*files, alignment.same_by_rank(files[0]))
    r = random.Random(3)
    low = [chr(c) for c in range(0x250)]
    texts = ["".join(r.choice(low) for _ in range(r.randint(0, 40))) for _ in range(300)]
    texts += ["".join(r.choice("ab 01\n'st") for _ in range(r.randint(0, 60))) for _ in range(300)]
    texts += [r.choice(["x", "=", "-", "\n", " ", "あ", "ab"]) * r.randint(1, 900) for _ in range(60)]
    columns = [c.to_pylist() for c in alignment.align_texts(tools, texts, True)]
    width = len(tools.b_bytes)
    for text, *_, groups, same, same_links, pairs, pair_links in zip(texts, *columns):
        want = plain.groups(text)
        assert groups == text_of(want)
        got = [((a, int(tools.same[a])), n) for a, n in zip(same, same_links)]
        got += [((p // width, p % width), n) for p, n in zip(pairs, pair_links)]
        assert len(got) == len(dict(got)) and dict(got) == links_of(want)


def test_the_fast_path_equals_the_library(files):
    assert alignment.same_by_rank(files[0])
    fast, slow = (alignment.Tokenizers(*files, x) for x in (True, False))
    r = random.Random(4)
    low = [chr(c) for c in range(0x250)]
    texts = ["".join(r.choice(low) for _ in range(r.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(r.choice("aeinrst  'lx9\n") for _ in range(r.randint(0, 300))) for _ in range(1000)]
    assert sum(alignment.OTHER.search(t) is None for t in texts) > 3900
    assert [x.tolist() for x in fast.encode_a(texts)] == [x.tolist() for x in slow.encode_a(texts)]
