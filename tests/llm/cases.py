"""Small tables and plain versions that the tests of this folder share."""

from __future__ import annotations

import hashlib
import math
import random
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: doc_id, text, lang, source, n_chars, and columns whose names the operators use themselves.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score string, _text int, fp string, k int, "
          "target string, _key int, _group int, evidence int, ids string, _doc_id int, _copies int, _place int, _clean int")


def sentence(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("aeioustrn") for _ in range(r.randint(2, 7))) for _ in range(n))


def texts() -> list[tuple]:
    """(doc_id, text, source): copies, near copies, repeats, nulls, blanks and a very long text."""
    base = sentence(1, 200)
    rows = [(i, sentence(100 + i, 30 + i), f"s{i % 3}") for i in range(30)]
    rows += [(40 + i, base, "s0") for i in range(5)]
    rows += [(50 + i, f"{base} {sentence(500 + i, 1)}", "s1") for i in range(5)]
    rows += [(60, None, "s0"), (61, "", None), (62, " \n\t ", "s2"), (63, "one two three", None), (64, "ONE two Three", "s2")]
    rows += [(70, "same row", "s1"), (70, "same row", "s1"), (None, "no id here", "s1"), (None, None, None)]
    rows += [(80, sentence(9, 30_000), "s2"), (81, "x" * 60_000, "s2")]
    return rows


def documents(spark):
    rows = [(i, t, "en" if i else None, s, len(t) if t else None, "x", 1, None, 2, "y", 3, None, 4, "z", 5, 6, 7, 8)
            for i, t, s in texts()]
    return spark.createDataFrame(rows, SCHEMA)


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def simhash(text: str | None, n: int = 4) -> int:
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(found[i:i + n]) for i in range(max(1, len(found) - n + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_components(rows: list[tuple[int, int]], distance: int = 4) -> dict[int, int]:
    """Smallest id reachable, for rows (id, fingerprint), by comparing all pairs."""
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, f) in enumerate(rows):
        for j, g in rows[n + 1:]:
            if (f ^ g).bit_count() <= distance:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i, _ in rows}


def letter_weight(text: str | None) -> float:
    visible = re.sub(r"[\x20\x09-\x0D]", "", text or "")
    return 0.25 + 0.75 * sum(c.isalpha() for c in visible) / len(visible) if visible else 0.25


def plain_mix(rows: list[tuple]) -> dict[int, tuple]:
    """doc_id -> (size, source_size, target, taken) for rows (doc_id, text, source) with distinct ids."""
    sizes = {i: len(words(t)) for i, t, _ in rows}
    names = sorted({s for _, _, s in rows if s is not None}) + ([None] if any(s is None for _, _, s in rows) else [])
    held = {s: sum(sizes[i] for i, _, t in rows if t == s) for s in names}
    weight = {s: n % 3 + 1 for n, s in enumerate(names)}
    target, free = {}, set(names)
    while free:
        left, all_weights = sum(held.values()) - sum(target.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / all_weights > 3 * held[s]]
        for s in over or list(free):
            target[s] = float(3 * held[s]) if over else left * weight[s] / all_weights
            free.discard(s)
    out = {}
    for s in names:
        def key(row):
            u = (int(hashlib.md5(str(row[0]).encode()).hexdigest()[:12], 16) + 0.5) / 2 ** 48
            return -math.log(u) / letter_weight(row[1])

        mine = sorted((r for r in rows if r[2] == s), key=key)
        epochs = int(target[s] // held[s]) if held[s] else 0
        budget, run, rest = target[s] - epochs * held[s], 0, []
        taken = {}
        for i, _, _ in mine:
            run += sizes[i]
            taken[i] = sizes[i] * (epochs + (run <= budget))
            if run > budget and sizes[i]:
                rest.append(i)
        missing = target[s] - sum(taken.values())
        near = [(abs(sizes[i] - missing), n, i) for n, i in enumerate(rest) if abs(sizes[i] - missing) < missing]
        if near:
            taken[min(near)[2]] += sizes[min(near)[2]]
        for i, _, _ in mine:
            out[i] = sizes[i], held[s], target[s], taken[i]
    return out
