"""Phrase collocations against a plain count in Python."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from protolith.llm import phrases

FIELDS = "doc_id long, text string, lang string, lang_pred string, n long, phrase string"


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain(rows, longest, least, limit):
    out = []
    by: dict[str, list[list[str]]] = {}
    for text, lang in rows:
        pieces = [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or ""))]
        by.setdefault("und" if lang is None else lang, []).extend(pieces)
    for lang, pieces in by.items():
        n = sum(map(len, pieces))
        f = Counter(tuple(p[i:i + k]) for p in pieces for k in range(1, longest + 1) for i in range(len(p) - k + 1))
        kept = [c for c, a in f.items() if len(c) > 1 and a >= least]
        found = []
        for c in kept:
            a = f[c]
            low = min((1000 * a * n // (f[c[:k]] * f[c[k:]]), k) for k in range(1, len(c)))
            around = [d for d in kept if len(d) > len(c) and any(d[i:i + len(c)] == c for i in range(len(d)))]
            if not any(100 * f[d] >= 100 * a for d in around):
                found.append((-low[0], -a, " ".join(c).encode(), f[c[:low[1]]], f[c[low[1]:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:limit], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def mine(spark, rows, **how):
    data = [(i, text, lang, "x", 1, "y") for i, (text, lang) in enumerate(rows)]
    return sorted(tuple(r) for r in phrases.collocations(spark.createDataFrame(data, FIELDS), **how).collect())


def made(seed: int, n: int) -> list[tuple[str | None, str | None]]:
    rnd = random.Random(seed)
    words = ["a", "B", "the", "é", "É", "x#y", "ü-ü", "\x00", "zz", "ab"]
    rows: list[tuple[str | None, str | None]] = [(None, "en"), ("", None), (" \t ", "en"), ("a", "de"), ("..;", "en")]
    for _ in range(n):
        parts = []
        for _ in range(rnd.randrange(40)):
            parts.append(rnd.choice(words[:rnd.randrange(2, 11)]) + rnd.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\r\n", "\x0b"]))
        rows.append(("".join(parts), rnd.choice(["en", "en", "de", None, "und", ""])))
    return rows + rows[5:25]


@pytest.mark.parametrize("seed, limit", [(1, 2000), (2, 7)])
def test_equals_plain_count(spark, seed, limit):
    rows = made(seed, 150)
    assert mine(spark, rows, longest=5, least=4, limit=limit) == plain(rows, 5, 4, limit)


def test_collisions_and_a_full_table_change_nothing(spark, monkeypatch):
    rows = made(3, 120)
    want = plain(rows, 4, 5, 2000)
    monkeypatch.setattr(phrases, "FILTER_BITS", 64)  # the table is full: nothing is filtered
    monkeypatch.setattr(phrases, "RANGE", 20)  # sums in many steps
    monkeypatch.setattr(phrases, "RANGE_BITS", 1)
    assert mine(spark, rows, longest=4, least=5) == want


def test_equal_fingerprints_are_told_apart_by_words(monkeypatch):
    words = [b"one", b"two", b"three"]
    block = phrases.Runs("en", phrases.np.array([0, 1, 0, 2, 0, 1], phrases.np.int32).tobytes(), b"".join(words),
                         phrases.np.array([0, 3, 6, 11], phrases.np.int64).tobytes())
    monkeypatch.setattr(phrases.Runs, "fingerprints", lambda self, k: phrases.np.zeros(len(self.code) - k + 1, phrases.np.uint64))
    full = phrases.np.full(1, ~phrases.np.uint64(0))
    found = [(block.text(at, 2), n) for _, place, count in block.phrases(2, full) for at, n in zip(place.tolist(), count.tolist())]
    assert sorted(found) == [(b"one three", 1), (b"one two", 2), (b"three one", 1), (b"two one", 1)]


def test_thue_morse_words_differ():
    even, odd = "a", "b"
    for _ in range(12):
        even, odd = even + odd, odd + even
    data = (even + odd).encode()
    at = phrases.np.array([0, len(even), 2 * len(even)])
    letters = phrases.np.frombuffer(data, phrases.np.uint8).astype(phrases.np.uint64)
    a, b = phrases.Prefixes((letters, letters)).at(at[:-1], at[1:])
    assert a[0] != a[1] and b[0] != b[1]


def test_small_tables(spark):
    assert mine(spark, [], least=1) == []
    assert mine(spark, [(None, None), ("", "en"), (" . ", "en")], least=1) == []
    long = "w " * 300_000
    assert mine(spark, [(long, "en")], longest=3, least=100) == plain([(long, "en")], 3, 100, 2000)


def test_scores_beyond_64_bits(spark):
    big = 4_000_000_000_000
    counts = spark.createDataFrame([("en", "a b", 2, big), ("en", "a", 1, big + 7), ("en", "b", 1, big + 1)], "lang string, phrase string, words int, f long")
    sizes = spark.createDataFrame([("en", 9 * big)], "lang string, n long")
    assert [r.score for r in phrases.scores(counts, sizes).collect()] == [1000 * big * 9 * big // ((big + 7) * (big + 1))]
