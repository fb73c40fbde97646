"""Lattice probabilities against the sum over all segmentations, and counts against plain Python."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from protolith.llm import lattice
from protolith.llm.queries import pieces_file

PIECES = {b" a": 3.0, b"a": 2.0, b"b": 1.5, b"ab": 2.5, b" ab": 4.0, b"ba": 1.0, b"bab": 0.5, "é".encode(): 0.4, b" ": 0.3, b" \xc3": 0.2}


def all_ways(word: bytes, weight: dict[bytes, float]) -> list[list[bytes]]:
    if not word:
        return [[]]
    return [[word[:n], *rest] for n in range(1, len(word) + 1) if word[:n] in weight for rest in all_ways(word[n:], weight)]


def names(pieces: lattice.Pieces) -> dict[int, bytes]:
    """Pieces by number, read back from the trie."""
    held, out = {0: b""}, {}
    for edge, target in sorted(zip(pieces.edges.tolist(), pieces.target.tolist()), key=lambda x: x[1]):
        held[target] = held[edge >> 8] + bytes([edge & 255])
    for state, piece in enumerate(pieces.piece.tolist()):
        if piece >= 0:
            out[piece] = held[state]
    return out


WORDS = [b"ab", b"a", b"bab", b"abab", "é".encode(), b"\x00", b"abba", b"zab", b"babab"]


@pytest.mark.parametrize("part", [1 << 17, 3])
def test_forward_and_expected_counts_equal_the_sum_over_segmentations(monkeypatch, part):
    monkeypatch.setattr(lattice, "PART_BYTES", part)  # 3: each word alone, its nodes in several parts
    pieces = lattice.trie(PIECES)
    name = names(pieces)
    prob = {name[i]: p for i, p in enumerate(pieces.first.tolist())}
    count = np.arange(1.0, len(WORDS) + 1)
    weight = lattice.log_weights(pieces.first, 0.25)
    got, uses = np.empty(len(WORDS)), np.zeros(len(pieces.first))
    for at in lattice.batches_of(WORDS):
        batch = lattice.Batch(pieces, WORDS[at])
        got[at] = batch.probability(weight)
        uses += batch.expected(weight, count[at])
    want_uses = Counter()
    for word, c, log_p in zip(WORDS, count, got):
        ways = all_ways(b" " + word, prob)
        each = [math.prod(prob[x] * 0.75 for x in way) for way in ways]
        assert math.isclose(math.exp(log_p), sum(each), rel_tol=1e-9)
        for way, p in zip(ways, each):
            for x in way:
                want_uses[x] += c * p / sum(each)
    for i, x in name.items():
        assert math.isclose(uses[i], want_uses[x], rel_tol=1e-9, abs_tol=1e-12)


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def rows_of(edge):
    return [*edge, (12, "The the THE cat"), (13, "cat sat"), (14, "the dog"), (14, "another text"), (16, "x\x1cy ▁ Éé")]


def test_counts_and_base_scores(spark, make, edge):
    rows = rows_of(edge)
    fold = lambda d: None if d is None else zlib.crc32(str(d).encode()) % 5
    learn = [t for d, t in rows if fold(d) not in (1, None)]
    c = Counter(w for t in learn for w in tokens(t))
    ends = len(learn)
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    base = lambda k: math.log10((k + 0.5) / (n + 0.5 * (v + 1)))
    want = sorted(((d, fold(d) == 1, len(tokens(t)) + 1, sum(c[w] > 0 for w in tokens(t)) + (ends > 0), n,
                    round(sum(base(c[w]) for w in tokens(t)) + base(ends), 4)) for d, t in rows), key=str)
    out = lattice.score_texts(make(rows), pieces_file(), rounds=1).collect()
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out), key=str)
    assert got == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)
    same = {(r.doc_id, r.n_tokens): r.score for r in out}
    assert len({s for (d, _), s in same.items() if d in (4, 5)}) == 1  # "one" each


def test_score_is_the_product_over_words(spark, make):
    rows = [(2, "ab ab ba"), (4, "ab"), (5, ""), (7, "ba")]
    got = {r.doc_id: r.score for r in lattice.score_texts(make(rows), pieces_file()).collect()}
    assert math.isclose(got[2], 2 * got[4] + got[7] - 2 * got[5], rel_tol=1e-12)


def test_nothing_to_learn_from(spark, make):
    assert lattice.score_texts(make([]), pieces_file()).count() == 0
    out = lattice.score_texts(make([(None, "a b"), (None, None)]), pieces_file()).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.held_out) for r in out) == [(1, 0, 0, False), (3, 0, 0, False)]
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in out)


def test_learning_helps_on_held_out_texts(documents):
    """Refitted pieces say held-out texts better than the first weights, round by round."""
    def bits(rounds):
        out = lattice.score_texts(documents, pieces_file(), rounds).filter("held_out").selectExpr("sum(score) AS s").first()
        return -out.s
    assert bits(2) < 0.99 * bits(1)
