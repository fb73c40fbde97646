"""The trie of rebuilt conversations against a plain walk."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from protolith.llm import trie

FIELDS = "conv_id long, turn long, role string, text string, depth int, print string, conv string, ref int"


def plain(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(turns)] for c, turns in own.items()}
    members, ends = {}, {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        path = own.get(base, [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
        ends.setdefault(tuple(path), []).append(c)
    kids = {}
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    out = []
    for node, convs in members.items():
        below = [x for x in members if x[:len(node)] == node]
        saved = sum((len(members[x]) - 1) * (len(x[-1][1].encode()) if x else 0) for x in below)
        text = ",".join(map(str, sorted(ends.get(node, []))))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(kids.get(node, [])),
                    sum(x not in kids for x in below), saved, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def mine(spark, rows, **how):
    data = [(*r, 1, "p", "c", 2) for r in rows]
    return sorted((tuple(r) for r in trie.prefix_trie(spark.createDataFrame(data, FIELDS), **how).collect()), key=str)


def made(seed, convs):
    rnd = random.Random(seed)
    rows = []
    for c in range(-7, convs):
        if rnd.random() < 0.9:
            for turn in range(rnd.randrange(1, 14)):
                rows.append((c, rnd.choice([turn, turn, turn, None, 3]), rnd.choice(["user", "assistant", None, ""]),
                             rnd.choice(["hi", "Hi", "é", "", None, "long " * 50])))
    return rows + [(None, 1, "user", "nobody"), (None, None, None, None)] + rows[:9]


def test_equals_a_plain_walk(spark):
    rows = made(1, 60)
    assert mine(spark, rows) == plain(rows)


def test_copies_and_one_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(trie, "BIN", 16)
    monkeypatch.setattr(trie, "RUN", 3)
    rows = [(c, t, "user", f"turn {t}") for c in range(120) for t in range(6)]
    rows += [(200, t, "user", f"turn {t % 7}") for t in range(150)] + [(10 ** 12, 0, "user", "turn 0")]
    assert mine(spark, rows) == plain(rows)


def test_colliding_bases_are_replaced(spark):
    rows = made(2, 20)
    # a base of -1 forgets the order of turns two apart
    bad = (trie.PRIMES[0] - 1, trie.PRIMES[1] - 1)
    assert mine(spark, rows, bases=(bad, *trie.BASES)) == plain(rows)


def test_unavoidable_collisions_are_reported(spark, monkeypatch):
    monkeypatch.setattr(trie, "prefixes", lambda turns, bases: spark.createDataFrame(
        [(1, 1, 1, 1, 5, 0), (2, 1, 2, 1, 5, 0)], "conv long, depth long, ref long, bytes long, print long, before long"))
    with pytest.raises(ArithmeticError):
        trie.prefix_trie(spark.createDataFrame([(1, 1, "a", "b")], "conv_id long, turn long, role string, text string"))


def test_small_tables(spark):
    assert mine(spark, []) == []
    assert mine(spark, [(None, 1, "a", "b")]) == []
    one = [(0, None, None, None)]
    assert mine(spark, one) == plain(one)
    turnless = [(3, 1, "user", "gone"), (14, 0, "x", "y")]  # the head takes their only turn away
    assert mine(spark, turnless) == plain(turnless)


def test_whole_table(spark):
    from protolith.llm.queries import QUERIES

    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in QUERIES["op13_prefix_trie"](spark, "/root/testdata/sf0.01").collect()), key=str) == plain(rows)
