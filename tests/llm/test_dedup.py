"""Near-duplicates and repeated passages against brute force."""

import hashlib
import re

import pytest
from protolith.llm import neardup, repeats
from protolith.llm.textkit import LAST_ID


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    up = list(range(len(rows)))

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    by = {}
    for i, s in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(i)
    shared = {}
    for group in by.values():
        for x, i in enumerate(group):
            for j in group[x + 1:]:
                shared[i, j] = shared.get((i, j), 0) + 1
    for (i, j), n in shared.items():
        if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
            up[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), LAST_ID), d)
    key = lambda r: tuple(str(x) for x in r)
    return sorted(((d, len(sets[i]), low.get(find(i)), d == low.get(find(i))) for i, (d, _) in enumerate(rows)), key=key)


def found_components(docs, k, percent):
    rows = neardup.near_duplicates(docs, k, percent).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows), key=lambda r: tuple(str(x) for x in r))


def test_near_duplicates_of_the_table(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert found_components(documents, 4, 80) == brute_components(rows, 4, 80)


def test_near_duplicates_edge_cases(make, edge, prose):
    base = prose(1, 300).split(" ")
    rows = list(edge)
    # a chain in which neighbours are linked and the ends are not
    for step in range(12):
        words = list(base)
        words[:step * 6] = [f"n{step}x{i}" for i in range(step * 6)]
        rows.append((100 + step, " ".join(words)))
    assert found_components(make(rows), 4, 80) == brute_components(rows, 4, 80)
    assert found_components(make(rows), 5, 80) == brute_components(rows, 5, 80)


def test_several_components_in_one_bucket(make, prose, monkeypatch):
    """Cells smaller than a bucket lose no link."""
    monkeypatch.setattr(neardup, "CELL", 4)
    rows = []
    for family in range(6):
        body = prose(9, 120).split(" ") + prose(100 + family, 40).split(" ")
        for copy in range(5):
            words = list(body)
            words[copy * 11] = f"c{family}x{copy}"
            rows.append((family * 10 + copy, " ".join(words)))
    assert found_components(make(rows), 4, 80) == brute_components(rows, 4, 80)


def test_near_duplicates_of_nothing(make):
    assert neardup.near_duplicates(make([])).count() == 0


def brute_removal(rows, length):
    texts = sorted({(LAST_ID if d is None else d, (t or "").encode()) for d, t in rows})
    seen, cut = {}, {}
    for d, b in texts:
        for i in range(len(b) - length + 1):
            at = seen.setdefault(b[i:i + length], (d, i))
            if at != (d, i):
                cut.setdefault((d, b), set()).add(i)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in cut.get((LAST_ID if d is None else d, b), ()):
            gone[i:i + length] = b"\1" * length
        left = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def removal(docs, length):
    return sorted((tuple(r) for r in repeats.remove_repeats(docs, length).collect()), key=str)


def test_repeats_of_the_table(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").filter("doc_id < 400").collect()]
    docs = documents.filter("doc_id < 400")
    assert removal(docs, 100) == brute_removal(rows, 100)


@pytest.mark.parametrize("length", [100, 20])
def test_repeats_edge_cases(make, edge, prose, length):
    shared = prose(3, 60)
    rows = [r for r in edge if r[0] != 10] + [(10, "word " * 300)]
    rows += [(20 + i, prose(50 + i, 40) + shared + prose(80 + i, 20)) for i in range(6)]
    rows += [(30, shared[:140]), (31, shared[5:300] + shared[5:300]), (32, "ü" * 120), (33, "xü" + "ü" * 110)]
    assert removal(make(rows), length) == brute_removal(rows, length)


def test_a_text_in_pieces(make, prose, monkeypatch):
    """A text longer than a piece gives the same result."""
    monkeypatch.setattr(repeats, "_PIECE", 700)
    rows = [(1, prose(1, 900, 50) + prose(1, 300, 50)), (2, prose(2, 40)), (3, prose(1, 500, 50)[333:])]
    assert removal(make(rows), 100) == brute_removal(rows, 100)


def test_text_left_is_whole_characters(make):
    passage = "é" * 30 + "".join(chr(0x4E00 + i) for i in range(60))
    rows = [(1, passage), (2, "a" + passage + "b"), (3, "no repeat")]
    left = {r.doc_id: r.text for r in repeats.remove_repeats(make(rows), 100, extra=["kept"], with_text=True).collect()}
    assert left == {1: passage, 2: "ab", 3: "no repeat"}


def test_texts_without_id_whose_short_hashes_agree(make, prose):
    """Two texts without id, alike in 24 bits of a hash, are still told apart."""
    import numpy as np
    from protolith.llm.textkit import Rolling

    def tags(body):
        out = {}
        for i in range(20_000):
            data = np.frombuffer(f"{body} {i}".encode(), dtype=np.uint8)
            out[int(Rolling(data).at(np.array([0]), np.array([len(data)]))[0] >> np.uint64(40))] = f"{body} {i}"
        return out

    passage, clean = prose(41, 150), prose(42, 150)
    one, other = tags(passage), tags(clean)
    alike = min(one.keys() & other.keys())
    rows = [(1, passage), (None, one[alike]), (None, other[alike]), (None, other[alike]), (2, prose(43, 40)), (2, passage[:300])]
    assert removal(make(rows), 100) == brute_removal(rows, 100)


def test_repeats_of_nothing(make):
    assert repeats.remove_repeats(make([])).count() == 0


def thue_morse(n):
    even, odd = "a", "b"
    while len(even) < n:
        even, odd = even + odd, odd + even
    return even, odd


def test_words_that_simple_hashes_confuse(make):
    """A Thue-Morse word and its complement agree in every polynomial hash modulo a power of two."""
    rows = [(i, w) for i, w in enumerate([*thue_morse(1024), *thue_morse(4096)])]
    assert found_components(make(rows), 4, 80) == [(i, 1, i, True) for i in range(4)]


def near_copies(prose, copies):
    """Copies with other similarities among themselves than to their source."""
    import random

    base = prose(3, 120).split(" ")
    rows = [(0, " ".join(base))]
    for i in range(1, copies):
        r, words = random.Random(i), list(base)
        for at in r.sample(range(120), r.randrange(1, 12)):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words)))
    return rows


def test_many_near_copies_of_one_text(make, prose):
    rows = near_copies(prose, 600)
    assert found_components(make(rows), 4, 80) == brute_components(rows, 4, 80)


def test_families_grow_with_the_copies_not_their_pairs(make, prose):
    from pyspark.sql import functions as F

    from protolith.llm.neardup import bucket_rows, families, signatures

    def count(copies):
        classes = signatures(make(near_copies(prose, copies)), 4).withColumns({"node": F.col("doc_id"), "label": F.col("doc_id"), "n": F.col("n_shingles")})
        rows = bucket_rows(classes)
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
        popular = rows.join(sizes, "key").groupBy("node").agg(F.sum("members").alias("pop"))
        return families(classes.join(popular, "node")).count()

    few, many = count(500), count(2000)
    assert few >= 500 and many <= 5 * few
