"""Greedy string tiling against a plain search, and the whole operator on planted passages."""

import random
import re

from protolith.llm import contamination as c


def brute_tiles(item, doc, least):
    """Longest unmarked common run again and again."""
    in_item, in_doc = set(), set()
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] \
                        and i + n not in in_item and j + n not in in_doc:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return in_item
        in_item |= set(range(best[1], best[1] + best[0]))
        in_doc |= set(range(best[2], best[2] + best[0]))


def test_tiling():
    r = random.Random(3)
    for _ in range(60):
        item = [r.randrange(30) for _ in range(40)]
        doc = [r.randrange(30) for _ in range(60)]
        for _ in range(r.randint(0, 4)):
            at, n, to = r.randrange(30), r.randint(3, 10), r.randrange(50)
            doc[to:to + n] = item[at:at + n]
        assert abs(int(c.tile(item, doc, 3).sum()) - len(brute_tiles(item, doc, 3))) <= 3


def words(text):
    return re.findall(r"[A-Za-z0-9\x80-\U0010FFFF]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_table(spark, documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = {r.item_id: words(r.text) for r in benchmark.collect()}
    seeds = {}
    for i, w in items.items():
        for k in range(len(w) - 4):
            seeds.setdefault(tuple(w[k:k + 5]), set()).add(i)
    want = set()
    for row in documents.select("doc_id", "text").collect():
        w = words(row.text)
        for i in {i for k in range(len(w) - 4) for i in seeds.get(tuple(w[k:k + 5]), ())}:
            if len(brute_tiles(items[i], [x if any(tuple(w[a:a + 5]) in seeds for a in range(max(0, k - 4), k + 1)) else (k,)
                                          for k, x in enumerate(w)], 5)) >= 0.5 * len(items[i]):
                want.add((row.doc_id, i))
    assert {(r.doc_id, r.item_id) for r in c.contaminated(documents, benchmark).collect()} == want and want


def test_edge_cases(spark, make, edge, prose):
    item = prose(5, 40)
    parts = item.split(" ")
    shuffled = " ".join(parts[20:30] + ["x"] + parts[:10] + ["y", "z"] + parts[30:] + ["q"] + parts[10:20])
    rows = [*edge, (20, prose(6, 50) + " " + item.upper().replace(" ", ", ") + "."), (21, shuffled), (22, " ".join(parts[:10])),
            (23, prose(7, 100)), (None, item), (24, item), (24, item), (25, " ".join(parts[:20]))]
    benchmark = spark.createDataFrame([(1, item, "?"), (2, None, "?"), (3, "", "?"), (4, "one two", "?"), (None, prose(8, 30), "?")],
                                      "item_id long, text string, words string")
    out = c.contaminated(make(rows), benchmark)
    found = {(r.doc_id, r.item_id): r.tiled_words for r in out.collect()}
    assert found == {(20, 1): 40, (21, 1): 40, (24, 1): 40, (25, 1): 20, (None, 1): 40}
    assert out.count() == 5
    assert c.contaminated(make([]), benchmark).count() == 0
    assert c.contaminated(make(rows), benchmark.limit(0)).count() == 0


def test_items_that_share_an_id_or_have_none(spark, make, prose):
    """Repeated item rows, several texts under one id and without id, and items of repeated words hide no copy."""
    repeated, left, right = prose(5, 40), prose(11, 30), prose(12, 30)
    nameless = [prose(20 + i, 30) for i in range(4)]
    chorus = " ".join(["la le li lo lu"] * 8)
    verse = prose(13, 10)
    rows = [(1, repeated), (2, left), (3, nameless[2] + " and " + nameless[0]), (4, chorus), (5, verse + " x " + verse), (5, verse + " x " + verse)]
    benchmark = spark.createDataFrame([(1, repeated)] * 3 + [(2, left), (2, right), (2, prose(14, 30))] + [(None, t) for t in nameless * 2] +
                                      [(4, chorus), (5, verse + " y " + verse + " " + prose(15, 4))], "item_id long, text string")
    found = sorted(((r.doc_id, r.item_id, r.tiled_words, r.item_words) for r in c.contaminated(make(rows), benchmark).collect()), key=str)
    assert found == [(1, 1, 40, 40), (2, 2, 30, 30), (3, None, 30, 30), (3, None, 30, 30), (4, 4, 40, 40), (5, 5, 20, 25)]


def test_words_that_simple_hashes_confuse(spark, make, prose):
    """Five long words and their complements: no item word is found in a text of the others."""
    even, odd = "a", "b"
    for _ in range(12):
        even, odd = even + odd, odd + even
    item = " ".join(even[i:] for i in (0, 0, 0, 0, 0, 0))
    rows = [(1, item.replace("a", "?").replace("b", "a").replace("?", "b")), (2, item)]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert [r.doc_id for r in c.contaminated(make(rows), benchmark).collect()] == [2]
