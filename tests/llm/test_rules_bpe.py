"""Quality rules against a plain count, and the codec against the tokenizers library."""

import base64
import hashlib
import random
import re
from collections import Counter

from protolith.llm import bpe, rules
from protolith.llm.queries import vocabulary
from tokenizers import Tokenizer


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            hit |= {i, i + 1, i + 2}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n)


def judged(docs):
    return rules.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()


def test_base_counts(documents, make, edge):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert sorted(map(tuple, judged(documents))) == sorted((d, *brute_counts(t)) for d, t in rows)
    rows = [*edge, (50, "a b a b a b c\nx\n x\nx\n\nx y #*$%&|<>"), (51, "Line one\r\nLine one\r\n")]
    assert sorted(map(str, map(tuple, judged(make(rows))))) == sorted(str((d, *brute_counts(t))) for d, t in rows)
    assert rules.judge(make([])).count() == 0


def test_verdicts(make, prose):
    r = random.Random(1)
    noise = base64.b85encode(r.randbytes(6000)).decode()
    noise = " ".join(noise[i:i + 20] for i in range(0, len(noise), 20))
    rows = [(1, prose(1, 400)), (2, "the same five words again " * 400), (3, noise), (4, prose(2, 800) + " " + "ab " * 5000)]
    out = {x.doc_id: x.kept for x in rules.judge(make(rows), extra=["seed"]).collect()}
    assert out == {1: True, 2: False, 3: False, 4: False}


def test_clean_rows_stay(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = rules.judge(documents).join(labels, "doc_id").filter("quality = 1 and not base_failed")
    assert rows.count() > 100 and rows.filter("not kept").count() == 0


def expected(text):
    t = Tokenizer.from_file(vocabulary())
    ids = t.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))


def test_codec(make, edge):
    r = random.Random(7)
    letters = "ab'sretlvdm  \n\t\r  é1٣!?.́中<|endoftext|>Ⅷ\x1c\x85\xa0_-\U0001F600"
    rows = [*edge, *((100 + i, "".join(r.choice(letters) for _ in range(r.randint(0, 40)))) for i in range(2000))]
    rows += [(5000, "<|endoftext|>a<|endoftext|><|endoftext|>"), (5001, "it's we'll 're'd ''s 'S x'll've"), (5002, "z" * 999 + " " * 500)]
    got = bpe.encode(make(rows), vocabulary()).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((d, *expected(t))) for d, t in rows)
    assert bpe.encode(make([]), vocabulary(), with_ids=True).count() == 0


def test_codec_of_the_table(documents):
    t = Tokenizer.from_file(vocabulary())
    got = {x.doc_id: x for x in bpe.encode(documents, vocabulary(), with_ids=True).collect()}
    for row in documents.select("doc_id", "text").collect():
        ids = t.encode(row.text or "", add_special_tokens=False).ids
        assert list(got[row.doc_id].ids) == ids and got[row.doc_id].n_tokens == len(ids)
        assert got[row.doc_id].decoded_sha256 == hashlib.sha256(row.text.encode()).hexdigest()


def thue_morse(n):
    even, odd = "a", "b"
    while len(even) < n:
        even, odd = even + odd, odd + even
    return [even, odd]


def test_codec_tells_words_apart_that_simple_hashes_confuse(make):
    rows = list(enumerate([*thue_morse(1024), *thue_morse(4096), *thue_morse(1024)]))
    got = bpe.encode(make(rows), vocabulary()).collect()
    assert sorted(map(tuple, got)) == [(d, *expected(t)) for d, t in rows]
