"""The chain of stages against plain versions of each, run one after the other on small tables."""

import hashlib
import re

import corpus_pipeline
import pyarrow as pa
import pyarrow.parquet as pq
import zstandard
from protolith.llm import rules
from protolith.llm.queries import vocabulary
from test_contamination import brute_tiles, words
from test_dedup import shingles
from test_rules_bpe import brute_counts
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.01"


def good(text):
    """The base rule and the compression bands, chunk by chunk."""
    raw, press = (text or "").encode(), zstandard.ZstdCompressor(level=rules.LEVEL)

    def fits(part):
        bands = [(low, high) for least, low, high in rules.BANDS if len(part) >= least]
        return not bands or bands[-1][0] <= len(part) / len(press.compress(part)) <= bands[-1][1]

    if brute_counts(text)[-1] or not fits(raw):
        return False
    chunks = [raw[i:i + rules.CHUNK] for i in range(0, len(raw), rules.CHUNK)]
    return len(chunks) == 1 or sum(len(c) for c in chunks if not fits(c)) <= rules.BAD_SHARE * len(raw)


def one_of_each_group(rows):
    """Rows (id, text): the first of every group of rows linked over five-word shingles."""
    rows = sorted(set(rows))
    sets = [shingles(t, 5) for _, t in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    first = {}
    for row, g in zip(rows, group):
        first.setdefault(g, row)
    return sorted(first.values())


def without_passages(rows):
    """Rows (id, text) in order of id without each byte under a 100-byte string that starts earlier."""
    seen, out = set(), []
    for d, text in rows:
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i:i + 100] in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(raw[i:i + 100])
        left = bytes(x for x, g in zip(raw, gone) if not g).decode()
        if left.strip() or not any(gone):
            out.append((d, left))
    return out


def leaks(text, items):
    have = words(text)
    grams = {tuple(have[k:k + 5]) for k in range(len(have) - 4)}
    for item in items:
        seeds = {tuple(item[k:k + 5]) for k in range(len(item) - 4)}
        if seeds & grams:
            near = [w if any(tuple(have[a:a + 5]) in seeds for a in range(max(0, k - 4), k + 1)) else (k,) for k, w in enumerate(have)]
            if len(brute_tiles(item, near, 5)) >= 0.5 * len(item):
                return True
    return False


def test_chain(spark, prose, tmp_path):
    table = pq.read_table(f"{SF}/documents.parquet", filters=[("doc_id", "<", 250)])
    item = prose(900, 60, 50000)
    passage = prose(901, 30, 50000)
    body = prose(902, 150, 50000).split(" ")
    planted = [
        (9000, None), (9001, ""), (9002, "too short"), (9003, "again and again " * 200),
        (9010, " ".join(body)), (9011, " ".join([*body[:70], "x", *body[71:]])), (9012, " ".join(body)),
        (9020, prose(903, 120, 50000)), (9020, " ".join(body)), (9021, prose(903, 120, 50000)), (9021, prose(903, 120, 50000)),
        (9030, f"{prose(904, 80, 50000)} {item} {prose(905, 80, 50000)}"),
        (9040, f"{prose(906, 80, 50000)} {passage} {prose(907, 80, 50000)}"), (9041, f"{prose(908, 80, 50000)} {passage} {prose(909, 80, 50000)}"),
    ]
    fields = table.schema
    made = pa.table({"doc_id": [d for d, _ in planted], "text": [t for _, t in planted], "lang": ["xx"] * len(planted),
                     "source": ["planted"] * len(planted), "n_chars": [len(t or "") for _, t in planted]}, fields)
    pq.write_table(pa.concat_tables([table, made]), tmp_path / "documents.parquet")
    items = pq.read_table(f"{SF}/benchmark.parquet")
    items = pa.concat_tables([items, pa.table({"item_id": [77777], "text": [item]}, items.schema)])
    pq.write_table(items, tmp_path / "benchmark.parquet")

    rows = list(zip(table["doc_id"].to_pylist(), table["text"].to_pylist())) + planted
    first = [r for r in rows if good(r[1])]
    single = one_of_each_group(first)
    cut = without_passages(single)
    known = [words(t) for t in items["text"].to_pylist()]
    clean = [(d, t) for d, t in cut if not leaks(t, known)]
    assert len(rows) > len(first) > len(single) >= len(cut) > len(clean) and cut != single[:len(cut)]

    tokens = Tokenizer.from_file(vocabulary())
    want = []
    for d, t in clean:
        ids = tokens.encode(t, add_special_tokens=False).ids
        want.append((d, ids, hashlib.sha256(tokens.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, list(r.ids), r.decoded_sha256) for r in got) == sorted(want)
    kept = {d for d, *_ in want}
    assert {9010, 9020, 9040, 9041} <= kept and not kept & {9000, 9001, 9002, 9003, 9011, 9012, 9021, 9030}


def test_groups_without_ids(spark, prose):
    """A group without any id keeps one text; a copy without an id goes where its group has one."""
    one, two = prose(1, 120, 50000).split(" "), prose(2, 120, 50000)
    rows = [(5, two), (None, two), (None, " ".join(one)), (None, " ".join([*one[:60], "x", *one[61:]])), (None, " ".join(one)),
            (6, prose(3, 100, 50000)), (6, two), (7, None), (7, None)]
    docs = spark.createDataFrame([(d, t, "xx", "s", 0) for d, t in rows], ", ".join(
        ("doc_id long", "text string", "lang string", "source string", "n_chars long")))
    left = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    assert sorted(str(r.doc_id) for r in left) == ["5", "6", "7", "None"]
    texts = {r.doc_id: r.text for r in left}
    assert texts[5] == two and texts[6] == rows[5][1] and texts[7] is None and re.match(re.escape(" ".join(one[:60])), texts[None])


def test_chain_of_nothing(spark, tmp_path):
    for name in ("documents", "benchmark"):
        pq.write_table(pq.read_schema(f"{SF}/{name}.parquet").empty_table(), tmp_path / f"{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
