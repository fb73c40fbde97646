import base64
import hashlib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from protolith.functions import checksums, motifs, topology
from protolith.functions.text import escape, number_text, unescape
from protolith.operators import ordered, sequences

RELAXED = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def values(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_ids(spark):
    df = column(spark, [0, 10, 35, 36, 36**4], "bigint")
    codes = values(df, checksums.encode_id(F.col("x"), "TS", 4))
    assert codes == ["TS0000", "TS000A", "TS000Z", "TS0010", "TS10000"]
    back = column(spark, ["S00000A"])
    assert values(back, checksums.decode_id(F.col("x"), "S")) == [10]


def test_checksums(spark):
    df = column(spark, ["acdefg", "ACDEFG"])
    seguid = base64.b64encode(hashlib.sha1(b"ACDEFG").digest()).decode().rstrip("=")
    assert values(df, checksums.sequence_checksum(F.col("x"))) == [seguid, seguid]
    assert values(df, checksums.sequence_md5(F.col("x"))) == [
        hashlib.md5(b"acdefg").hexdigest(), hashlib.md5(b"ACDEFG").hexdigest()]
    sha = base64.b64encode(hashlib.sha256(b"acdefg").digest()).decode().rstrip("=")
    assert values(df, checksums.record_checksum(F.col("x")))[0] == sha


def test_normalise(spark):
    df = column(spark, ["m-k.v*", "mJbzUo**", "a*c"])
    assert values(df, sequences.normalise(F.col("x"))) == ["MKV", "MXXXXX", "AXC"]


def test_invalid_first_letter_only(spark):
    df = column(spark, ["1A", "A1", "AB"])
    assert values(df, sequences.invalid(F.col("x"))) == [True, False, False]
    assert values(df, sequences.invalid(F.col("x"), strict=True)) == [True, True, False]


def test_number_text(spark):
    numbers = [1.2e-30, 1e-05, 0.0001, 0.00012345, 12345678.0, 1e16, 0.5, -1.5e-07, 100.0, 123456789.125, 0.001]
    assert values(column(spark, numbers, "double"), number_text(F.col("x"))) == [repr(n) for n in numbers]


def test_escape_round_trip(spark):
    texts = ["plain", "a;b=c,d%e", "%3B", "tab\tline\n", "100%25"]
    df = column(spark, texts)
    assert values(df, unescape(escape(F.col("x")))) == texts
    assert values(df, escape(F.col("x")))[1] == "a%3Bb%3Dc%2Cd%25e"


@RELAXED
@given(st.lists(st.text(alphabet="KRLAX", max_size=400), min_size=1, max_size=8))
def test_motifs_match_finditer(spark, texts):
    df = column(spark, texts)
    for regex in ("[KR]R", "L[A-Z][A-Z]R"):
        found = values(df, motifs.match_spans(F.col("x"), regex))
        assert [[tuple(m) for m in row] for row in found] == [
            [(m.group(), m.start(), m.end()) for m in re.finditer(regex, t)] for t in texts]


def test_many_matches_in_one_text(spark):
    text = "KR" * 5000 + "AAA"
    found = values(column(spark, [text]), motifs.match_spans(F.col("x"), "[KR]R"))[0]
    assert len(found) == 5000 and tuple(found[-1]) == ("KR", 9998, 10000)


def test_custom_motif_ignores_case(spark):
    df = spark.createDataFrame([("a", "xRaLx")], "id string, seq string")
    row = sequences.scan_motifs(df, "custom", "r.l").first()
    assert (row.pattern, row.match, row.start, row.end) == ("r.l", "RaL", 1, 4)


def test_topology(spark):
    df = column(spark, ["SSS..HHHHHHHHHHHhB", "", "S" * 12 + "b" * 11])
    assert [[tuple(r) for r in v] for v in values(df, topology.runs(F.col("x"), "BbHhS."))][0] == [
        ("S", 0, 3), (".", 3, 5), ("H", 5, 16), ("h", 16, 17), ("B", 17, 18)]
    assert values(df, topology.membrane_flag(F.col("x"))) == [True, False, True]
    assert values(df, topology.signal_flag(F.col("x"))) == [False, False, True]


def test_dedup_numbers_by_first_occurrence(spark):
    rows = [(5, "bbb"), (1, "AAA"), (2, "bbb"), (3, "aaa*"), (9, "ccc"), (10, "B-BB")]
    df = spark.createDataFrame(rows, "n bigint, seq string")
    out = sequences.dedup_encode(df, ["n"], prefix="P", length=3)
    got = {r.n: r.encoded for r in out.collect()}
    # B is masked, so the three spellings agree
    assert got == {1: "P000", 3: "P000", 2: "P001", 5: "P001", 10: "P001", 9: "P002"}


def test_dedup_keeps_rows_without_a_sequence(spark):
    df = spark.createDataFrame([(1, None), (2, "MK"), (3, None), (4, "MA")], "n bigint, seq string")
    out = sequences.dedup_encode(df, ["n"], prefix="P", length=3)
    assert {r.n: r.encoded for r in out.collect()} == {1: None, 2: "P000", 3: None, 4: "P001"}


def test_dedup_with_a_hot_sequence(spark):
    rows = [(i, "MKV" if i % 3 else f"M{'A' * (i // 3 % 50)}") for i in range(3000)]
    df = spark.createDataFrame(rows, "n bigint, seq string").repartition(7)
    out = sequences.dedup_encode(df, ["n"])
    assert out.count() == 3000 and out.select("encoded").distinct().count() == 51


@RELAXED
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 60), st.sampled_from("abc")), min_size=1, max_size=60,
                unique_by=lambda t: t[:2]))
def test_runs_match_a_walk(spark, rows):
    df = spark.createDataFrame(rows, "g int, t int, s string")
    got = sorted(map(tuple, ordered.runs(df, ["g"], ["t"], "s", bins=3).collect()))
    want = []
    for g in {r[0] for r in rows}:
        symbols = [s for _, _, s in sorted(r for r in rows if r[0] == g)]
        start = 0
        for i in range(1, len(symbols) + 1):
            if i == len(symbols) or symbols[i] != symbols[start]:
                want.append((g, symbols[start], start, i))
                start = i
    assert got == sorted(want)


def test_scan_keeps_null_neighbours(spark):
    df = spark.createDataFrame([(1, None, 0), (2, 5, 0), (12, None, 0), (13, 7, 0)], "t int, v int, k int")
    out = ordered.scan(df, ["k"], F.floor(F.col("t") / 10), ["t"], lags={"p": F.col("v")}, leads={"n": F.col("v")})
    assert [(r.t, r.p, r.n) for r in out.orderBy("t").collect()] == [
        (1, None, 5), (2, None, None), (12, 5, 7), (13, None, None)]
