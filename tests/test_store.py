import json

import pytest
from pyspark.sql import functions as F

from protolith.analyses import choose
from protolith.functions.attributes import attributes_text, parse_attributes
from protolith.operators import features, scoring, store, summary
from protolith.sinks import writers
from protolith.sources.results import ARRIVAL, bad_results, read_results
from protolith.streaming.load import follow


def envelope(kind, data, checksum="C1", version="1", database=None, database_version=None):
    return {"analysis": kind, "software": "soft", "software_version": version, "database": database,
            "database_version": database_version, "checksum": checksum, "md5sum": "M" + checksum, "data": data}


def tm(name, n):
    return {"name": name, "tm": n, "sp": False, "topology": "o"}


ROWS = [
    envelope("phobius", tm("a", 1)),
    envelope("phobius", tm("b", 2)),                      # same key: the first stays
    envelope("phobius", tm("a", 3), version="2"),
    envelope("kex2_cutsite", {"name": "a", "kind": "kex2_cutsite", "pattern": "[KR]R", "match": "KR", "start": 1, "end": 3}),
    envelope("kex2_cutsite", {"name": "a", "kind": "kex2_cutsite", "pattern": "[KR]R", "match": "KR", "start": 5, "end": 7}),
    envelope("dbcan", {"query": "a", "hmm": "GH10"}, database="DBCan"),
    envelope("dbcan", {"query": "a", "hmm": "GH10"}, database="DBCan", database_version="8"),
]


@pytest.fixture
def results_file(tmp_path):
    path = tmp_path / "in" / "r.ldjson"
    path.parent.mkdir()
    path.write_text("\n".join(json.dumps(r) for r in ROWS) + "\n\n")
    return str(path.parent)


def test_loading_twice_changes_nothing(spark, results_file, tmp_path):
    home = str(tmp_path / "store")
    rows = read_results(spark, results_file)
    first = store.load_results(rows, ARRIVAL)
    assert first.count() == 6
    store.append_store(first, home)
    held = store.read_store(spark, home)
    assert held.count() == 6
    assert store.load_results(rows, ARRIVAL, store=held).count() == 0
    kept = held.filter("analysis = 'phobius' AND software_version = '1'").first()
    assert json.loads(kept.data)["tm"] == 1


def test_filters(spark, results_file):
    rows = read_results(spark, results_file, exclude=["phobius"], drop_null_dbversion=True, drop_name=True)
    got = rows.collect()
    assert sorted(r.analysis for r in got) == ["dbcan", "kex2_cutsite", "kex2_cutsite"]
    assert all(r["name"] is None and "query" not in json.loads(r.data) and "name" not in json.loads(r.data) for r in got)
    assert choose(["tmhmm", "tmbed"], ["tmbed"]) == ["tmhmm"]
    with pytest.raises(ValueError):
        choose(["nothing"])


def test_stream_equals_batch(spark, results_file, tmp_path):
    home = str(tmp_path / "streamed")
    with open(f"{results_file}/bad.ldjson", "w") as out:
        out.write('{"analysis": "nothing"}\nnot json\nnot json\n')
    names = store.build_decoder(read_results(spark, results_file)).count()
    for turn in range(2):  # a second run over the same files, from scratch, adds nothing
        follow(spark, results_file, home, str(tmp_path / f"checkpoint{turn}")).awaitTermination(120)
        assert store.read_store(spark, home).count() == 6
        assert store.read_decoder(spark, home).count() == names > 0
        bad = spark.read.parquet(f"{home}/quarantine").collect()
        assert sorted(r.line for r in bad) == ["not json", '{"analysis": "nothing"}']
    assert bad_results(spark, results_file).count() == 3


def test_table_with_lists(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x", None, "y"], 0.123), ("b", None, None)], "name string, found array<string>, p double")
    writers.write_tsv(df.coalesce(1), str(tmp_path / "t"), digits=2)
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "t")).collect())
    assert lines == ["a\tx,.,y\t0.12", "b\t.\t.", "name\tfound\tp"]


def test_remaining_of_an_empty_kind(spark):
    results = spark.createDataFrame([], ", ".join(f"{c} string" for c in store.RESULT_COLUMNS))
    targets = spark.createDataFrame([("tmhmm", "2", None)], "analysis string, software_version string, database_version string")
    checksums = spark.createDataFrame([("C1",), ("C1",), ("C2",)], "checksum string")
    left = store.find_remaining(results, targets, checksums).collect()
    assert sorted(r.checksum for r in left) == ["C1", "C2"]


def test_remaining_of_many_targets(spark):
    results = spark.createDataFrame([("tmhmm", "s", str(v), None, None, None, "C1", "m", "{}") for v in range(0, 20_000, 2)],
                                    ", ".join(f"{c} string" for c in store.RESULT_COLUMNS))
    targets = spark.range(20_000).selectExpr("'tmhmm' AS analysis", "cast(id AS string) AS software_version", "cast(null AS string) AS database_version")
    checksums = spark.createDataFrame([("C1",), ("C2",)], "checksum string")
    left = store.find_remaining(results, targets, checksums).groupBy("checksum").count().collect()
    assert {r.checksum: r["count"] for r in left} == {"C1": 10_000, "C2": 20_000}


def test_usable_targets(spark):
    targets = spark.createDataFrame([("dbcan", "1", None), ("dbcan", "1", "8"), ("tmhmm", "1", None)],
                                    "analysis string, software_version string, database_version string")
    assert store.usable_targets(targets).count() == 2


def test_ldjson_line(spark):
    df = spark.createDataFrame(
        [("tmhmm", "T", "1", None, None, None, "c", "m", '{"length":null}', "s\"1"),
         ("dbcan", "H", "1", "DBCan", "8", None, "c", "m", "{}", None)],
        ", ".join(f"{c} string" for c in [*store.RESULT_COLUMNS, "name"]))
    one, two = (json.loads(r[0]) for r in df.select(writers.ldjson_line(df.columns)).collect())
    assert one == {"analysis": "tmhmm", "software": "T", "software_version": "1", "checksum": "c", "md5sum": "m",
                   "data": {"length": None, "name": 's"1'}}
    assert two["data"] == {"query": "."} and two["database_version"] == "8"


def result_frame(spark, rows):
    return spark.createDataFrame(
        [(r["analysis"], r["software"], r["software_version"], r["database"], r["database_version"], None, r["checksum"],
          r["md5sum"], json.dumps(r["data"]), r["data"].get("name", r["data"].get("query"))) for r in rows],
        ", ".join(f"{c} string" for c in [*store.RESULT_COLUMNS, "name"]))


HIT = dict(query="a", target="acc#PHI:1#g1__g2#x#y#Lethal", qstart=1, qend=90, qlen=99, tstart=2, tend=91, tlen=100,
           evalue=1e-30, gapopen=1, pident=0.4, alnlen=90, raw=1.0, bits=30.0, cigar="40M1D49M", mismatch=1, qcov=0.5, tcov=0.9)


def test_features_and_their_text(spark):
    rows = [
        envelope("phobius", {"name": "a", "tm": 1, "sp": True, "topology": "n4-20c25/26o40-60i"}),
        envelope("phibase", HIT, database="PHIBase", database_version="4"),
        envelope("phibase", {**HIT, "tcov": 0.1}, database="PHIBase", database_version="4"),
        envelope("targetp_plant", {"name": "a", "prediction": "luTP", "other": 0.1, "sp": 0.1, "mtp": 0.1, "ctp": 0.2, "lutp": 0.8,
                                   "cs_pos": "CS pos luTP: 90-91. ALA-SP. Pr: 0.83; CS pos cTP: 41-42. Pr: 0.78"}),
        envelope("pfamscan", {"name": "a", "ali_start": 0, "ali_end": 9, "env_start": 0, "env_end": 9, "hmm": "PF1", "hmm_name": "n",
                              "hmm_type": "Family", "hmm_start": 0, "hmm_end": 9, "hmm_len": 9, "bitscore": 1.0, "evalue": 1e-9,
                              "is_significant": True, "clan": None, "active_sites": "1,2;5"}, database="Pfam", database_version="33"),
        envelope("regexanalysis", {"name": "a", "kind": "custom", "pattern": "x", "match": "x", "start": 5, "end": 5}),
    ]
    df = result_frame(spark, rows)
    found = features.features(df)
    text = attributes_text(F.col("attributes"))
    got = {(r.type, r.start, r.end): (r.source, r.t) for r in found.select("*", text.alias("t")).collect()}
    assert got[("signal_peptide", 0, 25)] == ("soft:1", "ID=signal_peptide1")
    assert got[("c_terminal_region", 20, 25)][1] == "Parent=signal_peptide1"
    assert got[("protein_match", 1, 90)] == (
        "soft:1:PHIBase:4", "Target=acc#PHI:1#g1__g2#x#y#Lethal 3 91;Gap=M40 D1 M49;tlen=100;evalue=1e-30;gapopen=1;pident=0.4;"
        "alnlen=90;raw=1.0;bits=30.0;mismatch=1;qcov=0.5;tcov=0.9")
    assert {k for k in got if k[0] == "transit_peptide"} == {("transit_peptide", 0, 90), ("transit_peptide", 0, 41)}
    assert "active_sites=1,2;5".replace(";", "%3B") in got[("protein_hmm_match", 0, 9)][1]
    assert len(got) == 9
    assert [r.type for r in features.empty_features(df).collect()] == ["polypeptide_motif"]
    again = found.select(text.alias("t"), attributes_text(parse_attributes(text)).alias("u"))
    assert all(sorted(r.t.split(";")) == sorted(r.u.split(";")) for r in again.collect())
    kept = features.features(df, keep_all=True)
    assert kept.filter("type = 'protein_match'").count() == 2


def test_summary_lists_and_flags(spark):
    rows = [
        envelope("phibase", HIT, database="PHIBase", database_version="4"),
        envelope("phibase", {**HIT, "target": "acc#PHI:2#g1#x#y#reduced_virulence", "evalue": 1e-40}, database="PHIBase", database_version="4"),
        envelope("kex2_cutsite", {"name": "a", "kind": "k", "pattern": "L[A-Z][A-Z]R", "match": "LKKR", "start": 4, "end": 8}),
        envelope("kex2_cutsite", {"name": "a", "kind": "k", "pattern": "[LIJVAP][A-Z][KRTPEI]R", "match": "LKKR", "start": 4, "end": 8}),
        envelope("deepsig", {"name": "a", "prediction": "SignalPeptide", "prob": 0.9, "cs_pos": 20}),
        envelope("tmhmm", {"name": "a", "length": 99, "exp_aa": 1.0, "first_60": 2.0, "pred_hel": 1, "topology": "i11-30o50-60i"}),
        envelope("effectorp1", {"name": "a", "prediction": "Non-effector", "prob": 0.9}),
        envelope("effectorp1", {"name": "a", "prediction": "Non-effector", "prob": 0.9}, version="2"),
    ]
    names = spark.createDataFrame([("C1", "x"), ("C1", "y")], "checksum string, name string")
    out = scoring.with_scores(summary.summary_table(result_frame(spark, rows), names)).collect()
    assert {r.name for r in out} == {"x", "y"}
    r = out[0]
    assert (r.phibase_genes, r.phibase_ids, r.phibase_phenotypes) == ("g1,g2", "PHI:2,PHI:1", "reduced_virulence,Lethal")
    assert (r.has_phibase_lethal_match, r.has_phibase_virulence_match, r.has_phibase_effector_match) == (1, 1, 0)
    assert r.kex2_cutsites == "LKKR:LXXR&[LIJVAP]X[KRTPEI]R:5-8"
    assert (r.signal_peptide_cutsites, r.tmhmm_domains, r.phobius_tm_domains) == ("DeepSig:20", "tm:11-30,50-60", None)
    assert r.tmhmm_first_tm_sp_coverage == 0.5
    assert abs(r.effectorp1 - 0.1) < 1e-12
    assert (r.any_signal_peptide, r.single_transmembrane, r.is_secreted) == (1, 0, 1)
    # 3 secreted + 0.25 deepsig; then effectorp1, virulence factor -1, lethal -5
    assert r.manual_secretion_score == 3.25
    assert abs(r.manual_effector_score - (3.25 + 6 * (0.1 - 0.5) - 1 - 5)) < 1e-9


def test_documented_rules_are_available(spark):
    cols = [*scoring.SIGNAL_COLUMNS, "tmhmm_tmcount", "phobius_tmcount"]
    df = spark.createDataFrame([(0,) * 7 + (1, 0, 3.0), (0,) * 7 + (2, 0, 3.0)],
                               ", ".join(f"{c} int" for c in cols) + ", tmhmm_first_60 double")
    effective = scoring.score_flags(df).select("single_transmembrane", "multiple_transmembrane").collect()
    documented = scoring.score_flags(df, intended=True).select("single_transmembrane", "multiple_transmembrane").collect()
    assert [tuple(r) for r in effective] == [(0, 0), (0, 1)] and [tuple(r) for r in documented] == [(1, 0), (0, 0)]
