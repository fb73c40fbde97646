"""Store layout and log, feature files in tree order, strict summaries, and the composed mapping job."""

import json

import pytest
from pyspark.sql import functions as F

from protolith.functions import topology
from protolith.functions.attributes import attributes
from protolith.operators import projection, store, summary
from protolith.sinks import writers
from protolith.streaming.load import load_batch

RESULT = ", ".join(f"{c} string" for c in store.RESULT_COLUMNS)


def result(analysis, checksum, data="{}", version="1", database=None):
    return (analysis, "x", version, database and "db", database, None, checksum, "m" + checksum, data)


def test_a_join_with_checksums_leaves_the_store_in_place(spark, tmp_path):
    home = str(tmp_path / "store")
    rows = spark.createDataFrame([result(a, f"c{i}") for a in ("tmhmm", "phobius") for i in range(300)], RESULT)
    store.append_store(store.keep_first(rows, ["checksum"]), home)
    store.append_store(store.keep_first(rows.unionByName(rows), ["checksum"], store.read_store(spark, home)), home)
    held = store.read_store(spark, home)
    assert held.count() == 600
    targets = spark.createDataFrame([("tmhmm", "1", None), ("phobius", "2", None)], "analysis string, software_version string, database_version string")
    keys = spark.createDataFrame([(f"c{i}",) for i in range(0, 400, 7)], "checksum string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits = store.select_target(held, targets, keys)
        assert sorted(r.checksum for r in hits.collect()) == sorted(f"c{i}" for i in range(0, 300, 7))
        plan = hits._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # what is exchanged are the keys: once to be distinct, once to the store's buckets
    final = plan.partition("== Initial Plan ==")[0]
    assert "Bucketed: true" in final and final.count("Exchange hashpartitioning") == 2 and f", {store.BUCKETS})" in final, plan


def test_many_targets_are_joined_in_copies(spark, monkeypatch):
    rows = spark.createDataFrame([result("tmhmm", f"c{i}", version=str(i % 5)) for i in range(50)], RESULT)
    targets = spark.createDataFrame([("tmhmm", "1", None), ("tmhmm", "3", "ignored")], "analysis string, software_version string, database_version string")
    few = sorted(map(str, store.select_target(rows, targets).collect()))
    left = sorted(map(str, store.find_remaining(rows, targets, rows.select("checksum")).collect()))
    monkeypatch.setattr(store, "SMALL", 0)
    monkeypatch.setattr(store, "BUCKET", 1)
    assert sorted(map(str, store.select_target(rows, targets).collect())) == few and len(few) == 20
    assert sorted(map(str, store.find_remaining(rows, targets, rows.select("checksum")).collect())) == left and len(left) == 80


def test_the_earliest_row_of_a_key_is_kept(spark):
    rows = [(i, *result("tmhmm", f"c{i % 4}", json.dumps({"k": i}))) for i in range(12)] + [(0, *result("tmhmm", "c0", json.dumps({"k": 99})))]
    df = spark.createDataFrame(rows, "n bigint, " + RESULT)
    one = {r.checksum: r.n for r in store.keep_first(df, ["n"]).collect()}
    two = {r.checksum: r.n for r in store.keep_first(df, ["n", "data"]).collect()}
    assert one == two == {"c0": 0, "c1": 1, "c2": 2, "c3": 3}
    # kinds with many rows keep one for each payload; a missing database version is the empty one
    many = spark.createDataFrame([(i, *result("pfamscan", "c", str(i % 3), database=None if i % 2 else "")) for i in range(12)], "n bigint, " + RESULT)
    assert store.keep_first(many, ["n"]).count() == 3
    plan = store.keep_first(df, ["n"], df.limit(1))._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan


def test_a_finished_batch_is_skipped(spark, tmp_path):
    home = str(tmp_path / "store")
    line = json.dumps({"analysis": "tmhmm", "software": "T", "software_version": "1", "checksum": "c", "md5sum": "m", "data": {"name": "s", "length": 3}})
    lines = spark.createDataFrame([(line,), ("{broken",)], "value string")
    assert load_batch(lines, home, "run", 0) is True
    assert load_batch(lines, home, "run", 0) is False
    assert load_batch(lines, home, "run", 1) is True
    assert store.read_store(spark, home).count() == 1
    assert sorted((r.run, r.batch) for r in spark.read.parquet(f"{home}/batches").collect()) == [("run", 0), ("run", 1)]


FEATURE = "seqid string, source string, type string, start int, end int, score double, strand string, phase string, id string, parents array<string>"


def features(spark, rows):
    df = spark.createDataFrame([("c", "s", t, a, b, None, "+", ".", i, p) for t, a, b, i, p in rows], FEATURE)
    return df.withColumn("attributes", attributes(id=F.col("id"), parent=F.col("parents"))).drop("id", "parents")


def test_feature_files_in_tree_order(spark, tmp_path):
    rows = [("gene", 50, 90, "g2", None), ("CDS", 5, 9, None, ["m1"]), ("mRNA", 1, 20, "m1", ["g1"]), ("n_terminal_region", 1, 3, "n", ["g1"]),
            ("gene", 1, 30, "g1", None), ("CDS", 2, 4, "shared", ["m1", "g2"]), ("c_terminal_region", 70, 80, None, None), ("exon", 3, 4, None, ["n", "gone"])]
    path = tmp_path / "gff"
    writers.write_gff3_tree(features(spark, rows), str(path), files=3)
    lines = [x for p in sorted(path.glob("part-*")) for x in p.read_text().splitlines()]
    shown = ["###" if x == "###" else f"{x.split(chr(9))[2]}@{int(x.split(chr(9))[3]) - 1}" for x in lines]
    assert shown == ["gene@1", "exon@3", "mRNA@1", "CDS@2", "CDS@5", "###", "gene@50", "###", "###"]
    two = features(spark, rows).withColumn("source", F.when(F.col("type") == "exon", "t").otherwise("s")).withColumn("track", F.col("source"))
    writers.write_gff3_tree(two, str(tmp_path / "split"), partition=["track"], files=2)
    alone = [x for p in sorted((tmp_path / "split" / "track=t").glob("part-*")) for x in p.read_text().splitlines()]
    assert [x.split("\t")[0] for x in alone] == ["c", "###"]


def test_annotations_lose_what_mapping_does_not_keep(spark):
    rows = [("signal_peptide", 0, 4, "sp", None), ("n_terminal_region", 0, 2, "n", ["sp"]), ("protein_match", 1, 9, "pm", ["sp", "x"]), ("protein_match", 1, 9, None, None)]
    out = {(r.type, r.feature_id): r for r in projection.annotation_rows(features(spark, rows)).collect()}
    assert sorted(t for t, _ in out) == ["protein_match", "protein_match", "signal_peptide"]
    kept = {r.type: (r.attributes.id, r.attributes.parent) for r in out.values() if r.attributes.parent or r.type == "signal_peptide"}
    assert kept == {"signal_peptide": (None, None), "protein_match": ("pm", ["x"])}


def test_conflicting_predictions(spark):
    rows = [result("apoplastp", "a", json.dumps({"prediction": "Apoplastic", "prob": 0.75})), result("apoplastp", "a", json.dumps({"prediction": "Apoplastic", "prob": 0.5})),
            result("apoplastp", "b", json.dumps({"prediction": "Apoplastic", "prob": 0.75})), result("apoplastp", "b", json.dumps({"prediction": "Non-apoplastic", "prob": 0.25}))]
    df = spark.createDataFrame(rows, RESULT)
    assert [tuple(r) for r in summary.prediction_conflicts(df).collect()] == [("a", "apoplastp")]
    assert {r.checksum: r.apoplastp for r in summary.numeric_summary(df).collect()} == {"a": 0.75, "b": 0.75}
    assert summary.numeric_summary(df.filter("checksum = 'b'"), strict=True).count() == 1
    with pytest.raises(Exception, match="several values of apoplastp: a"):
        summary.numeric_summary(df, strict=True).collect()


def test_tables_of_a_kind_in_two_versions(spark):
    rows = spark.createDataFrame([result("tmhmm", "a", '{"name":"x"}'), result("tmhmm", "b", "{}", version="2"), result("phobius", "a", '{"name":"y","tm":2}')], RESULT)
    tables = store.analysis_tables(rows, ["tmhmm", "phobius"])
    assert [r.tm for r in tables["phobius"].collect()] == [2]
    with pytest.raises(Exception, match="several versions of tmhmm"):
        tables["tmhmm"].collect()


def test_topology_as_text(spark):
    df = spark.createDataFrame([("SSS..HHHbb",), ("....",), ("BB.H",), (None,)], "x string")
    assert [r[0] for r in df.select(topology.summary_text(F.col("x"))).collect()] == ["sp:1-3|tm:6-8,9-10", None, "tm:1-2,4-4", None]
