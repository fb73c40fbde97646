from statistics import median

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from protolith.functions.attributes import attributes
from protolith.operators import graph, intervals, projection
from protolith.sinks import writers

RELAXED = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
span = st.tuples(st.integers(0, 90), st.integers(1, 40))


@RELAXED
@given(st.lists(st.tuples(st.integers(0, 1), span), min_size=1, max_size=12),
       st.lists(st.tuples(st.integers(0, 1), span), min_size=1, max_size=12))
def test_overlap_join_is_exact(spark, left, right):
    a = [(k, i, s, s + n) for i, (k, (s, n)) in enumerate(left)]
    b = [(k, i, s, s + n) for i, (k, (s, n)) in enumerate(right)]
    out = intervals.overlap_join(
        spark.createDataFrame(a, "k int, i int, ls bigint, le bigint"), ("ls", "le"),
        spark.createDataFrame(b, "k int, j int, rs bigint, re bigint"), ("rs", "re"), ["k"])
    got = sorted((r.i, r.j) for r in out.collect())
    assert got == sorted((i, j) for k, i, ls, le in a for q, j, rs, re in b if k == q and ls < re and rs < le)


def test_long_intervals_meet_the_top_block_size(spark):
    spans = [(0, 5), (100, 400_000), (65_536, 131_072), (65_535, 200_001), (399_999, 400_000)]
    points = [0, 4, 5, 99, 100, 65_535, 65_536, 131_071, 131_072, 200_000, 200_001, 399_999, 400_000]
    p = spark.createDataFrame([("c", x) for x in points], "c string, p bigint")
    s = spark.createDataFrame([("c", i, a, b) for i, (a, b) in enumerate(spans)], "c string, i int, s bigint, e bigint")
    got = sorted((r.p, r.i) for r in intervals.point_join(p, "p", s, "s", "e", ["c"]).collect())
    assert got == sorted((x, i) for x in points for i, (a, b) in enumerate(spans) if a <= x < b)


FOLDS = {"min": min, "max": max, "mean": lambda v: sum(v) / len(v), "median": median}


@pytest.mark.parametrize("reducer", list(FOLDS))
def test_folds_match_brute_force(spark, reducer):
    rows = [(c, s, s + n, float(v) if v % 5 else None)
            for i in range(120) for c, s, n, v in [("ab"[i % 2], (i * 37) % 90, 1 + (i * 13) % 40, (i * 29) % 17)]]
    df = spark.createDataFrame(rows, "c string, s int, e int, v double")
    got = {(r.seqid, r.start, r.end): r.v for r in intervals.fold_overlaps(df, "c", "s", "e", ["v"], reducer).collect()}
    want = {}
    for c in "ab":
        mine = [r for r in rows if r[0] == c]
        points = sorted({p for _, s, e, _ in mine for p in (s, e)})
        for lo, hi in zip(points, points[1:]):
            cover = [v for _, s, e, v in mine if s <= lo and hi <= e]
            known = [v for v in cover if v is not None]
            if cover:
                want[(c, lo, hi)] = FOLDS[reducer](known) if known else None
    assert got.keys() == want.keys()
    assert all((got[k] is None) == (want[k] is None) and (want[k] is None or abs(got[k] - want[k]) < 1e-9) for k in want)


def walk(exons, strand, start, end):
    """Sequential projection, base by base."""
    bases = [p for s, e in sorted(exons) for p in range(s, e)]
    if strand == "-":
        bases.reverse()
    chosen = sorted(bases[start * 3:end * 3])
    pieces = []
    for s, e in sorted(exons):
        inside = [p for p in chosen if s <= p < e]
        if inside:
            pieces.append((inside[0], inside[-1] + 1))
    return pieces


@RELAXED
@given(st.lists(st.tuples(st.integers(1, 30), st.integers(1, 9)), min_size=1, max_size=6), st.sampled_from("+-"),
       st.integers(0, 20), st.integers(1, 20))
def test_projection_matches_a_walk(spark, shape, strand, start, size):
    exons, at = [], 0
    for length, gap in shape:
        exons.append((at + gap, at + gap + length))
        at += gap + length
    ex = spark.createDataFrame([("p", "chr", strand, s, e) for s, e in exons],
                               "id string, seqid string, strand string, start int, end int")
    ft = spark.createDataFrame([("p", 1, start, start + size)], "id string, feature_id int, p_start int, p_end int")
    got = sorted((r.start, r.end) for r in projection.project(ft, ex).collect())
    assert got == walk(exons, strand, start, start + size)
    lost = projection.unprojectable(ft, ex).count()
    assert lost == (0 if got else 1)


def test_map_to_genome_parents(spark):
    ex = spark.createDataFrame([("p", "c", "+", 0, 30), ("p", "c", "+", 100, 160)],
                               "id string, seqid string, strand string, start int, end int")
    ft = spark.createDataFrame(
        [("p", 1, "protein_match", "t", "x", 5, 15), ("p", 2, "signal_peptide", "s", None, 0, 4),
         ("p", 3, "n_terminal_region", "s", None, 0, 2)],
        "id string, feature_id bigint, type string, source string, target string, p_start int, p_end int")
    rows = projection.map_to_genome(ft, ex).collect()
    tops = {(r.type, r.kind, r.own_id, r.start, r.end) for r in rows if r.own_id}
    assert tops == {("protein_match", None, "p-protein_match-1", 15, 115),
                    ("region", "signal_peptide", "polypeptide-p-2", 0, 12)}
    parts = {(r.type, r.start, r.end, r.parent) for r in rows if not r.own_id}
    assert parts == {("match_part", 15, 30, "p-protein_match-1"), ("match_part", 100, 115, "p-protein_match-1"),
                     ("signal_peptide", 0, 12, "polypeptide-p-2")}


def test_mapped_features_can_be_written(spark, tmp_path):
    ex = spark.createDataFrame([("p", "c", "-", 0, 30), ("p", "c", "-", 100, 160)],
                               "id string, seqid string, strand string, start int, end int")
    ft = spark.createDataFrame(
        [("p", 1, "protein_match", "t", "x", 15, 25, 2.5), ("p", 2, "signal_peptide", "s", None, 0, 4, None)],
        "id string, feature_id bigint, type string, source string, target string, p_start int, p_end int, score double")
    full = attributes(id=F.lit("old"), parent=F.array(F.lit("gone")), gap=F.array(F.struct(F.lit("M").alias("code"), F.lit(3).alias("length"))))
    ft = ft.withColumn("attributes", F.when(F.col("feature_id") == 1, full))
    writers.write_gff3(projection.map_to_genome(ft, ex), str(tmp_path / "g"))
    lines = sorted(r.value for r in spark.read.text(str(tmp_path / "g")).collect())
    assert lines == [
        "c\ts\tregion\t149\t160\t.\t-\t.\tID=polypeptide-p-2;kind=signal_peptide",
        "c\ts\tsignal_peptide\t149\t160\t.\t-\t.\tParent=polypeptide-p-2",
        "c\tt\tmatch_part\t101\t115\t2.5\t-\t.\tID=old;Parent=p-protein_match-1",
        "c\tt\tmatch_part\t16\t30\t2.5\t-\t.\tID=old;Parent=p-protein_match-1",
        "c\tt\tprotein_match\t16\t115\t2.5\t-\t.\tID=p-protein_match-1"]


def test_cuts_without_signal_are_dropped(spark):
    df = spark.createDataFrame([("a", "signal_peptide"), ("a", "propeptide_cleavage_site"),
                                ("b", "propeptide_cleavage_site"), ("b", "x")], "id string, type string")
    assert sorted(map(tuple, projection.drop_lonely_cuts(df).collect())) == [
        ("a", "propeptide_cleavage_site"), ("a", "signal_peptide"), ("b", "x")]


def test_graph_with_a_cycle_and_two_parents(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "a"), ("d", "b"), ("d", "c"), ("a", "d")],
                                  "child_id string, parent_id string")
    down = graph.descendants(edges, spark.createDataFrame([("a",)], "id string"))
    assert sorted((r.node_id, r.depth) for r in down.collect()) == [("a", 0), ("b", 1), ("c", 1), ("d", 2)]


def test_tree_order(spark):
    nodes = spark.createDataFrame([("r2", 5), ("r1", 1), ("x", 9), ("y", 3), ("z", 0)], "id string, start int")
    edges = spark.createDataFrame([("x", "r1"), ("y", "r1"), ("z", "y")], "child_id string, parent_id string")
    placed = graph.tree_order(nodes, edges, ["start"]).orderBy("position")
    assert [r.id for r in placed.collect()] == ["r1", "y", "z", "x", "r2"]


def test_tree_order_of_a_node_below_parents_at_different_depths(spark):
    nodes = spark.createDataFrame([("A", 1), ("B", 2), ("x", 1), ("n", 5), ("m", 6)], "id string, start int")
    edges = spark.createDataFrame([("x", "A"), ("n", "x"), ("n", "B"), ("m", "n")], "child_id string, parent_id string")
    placed = graph.tree_order(nodes, edges, ["start"]).orderBy("position")
    assert [r.id for r in placed.collect()] == ["A", "x", "n", "m", "B"]


def test_a_deep_chain(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(70)], "child_id int, parent_id int")
    down = graph.descendants(edges, spark.createDataFrame([(0,)], "id int"))
    assert sorted((r.node_id, r.depth) for r in down.collect()) == [(i, i) for i in range(71)]


def test_nan_is_skipped(spark):
    spans = spark.createDataFrame([("s", 0, 10, 1.0), ("s", 0, 10, float("nan"))], "seqid string, start int, end int, v double")
    for reducer in ("min", "max", "mean", "median"):
        assert {r.v for r in intervals.fold_overlaps(spans, "seqid", "start", "end", ["v"], reducer).collect()} == {1.0}


def test_rows_without_a_type_stay(spark):
    rows = spark.createDataFrame([("a", None), ("a", "propeptide_cleavage_site")], "id string, type string")
    assert [r.type for r in projection.drop_lonely_cuts(rows).collect()] == [None]


def test_trim_and_pad(spark):
    df = spark.createDataFrame([(0, 2), (0, 10), (50, 100)], "s int, e int")
    a, b = graph.trim(F.col("s"), F.col("e"), 8)
    c, d = graph.pad(F.col("s"), F.col("e"), 8, F.lit(105))
    assert [tuple(r) for r in df.select(a, b, c, d).collect()] == [(0, 2, 0, 10), (3, 7, 0, 18), (58, 92, 42, 105)]


def test_scores_count_a_protein_once(spark):
    from protolith.operators.genome_scores import merge_spans, numeric_subset, scores_to_genome

    ex = spark.createDataFrame(
        [("p", "c", 0, 10), ("p", "c", 4, 12), ("q", "c", 6, 20), ("none", "c", 8, 30), ("p", "c", 12, 14)],
        "id string, seqid string, start int, end int")
    merged = merge_spans(ex, ["seqid", "id"], "start", "end", bin_size=4)
    assert sorted(map(tuple, merged.collect())) == [
        ("c", "none", 8, 30), ("c", "p", 0, 14), ("c", "q", 6, 20)]
    ranked = spark.createDataFrame([("p", 1.0), ("q", 4.0)], "name string, charge double")
    got = {(r.start, r.end): r.charge for r in scores_to_genome(
        ex, numeric_subset(ranked, ["charge"]), ["charge"], "mean").collect()}
    assert got == {(0, 4): 1.0, (4, 6): 1.0, (6, 8): 2.5, (8, 10): 2.5, (10, 12): 2.5, (12, 14): 2.5, (14, 20): 4.0}
    with pytest.raises(ValueError):
        numeric_subset(ranked, ["nonsense"])


def test_bedgraph_file(spark, tmp_path):

    df = spark.createDataFrame([("c2", 0, 4, 1.5), ("c1", 4, 9, None)], "seqid string, start int, end int, v double")
    writers.write_bedgraph(df.coalesce(1), str(tmp_path / "b"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "b").glob("part-*")))
    lines = [x for x in text.splitlines() if not x.startswith("#")]
    assert text.startswith("#seqid\tstart\tend\tv") and lines == ["c1\t4\t9\tNA", "c2\t0\t4\t1.5"]


def test_match_files(spark, tmp_path):
    import json


    df = spark.createDataFrame([("s", "custom", "r", "R", 0, 1)],
                               "name string, kind string, pattern string, match string, start int, end int")
    writers.write_matches(df, str(tmp_path / "j"), ldjson=True)
    rows = [json.loads(x) for p in (tmp_path / "j").glob("part-*") for x in p.read_text().splitlines()]
    assert rows == [{"name": "s", "kind": "custom", "pattern": "r", "match": "R", "start": 0, "end": 1}]
    writers.write_matches(df.coalesce(1), str(tmp_path / "t"))
    text = "".join(p.read_text() for p in (tmp_path / "t").glob("part-*"))
    assert text == "name\tkind\tpattern\tmatch\tstart\tend\ns\tcustom\tr\tR\t0\t1\n"
