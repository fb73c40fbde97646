"""Work spreads over the cores, and what moves between tasks stays small."""

import random
from pathlib import Path
from statistics import mean, median

import pytest
from pyspark.sql import functions as F

from protolith.functions.attributes import attributes, parse_attributes
from protolith.functions.text import by_line_ends, number_text, strip, trimmed
from protolith.operators import genome_scores, intervals, projection
from protolith.plans import JOBS
from protolith.plans import bindings as B
from protolith.plans import ingest_jobs
from protolith.session import RUNTIME_SETTINGS
from protolith.sources import gff3


@pytest.fixture
def tables(spark, tmp_path):
    """A folder with one-file tables: a single split each."""
    def put(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
        return str(tmp_path)
    return put


def test_matches_of_one_small_file_go_to_all_cores(spark, tables):
    sf = tables("part", [(i, f"type {i}", 7) for i in range(64)], "p_partkey bigint, p_type string, p_size int")
    found = JOBS["interpro_features"](spark, sf)
    # one task for the whole table before
    assert found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert found.count() == 64 * 15


@pytest.mark.parametrize("name, rows", [("src_blocks", 40 * 5), ("src_lines", 40 * 28)])
def test_files_are_written_by_all_cores(spark, tables, name, rows):
    sf = tables("events", [(i, 0, 1.0, '{"k": %d}' % (i % 9), "x") for i in range(40)],
                "event_id bigint, user_id bigint, value double, props string, event_type string")
    spark.sql(f"SELECT *, timestamp'2020-01-01 00:00:00' AS ts FROM parquet.`{sf}/events.parquet`").coalesce(1).write.parquet(f"{sf}/more/events.parquet")
    found = JOBS[name](spark, f"{sf}/more")
    assert len([f for f in found.inputFiles() if "pepstats" in f or "deepsig" in f]) >= spark.sparkContext.defaultParallelism
    assert found.filter(F.col("problem").isNull()).count() == rows


def test_block_files_are_packed(spark, tables, monkeypatch):
    monkeypatch.setattr(ingest_jobs, "BLOCKS_PER_FILE", 200, raising=False)
    sf = tables("events", [(i, i % 7, 1.0, '{"k": %d}' % (i % 100), "x") for i in range(4000)],
                "event_id bigint, user_id bigint, value double, props string, event_type string")
    spark.sql(f"SELECT *, timestamp'2020-01-01 00:00:00' AS ts FROM parquet.`{sf}/events.parquet`").coalesce(1).write.parquet(f"{sf}/more/events.parquet")
    found = JOBS["src_blocks"](spark, f"{sf}/more")
    files = [Path(f.removeprefix("file:")) for f in found.inputFiles()]
    # 2,500 bytes of text an event before
    assert sum(f.stat().st_size for f in files) < 500 * 4000
    # and none of them keeps one task long
    assert len(files) >= 4 * 4000 / 200
    assert {r.kind: r["count"] for r in found.groupBy("kind").count().collect()} == {"pepstats": 4000, "tmbed": 4000, "deeptmhmm": 4000, "hhr": 8000}
    assert found.filter("kind = 'pepstats' AND problem IS NULL").select("name").distinct().count() == 4000


def test_methods_that_the_jvm_would_not_compile_are_not_made():
    assert int(RUNTIME_SETTINGS["spark.sql.codegen.hugeMethodLimit"]) <= 8000


FOLDS = {"min": min, "max": max, "mean": mean, "median": median}


def folded_plainly(exons, scores, reducer):
    """Segment by segment: the scores of each protein that covers it, once."""
    out = {}
    for q in {x[1] for x in exons if x[1]}:
        mine = [x for x in exons if x[1] == q]
        points = sorted({p for x in mine for p in x[2:] if p is not None})
        for a, b in zip(points, points[1:]):
            over = {x[0] for x in mine if None not in x and x[2] <= a and x[3] >= b}
            held = [v for n, v in scores if n in over]
            known = [v for v in held if v is not None and v == v]
            if held:
                out[q, a, b] = round(FOLDS[reducer](known), 6) if known else None
    return out


@pytest.mark.parametrize("crowd", [1 << 14, 20])
@pytest.mark.parametrize("reducer", list(FOLDS))
def test_scores_fold_over_buckets(spark, monkeypatch, reducer, crowd):
    monkeypatch.setattr(intervals, "CROWD", crowd)
    monkeypatch.setattr(intervals, "MEDIAN_CROWD", crowd)
    monkeypatch.setattr(intervals, "PAIRS", 50)
    draw = random.Random(3)
    exons = [(draw.randrange(20), draw.choice(["x", "y", None]), a, a + draw.choice([0, 5, 40, 90, 4096])) for a in (draw.randrange(9000) for _ in range(90))]
    # far over several buckets, up to a bucket's edge, backwards, and half known
    exons += [(1, "x", 100, 40_000), (2, "x", 4096, 8192), (3, "y", 12_288, 16_384), (4, "x", 900, 700), (5, "y", None, 6000), (None, "x", 30, 60)]
    scores = [(n, draw.choice([1.0, 2.5, float("nan"), None, n / 3])) for n in range(15)] + [(1, 7.0), (2, 2.0), (2, 2.0)]
    got = genome_scores.scores_to_genome(spark.createDataFrame(exons, "id int, seqid string, start bigint, end bigint"),
                                         spark.createDataFrame(scores, "name int, value double"), ["value"], reducer)
    found = {(r.seqid, r.start, r.end): None if r.value is None else round(r.value, 6) for r in got.collect()}
    assert got.count() == len(found) and found == folded_plainly(exons, scores, reducer)


def test_one_fold_moves_each_span_few_times(spark):
    """Spans meet scores, and pieces their buckets; before, events, places and pairs went over a dozen exchanges."""
    exons = spark.range(500).selectExpr("id % 50 AS id", "id % 3 AS seqid", "id AS start", "id + 20 AS end")
    scores = spark.range(50).selectExpr("id AS name", "CAST(id AS double) AS value")
    plan = []
    real = intervals.stored
    try:
        intervals.stored = lambda df, label: (plan.append(df._jdf.queryExecution().executedPlan().toString()), real(df, label))[1]
        out = genome_scores.scores_to_genome(exons, scores, ["value"], "median")
    finally:
        intervals.stored = real
    plan.append(out._jdf.queryExecution().executedPlan().toString())
    assert out.count() > 0 and sum(p.partition("== Initial Plan ==")[0].count("Exchange") for p in plan) <= 10


def test_line_features_are_counted_without_sorting(spark, tables):
    sf = tables("lineitem", [(1, 1, 5, "B"), (1, 1, 7, "A"), (1, 2, 5, "A"), (1, 2, 5, "0"), (2, 1, 4, None), (2, 2, 4, "R")],
                "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_returnflag string")
    rows = B.line_features(spark, sf)
    assert "SortAggregate" not in JOBS["feature_groups"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert {r.feature_id: r.source for r in rows.collect()} == {11: "toolA", 12: "toolB", 21: "toolB", 22: "toolB"}


def test_parts_of_line_features_follow_the_rows(spark, tables, monkeypatch):
    sf = tables("lineitem", [(i // 4, i % 4, 5, "A") for i in range(400)], "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_returnflag string")
    monkeypatch.setattr(B, "ROWS_PER_TASK", 10)
    found = JOBS["feature_groups"](spark, sf)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert found.rdd.getNumPartitions() == 40


def proteins(spark):
    """Exons and features of twelve proteins: no length, one place twice, mixed strands, backwards, unknown, and none at all."""
    draw = random.Random(5)
    exons = [(i, f"c{i % 3}", draw.choice("+-") if i == 3 else "+-."[i % 3 if i > 8 else i % 2], "s", at, at + draw.choice([0, 4, 9, 30]))
             for i in range(12) for at in (draw.randrange(900) for _ in range(i))]
    exons += [(4, "c1", None, "s", 5000, 5010), (5, "c2", "-", "s", 700, 730), (5, "c2", "-", "s", 700, 730), (None, "c1", "+", "s", 1, 90), (6, "c0", "+", "s", None, 8)]
    kinds = ["signal_peptide", "protein_match", "propeptide_cleavage_site", "transmembrane_polypeptide_region", "n_terminal_region", "other"]
    rows = [(i, 100 * (i or 99) + n, draw.choice(kinds[(i or 0) % 2:]), draw.choice("ab"), draw.choice(["t", "u", None]), draw.choice([-3, 0, 2, 5, None]), draw.choice([1, 9, 40, None]))
            for i in [*range(14), None] for n in range(7)]
    rows += [(7, None, "other", "a", "t", 1, 9), (7, 799, "other", "b", "t", 1, 9), (7, 799, "other", "b", "t", 1, 9)]
    rows += [(1, 199, "protein_match", "a", "t", 0, 1), (1, 199, "other", "a", "t", 0, 1)]
    return (spark.createDataFrame(rows, "id bigint, feature_id bigint, type string, source string, target string, p_start int, p_end int"),
            spark.createDataFrame(exons, "id bigint, seqid string, strand string, source string, start bigint, end bigint"))


def in_text(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how, full", [({}, True), ({"grouped": False}, False)])
def test_features_meet_exons_as_if_swept(spark, monkeypatch, how, full):
    features, exons = proteins(spark)
    if full:
        number = F.col("feature_id").cast("string")
        features = features.withColumns({"score": F.col("feature_id") / 4, "attributes": attributes(id=number, gap=F.array(F.struct(F.lit("M").alias("code"), F.lit(1).alias("length"))))})
    assert {r.id for r in projection.apart(features, exons).collect()} == {None, 4}
    met = projection.map_to_genome(features, exons, **how), projection.project(features, exons)
    monkeypatch.setattr(projection, "PAIRS", 1)
    assert {r.id for r in projection.apart(features, exons).collect()} > {None, 4, 7}
    some = projection.map_to_genome(features, exons, **how), projection.project(features, exons)
    monkeypatch.setattr(projection, "CROWD", 0)
    swept = projection.map_to_genome(features, exons, **how), projection.project(features, exons)
    assert swept[0].count() > 60 and swept[0].dtypes == met[0].dtypes
    for a, b, c in zip(met, some, swept):
        assert in_text(a) == in_text(c) and in_text(b) == in_text(c)


def test_a_feature_without_exon_fails_where_it_meets_them(spark):
    exons = spark.createDataFrame([(1, "c", "+", 0, 30), (1, "c", "+", 50, 80), (2, "c", "+", 5, 5)], "id int, seqid string, strand string, start bigint, end bigint")
    fits = spark.createDataFrame([(1, 1, 2, 30), (2, 2, 0, 4), (3, 3, 0, 4)], "id int, feature_id int, p_start int, p_end int")
    assert projection.project(fits, exons, strict=True).count() == 2
    for bad in [(1, 7, 20, 25), (1, 7, 4, 4), (1, 7, None, 4), (1, 7, -5, 0)]:
        with pytest.raises(Exception, match="feature reaches no exon: 7"):
            projection.project(fits.union(spark.createDataFrame([bad], fits.schema)), exons, strict=True).collect()


@pytest.mark.parametrize("name", ["project_features", "project_generic"])
def test_rows_of_a_protein_meet_once(spark, tables, monkeypatch, name):
    """Before, eleven tables were written on the way and rows went over exchanges for each step."""
    sf = tables("lineitem", [(i // 4, i % 4 + 1, i, float(i % 30), "A") for i in range(400)],
                "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_quantity double, l_returnflag string")
    written = []
    real = projection.stored
    monkeypatch.setattr(projection, "stored", lambda df, label: (written.append(label), real(df, label))[1])
    found = JOBS[name](spark, sf)
    assert written == ["apart"]
    # lines as features and lines as exons, for counts and for places
    assert found._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0].count(" Exchange hashpartitioning") <= 3
    assert found.count() > 0


def test_gff_lines_are_split_once_and_written_by_all_cores(spark, tables):
    sf = tables("lineitem", [(i, i % 7, i, i % 5, 3.0, 0.05 * (i % 2), "A") for i in range(64)],
                "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_discount double, l_returnflag string")
    found = JOBS["snk_gff"](spark, sf)
    # before, one small file was one task, and the filter split the line once for each of its checks
    assert len(found.inputFiles()) >= spark.sparkContext.defaultParallelism
    filters = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if x.lstrip(" +-:").startswith("Filter")]
    assert filters and not any("split(" in x for x in filters)
    assert found.count() == 64 and found.filter("id <> '' AND parents LIKE 'p=%|q,r' AND tag = 'A'").count() == 64


def test_odd_attribute_texts(spark):
    texts = {
        " ;ID=a;; Name = b c ;ID=z; ": ("z", "b c", None, {}), "Parent= ,p%2Cq, r ,;k=1,2;=x;e=;nothing": (None, None, ["p,q", "r"], {"k": ["1", "2"], "": ["x"]}),
        ".": (None, None, None, {}), 'ID="q";Note=\'n\'': ('"q"', None, None, {}), "ID=%253B;k==v=": ("%3B", None, None, {"k": ["=v="]}), "ID=%2509x%0A": ("%09x\n", None, None, {})}
    lines = [(f"c\ts\tt\t1\t9\t.\t+\t.\t{t}",) for t in texts] + [("  c\ts\tt\t1\t9\t1e-05\t+\t.\t",), ("#x",), ("   ",), ("c\ts",)]
    rows = gff3.parse_gff3(spark.createDataFrame(lines, "value string")).collect()
    assert [r.problem for r in rows] == [None] * 7 + ["columns"] and rows[6].score == 1e-05
    for row, (id_, name, parent, custom) in zip(rows, texts.values()):
        a = row.attributes
        assert (a.id, a.name, a.parent, a.custom) == (id_, name, parent, custom)
    alone = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_attributes(F.col("t")).alias("a"))
    assert [r.a for r in alone.collect()] == [r.attributes for r in rows[:6]]


def test_numbers_as_text(spark):
    found = spark.createDataFrame([(x,) for x in (12.5, 0.0001, 1e-05, 1.2e-30, 1e7, 1.5e16, float("nan"), float("inf"), None, 0.0)], "x double").select(number_text(F.col("x")))
    assert [r[0] for r in found.collect()] == ["12.5", "0.0001", "1e-05", "1.2e-30", "10000000.0", "1.5e+16", "NaN", "Infinity", None, "0.0"]


def test_parts_of_annotations_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(projection, "ROWS_PER_TASK", 10)
    rows = spark.range(400).select(
        (F.col("id") % 50).cast("string").alias("seqid"), F.lit("s").alias("source"), F.lit("signal_peptide").alias("type"), F.lit(0).alias("start"),
        F.lit(9).alias("end"), F.lit(None).cast("double").alias("score"), attributes(id=F.col("id").cast("string")).alias("attributes"))
    found = projection.annotation_rows(rows)
    assert found.rdd.getNumPartitions() == 40 and found.count() == 400


def test_trimmed_is_the_regex(spark):
    draw = random.Random(2)
    texts = ["".join(draw.choice(" \t\n\r\x0b\f\u0085\u2028\u2029;,'\"ab\u00a0") for _ in range(draw.randrange(7))) for _ in range(3000)] + [None, ""]
    c = F.col("t")
    sets = {" \t\n\x0b\f\r": strip(c), **{s: F.regexp_replace(c, f"^[{s}]+|[{s}]+$", "") for s in (", ", " ;", " '\"")}}
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for chars, plainly in sets.items():
        assert rows.filter(~trimmed(c, chars).eqNullSafe(plainly)).count() == 0
        assert rows.filter(~by_line_ends(c, lambda trim: trim(c, chars)).eqNullSafe(plainly)).count() == 0
