"""Readers and writers: text made from the tables, written, read, and compared."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.attributes import attributes, custom_from, gap_from_cigar, gap_text, target
from ..operators.ordered import number_rows
from ..operators.sequences import normalise
from ..session import scratch, spread, stored
from ..sinks import writers
from ..sources import blocks, gff3, interpro, lines, sequences
from . import bindings as B
from .registry import job
from .sequence_jobs import LETTERS

EV = f"WITH {B.EVENTS_SQL}"
# a compressed file is read by one task, so files end after so many blocks
BLOCKS_PER_FILE = 1 << 14


def _written(spark: SparkSession, df: DataFrame, line: Column, label: str, **options) -> str:
    path = scratch(spark, label)
    df.select(line.alias("value")).write.mode("overwrite").options(**options).text(path)
    return path


def _s(c: str) -> Column:
    return F.col(c).cast("string")


# -- sequences ----------------------------------------------------------------------
@job("src_fasta", f"WITH {LETTERS} SELECT CAST(doc_id AS STRING) AS id, seq FROM seqs")
def src_fasta(spark, sf):
    """Records on one line each, with a description behind the id."""
    rows = B.letters(spark, sf).withColumn("seq", normalise(F.col("seq")))
    path = _written(spark, rows, F.concat(
        F.lit(">"), F.col("id"), F.lit(" from "), F.col("filename"), F.lit("\n"), F.col("seq")), "fasta")
    return sequences.read_fasta(spark, path).select("id", "seq")


@job("snk_fasta", f"WITH {LETTERS} SELECT CAST(doc_id AS STRING) AS id, seq FROM seqs")
def snk_fasta(spark, sf):
    rows = B.letters(spark, sf).withColumn("seq", normalise(F.col("seq")))
    path = scratch(spark, "fasta")
    writers.write_fasta(rows, path, id_="id")
    return sequences.read_fasta(spark, path).select("id", "seq")


@job("src_getorf", "SELECT 'chr' || CAST(l_suppkey AS STRING) AS seqid, 'CDS' AS type, CAST(l_partkey AS INT) AS start, "
     "CAST(l_partkey + l_quantity AS INT) AS \"end\", CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '-' END AS strand, "
     "'0' AS phase, 'chr' || CAST(l_suppkey AS STRING) || '_' || CAST(l_orderkey AS STRING) AS id FROM lineitem")
def src_getorf(spark, sf):
    row = B.table(spark, sf, "lineitem").selectExpr(
        "concat('chr', l_suppkey, '_', l_orderkey) AS id", "CAST(l_partkey + 1 AS INT) AS a",
        "CAST(l_partkey + l_quantity AS INT) AS b", "l_linenumber % 2 = 0 AS forward")
    line = F.when(F.col("forward"), F.format_string(">%s [%d - %d] \nATG", "id", "a", "b")).otherwise(
        F.format_string(">%s [%d - %d] (REVERSE SENSE) \nATG", "id", "b", "a"))
    fasta = sequences.read_fasta(spark, _written(spark, row, line, "orfs"))
    return sequences.orf_order(sequences.orf_features(fasta)).select(
        "seqid", "type", "start", "end", "strand", "phase", "id")


# -- line formats ---------------------------------------------------------------------


def _name() -> Column:
    return F.concat(F.lit("P"), _s("e"))


def _tabbed(*parts: Column) -> Column:
    return F.concat_ws("\t", *parts)


def _line_sources(spark, sf) -> dict[str, Column]:
    k = F.col("k")
    score = F.format_string("0.%02d", k)
    broken = k % 10 == 9
    return {
        "deepsig": _tabbed(
            _name(), F.when(broken, "Nonsense").when(k % 3 == 0, "SignalPeptide").otherwise("Other"), score,
            F.when(k % 3 == 0, _s("k")).otherwise("-")),
        "tmhmm": _tabbed(
            _name(), F.lit("len=200"), F.concat(F.lit("ExpAA="), score), F.concat(F.lit("First60="), score),
            F.concat(F.when(broken, F.lit("Hel=")).otherwise("PredHel="), _s("k")), F.lit("Topology=o")),
        "phobius": F.concat_ws("   ", _name(), _s("k"), F.when(broken, "X").when(k % 2 == 0, "Y").otherwise("0"), F.lit("o")),
        "localizer": _tabbed(
            _name(), F.when(k % 2 == 0, F.concat(F.lit("Y ("), score, F.lit(" | "), _s("k"), F.lit("-90)"))).otherwise("-"),
            F.when(broken, "maybe").otherwise("-"), F.when(k % 5 == 0, "Y (KRKK)").otherwise("-")),
        "effectorp3": _tabbed(
            _name(), F.when(k % 2 == 0, F.concat(F.lit("Y ("), score, F.lit(")"))).otherwise("-"), F.lit("-"),
            F.lit("-"), F.when(broken, "?").otherwise("Non-effector")),
        "phibase": F.concat_ws(
            "\t", _name(), F.lit("acc#PHI:1#g#t#o#lethal"), (k + 1).cast("string"), F.lit("190"), F.lit("200"),
            F.lit("1"), F.lit("90"), F.lit("150"), F.lit("1e-10"), F.lit("0"), F.lit("0.5"), F.lit("90"), F.lit("55"),
            F.when(broken, "x").otherwise("55"), F.lit("90M"), F.lit("3"), F.lit("0.4"), score),
        "dbcan": F.concat_ws(
            "  ", F.lit("GH10.hmm"), F.lit("-"), F.lit("100"), _name(), F.lit("-"), F.lit("200"), F.lit("1e-20"),
            F.lit("60.1"), F.lit("0.1"), F.lit("1"), F.lit("1"), F.lit("1e-20"), F.lit("1e-19"), F.lit("59"),
            F.lit("0.1"), F.lit("1"), F.when(broken, "end").otherwise("100"), (k + 1).cast("string"), F.lit("180"), F.lit("1"),
            F.lit("190"), score, F.lit("a free text")),
    }


# the other kinds as one line each: name {n}, integer {k}, number {s}, and [good>bad] where every tenth line is malformed;
# then the integer and the number the check looks at, with their SQL, and the field that is malformed
_HUNDREDTH = "CAST(k AS DOUBLE) / 100"
_TEMPLATES = {
    "signalp3_nn": ("{n}  {s} 21 [Y>X]  0.6 {k} Y  0.9 5 Y  0.8 Y  0.7 Y", "ymax_pos", "k", "cmax", _HUNDREDTH, "cmax_decision"),
    "signalp3_hmm": ("{n}  S  {s} {k} Y  0.99 [Y>X]", "cmax_pos", "k", "cmax", _HUNDREDTH, "sprob_decision"),
    "signalp4": ("{n} {s} 21 0.6 {k} 0.9 5 0.8 0.7 [Y>X] 0.45 SignalP-noTM", "ymax_pos", "k", "cmax", _HUNDREDTH, "decision"),
    "signalp5": ("{n}\t[SP(Sec/SPI)>Odd]\t{s}\t0.1\tCS pos: {k}-21. VLA-AP. Pr: 0.85", "prob_other", "0", "prob_signal", _HUNDREDTH, "prediction"),
    "signalp6": ("{n}\t[SP>Odd]\t0.1\t{s}\tCS pos: 20-21. Pr: 0.85", "prob_other", "0", "prob_signal", _HUNDREDTH, "prediction"),
    "deeploc": ("{n}\t[Nucleus>Odd]\t{s}" + "\t0.1" * 10, "peroxisome", "0", "membrane", _HUNDREDTH, "prediction"),
    "deeploc2": ("{n},[Cytoplasm|Nucleus>Odd],Signal peptide,{s}" + ",0.25" * 9, "peroxisome", "0", "cytoplasm", _HUNDREDTH, "localisations"),
    "targetp_plant": ("{n}\t[cTP>Odd]\t{s}\t0.1\t0.1\t0.6\t0.1\tCS pos: 20-21. VLA-AP. Pr: 0.5", "lutp", "0", "other", _HUNDREDTH, "prediction"),
    "targetp_non_plant": ("{n}\t[noTP>Odd]\t{s}\t0.05\t0.05", "mtp", "0", "other", _HUNDREDTH, "prediction"),
    "effectorp1": ("{n}\t[Effector>Odd]\t{s}", "prob", "0", "prob", _HUNDREDTH, "prediction"),
    "effectorp2": ("{n}\t[Unlikely effector>Odd]\t{s}", "prob", "0", "prob", _HUNDREDTH, "prediction"),
    "effectorp3_fungal": ("{n}\t-\t-\tY ({s})\t[Non-effector>Odd]", "noneffector_prob", "0", "noneffector_prob", _HUNDREDTH, "prediction"),
    "apoplastp": ("{n}\t[Apoplastic>Odd]\t{s}", "prob", "0", "prob", _HUNDREDTH, "prediction"),
    "pfamscan": ("{n} 11 50 10 51 PF1.1 dom Family 2 40 {k} {s} 1e-10 [1>7] No_clan predicted_active_site[5,9][30]", "hmm_len", "k", "bitscore",
                 _HUNDREDTH, "is_significant"),
    "effectordb": ("E.hmm.hmm - 100 {n} - 200 1e-20 {s} 0.1 1 1 1e-20 1e-19 59 0.1 1 [100>end] 11 {k} 1 190 0.9 -", "query_to", "k", "full_score",
                   _HUNDREDTH, "hmm_to"),
    "regexanalysis": ("{n}\tcustom\tR.L\tRAL\t{k}\t[9>x]", "start", "k", "start", "CAST(k AS DOUBLE)", "end"),
    "kex2_cutsite": ("{n}\tkex2_cutsite\t[KR]R\tKR\t{k}\t[9>x]", "start", "k", "start", "CAST(k AS DOUBLE)", "end"),
    "rxlr_like_motif": ("{n}\trxlr_like_motif\tx\tRALR\t{k}\t[9>x]", "start", "k", "start", "CAST(k AS DOUBLE)", "end"),
    "deepredeff_fungi": ("{n}\t{s}\t[effector>odd]", "s_score", "0", "s_score", _HUNDREDTH, "prediction"),
    "deepredeff_oomycete": ("{n}\t{s}\t[non-effector>odd]", "s_score", "0", "s_score", _HUNDREDTH, "prediction"),
    "deepredeff_bacteria": ("{n}\t{s}\t[effector>odd]", "s_score", "0", "s_score", _HUNDREDTH, "prediction"),
}


def _from_template(template: str) -> Column:
    def filled(which: int) -> Column:
        text = F.lit(re.sub(r"\[([^\[\]>]*)>([^\[\]]*)\]", lambda m: m[which], template))
        for token, value in (("{n}", _name()), ("{k}", _s("k")), ("{s}", F.format_string("0.%02d", F.col("k")))):
            text = F.replace(text, F.lit(token), value)
        return text
    return F.when(F.col("k") % 10 == 9, filled(2)).otherwise(filled(1))


# per kind: the two integers and the number the check looks at
_LINE_VIEWS = {
    "deepsig": ("cs_pos", "prob", "prediction"), "tmhmm": ("pred_hel", "exp_aa", "exp_aa"),
    "phobius": ("tm", "tm", "sp"), "localizer": ("chloroplast_start", "chloroplast_prob", "mitochondria_decision"),
    "effectorp3": ("cytoplasmic_prob", "cytoplasmic_prob", "prediction"),
    "phibase": ("qstart", "tcov", "bits"), "dbcan": ("query_from", "acc", "hmm_to"),
}


def _lines_sql() -> str:
    s = "CAST(k AS DOUBLE) / 100"
    views = {
        "deepsig": ("CASE WHEN k % 3 = 0 THEN k END", s),
        "tmhmm": ("k", s), "phobius": ("k", "CAST(k AS DOUBLE)"),
        "localizer": ("CASE WHEN k % 2 = 0 THEN k + 19 END", f"CASE WHEN k % 2 = 0 THEN {s} END"),
        "effectorp3": ("CASE WHEN k % 2 = 0 THEN 0 END", f"CASE WHEN k % 2 = 0 THEN {s} END"),
        "phibase": ("k", s), "dbcan": ("k", s),
    }
    problems = {"deepsig": "prediction", "tmhmm": "pred_hel", "phobius": "sp", "localizer": "mitochondria_decision",
                "effectorp3": "prediction", "phibase": "bits", "dbcan": "hmm_to"}
    for kind, (_, _, i, _, x, problem) in _TEMPLATES.items():
        views[kind], problems[kind] = (i, x), problem
    parts = []
    for kind, (i, x) in views.items():
        parts.append(
            f"SELECT '{kind}' AS kind, CASE WHEN k % 10 < 9 THEN 'P' || CAST(e AS STRING) END AS name, "
            f"CASE WHEN k % 10 < 9 THEN CAST({i} AS INT) END AS i, CASE WHEN k % 10 < 9 THEN ROUND({x}, 6) END AS x, "
            f"CASE WHEN k % 10 = 9 THEN '{problems[kind]}' END AS problem FROM ev")
    return f"{EV} " + " UNION ALL ".join(parts)


@job("src_lines", _lines_sql())
def src_lines(spark, sf):
    """All formats written as files and ingested; a tenth of the lines is malformed."""
    rows = stored(spread(B.events(spark, sf).select("e", "k")), "events")
    sources = {**_line_sources(spark, sf), **{kind: _from_template(t[0]) for kind, t in _TEMPLATES.items()}}
    assert set(sources) == set(lines.FORMATS)
    out = None
    for kind, line in sources.items():
        parsed = lines.read_lines(spark, kind, _written(spark, rows, line, kind))
        i, x = _LINE_VIEWS[kind][:2] if kind in _LINE_VIEWS else (_TEMPLATES[kind][1], _TEMPLATES[kind][3])
        name = "query" if kind in ("phibase", "dbcan", "effectordb") else "name"
        view = parsed.select(
            F.lit(kind).alias("kind"), F.col(f"data.{name}").alias("name"),
            F.floor(F.col(f"data.{i}").cast("double")).cast("int").alias("i"),
            F.round(F.col(f"data.{x}").cast("double"), 6).alias("x"), "problem")
        out = view if out is None else out.unionByName(view)
    return out


# -- block formats ----------------------------------------------------------------------
def _pepstats_block() -> Column:
    k = F.col("k")
    residues = [F.format_string(f"{a.upper()} = Xxx\t\t%d\t\t%d.500\t\t1.100  \t", (k + i) % 10, k)
                for i, a in enumerate("abcdefghijklmnopqrstuvwxyz")]
    properties = [F.format_string(f"{p}\t\t(A+C+G)\t\t%d\t\t %d.250", (k * (i + 1)) % 50, k) for i, p in enumerate(
        ("Tiny", "Small", "Aliphatic", "Aromatic", "Non-polar", "Polar", "Charged", "Basic", "Acidic"))]
    head = F.format_string(
        "PEPSTATS of P%d from 1 to 99\n\nMolecular weight = %d.25  \t\tResidues = %d   \n"
        "Average Residue Weight  = 104.340 \tCharge   = -%d.5   \nIsoelectric Point = %s\n"
        "A280 Molar Extinction Coefficients  = 26930 (reduced)   26930 (cystine bridges)\n"
        "A280 Extinction Coefficients 1mg/ml = 0.531 (reduced)   0.531 (cystine bridges)\n"
        "Improbability of expression in inclusion bodies = 0.791\n\n", F.col("e"), k * 100, k + 100, k,
        F.when(k % 7 == 0, "None").otherwise("9.5"))
    return F.concat(
        head, F.lit("Residue\t\tNumber\t\tMole%\t\tDayhoffStat\n"), F.array_join(F.array(*residues), "\n"),
        F.lit("\n\nProperty\tResidues\t\tNumber\t\tMole%\n"), F.array_join(F.array(*properties), "\n"), F.lit("\n"))


_LABELLED = "repeat('S', k) || repeat('.', 5) || repeat('H', 15) || repeat('h', k)"


def _profile_block() -> Column:
    """A query with two templates, each in two rows; every tenth lacks a value."""
    k = F.col("k")
    evalue = F.when(k % 10 == 9, "").otherwise("E-value=1e-30  ")

    def template(j: int) -> Column:
        return F.concat(
            F.lit(f"\nNo {j}\n>T{j} a template\nProbab=99.90  "), evalue, F.lit("Score=200.5  Aligned_cols=6  Identities="), k.cast("string"),
            F.lit(".5%  Similarity=0.9  Sum_probs=5.5\n\nQ ss_pred             HHH\nQ seq1             3 MKV    5 (120)\n"
                  "Q Consensus        3 mkv    5 (120)\nT Consensus        7 mrv    9 (800)\n"
                  f"T T{j}               7 MRV    9 (800)\nConfidence           9 8\n\nQ seq1             6 AC-    7 (120)\n"
                  f"T T{j}              10 ACD   "), (k + 9 + j).cast("string"), F.lit(" (800)\nConfidence           765\n\n"))

    return F.concat(F.lit("Query         "), _name(), F.lit(" of ev\nMatch_columns 120\nNeff          3.5\n\n"), template(1), template(2))


@job("src_blocks", f"{EV} SELECT 'pepstats' AS kind, 'P' || CAST(e AS STRING) AS name, CAST(k * 100 + 0.25 AS DOUBLE) AS x, "
     "(k + 2) % 10 AS i, CAST(k * 5 % 50 AS STRING) AS t, NULL AS problem FROM ev UNION ALL "
     f"SELECT 'tmbed', 'P' || CAST(e AS STRING), CAST(CASE WHEN k > 10 THEN 1 ELSE 0 END AS DOUBLE), 1, {_LABELLED}, NULL FROM ev "
     "UNION ALL SELECT 'deeptmhmm', CASE WHEN k % 10 < 9 THEN 'P' || CAST(e AS STRING) END, CASE WHEN k % 10 < 9 THEN "
     "CAST(0 AS DOUBLE) END, CASE WHEN k % 10 < 9 THEN 0 END, CASE WHEN k % 10 < 9 THEN 'SP+TM' END, "
     "CASE WHEN k % 10 = 9 THEN 'name' END FROM ev UNION ALL SELECT 'hhr', CASE WHEN k % 10 < 9 THEN 'P' || CAST(e AS STRING) || ' of ev' END, "
     "CASE WHEN k % 10 < 9 THEN CAST((k + 0.5) / 100 AS DOUBLE) END, CASE WHEN k % 10 < 9 THEN (k + 9 + j) END, CASE WHEN k % 10 < 9 THEN 'T' || CAST(j AS STRING) "
     "|| '|MKVAC-|MRVACD|9-8765' END, CASE WHEN k % 10 = 9 THEN 'evalue' END FROM ev, (VALUES (1), (2)) v(j)")
def src_blocks(spark, sf):
    rows = stored(spread(B.events(spark, sf).select("e", "k")), "events")
    k = F.col("k")
    labels = F.expr(_LABELLED)
    tmbed = F.concat(F.lit(">"), _name(), F.lit(" more\nMKV\n"), labels)
    deep = F.concat(F.lit(">"), _name(), F.when(k % 10 == 9, " | ODD").otherwise(" | SP+TM"), F.lit("\nMKV\n"),
                    F.lit("SSSMMMOO"))
    # blocks are long and mostly labels: all four kinds stay on disk until the result is read
    packed = {"compression": "gzip", "maxRecordsPerFile": BLOCKS_PER_FILE}
    read = {kind: blocks.read_blocks(spark, kind, _written(spark, rows, line, kind, **packed))
            for kind, line in (("pepstats", _pepstats_block()), ("tmbed", tmbed), ("deeptmhmm", deep), ("hhr", _profile_block()))}
    d = "data."
    return (
        read["pepstats"].select(
            F.lit("pepstats").alias("kind"), F.col(d + "name").alias("name"), F.col(d + "molecular_weight").alias("x"),
            F.col(d + "residue_c_number").alias("i"), _s(d + "property_nonpolar_number").alias("t"), "problem")
        .unionByName(read["tmbed"].select(
            F.lit("tmbed").alias("kind"), F.col(d + "name").alias("name"),
            F.col(d + "has_sp").cast("int").cast("double").alias("x"), F.col(d + "has_tm").cast("int").alias("i"),
            F.col(d + "topology").alias("t"), "problem"))
        .unionByName(read["deeptmhmm"].select(
            F.lit("deeptmhmm").alias("kind"), F.col(d + "name").alias("name"),
            F.when(F.col("problem").isNull(), 0.0).alias("x"), F.when(F.col("problem").isNull(), 0).alias("i"),
            F.col(d + "prediction").alias("t"), "problem"))
        .unionByName(read["hhr"].select(
            F.lit("hhr").alias("kind"), F.col(d + "query_id").alias("name"), F.col(d + "identity").alias("x"),
            F.col(d + "template_end").alias("i"),
            F.when(F.col("problem").isNull(), F.concat_ws("|", d + "template_id", d + "query_ali", d + "template_ali", d + "confidence")).alias("t"),
            "problem"))
    )


# -- features ---------------------------------------------------------------------------
_FEATURE_SQL = (
    "SELECT 'chr' || CAST(l_suppkey AS STRING) AS seqid, CAST(l_partkey AS INT) AS start, "
    "CAST(l_partkey + l_quantity AS INT) AS \"end\", CASE WHEN l_discount > 0 THEN l_discount END AS score, "
    "CASE WHEN l_linenumber % 2 = 0 THEN '+' ELSE '-' END AS strand, 'f;' || CAST(l_orderkey AS STRING) AS id, "
    "'p=' || CAST(l_linenumber AS STRING) || '|q,r' AS parents, l_returnflag AS tag FROM lineitem")


def _features(spark, sf) -> DataFrame:
    """Interval features whose attributes need every kind of escaping."""
    rows = spread(B.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_suppkey", "l_partkey", "l_quantity", "l_discount"))
    attrs = attributes(
        id=F.concat(F.lit("f;"), _s("l_orderkey")),
        parent=F.array(F.concat(F.lit("p="), _s("l_linenumber")), F.lit("q,r")),
        target=target(F.lit("t 1"), F.lit(0), F.lit(9)),
        custom=custom_from([("tag", F.col("l_returnflag"))]))
    return rows.select(
        F.concat(F.lit("chr"), _s("l_suppkey")).alias("seqid"), F.lit("src").alias("source"),
        F.lit("CDS").alias("type"), F.col("l_partkey").cast("int").alias("start"),
        (F.col("l_partkey") + F.col("l_quantity")).cast("int").alias("end"),
        F.when(F.col("l_discount") > 0, F.col("l_discount")).alias("score"),
        F.when(F.col("l_linenumber") % 2 == 0, "+").otherwise("-").alias("strand"),
        F.lit("0").alias("phase"), attrs.alias("attributes"))


def _feature_view(df: DataFrame) -> DataFrame:
    a = F.col("attributes")
    return df.select("seqid", "start", "end", "score", "strand", a["id"].alias("id"),
                     F.array_join(a["parent"], "|").alias("parents"), a["custom"]["tag"][0].alias("tag"))


@job("snk_gff", _FEATURE_SQL)
def snk_gff(spark, sf):
    path = scratch(spark, "gff")
    writers.write_gff3(_features(spark, sf), path)
    return _feature_view(gff3.read_gff3(spark, path).filter("problem IS NULL"))


@job("src_gff", "SELECT 'chr' || CAST(l_suppkey AS STRING) AS seqid, CAST(l_partkey AS INT) AS start, "
     "CAST(l_partkey + l_quantity AS INT) AS \"end\", 'x%3By' AS note, CASE WHEN l_linenumber = 7 THEN 'strand' END AS problem "
     "FROM lineitem")
def src_gff(spark, sf):
    """Hand-written lines: swapped coordinates, missing attributes, odd strands, comments."""
    rows = B.table(spark, sf, "lineitem").selectExpr(
        "l_suppkey", "l_linenumber", "CAST(l_partkey + 1 AS BIGINT) AS a", "CAST(l_partkey + l_quantity AS BIGINT) AS b")
    # a range given backwards keeps its bounds: start - 1 and end are swapped after the shift
    strand = F.when(F.col("l_linenumber") == 7, "x").otherwise("+")
    line = F.concat(F.lit("#note\n\n"), F.concat_ws(
        "\t", F.concat(F.lit("chr"), _s("l_suppkey")), F.lit("tool"), F.lit("CDS"), _s("a"), _s("b"), F.lit("."), strand,
        F.lit("."), F.lit('ID=a;Note="x%253By";Is_circular=true;')))
    parsed = gff3.read_gff3(spark, _written(spark, rows, line, "gff"), strip_quote=True)
    return parsed.select("seqid", "start", "end", F.col("attributes.note")[0].alias("note"), "problem")


# -- tables -----------------------------------------------------------------------------
@job("src_ranked_tsv", "SELECT 'n' || CAST(o_orderkey AS STRING) AS name, CASE WHEN o_orderstatus <> 'F' THEN "
     "CAST(o_custkey AS INT) END AS score, o_orderpriority AS label FROM orders")
def src_ranked_tsv(spark, sf):
    path = scratch(spark, "ranked")
    rows = B.table(spark, sf, "orders").selectExpr(
        "'n' || CAST(o_orderkey AS STRING) AS name",
        "CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS INT) END AS score", "o_orderpriority AS label")
    writers.write_tsv(rows, path)
    return sequences.read_ranked(spark, path, "name string, score int, label string")


@job("snk_tsv", "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN ROUND(o_totalprice / 7, 3) END AS price FROM orders")
def snk_tsv(spark, sf):
    """Prices to three digits; NULL becomes a dot and comes back as NULL."""
    path = scratch(spark, "tsv")
    rows = B.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderstatus <> 'F' THEN round(o_totalprice / 7, 3) END AS price")
    writers.write_tsv(rows, path, digits=3)
    return spark.read.schema("o_orderkey bigint, price double").csv(path, sep="\t", header=True, nullValue=".")


@job("src_targets", f"{EV} SELECT event_type || CAST(e AS STRING) AS analysis, '1.' || CAST(k AS STRING) AS software_version, "
     "CASE WHEN k % 2 = 0 THEN 'db' || CAST(k AS STRING) END AS database_version FROM ev")
def src_targets(spark, sf):
    version = F.concat(F.lit("1."), _s("k"))
    kind = F.concat(F.col("event_type"), _s("e"))
    # odd rows alternate between two columns and an empty third one
    line = F.when(F.col("k") % 2 == 0, _tabbed(kind, version, F.concat(F.lit("db"), _s("k")))).when(
        F.col("k") % 4 == 1, _tabbed(kind, version)).otherwise(F.concat(_tabbed(kind, version), F.lit("\t")))
    return sequences.read_targets(spark, _written(spark, B.events(spark, sf), line, "targets"))


@job("src_idmap", "SELECT 'SR' || CAST(c_custkey AS STRING) AS encoded, CASE WHEN c_nationkey % 2 = 0 THEN c_mktsegment END "
     "AS filename, c_name AS id, 'S' || CAST(c_custkey AS STRING) AS checksum, 'M' || CAST(c_custkey AS STRING) AS md5sum "
     "FROM customer")
def src_idmap(spark, sf):
    rows = B.table(spark, sf, "customer")
    key = _s("c_custkey")
    line = F.concat(F.lit("encoded\tfilename\tid\tchecksum\tmd5sum\n"), _tabbed(
        F.concat(F.lit("SR"), key), F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment")).otherwise("."),
        F.col("c_name"), F.concat(F.lit("S"), key), F.concat(F.lit("M"), key)))
    return sequences.read_idmap(spark, _written(spark, rows, line, "idmap"))


# -- match XML --------------------------------------------------------------------------
def _signature(library: str, name: bool = True) -> Column:
    named = F.concat(F.lit(' name="'), F.col("p_type"), F.lit('"')) if name else F.lit("")
    return F.concat(
        F.lit('<signature ac="A'), _s("p_partkey"), F.lit('"'), named, F.lit("><entry ac=\"IPR"), _s("p_size"),
        F.lit('" desc="a &lt; b" name="entry" type="DOMAIN"><go-xref id="GO:1" name="cell part"/>'
              '<pathway-xref db="KEGG" id="7"/></entry>'
              f'<signature-library-release library="{library}" version="9"/></signature>'))


def _place(tag: str, extra: str = "", body: str = "") -> Column:
    return F.concat(F.lit(f'<locations><{tag} start="'), (F.col("p_size") + 1).cast("string"), F.lit('" end="'),
                    (F.col("p_size") + 60).cast("string"), F.lit(f'" {extra}>{body}</{tag}></locations>'))


def _fragment(kind: str) -> str:
    return (f'<location-fragments><{kind}-location-fragment start="5" end="25"/></location-fragments>')


_HMM = 'env-start="1" env-end="99" hmm-start="3" hmm-end="90" hmm-bounds="COMPLETE"'
_SITE = '<site-locations><site-location start="7" end="9" residue="H"/></site-locations>'


def _proteins() -> Column:
    """One element per part with a match of every kind."""
    kinds = [
        ("hmmer3-match", 'score="60.5" evalue="1e-20"', _signature("PFAM"), _place("hmmer3-location", _HMM)),
        ("panther-match", 'score="60.5" evalue="1e-20" familyName="FAM"', _signature("PANTHER", False),
         _place("panther-location", _HMM)),
        ("hmmer2-match", 'score="5" evalue="0.001"', _signature("SMART"),
         _place("hmmer2-location", 'hmm-start="1" hmm-end="1" hmm-bounds="INCOMPLETE"')),
        ("hmmer3-match-with-sites", 'score="60.5" evalue="1e-20"', _signature("SFLD"), _place(
            "hmmer3-location-with-sites", _HMM,
            f'<sites><hmmer3-site description="act">{_SITE}<hmmStart>1</hmmStart><hmmEnd>2</hmmEnd></hmmer3-site></sites>')),
        ("coils-match", "", _signature("COILS"), _place("coils-location", "", _fragment("coils"))),
        ("tmhmm-match", "", _signature("TMHMM"), _place("tmhmm-location", "", _fragment("tmhmm"))),
        ("signalp-match", "", _signature("SIGNALP_EUK"), _place("signalp-location", 'score="0.8"', _fragment("signalp"))),
        ("mobidblite-match", "", _signature("MOBIDB"), _place("mobidblite-location", "", _fragment("mobidblite"))),
        ("profilescan-match", "", _signature("PROFILE"), _place("profilescan-location", 'score="12.5"')),
        ("rpsblast-match", "", _signature("CDD"), _place(
            "rpsblast-location", 'score="100" evalue="1e-9"',
            f'<sites><rpsblast-site description="act">{_SITE}</rpsblast-site></sites>')),
        ("superfamilyhmmer3-match", 'evalue="1e-5"', _signature("SUPERFAMILY"), _place("superfamilyhmmer3-location")),
        ("fingerprints-match", "", _signature("PRINTS"), _place("fingerprints-location", 'pvalue="1e-4" score="3"')),
        ("patternscan-match", "", _signature("PROSITE"), _place("patternscan-location", 'level="STRONG"')),
        ("phobius-match", "", _signature("PHOBIUS"), _place("phobius-location")),
    ]
    matches = [F.concat(F.lit(f"<{tag} {extra}>"), signature, place, F.lit(f"</{tag}>"))
               for tag, extra, signature, place in kinds]
    return F.concat(F.lit('<protein><sequence>MKV</sequence><xref id="P'), _s("p_partkey"), F.lit('"/><matches>'),
                    *matches, F.lit("</matches></protein>"))


_XML_ROWS = (
    # type, source, start, end, score, name
    ("protein_hmm_match", "PFAM", "p_size", "p_size + 60", "1e-20", "p_type"),
    ("protein_hmm_match", "PANTHER", "p_size", "p_size + 60", "1e-20", "'entry'"),
    ("protein_hmm_match", "SMART", "p_size", "p_size + 60", "0.001", "p_type"),
    ("protein_hmm_match", "SFLD", "p_size", "p_size + 60", "1e-20", "p_type"),
    ("biochemical_region_of_peptide", "SFLD", "6", "9", None, None),
    ("peptide_coil", "COILS", "4", "25", None, None),
    ("transmembrane_polypeptide_region", "TMHMM", "4", "25", None, None),
    ("signal_peptide", "SIGNALP_EUK", "4", "25", "0.8", None),
    ("intrinsically_unstructured_polypeptide_region", "MOBIDB", "4", "25", None, None),
    ("protein_match", "PROFILE", "p_size", "p_size + 60", "12.5", "p_type"),
    ("protein_match", "CDD", "p_size", "p_size + 60", "1e-9", "p_type"),
    ("biochemical_region_of_peptide", "CDD", "6", "9", None, None),
    ("protein_hmm_match", "SUPERFAMILY", "p_size", "p_size + 60", "1e-5", "p_type"),
    ("protein_match", "PRINTS", "p_size", "p_size + 60", "1e-4", "p_type"),
    ("protein_match", "PROSITE", "p_size", "p_size + 60", None, "p_type"),
)


def _xml_sql(extra: str = "") -> str:
    parts = [
        f"SELECT 'P' || CAST(p_partkey AS STRING) AS seqid, 'InterProScan:5.59:{source}:9' AS source, '{type_}' AS type, "
        f"CAST({a} AS INT) AS start, CAST({b} AS INT) AS \"end\", CAST({score or 'NULL'} AS DOUBLE) AS score, "
        f"{name or 'NULL'} AS name, "
        + (f"'InterPro:IPR' || CAST(p_size AS STRING) || '|KEGG:7'" if name else "NULL") + " AS dbxref, "
        + ("'GO:1|GO:cell_part'" if name else "NULL") + " AS terms FROM part"
        for type_, source, a, b, score, name in _XML_ROWS]
    return " UNION ALL ".join(parts)


def _xml_view(df: DataFrame) -> DataFrame:
    a = F.col("attributes")
    return df.select("seqid", "source", "type", "start", "end", "score", a["name"].alias("name"),
                     F.array_join(a["dbxref"], "|").alias("dbxref"), F.array_join(a["ontology_term"], "|").alias("terms"))


@job("src_xml", _xml_sql())
def src_xml(spark, sf):
    """Match files split at the closing protein tag."""
    path = _written(spark, spread(B.table(spark, sf, "part")), _proteins(), "xml")
    return _xml_view(interpro.features(interpro.read_proteins(spark, path, "5.59")))


@job("interpro_features", _xml_sql())
def interpro_features(spark, sf):
    """The same elements parsed from a column."""
    rows = spread(B.table(spark, sf, "part")).select(_proteins().alias("value"))
    return _xml_view(interpro.features(interpro.parse_proteins(rows, F.lit("5.59"))))


_SCAN = "p_partkey % 8"


@job("src_xml_quarantine", "WITH r AS (SELECT 'P' || CAST(p_partkey AS STRING) AS seqid, 'InterProScan:' || CASE WHEN p_partkey % 8 % 2 = 0 THEN "
     "'5.' || CAST(p_partkey % 8 AS STRING) || ':' ELSE '' END || 'PROSITE:9' AS source, p_partkey % 10 = 3 AS broken, p_partkey % 7 = 2 AS odd, "
     "CAST(p_size AS INT) AS s, CAST(p_size + 60 AS INT) AS e FROM part) SELECT seqid, source, s AS start, e AS \"end\", NULL AS problem FROM r "
     "WHERE NOT broken AND NOT odd UNION ALL SELECT seqid, source, NULL, e, 'start' FROM r WHERE NOT broken AND odd UNION ALL "
     "SELECT NULL, NULL, NULL, NULL, 'xml' FROM r WHERE broken")
def src_xml_quarantine(spark, sf):
    """Files with and without a version in their root, with broken proteins and odd numbers."""
    rows = B.table(spark, sf, "part")
    start = F.when(F.col("p_partkey") % 7 == 2, "x").otherwise((F.col("p_size") + 1).cast("string"))
    match = F.concat(
        F.lit("<patternscan-match>"), _signature("PROSITE"), F.lit('<locations><patternscan-location level="STRONG" start="'), start,
        F.lit('" end="'), (F.col("p_size") + 60).cast("string"), F.lit('"/></locations></patternscan-match>'))
    # a sequence that is not closed breaks the element
    sequence = F.when(F.col("p_partkey") % 10 == 3, "<sequence>MKV").otherwise("<sequence>MKV</sequence>")
    protein = F.concat(F.lit("<protein>"), sequence, F.lit('<xref id="P'), _s("p_partkey"), F.lit('"/><matches>'), match, F.lit("</matches></protein>\n"))
    root = F.when(F.col("f") % 2 == 0, F.concat(F.lit('<protein-matches interproscan-version="5.'), _s("f"), F.lit('">\n'))).otherwise("<protein-matches>\n")
    files = rows.select(F.expr(_SCAN).alias("f"), protein.alias("p")).groupBy("f").agg(F.array_join(F.collect_list("p"), "").alias("p"))
    path = scratch(spark, "xml-files")
    files.select("f", F.concat(root, "p", F.lit("</protein-matches>")).alias("value")).write.mode("overwrite").partitionBy("f").text(path)
    proteins = interpro.read_proteins(spark, path)
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("seqid", "string"), ("source", "string"), ("start", "int"), ("end", "int"))]
    return (interpro.features(proteins).select("seqid", "source", "start", "end", F.lit(None).cast("string").alias("problem"))
            .unionByName(interpro.bad_features(proteins).select("seqid", "source", "start", "end", "problem"))
            .unionByName(interpro.bad_proteins(proteins).select(*nothing, "problem")))


# -- small tables and lists ------------------------------------------------------------------
@job("src_id_list", f"{EV} SELECT DISTINCT 'D' || CAST(k AS STRING) AS id FROM ev")
def src_id_list(spark, sf):
    """One id per line, repeated, with blanks around and empty lines between."""
    line = F.concat(F.lit(" D"), _s("k"), F.lit(" \n"))
    return sequences.read_id_list(spark, _written(spark, B.events(spark, sf), line, "ids")).select("id")


@job("gap_from_cigar", f"{EV} SELECT e, 'M' || CAST(k + 1 AS STRING) || ' D2 I' || CAST(k % 7 AS STRING) AS gap FROM ev")
def gap_from_cigar_job(spark, sf):
    cigar = F.concat((F.col("k") + 1).cast("string"), F.lit("M2D"), (F.col("k") % 7).cast("string"), F.lit("I"))
    return B.events(spark, sf).select("e", gap_text(gap_from_cigar(cigar)).alias("gap"))


@job("snk_matches", f"{EV} SELECT 'P' || CAST(e AS STRING) AS name, 'custom' AS kind, 'R.L' AS pattern, event_type AS match, k AS start, k + 3 AS \"end\" FROM ev")
def snk_matches(spark, sf):
    """Motif hits as a table, read back by the reader of such tables."""
    hits = B.events(spark, sf).select(_name().alias("name"), F.lit("custom").alias("kind"), F.lit("R.L").alias("pattern"),
                                      F.col("event_type").alias("match"), F.col("k").alias("start"), (F.col("k") + 3).alias("end"))
    path = scratch(spark, "matches")
    writers.write_matches(hits, path)
    return lines.good(lines.read_lines(spark, "regexanalysis", path)).select("data.*").select("name", "kind", "pattern", "match", "start", "end")


@job("snk_bedgraph", "WITH b AS (SELECT 'q' || CAST(l_suppkey AS STRING) AS q, l_partkey AS s, max(l_discount) AS v FROM lineitem GROUP BY 1, 2) "
     "SELECT q AS seqid, s AS start, s + 1 AS \"end\", CASE WHEN v > 0 THEN v END AS value, row_number() OVER (ORDER BY q, s) - 1 AS line FROM b")
def snk_bedgraph(spark, sf):
    """Written in order of sequence and start, read back with the place of each line."""
    rows = B.table(spark, sf, "lineitem").groupBy(F.concat(F.lit("q"), _s("l_suppkey")).alias("seqid"), F.col("l_partkey").alias("start")).agg(
        F.max("l_discount").alias("v")).selectExpr("seqid", "start", "start + 1 AS end", "CASE WHEN v > 0 THEN v END AS value")
    path = scratch(spark, "bedgraph")
    writers.write_bedgraph(rows, path)
    read = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("n"))
    placed = number_rows(read.filter("value NOT LIKE '#%'"), ["file", "n"], out="line")
    f = F.split("value", "\t")
    return placed.select(f[0].alias("seqid"), f[1].cast("bigint").alias("start"), f[2].cast("bigint").alias("end"),
                         F.when(f[3] != "NA", f[3].try_cast("double")).alias("value"), "line")
