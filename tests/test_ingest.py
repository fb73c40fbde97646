"""Small golden inputs for every reader, with the rows that must go aside."""

from pyspark.sql import functions as F

from protolith.analyses import RESIDUE_PROPERTIES, RESIDUES
from protolith.sources import blocks, gff3, interpro, lines, sequences
from protolith.sources.results import parse_results

GOOD = {
    "signalp3_nn": ("s1  0.7 21 Y  0.6 22 Y  0.9 5 Y  0.8 Y  0.7 Y", {"ymax_pos": 22, "d_decision": True}),
    "signalp3_hmm": ("s1  S  0.9 19 Y  0.99 Y", {"is_secreted": True, "cmax_pos": 19}),
    "signalp4": ("s1 0.7 21 0.6 22 0.9 5 0.8 0.7 Y 0.45 SignalP-noTM", {"decision": True, "networks_used": "SignalP-noTM"}),
    "signalp5": ("s1\tSP(Sec/SPI)\t0.9\t0.1\tCS pos: 20-21. VLA-AP. Pr: 0.85", {"prob_signal": 0.9, "prob_other": 0.1}),
    "signalp6": ("s1\tSP\t0.1\t0.9\tCS pos: 20-21. Pr: 0.85", {"prob_signal": 0.9, "prob_other": 0.1}),
    "deepsig": ("s1\tSignalPeptide\t0.98\t22", {"cs_pos": 22}),
    "phobius": ("s1   1  Y n4-20c25/26o40-60i", {"tm": 1, "sp": True}),
    "tmhmm": ("s1\tlen=100\tExpAA=20.5\tFirst60=0.1\tPredHel=1\tTopology=i5-27o", {"exp_aa": 20.5, "topology": "i5-27o"}),
    "deeploc": ("s1\tNucleus" + "\t0.1" * 11, {"prediction": "Nucleus", "peroxisome": 0.1}),
    "deeploc2": ("s1,Cytoplasm|Nucleus,Signal peptide" + ",0.25" * 10,
                 {"localisations": ["Cytoplasm", "Nucleus"], "signals": ["Signal peptide"]}),
    "targetp_plant": ("s1\tcTP\t0.1\t0.1\t0.1\t0.6\t0.1\tCS pos: 20-21. VLA-AP. Pr: 0.5", {"ctp": 0.6}),
    "targetp_non_plant": ("s1\tnoTP\t0.9\t0.05\t0.05", {"prediction": "OTHER", "cs_pos": None}),
    "effectorp1": ("s1\tEffector\t0.8", {"prob": 0.8}),
    "effectorp2": ("s1\tUnlikely effector\t0.6", {"prediction": "Unlikely effector"}),
    "effectorp3": ("s1\tY (0.9)\t-\t-\tCytoplasmic effector", {"cytoplasmic_prob": 0.9, "apoplastic_prob": None}),
    "effectorp3_fungal": ("s1\t-\t-\tY (0.7)\tNon-effector", {"noneffector_prob": 0.7}),
    "apoplastp": ("s1\tApoplastic\t0.9", {"prediction": "Apoplastic"}),
    "localizer": ("s1\tY (0.9 | 25-49)\t-\tY (KRKK)", {
        "chloroplast_start": 44, "chloroplast_end": 49, "mitochondria_decision": False, "nucleus_signals": "KRKK"}),
    "pfamscan": ("s1 11 50 10 51 PF1.1 dom Family 2 40 44 60.1 1e-10 1 No_clan predicted_active_site[5,9][30]",
                 {"ali_start": 10, "clan": None, "active_sites": "5,9;30"}),
    "dbcan": ("GH10.hmm - 100 s1 - 200 1e-20 60 0.1 1 1 1e-20 1e-19 59 0.1 1 100 11 180 1 190 0.9 some free text",
              {"query": "s1", "hmm": "GH10", "hmm_from": 0, "query_from": 10, "description": "some free text"}),
    "effectordb": ("E.hmm.hmm - 100 s1 - 200 1e-20 60 0.1 1 1 1e-20 1e-19 59 0.1 1 100 11 180 1 190 0.9 -",
                   {"hmm": "E.hmm", "description": None}),
    "phibase": ("s1\ta#b#c#d#e#lethal\t11\t90\t200\t1\t80\t100\t1e-30\t0\t0.5\t80\t100\t55.5\t40M1D39M\t3\t0.4\t0.8",
                {"qstart": 10, "tstart": 0, "tcov": 0.8}),
    "regexanalysis": ("s1\tcustom\tR.L\tRAL\t3\t6", {"start": 3, "end": 6}),
    "kex2_cutsite": ("s1\tkex2_cutsite\t[KR]R\tKR\t3\t5", {"match": "KR"}),
    "rxlr_like_motif": ("s1\trxlr_like_motif\tx\tRALR\t3\t7", {"match": "RALR"}),
    "deepredeff_fungi": ("s1\t0.7\teffector", {"s_score": 0.7}),
    "deepredeff_oomycete": ("s1\t0.7\tnon-effector", {"prediction": "non-effector"}),
    "deepredeff_bacteria": ("s1\t0.7\teffector", {"s_score": 0.7}),
}


def test_every_line_format(spark):
    assert set(GOOD) == set(lines.FORMATS)
    for kind, (line, expected) in GOOD.items():
        df = spark.createDataFrame([("# comment",), ("",), (line,), ("only_a_name",)], "value string")
        rows = lines.parse_lines(df, kind).collect()
        good = [r.data for r in rows if r.problem is None]
        assert len(rows) == 2 and len(good) == 1, (kind, rows)
        for field, value in expected.items():
            assert good[0][field] == value, (kind, field, good[0][field])


def test_headers_and_bad_values(spark):
    df = spark.createDataFrame([
        ("SEQENCE ID                     TM SP PREDICTION",), ("s1  1  Y  o",), ("s2  x  Y  o",), ("s3  1  N  o",)],
        "value string")
    rows = {r.value[:2]: r.problem for r in lines.parse_lines(df, "phobius").collect()}
    assert rows == {"s1": None, "s2": "tm", "s3": "sp"}
    parsed = lines.parse_lines(df, "phobius")
    assert lines.good(parsed).count() == 1 and lines.quarantine(parsed).count() == 2


def test_banner_file(spark, tmp_path):
    (tmp_path / "out.txt").write_text(
        "-----------------\nA banner\n-----------------\n# Identifier\tPrediction\tProbability\ns1\tEffector\t0.9\n")
    rows = lines.read_lines(spark, "effectorp1", str(tmp_path)).collect()
    assert [(r.problem, r.data.prob) for r in rows] == [(None, 0.9)]


def test_envelope(spark):
    parsed = lines.good(lines.parse_lines(spark.createDataFrame([("s1\t0.7\teffector",)], "value string"),
                                          "deepredeff_fungi"))
    row = lines.envelope(parsed, "deepredeff_fungi", "1.0").first()
    assert (row["name"], row.analysis, row.software, row.software_version, row.database) == (
        "s1", "deepredeff_fungi", "deepredeff", "1.0", None)
    assert row.data == '{"name":"s1","s_score":0.7,"prediction":"effector"}'


def composition(name, point):
    residues = "\n".join(f"{a.upper()} = Xxx\t\t{i}\t\t1.5  \t\t0.25  \t" for i, a in enumerate(RESIDUES))
    properties = "\n".join(
        f"{('Non-polar' if p == 'nonpolar' else p.title())}\t\t(A+C)\t\t{i}\t\t 2.5" for i, p in enumerate(RESIDUE_PROPERTIES))
    return (
        f"PEPSTATS of {name} from 1 to 9\n\nMolecular weight = 100.25  \t\tResidues = 9   \n"
        f"Average Residue Weight  = 11.1 \tCharge   = -1.5   \nIsoelectric Point = {point}\n"
        "A280 Molar Extinction Coefficients  = 10 (reduced)   20 (cystine bridges)\n"
        "A280 Extinction Coefficients 1mg/ml = 0.1 (reduced)   0.2 (cystine bridges)\n"
        "Improbability of expression in inclusion bodies = 0.7\n\n"
        f"Residue\t\tNumber\t\tMole%\t\tDayhoffStat\n{residues}\n\n"
        f"Property\tResidues\t\tNumber\t\tMole%\n{properties}\n\n")


def test_composition_blocks(spark, tmp_path):
    (tmp_path / "a.txt").write_text(composition("s1", "9.5") + composition("s2", "None") + "PEPSTATS of s3 from 1 to 2\n")
    rows = blocks.read_blocks(spark, "pepstats", str(tmp_path)).collect()
    good = {r.data.name: r.data for r in rows if r.problem is None}
    assert set(good) == {"s1", "s2"} and [r.problem for r in rows if r.problem] == ["molecular_weight"]
    d = good["s1"]
    assert (d.charge, d.residue_c_number, d.residue_z_dayhoff, d.property_nonpolar_number) == (-1.5, 2, 0.25, 4)
    assert d.a280_molar_extinction_coefficients_cysteine_bridges == 20.0
    assert good["s2"].isoelectric_point is None


def test_label_blocks(spark, tmp_path):
    (tmp_path / "deep.txt").write_text(">a | SP+TM\nMKV\nSSM\n>b | GLOB\nMKV\nIII\n")
    rows = blocks.read_blocks(spark, "deeptmhmm", str(tmp_path / "deep.txt")).collect()
    assert {(r.data.name, r.data.prediction, r.data.topology) for r in rows} == {
        ("a", "SP+TM", "SSM"), ("b", "GLOB", "III")}
    (tmp_path / "bed.txt").write_text(f">a x\nMKV\n{'S' * 12}{'H' * 12}\n\n>b\nMKV\nSSQ\n")
    rows = {r.problem: r.data for r in blocks.read_blocks(spark, "tmbed", str(tmp_path / "bed.txt")).collect()}
    assert rows[None].has_sp and rows[None].has_tm and "topology" in rows


def test_profile_alignments(spark, tmp_path):
    (tmp_path / "q.hhr").write_text(
        "Query         seq1 extra words\nMatch_columns 120\nNo_of_seqs    5 out of 9\nNeff          3.5\n\n"
        " No Hit                             Prob E-value\n  1 T1 thing                         99.9  1e-30\n\n"
        "No 1\n>T1 a template\nProbab=99.90  E-value=1e-30  Score=200.5  Aligned_cols=6  Identities=50%  "
        "Similarity=0.9  Sum_probs=5.5  Template_Neff=4.0\n\n"
        "Q ss_pred             HHH\nQ seq1             3 MKV    5 (120)\nQ Consensus        3 mkv    5 (120)\n"
        "T Consensus        7 mrv    9 (80)\nT T1               7 MRV    9 (80)\nConfidence           9 8\n\n"
        "Q seq1             6 AC-    7 (120)\nT T1              10 ACD   12 (80)\nConfidence           765\n\n"
        "No 2\n>T2 other\nProbab=10.00  E-value=3  Score=1.0  Aligned_cols=1  Identities=10%  Similarity=0.1  "
        "Sum_probs=0.5\n\nQ seq1             3 M    3 (120)\nT T2               1 M    1 (9)\nConfidence           1\n")
    rows = [r for r in blocks.read_blocks(spark, "hhr", str(tmp_path / "q.hhr")).collect()]
    d = {r.data.template_id: r.data for r in rows if r.problem is None}
    assert set(d) == {"T1", "T2"}, [r.problem for r in rows]
    t = d["T1"]
    assert (t.query_id, t.query_length, t.query_neff) == ("seq1 extra words", 120, 3.5)
    assert (t.query_ali, t.template_ali, t.confidence) == ("MKVAC-", "MRVACD", "9-8765")
    assert (t.query_start, t.query_end, t.template_start, t.template_end, t.template_length) == (3, 7, 7, 12, 80)
    assert (t.identity, t.template_neff, d["T2"].template_neff) == (0.5, 4.0, None)


def test_fasta(spark, tmp_path):
    (tmp_path / "a.fa").write_text(">s1 first one\nMK\nV\n>s2\nAAA\n\n>s3\n")
    (tmp_path / "b.fa").write_text(">s1\nCC")
    rows = sequences.read_fasta(spark, str(tmp_path)).orderBy(*sequences.file_order()).collect()
    assert [(r.id, r.seq, r.filename) for r in rows] == [
        ("s1", "MKV", "a.fa"), ("s2", "AAA", "a.fa"), ("s3", "", "a.fa"), ("s1", "CC", "b.fa")]
    assert rows[0].description == "s1 first one"


def test_small_tables(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("analysis\tsoftware_version\tdatabase_version\ntmhmm\t2\n\ndbcan\t3\t8\n")
    assert {tuple(r) for r in sequences.read_targets(spark, str(tmp_path / "t.tsv")).collect()} == {
        ("tmhmm", "2", None), ("dbcan", "3", "8")}
    (tmp_path / "m.tsv").write_text("encoded\tfilename\tid\tchecksum\tmd5sum\nSR0\t.\ts1\tC\tM\n")
    assert tuple(sequences.read_idmap(spark, str(tmp_path / "m.tsv")).first()) == ("SR0", None, "s1", "C", "M")
    assert sequences.read_id_list(spark).count() == 4
    (tmp_path / "ids").write_text("a\n b \na\n")
    assert {r.id for r in sequences.read_id_list(spark, str(tmp_path / "ids")).collect()} == {"a", "b"}


def test_orfs(spark):
    df = spark.createDataFrame([("chr_1_2 [10 - 30] x",), ("chr_1_3 [60 - 31] (REVERSE SENSE) x",)], "description string")
    assert [(r.seqid, r.start, r.end, r.strand, r.id) for r in sequences.orf_features(df).collect()] == [
        ("chr_1", 9, 30, "+", "chr_1_2"), ("chr_1", 30, 60, "-", "chr_1_3")]


def test_gff3(spark):
    text = [
        "##gff-version 3", "", "c1\tsrc\tCDS\t1\t30\t.\t+\t0\tID=c1;Parent=m1,m2;Note=a%2Cb;my=1,2;Target=t%20x 1 9 +;Gap=M3 D2",
        "c1\tsrc\tgene\t50\t10\t0.5\t-\t.\t.", "c1\tsrc\tgene\t5\t9\t.\t*\t.\t.", "c1\tsrc", "c1\tsrc\tgene\t5\tx\t.\t+\t.\t."]
    rows = gff3.parse_gff3(spark.createDataFrame([(t,) for t in text], "value string")).collect()
    assert [r.problem for r in rows] == [None, None, "strand", "columns", "end"]
    a = rows[0].attributes
    assert (rows[0].start, rows[0].end, a.id, a.parent, a.note) == (0, 30, "c1", ["m1", "m2"], ["a,b"])
    assert a.custom == {"my": ["1", "2"]} and (a.target.id, a.target.start, a.target.end) == ("t x", 0, 9)
    assert [(g.code, g.length) for g in a.gap] == [("M", 3), ("D", 2)]
    assert (rows[1].start, rows[1].end, rows[1].attributes.id) == (10, 49, None)


def test_results_with_bad_rows(spark):
    good = '{"analysis":"tmhmm","software":"T","software_version":"1","checksum":"c","md5sum":"m","data":{"name":"s"}}'
    df = spark.createDataFrame(
        [(good,), ("",), ("{oops",), (good.replace("tmhmm", "other"),), (good.replace('"checksum":"c",', ""),)], "value string")
    assert [r.problem for r in parse_results(df).collect()] in (
        [None, "json", "analysis", "checksum"], [None, "analysis", "analysis", "checksum"])


def test_match_xml_version_from_the_file(spark, tmp_path):
    (tmp_path / "m.xml").write_text(
        '<?xml version="1.0"?>\n<protein-matches xmlns="http://x" interproscan-version="5.1">\n<protein>'
        '<sequence md5="q">MKV</sequence><xref id="p1" name="n"/><matches><patternscan-match><signature ac="PS1" name=" ">'
        '<signature-library-release library="PROSITE" version="2"/></signature><locations>'
        '<patternscan-location level="STRONG" start="3" end="5"/><patternscan-location level="WEAK" start="7" end="9"/>'
        "</locations></patternscan-match></matches></protein>\n<protein><sequence/><xref id=\"p2\"/><matches/></protein>\n"
        "</protein-matches>\n")
    rows = interpro.features(interpro.read_proteins(spark, str(tmp_path))).collect()
    assert [(r.seqid, r.source, r.start, r.end, r.attributes.name, r.attributes.custom["level"]) for r in rows] == [
        ("p1", "InterProScan:5.1:PROSITE:2", 2, 5, None, ["STRONG"]), ("p1", "InterProScan:5.1:PROSITE:2", 6, 9, None, ["WEAK"])]
