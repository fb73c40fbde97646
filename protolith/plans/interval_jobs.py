"""Genome projection, score folding and the feature tree."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.attributes import attributes, target
from ..operators import genome_scores, graph, projection
from ..operators.ordered import climb, dealt
from ..session import scratch
from ..sinks import writers
from ..sources import gff3
from . import bindings as B
from .registry import job

PROJ = f"WITH {B.EXONS_SQL}, {B.OFFSETS_SQL}"


def _pieces_sql(features: str) -> str:
    lo, hi = "greatest(f.p_start * 3, o.c0)", "least(f.p_end * 3, o.c0 + o.e - o.s)"
    return (
        f"pieces AS (SELECT f.*, o.seqid, o.strand, CAST(CASE WHEN o.strand = '+' THEN o.s + {lo} - o.c0 "
        f"ELSE o.e - ({hi} - o.c0) END AS BIGINT) AS start, CAST(CASE WHEN o.strand = '+' THEN o.s + {hi} - o.c0 "
        f"ELSE o.e - ({lo} - o.c0) END AS BIGINT) AS \"end\" FROM {features} f JOIN off o USING (id) "
        "WHERE f.p_start * 3 < o.c0 + o.e - o.s AND f.p_end * 3 > o.c0)")


ORDER_FEATURES = (
    "feats AS (SELECT o_orderkey AS id, o_orderkey AS feature_id, o_orderkey % 40 AS p_start, "
    "o_orderkey % 40 + 15 AS p_end FROM orders)")
ORDER_PIECES = f"{PROJ}, {ORDER_FEATURES}, {_pieces_sql('feats')}"


def _order_pieces(spark, sf):
    return projection.project(B.order_features(spark, sf), B.exons(spark, sf))


def _project_job(name: str, strand: str) -> None:
    @job(name, f"{ORDER_PIECES} SELECT feature_id, seqid, start, \"end\" FROM pieces WHERE strand = '{strand}'")
    def run(spark, sf):
        return _order_pieces(spark, sf).filter(F.col("strand") == strand).select(
            "feature_id", "seqid", "start", "end")


_project_job("project_plus", "+")
_project_job("project_minus", "-")


@job("unprojectable", f"{ORDER_PIECES} SELECT feature_id, id, p_start, p_end FROM feats WHERE id IN (SELECT id FROM ex) "
     "AND feature_id NOT IN (SELECT feature_id FROM pieces)")
def unprojectable(spark, sf):
    return projection.unprojectable(B.order_features(spark, sf), B.exons(spark, sf))


@job("envelope", f"{ORDER_PIECES} SELECT feature_id, seqid, strand, min(start) AS start, max(\"end\") AS \"end\", "
     "COUNT(*) AS n_pieces FROM pieces GROUP BY 1, 2, 3")
def envelope(spark, sf):
    return projection.envelope(_order_pieces(spark, sf), ["feature_id", "seqid", "strand"])


@job("single_value_violations", "SELECT l_orderkey AS id, min(l_linestatus) <> max(l_linestatus) AS many_strand, "
     "min(l_returnflag) <> max(l_returnflag) AS many_seqid FROM lineitem GROUP BY 1 "
     "HAVING min(l_linestatus) <> max(l_linestatus) OR min(l_returnflag) <> max(l_returnflag)")
def single_value_violations(spark, sf):
    rows = B.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS id", "l_linestatus AS strand", "l_returnflag AS seqid")
    return projection.single_value_violations(rows)


LINE_FEATURES = (
    "lf0 AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS pk, min(l_returnflag) AS flag FROM lineitem GROUP BY 1, 2), "
    f"lf AS (SELECT l_orderkey AS id, l_orderkey * 10 + l_linenumber AS feature_id, {B.LINE_FEATURE_TYPE} AS type, "
    "CASE WHEN flag = 'A' THEN 'toolA' ELSE 'toolB' END AS source, CAST(pk % 3 AS STRING) AS target, "
    "CAST(pk % 9 AS INT) AS p_start, CAST(pk % 9 + 8 AS INT) AS p_end FROM lf0)")
_KEYS = (
    "CASE WHEN type LIKE 'protein%' THEN target END AS gt, "
    "CASE WHEN type LIKE 'protein%' OR type LIKE 'propep%' OR type LIKE 'transm%' THEN p_start END AS gs, "
    "CASE WHEN type LIKE 'protein%' OR type LIKE 'propep%' OR type LIKE 'transm%' THEN p_end END AS ge")


@job("feature_groups", f"WITH {LINE_FEATURES}, g AS (SELECT *, {_KEYS} FROM lf) SELECT id, type, source, gt AS target, "
     "gs AS start, ge AS \"end\", COUNT(*) AS n, min(feature_id) AS first_id FROM g GROUP BY 1, 2, 3, 4, 5, 6")
def feature_groups(spark, sf):
    groups = projection.feature_groups(B.line_features(spark, sf))
    return groups.select("id", "g.*", "n", "first_id")


def _kids_sql(grouped: bool, features: str = LINE_FEATURES) -> str:
    keep = (
        "kept AS (SELECT * FROM lf WHERE type <> 'n_terminal_region' AND (type <> 'propeptide_cleavage_site' "
        "OR id IN (SELECT id FROM lf WHERE type = 'signal_peptide')))" if grouped else "kept AS (SELECT * FROM lf)")
    keys = _KEYS if grouped else "feature_id AS gt, NULL AS gs, NULL AS ge"
    same = "a.id = b.id AND a.type = b.type AND a.source = b.source AND a.gt IS NOT DISTINCT FROM b.gt AND " \
           "a.gs IS NOT DISTINCT FROM b.gs AND a.ge IS NOT DISTINCT FROM b.ge"
    return (
        f"{PROJ}, {features}, {keep}, keyed AS (SELECT *, {keys} FROM kept), ne AS (SELECT id, COUNT(*) AS n FROM ex "
        "GROUP BY 1), groups AS (SELECT id, type, source, gt, gs, ge, min(feature_id) AS first_id FROM keyed JOIN ne USING (id) "
        "WHERE NOT (type LIKE 'protein%' AND n = 1) GROUP BY 1, 2, 3, 4, 5, 6), numbered AS (SELECT *, row_number() OVER "
        "(PARTITION BY id ORDER BY first_id) AS i FROM groups), named AS (SELECT *, CASE WHEN type LIKE 'protein%' THEN "
        "CAST(id AS STRING) || '-' || type || '-' || CAST(i AS STRING) ELSE 'polypeptide-' || CAST(id AS STRING) || '-' || "
        f"CAST(i AS STRING) END AS parent FROM numbered), {_pieces_sql('keyed')}, kids AS (SELECT a.id, a.source, a.type AS "
        "of_type, a.seqid, a.start, a.\"end\", a.strand, a.feature_id, b.parent FROM pieces a LEFT JOIN named b ON "
        f"{same})")


def _mapped_sql(grouped: bool, features: str = LINE_FEATURES) -> str:
    return (
        f"{_kids_sql(grouped, features)} SELECT id, source, CASE WHEN of_type LIKE 'protein%' THEN of_type ELSE 'region' END AS type, "
        "CASE WHEN of_type NOT LIKE 'protein%' THEN of_type END AS kind, seqid, min(start) AS start, max(\"end\") AS \"end\", "
        "strand, NULL AS feature_id, parent AS own_id, NULL AS parent FROM kids WHERE parent IS NOT NULL "
        "GROUP BY id, source, of_type, seqid, strand, parent UNION ALL SELECT id, source, CASE WHEN parent IS NOT NULL AND "
        "of_type LIKE 'protein%' THEN 'match_part' ELSE of_type END, NULL, seqid, start, \"end\", strand, feature_id, NULL, "
        "parent FROM kids")


@job("project_features", _mapped_sql(True))
def project_features(spark, sf):
    return projection.map_to_genome(B.line_features(spark, sf), B.exons(spark, sf))


@job("project_generic", _mapped_sql(False))
def project_generic(spark, sf):
    return projection.map_to_genome(B.line_features(spark, sf), B.exons(spark, sf), grouped=False)


_TWO_MODELS = LINE_FEATURES.replace("THEN 'toolA'", "THEN CASE WHEN l_orderkey % 2 = 0 THEN 'SignalPNN:3.0b' ELSE 'SignalPHMM:3.0b' END")


@job("map_annotations", f"SELECT * EXCLUDE (feature_id, own_id, parent), feature_id IS NULL AS top, COALESCE(own_id, '') || COALESCE(parent, '') AS link "
     f"FROM ({_mapped_sql(True, _TWO_MODELS)})")
def map_annotations(spark, sf):
    """Gene and annotation features, as read from files, through the whole mapping job."""
    exons = B.exons(spark, sf)
    genes = exons.select("seqid", "source", F.lit("CDS").alias("type"), "start", "end", F.lit(None).cast("double").alias("score"), "strand",
                         F.lit("0").alias("phase"), attributes(parent=F.array(F.col("id").cast("string"))).alias("attributes"))
    genes = genes.unionByName(genes.withColumn("type", F.lit("mRNA"))).unionByName(genes.limit(5).withColumn("attributes", attributes()))
    rows = B.line_features(spark, sf)
    custom = F.when(F.col("id") % 2 == 0, F.create_map(F.lit("d_decision"), F.array(F.lit("Y")))).otherwise(F.create_map(F.lit("x"), F.array(F.lit("1"))))
    found = rows.select(
        F.col("id").cast("string").alias("seqid"), F.when(F.col("source") == "toolA", "SignalP:3.0b").otherwise(F.col("source")).alias("source"), "type",
        F.col("p_start").alias("start"), F.col("p_end").alias("end"), F.lit(None).cast("double").alias("score"), F.lit(".").alias("strand"),
        F.lit(".").alias("phase"), attributes(id=F.concat(F.lit("f"), F.col("feature_id").cast("string")),
                                              target=target(F.col("target"), F.lit(0), F.lit(9)), custom=custom).alias("attributes"), "feature_id")
    mapped = projection.map_annotations(genes, found)
    return mapped.select(F.col("id").cast("bigint").alias("id"), "source", "type", "kind", "seqid", F.col("start").cast("bigint").alias("start"),
                         F.col("end").cast("bigint").alias("end"), "strand", F.col("feature_id").isNull().alias("top"),
                         F.concat(F.coalesce("own_id", F.lit("")), F.coalesce("parent", F.lit(""))).alias("link"))


_SCORE = "CAST(feature_id % 100 AS DOUBLE) / 4"
_MATCH = "of_type LIKE 'protein%'"


@job("map_to_genome_gff", f"{_kids_sql(True)}, tops AS (SELECT seqid, source, of_type, min(start) AS start, max(\"end\") AS \"end\", "
     "strand, parent, min(feature_id) AS feature_id FROM kids WHERE parent IS NOT NULL GROUP BY id, source, of_type, seqid, strand, parent) "
     f"SELECT seqid, source, CASE WHEN {_MATCH} THEN of_type ELSE 'region' END AS type, start, \"end\", CASE WHEN {_MATCH} THEN {_SCORE} END "
     f"AS score, strand, '.' AS phase, parent AS id, CASE WHEN {_MATCH} THEN 'N' || CAST(feature_id AS STRING) END AS name, NULL AS parent, "
     f"CASE WHEN NOT {_MATCH} THEN of_type END AS kind FROM tops UNION ALL SELECT seqid, source, CASE WHEN parent IS NOT NULL AND {_MATCH} "
     f"THEN 'match_part' ELSE of_type END, start, \"end\", {_SCORE}, strand, '.', 'F' || CAST(feature_id AS STRING), "
     "'N' || CAST(feature_id AS STRING), parent, NULL FROM kids")
def map_to_genome_gff(spark, sf):
    """Features with scores and attributes onto the genome, one GFF3 folder per source, read back."""
    number = F.col("feature_id").cast("string")
    features = B.line_features(spark, sf).withColumns({
        "score": F.expr(_SCORE),
        "attributes": attributes(id=F.concat(F.lit("F"), number), name=F.concat(F.lit("N"), number),
                                 gap=F.array(F.struct(F.lit("M").alias("code"), F.lit(8).alias("length"))))})
    path = scratch(spark, "map_to_genome_gff")
    writers.write_gff3(projection.map_to_genome(features, B.exons(spark, sf)), path, ["source"])
    a = F.col("attributes")
    return gff3.read_gff3(spark, path).select(
        "seqid", "source", "type", F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end"),
        "score", "strand", "phase", a["id"].alias("id"), a["name"].alias("name"), F.get(a["parent"], F.lit(0)).alias("parent"),
        F.get(F.try_element_at(a["custom"], F.lit("kind")), F.lit(0)).alias("kind"))


# a mean of prices over 32 or 64 values ends exactly between two roundings, where the order of
# additions decides; both sides of the mean's check round a little off that point
OFF_TIES = {"mean": 1.3e-7}


def _fold_job(reducer: str, sql: str) -> None:
    off = OFF_TIES.get(reducer, 0.0)
    check = (
        "WITH iv AS (SELECT l_suppkey AS q, l_orderkey AS id, l_partkey AS s, l_partkey + CAST(l_quantity AS INT) AS e "
        "FROM lineitem), p AS (SELECT q, s AS p FROM iv UNION SELECT q, e FROM iv), "
        "g AS (SELECT q, p AS s, lead(p) OVER (PARTITION BY q ORDER BY p) AS e FROM p), "
        "c AS (SELECT DISTINCT g.q, g.s, g.e, iv.id FROM g JOIN iv ON g.q = iv.q AND iv.s <= g.s AND iv.e > g.s "
        "WHERE g.e IS NOT NULL) SELECT q AS seqid, s AS start, e AS \"end\", "
        f"ROUND({sql}(o_totalprice) + {off}, 6) AS value FROM c JOIN orders ON id = o_orderkey "
        "WHERE o_orderstatus <> 'P' GROUP BY 1, 2, 3")

    @job(f"bedgraph_{reducer}", check)
    def run(spark, sf):
        """Orders in progress have no score: their lines cut segments and count for nothing."""
        scores = B.table(spark, sf, "orders").filter("o_orderstatus <> 'P'").selectExpr(
            "o_orderkey AS name", "o_totalprice AS value")
        out = genome_scores.scores_to_genome(B.intervals(spark, sf), scores, ["value"], reducer)
        return out.withColumn("value", F.round(F.col("value") + off, 6))


for _reducer, _sql in (("min", "min"), ("max", "max"), ("mean", "avg"), ("median", "median")):
    _fold_job(_reducer, _sql)


@job("interval_pad_trim", "WITH i AS (SELECT l_orderkey, l_linenumber, l_partkey AS s, l_partkey + CAST(l_quantity AS INT) AS e, "
     "CAST(l_quantity AS INT) AS n FROM lineitem), c AS (SELECT *, CASE WHEN n <= 2 THEN 0 WHEN n < 20 THEN "
     "CAST(ceil(n / 4.0) AS INT) ELSE 10 END AS c FROM i) SELECT l_orderkey, s, e, s + c AS trim_start, e - c AS trim_end, "
     "greatest(s - 10, 0) AS pad_start, CASE WHEN e + 10 > 1500 THEN 1500 ELSE e + 10 END AS pad_end FROM c")
def interval_pad_trim(spark, sf):
    rows = B.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_partkey AS s", "l_partkey + CAST(l_quantity AS INT) AS e")
    a, b = graph.trim(F.col("s"), F.col("e"), 10)
    c, d = graph.pad(F.col("s"), F.col("e"), 10, F.lit(1500).cast("bigint"))
    return rows.select("l_orderkey", "s", "e", a.alias("trim_start"), b.alias("trim_end"),
                       c.alias("pad_start"), d.alias("pad_end"))


TREE = f"WITH RECURSIVE {B.TREE_SQL}"


@job("resolve_parents", f"{TREE} SELECT c.id AS child_id, c.parent_id, p.name AS parent_name FROM nodes c "
     "JOIN nodes p ON c.parent_id = p.id")
def resolve_parents(spark, sf):
    return graph.resolve(B.tree_edges(spark, sf), B.tree_nodes(spark, sf), carry=["name"])


@job("dangling_parents", "SELECT 'C' || CAST(c_custkey AS STRING) AS child_id, 'N' || CAST(c_nationkey + 3 AS STRING) AS "
     "parent_id FROM customer WHERE c_nationkey + 3 NOT IN (SELECT n_nationkey FROM nation)")
def dangling_parents(spark, sf):
    """Customers pointing three nations too far."""
    children = B.table(spark, sf, "customer").selectExpr(
        "'C' || CAST(c_custkey AS STRING) AS id", "array('N' || CAST(c_nationkey + 3 AS STRING)) AS parent")
    return graph.dangling(graph.parent_edges(children), B.tree_nodes(spark, sf))


_DOWN = (
    f"{TREE}, walk AS (SELECT id AS ancestor_id, id AS node_id, 0 AS depth FROM nodes UNION ALL SELECT w.ancestor_id, n.id, "
    "w.depth + 1 FROM walk w JOIN nodes n ON n.parent_id = w.node_id)")


@job("descendants", f"{_DOWN} SELECT * FROM walk WHERE ancestor_id LIKE 'R%'")
def descendants(spark, sf):
    roots = B.tree_nodes(spark, sf).filter("parent_id IS NULL").select("id")
    return graph.descendants(B.tree_edges(spark, sf), roots)


@job("ancestors", f"{_DOWN} SELECT * FROM walk WHERE node_id LIKE 'C%'")
def ancestors(spark, sf):
    leaves = B.tree_nodes(spark, sf).filter("type = 'match_part'").select("id")
    return graph.ancestors(B.tree_edges(spark, sf), leaves)


@job("track_split", f"{_DOWN}, typed AS (SELECT id, {B.TRACK} AS track FROM nodes), near AS (SELECT ancestor_id AS id, node_id AS other FROM walk "
     "UNION SELECT node_id, ancestor_id FROM walk) SELECT DISTINCT t.track, n.other AS id FROM typed t JOIN near n ON n.id = t.id "
     "WHERE t.track IS NOT NULL")
def track_split(spark, sf):
    """Every track with all relatives of its members."""
    nodes = B.tree_nodes(spark, sf).withColumn("type", F.expr(B.TRACK_TYPE))
    return graph.tracks(nodes, B.tree_edges(spark, sf), projection.track(F.col("type")))


# the members in turn, with what has been taken so far
_TAKEN = (
    f"{_DOWN}, typed AS (SELECT id, start, {B.TRACK} AS track FROM nodes), near AS (SELECT ancestor_id AS id, node_id AS other FROM walk "
    "UNION SELECT node_id, ancestor_id FROM walk), around AS (SELECT id, list(other) AS kin FROM near GROUP BY id), members AS "
    "(SELECT row_number() OVER (ORDER BY start, id) AS i, id, track, kin FROM typed JOIN around USING (id) WHERE track IS NOT NULL), "
    "steps AS (SELECT CAST(0 AS BIGINT) AS i, CAST([] AS VARCHAR[]) AS seen, CAST([] AS VARCHAR[]) AS got, CAST(NULL AS VARCHAR) AS track "
    "UNION ALL SELECT i, list_concat(seen, got), got, track FROM (SELECT m.i, s.seen, m.track, CASE WHEN list_contains(s.seen, m.id) THEN [] "
    "ELSE list_filter(m.kin, lambda x: NOT list_contains(s.seen, x)) END AS got FROM steps s JOIN members m ON m.i = s.i + 1)) ")


@job("track_first", f"{_TAKEN} SELECT unnest(got) AS id, track FROM steps WHERE len(got) > 0")
def track_first(spark, sf):
    """Each feature in the one track that takes it first."""
    nodes = B.tree_nodes(spark, sf).withColumn("type", F.expr(B.TRACK_TYPE))
    return graph.first_tracks(nodes, B.tree_edges(spark, sf), projection.track(F.col("type")), ["start", "id"])


_PATHS = (
    f"{TREE}, {{edges}}, walk AS (SELECT id, id AS root_id, 0 AS depth, [struct_pack(a := start, b := type, c := id)] AS path FROM nodes "
    "WHERE parent_id IS NULL UNION ALL SELECT n.id, w.root_id, w.depth + 1, list_append(w.path, struct_pack(a := n.start, b := n.type, "
    "c := n.id)) FROM walk w JOIN edges e ON e.parent_id = w.id JOIN nodes n ON n.id = e.child_id)")
_TREE_EDGES = "edges AS (SELECT id AS child_id, parent_id FROM nodes WHERE parent_id IS NOT NULL)"


@job("gff_order", f"{_PATHS.format(edges=_TREE_EDGES)} SELECT id, root_id, row_number() OVER (ORDER BY path) - 1 AS position FROM walk")
def gff_order(spark, sf):
    """Depth-first write order, as dense positions."""
    return graph.tree_order(B.tree_nodes(spark, sf), B.tree_edges(spark, sf), ["start", "type"]).select("id", "root_id", "position")


@job("gff_order_shared", f"{_PATHS.format(edges=B.SHARED_EDGES_SQL)}, best AS (SELECT id, arg_min(root_id, path) AS root_id, min(path) AS path "
     "FROM walk GROUP BY id) SELECT id, root_id, row_number() OVER (ORDER BY path) - 1 AS position FROM best")
def gff_order_shared(spark, sf):
    """The same where many features have several parents, at different depths."""
    return graph.tree_order(B.tree_nodes(spark, sf), B.shared_edges(spark, sf), ["start", "type"]).select("id", "root_id", "position")


def _traverse_job(order: str, by: str) -> None:
    @job(f"traverse_{order}", f"{_PATHS.format(edges=_TREE_EDGES)} SELECT root_id AS start_id, id AS node_id, depth, "
         f"row_number() OVER (PARTITION BY root_id ORDER BY {by}) - 1 AS position FROM walk")
    def run(spark, sf):
        nodes = B.tree_nodes(spark, sf)
        roots = nodes.filter("parent_id IS NULL").select("id")
        return graph.traverse(nodes, B.tree_edges(spark, sf), roots, ["start", "type"], order)


_traverse_job("depth", "path")
_traverse_job("breadth", "depth, path")


@job("parents_from_links", f"{TREE}, {B.SHARED_EDGES_SQL} SELECT n.id, COALESCE(string_agg(e.parent_id, '|' ORDER BY e.parent_id), '') AS parents "
     "FROM nodes n LEFT JOIN (SELECT DISTINCT child_id, parent_id FROM edges) e ON e.child_id = n.id GROUP BY n.id")
def parents_from_links(spark, sf):
    """Parent lists rebuilt from the links of the graph."""
    rows = graph.with_parents(B.tree_nodes(spark, sf).select("id"), B.shared_edges(spark, sf))
    return rows.select("id", F.array_join("parent", "|").alias("parents"))


_PRINTED = "CASE WHEN id LIKE 'C%' AND CAST(substr(id, 2) AS INT) % 4 = 2 THEN 'c_terminal_region' ELSE type END"


@job("snk_gff_tree", f"{_PATHS.format(edges=B.SHARED_EDGES_SQL).replace('b := type', 'b := kind').replace('b := n.type', 'b := n.kind').replace('FROM nodes WHERE parent_id IS NULL', 'FROM kinds WHERE parent_id IS NULL').replace('JOIN nodes n', 'JOIN kinds n').replace(', edges AS', f', kinds AS (SELECT *, {_PRINTED} AS kind FROM nodes), edges AS', 1)}"
     ", best AS (SELECT id, arg_min(root_id, path) AS root_id, min(path) AS path FROM walk GROUP BY id), heads AS (SELECT root_id, "
     "row_number() OVER (ORDER BY min(path)) - 1 AS family FROM best GROUP BY root_id) SELECT id, family, row_number() OVER (ORDER BY path) - 1 AS line "
     "FROM best JOIN heads USING (root_id) JOIN kinds USING (id) WHERE kind <> 'c_terminal_region'")
def snk_gff_tree(spark, sf):
    """A feature graph with shared children written in tree order, read back file by file: which family and line each feature is."""
    nodes = graph.with_parents(B.tree_nodes(spark, sf).drop("parent_id"), B.shared_edges(spark, sf))
    features = nodes.select(
        F.lit("chr").alias("seqid"), F.lit("src").alias("source"), F.expr(_PRINTED).alias("type"), "start", F.lit(99).alias("end"),
        F.lit(None).cast("double").alias("score"), F.lit("+").alias("strand"), F.lit(".").alias("phase"), attributes(id=F.col("id"), parent=F.col("parent")).alias("attributes"))
    path = scratch(spark, "gff-tree")
    # ids break ties as in the check
    writers.write_gff3_tree(features.withColumn("id", F.col("attributes.id")), path, sort=("start", "type", "id"))
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("n"))
    placed = dealt(lines, ["file", "n"])
    swept = climb(placed.rows, placed.bins, sums={"family": (F.col("value") == "###").cast("bigint"), "line": (F.col("value") != "###").cast("bigint")})
    return swept.filter("value <> '###'").select(F.regexp_extract("value", "ID=([^;]+)", 1).alias("id"), "family", "line")


@job("fit_to_children", "WITH c AS (SELECT l_orderkey, min(l_partkey) AS lo, max(l_partkey + CAST(l_quantity AS INT)) AS hi FROM lineitem GROUP BY 1) "
     "SELECT o_orderkey AS id, COALESCE(lo, 5) AS start, COALESCE(hi, 6) AS \"end\" FROM orders LEFT JOIN c ON l_orderkey = o_orderkey")
def fit_to_children(spark, sf):
    parents = B.table(spark, sf, "orders").selectExpr("o_orderkey AS id", "CAST(5 AS BIGINT) AS start", "CAST(6 AS BIGINT) AS end")
    children = B.table(spark, sf, "lineitem").selectExpr("l_orderkey AS id", "l_partkey AS start", "l_partkey + CAST(l_quantity AS INT) AS end")
    return projection.fit_to_children(parents, children, "id")


@job("numeric_subset", "SELECT 'O' || CAST(o_orderkey AS STRING) AS name, o_totalprice AS charge FROM orders")
def numeric_subset(spark, sf):
    ranked = B.table(spark, sf, "orders").selectExpr("'O' || o_orderkey AS name", "o_totalprice AS charge", "o_custkey AS effector_score")
    return genome_scores.numeric_subset(ranked, ["charge"])
