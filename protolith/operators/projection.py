"""Protein features onto the genome, through the exons.

Exons get their offset in the transcript by a cumulative sum in strand order; a
feature piece is then an interval overlap inside one protein.  Features and exons
meet once, by protein; proteins with too many of both for that are swept along
the transcript, without pairing all exons with all features.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..functions.attributes import GAP, attributes
from ..session import stored
from ..sources.gff3 import coding_exons
from .ordered import climb, dealt, number_rows, scan

# --- fixed values: feature types with a role ------------------------------------
SIGNAL_PARTS = (
    "n_terminal_region", "c_terminal_region", "central_hydrophobic_region_of_signal_peptide",
)
MATCH_TYPES = ("protein_hmm_match", "protein_match")
POSITIONED_TYPES = (
    "transmembrane_polypeptide_region", "polypeptide_motif", "propeptide_cleavage_site",
)
TRACKS = {
    "signal_peptide": "signal_peptide",
    "n_terminal_region": "signal_peptide",
    "c_terminal_region": "signal_peptide",
    "central_hydrophobic_region_of_signal_peptide": "signal_peptide",
    "mitochondrial_targeting_signal": "peptide_localization_signal",
    "transit_peptide": "peptide_localization_signal",
    "peptide_localization_signal": "peptide_localization_signal",
    "transmembrane_polypeptide_region": "transmembrane_polypeptide_region",
    "propeptide_cleavage_site": "propeptide_cleavage_site",
    "polypeptide_motif": "polypeptide_motif",
    "protein_match": "protein_match",
    "protein_hmm_match": "protein_match",
    "match_part": "protein_match",
}
# --- end of fixed values ------------------------------------------------------

CODON = 3
EXON_BIN = 1 << 20
#: A protein with more features and exons than this is not left to one task.
CROWD = 1 << 17
#: Most pairs of features and exons that are looked at for each row of a protein.
PAIRS = 256
STRANDS = ("+", "-")
#: Annotations of a part; their attributes are sorted along.
ROWS_PER_TASK = 100_000


def track(type_: Column) -> Column:
    """The track group of a feature type, NULL for types without one."""
    table = F.create_map(*[F.lit(x) for kv in TRACKS.items() for x in kv])
    return F.try_element_at(table, type_)


def _along() -> Column:
    return F.when(F.col("strand") == "-", -F.col("end")).otherwise(F.col("start")).cast("bigint")


def exon_offsets(exons: DataFrame, bin_size: int = EXON_BIN) -> DataFrame:
    """Exons ``id, seqid, strand, start, end`` with ``t_start, t_end`` in the transcript and their number ``k``.

    The transcript runs up the genome on ``+`` and down on ``-``.  Exons without a length take part in nothing.
    """
    rows = exons.filter(F.col("start") < F.col("end")).withColumn("__at", _along())
    placed = scan(
        rows, ["id"], F.floor(F.col("__at") / bin_size), ["__at"],
        sums={"t_start": (F.col("end") - F.col("start")).cast("bigint"), "k": F.lit(1).cast("bigint")})
    return placed.withColumn(
        "t_end", F.col("t_start") + F.col("end") - F.col("start")).drop("__at")


def _at_exon(rows: DataFrame, offsets: DataFrame, position: Column, label: str) -> DataFrame:
    """Rows with the exon ``__x`` of their protein that holds a transcript position; NULL past the last one.

    Exons and positions are one event stream, sorted by protein and place and swept once: the exon that
    began last is the running maximum of the exon events.
    """
    exon = F.struct("id", "t_start", "t_end", "k", "seqid", "strand", F.col("start").alias("gs"), F.col("end").alias("ge"))
    begins = offsets.select("id", F.col("t_start").alias("__p"), F.lit(0).alias("__kind"), exon.alias("__x"))
    asks = rows.select("id", position.alias("__p"), F.lit(1).alias("__kind"), F.struct(*rows.columns).alias("__row"))
    stream = dealt(begins.unionByName(asks, allowMissingColumns=True), ["id", "__p", "__kind"], label=label)
    swept = climb(stream.rows, stream.bins, peaks={"__last": F.col("__x")}).filter("__kind = 1")
    inside = F.col("__last.id").eqNullSafe(F.col("__row.id")) & (F.col("__p") >= 0) & (F.col("__p") < F.col("__last.t_end"))
    return swept.select("__row.*", F.when(inside, F.col("__last")).alias("__x"))


def apart(features: DataFrame, exons: DataFrame) -> DataFrame:
    """Proteins that are swept: too many rows or pairs for one task, exons with and without a strand, or no id."""
    has_length = F.col("start") < F.col("end")
    one = [F.lit(n).cast("bigint") for n in (0, 1)]
    rows = features.select("id", one[1].alias("f"), one[0].alias("e"), one[0].alias("known")).unionByName(exons.filter(has_length).select(
        "id", one[0].alias("f"), one[1].alias("e"), F.coalesce(F.col("strand").isin(*STRANDS), F.lit(False)).cast("bigint").alias("known")))
    sizes = rows.groupBy("id").agg(*(F.sum(c).alias(c) for c in ("f", "e", "known"))).filter("f > 0 AND e > 0")
    size = F.col("f") + F.col("e")
    return sizes.filter((size > CROWD) | (F.col("f") * F.col("e") > size * PAIRS) | F.col("known").between(1, F.col("e") - 1) | F.col("id").isNull()).select("id")


def _by_apart(features: DataFrame, exons: DataFrame, near, swept) -> DataFrame:
    """``near(features, exons)``, but ``swept(features, exons)`` for the proteins that need it."""
    found = stored(apart(features, exons), "apart")
    if found.isEmpty():
        return near(features, exons)

    def split(how: str) -> list[DataFrame]:
        return [rows.join(found.withColumnRenamed("id", "__id"), F.col("id").eqNullSafe(F.col("__id")), how) for rows in (features, exons)]
    return near(*split("left_anti")).unionByName(swept(*split("left_semi")))


def _near_offsets(exons: DataFrame) -> DataFrame:
    """:func:`exon_offsets` where the exons of a protein fit a task, as ``__x``, with ``__id`` and the length of the transcript."""
    protein = Window.partitionBy("id")
    before = protein.orderBy("__at", "start", "end", "seqid", "strand").rowsBetween(Window.unboundedPreceding, -1)
    rows = exons.filter(F.col("start") < F.col("end")).select("id", "seqid", "strand", "start", "end", _along().alias("__at"))
    size = (F.col("end") - F.col("start")).cast("bigint")
    placed = rows.withColumn("t_start", F.coalesce(F.sum(size).over(before), F.lit(0).cast("bigint")))
    return placed.select(F.col("id").alias("__id"), F.struct(
        "t_start", (F.col("t_start") + F.col("end") - F.col("start")).alias("t_end"), "seqid", "strand",
        F.col("start").alias("gs"), F.col("end").alias("ge")).alias("__x"))


def _project_near(features: DataFrame, exons: DataFrame, strict: bool) -> DataFrame:
    """Pieces of proteins whose features and exons fit a task: they meet once, by protein."""
    x = F.col("__x")
    on_codons = features.withColumns({"__fs": F.col("p_start").cast("bigint") * CODON, "__fe": F.col("p_end").cast("bigint") * CODON})
    offsets = _near_offsets(exons)
    has_length = F.col("__fs") < F.col("__fe")
    meets = has_length & (F.col("__fs") < x["t_end"]) & (F.col("__fe") > x["t_start"]) & x["strand"].isin(*STRANDS)
    if strict:
        offsets = offsets.withColumn("__total", F.max(x["t_end"]).over(Window.partitionBy("__id")))
        fits = has_length & (F.col("__fs") < F.col("__total")) & (F.col("__fe") > 0) & x["strand"].isin(*STRANDS)
        # told once for each feature, on the first exon
        meets = F.when((x["t_start"] == 0) & ~F.coalesce(fits, F.lit(False)), _reaches_none()).otherwise(meets)
    return on_codons.join(offsets, F.col("id") == F.col("__id")).filter(meets).select(*_on_genome(x, features.columns))


def _reaches_none() -> Column:
    return F.raise_error(F.concat(F.lit("feature reaches no exon: "), F.col("feature_id").cast("string"))).cast("boolean")


def _on_genome(x: Column, columns: list[str]) -> list[Column]:
    """Feature columns with the part of exon ``x`` between ``__fs`` and ``__fe`` on the genome."""
    lo = F.greatest(F.col("__fs"), x["t_start"]) - x["t_start"]
    hi = F.least(F.col("__fe"), x["t_end"]) - x["t_start"]
    plus = x["strand"] == "+"
    return [*columns, x["seqid"].alias("seqid"), x["strand"].alias("strand"),
            F.when(plus, x["gs"] + lo).otherwise(x["ge"] - hi).alias("start"),
            F.when(plus, x["gs"] + hi).otherwise(x["ge"] - lo).alias("end")]


def project(features: DataFrame, exons: DataFrame, strict: bool = False) -> DataFrame:
    """Genome pieces of protein features.

    ``features``: ``id`` (protein), ``feature_id``, ``p_start``, ``p_end`` in residues and
    anything else.  The pieces carry the feature columns plus ``seqid, strand, start,
    end`` on the genome; what lies past the last exon is cut off, empty pieces do
    not appear.  A feature of a protein with exons that reaches none of them, has no length, or whose exons have a
    strand other than + and - leaves no piece; with ``strict`` it fails the job.

    Features and exons meet by protein; the few proteins that :func:`apart` names are swept.
    """
    return _by_apart(features, exons, lambda f, e: _project_near(f, e, strict), lambda f, e: _project_swept(f, e, strict))


def _project_swept(features: DataFrame, exons: DataFrame, strict: bool) -> DataFrame:
    """Pieces without pairing all exons with all features, however many a protein has.

    One sweep finds the exon a feature starts in.  Only features that go on past it are swept
    again for their last exon, and joined with the exons between by number.
    """
    offsets = stored(exon_offsets(exons).select("id", "seqid", "strand", "start", "end", "t_start", "t_end", "k"), "exons")
    on_codons = features.withColumns({"__fs": F.col("p_start").cast("bigint") * CODON, "__fe": F.col("p_end").cast("bigint") * CODON})
    # a feature that begins before the protein does starts with it
    started = _at_exon(on_codons, offsets, F.greatest(F.col("__fs"), F.lit(0).cast("bigint")), "feature-starts")
    x = F.col("__x")
    fits = x.isNotNull() & (F.col("__fs") < F.col("__fe")) & (F.col("__fe") > 0) & x["strand"].isin(*STRANDS)
    if strict:
        started = started.join(offsets.select("id").distinct().withColumn("__known", F.lit(True)), "id", "left")
        fits = F.when(F.coalesce(fits, F.lit(False)), True).when(F.col("__known"), _reaches_none()).otherwise(False)
    started = stored(started.filter(fits).drop("__known"), "started")
    first = started.select(*_on_genome(x, features.columns))
    longer = started.filter(F.col("__fe") > x["t_end"]).withColumn("__from", x["k"] + 1).drop("__x")
    total = offsets.groupBy("id").agg(F.max("t_end").alias("__total"))
    longer = longer.join(total, "id")
    ended = _at_exon(longer, offsets, F.least(F.col("__fe"), F.col("__total")) - 1, "feature-ends")
    rest = ended.filter(F.col("__from") <= x["k"]).withColumn("k", F.explode(F.sequence(F.col("__from"), x["k"]))).drop("__x")
    between = offsets.select("id", "k", F.struct("t_start", "t_end", "seqid", "strand", F.col("start").alias("gs"), F.col("end").alias("ge")).alias("__x"))
    return first.unionByName(rest.join(between, ["id", "k"]).select(*_on_genome(x, features.columns)))


def unprojectable(features: DataFrame, exons: DataFrame, pieces: DataFrame | None = None) -> DataFrame:
    """Features of proteins with exons that ended up without any piece."""
    known = exons.select("id").distinct()
    pieces = project(features, exons) if pieces is None else pieces
    return features.join(known, "id", "left_semi").join(
        pieces.select("feature_id").distinct(), "feature_id", "left_anti")


def single_value_violations(exons: DataFrame) -> DataFrame:
    """Proteins whose exons disagree about strand, sequence or source."""
    columns = [c for c in ("strand", "seqid", "source") if c in exons.columns]
    differs = [F.min(c) != F.max(c) for c in columns]
    out = exons.groupBy("id").agg(*[d.alias(f"many_{c}") for c, d in zip(columns, differs)])
    bad = F.col(f"many_{columns[0]}")
    for c in columns[1:]:
        bad = bad | F.col(f"many_{c}")
    return out.filter(bad)


def drop_lonely_cuts(features: DataFrame, group: str = "id", type_: str = "type",
                     needs: str = "signal_peptide", drops: str = "propeptide_cleavage_site", near: bool = False) -> DataFrame:
    """Remove features of one type from groups that lack another type; ``near``: each group fits a task."""
    if near:
        seen = F.max(F.when(F.col(type_) == needs, True)).over(Window.partitionBy(group))
        return features.withColumn("__having", seen).filter(~F.col(type_).eqNullSafe(drops) | F.col("__having")).drop("__having")
    having = features.filter(F.col(type_) == needs).select(F.col(group).alias("__group"), F.lit(True).alias("__having")).distinct()
    flagged = features.join(having, F.col(group).eqNullSafe(F.col("__group")), "left")
    return flagged.filter(~F.col(type_).eqNullSafe(drops) | F.col("__having")).select(*features.columns)


def relabel(source: Column, custom: Column, old: str = "SignalP:3.0b") -> Column:
    """Tell the two models behind one source label apart by an attribute."""
    neural = F.array_contains(F.map_keys(custom), "d_decision")
    name, _, version = old.partition(":")
    return F.when(source == old, F.when(F.coalesce(neural, F.lit(False)), f"{name}NN:{version}")
                  .otherwise(f"{name}HMM:{version}")).otherwise(source)


def group_key(type_: Column, source: Column, target: Column, start: Column, end: Column) -> Column:
    """Which features belong together: positioned types by place, matches also by
    target, everything else by type and source only."""
    positioned = type_.isin(*POSITIONED_TYPES)
    match = type_.isin(*MATCH_TYPES)
    return F.struct(
        type_.alias("type"), source.alias("source"),
        F.when(match, target).alias("target"),
        F.when(positioned | match, start).alias("start"),
        F.when(positioned | match, end).alias("end"),
    )


def feature_groups(features: DataFrame) -> DataFrame:
    """Distinct groups per protein with the number of members and a running index.

    The index follows the first member (lowest ``feature_id``).
    """
    key = group_key(F.col("type"), F.col("source"), F.col("target"), F.col("p_start"), F.col("p_end"))
    grouped = features.withColumn("g", key).groupBy("id", "g").agg(
        F.count(F.lit(1)).alias("n"), F.min("feature_id").alias("first_id"))
    return grouped


def envelope(pieces: DataFrame, keys: list[str], first_by: list[str] | None = None) -> DataFrame:
    """Per group the extent of its pieces, the piece count, and the first piece's score."""
    out = [F.min("start").alias("start"), F.max("end").alias("end"),
           F.count(F.lit(1)).alias("n_pieces")]
    if "score" in pieces.columns:
        out.append(F.min_by("score", F.struct(*(first_by or ["start"]))).alias("score"))
    return pieces.groupBy(*keys).agg(*out)


def fit_to_children(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Parents take the extent of their children; childless ones keep theirs."""
    extent = children.groupBy(key).agg(F.min("start").alias("__lo"), F.max("end").alias("__hi"))
    return parents.join(extent, key, "left").withColumn(
        "start", F.coalesce("__lo", "start")).withColumn("end", F.coalesce("__hi", "end")).drop(
        "__lo", "__hi")


def map_to_genome(
    features: DataFrame, exons: DataFrame, filter_cuts: bool = True, grouped: bool = True, strict: bool = False,
) -> DataFrame:
    """Project features and give them their genome parents.

    Output rows are parents and pieces: ``id, source, type, kind, seqid, start, end,
    strand, feature_id, parent``.  Homology features on several exons become
    ``match_part`` pieces below a match; other features sit below a ``region``.
    ``grouped=False`` treats every feature as a group of its own and applies no
    type-specific filter.

    Features with ``score`` and ``attributes`` keep them on every piece, without Gap and with the
    Parent list of their links; a match takes those of its first member, a region holds the
    ``kind`` below it.  The rows then have a ``phase`` too and can be written as GFF3.

    ``strict`` fails the job where exons of a protein disagree about strand, sequence or source, and where a
    feature reaches no exon; otherwise such features are left out (``unprojectable`` and
    ``single_value_violations`` list them).
    """
    features = features.filter(F.col("id").isNotNull())
    how = {"filter_cuts": filter_cuts, "grouped": grouped, "strict": strict}
    return _by_apart(features, exons, lambda f, e: _mapped_near(f, e, **how), lambda f, e: _mapped_swept(f, e, **how))


def _wanted(features: DataFrame, filter_cuts: bool, grouped: bool, near: bool) -> DataFrame:
    """The features that are mapped, with the group ``g`` they belong to."""
    if not grouped:
        return features.withColumn("g", F.struct(F.col("feature_id").alias("feature_id")))
    rows = features.filter(~F.col("type").isin(*SIGNAL_PARTS))
    if filter_cuts:
        rows = drop_lonely_cuts(rows, near=near)
    return rows.withColumn("g", group_key(F.col("type"), F.col("source"), F.col("target"), F.col("p_start"), F.col("p_end")))


def _parent_id(index: str) -> Column:
    return F.when(
        F.col("type").isin(*MATCH_TYPES), F.concat_ws("-", F.col("id").cast("string"), "type", F.col(index).cast("string"))
    ).otherwise(F.concat_ws("-", F.lit("polypeptide"), F.col("id").cast("string"), F.col(index).cast("string")))


def _takes_number() -> Column:
    """A match on a single exon has no parent and takes no number."""
    return ~(F.col("type").isin(*MATCH_TYPES) & (F.col("n_exons") == 1))


def _mapped_near(features: DataFrame, exons: DataFrame, filter_cuts: bool, grouped: bool, strict: bool) -> DataFrame:
    """Proteins whose features and exons fit a task: all steps stay where the rows of a protein have met."""
    rows = _wanted(features.join(_exon_counts(exons, strict), "id"), filter_cuts, grouped, near=True)
    rows = rows.withColumn("__counts", F.coalesce(_takes_number(), F.lit(False)))
    if grouped:
        rows = rows.withColumn("__first", F.min("feature_id").over(Window.partitionBy("id", "g")))
    else:
        rows = rows.withColumn("__first", F.col("feature_id"))
    # groups with a number come first; what has no number may follow in any order
    order = Window.partitionBy("id").orderBy(F.col("__counts").desc(), "__first", "g", "type", "source")
    rows = rows.withColumn("__index", F.dense_rank().over(order).cast("bigint"))
    rows = rows.withColumn("parent", F.when(F.col("__counts"), _parent_id("__index")))
    if not grouped:
        # features that share an id have the parents of all of them
        rows = rows.withColumn("parent", F.collect_set("parent").over(Window.partitionBy("id", "g"))).withColumn("parent", F.explode_outer("parent"))
    placed = rows.drop("g", "n_exons", "__counts", "__first", "__index")
    children = _children(_project_near(placed, exons, strict))
    full = "attributes" in children.columns
    group = Window.partitionBy("id", "parent", "source", "__of", "seqid", "strand").orderBy("feature_id")
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = {"__first": F.min_by(F.struct("score", "attributes"), "feature_id").over(whole)} if full else {}
    spread = children.withColumns({"__n": F.row_number().over(group), "__lo": F.min("start").over(whole), "__hi": F.max("end").over(whole), **first})
    names = [c for c in children.columns if c != "__of"]
    types = {f.name: f.dataType for f in children.schema.fields}
    top = _top_columns(types["feature_id"], full)
    ends = {"start": F.col("__lo"), "end": F.col("__hi")}
    above = F.struct(*(ends.get(c, top[c]).cast(types[c]).alias(c) for c in names), F.col("parent").alias("own_id"))
    own = F.struct(*names, F.lit(None).cast("string").alias("own_id"))
    # a group's parent goes out beside its first piece
    out = spread.select(F.inline(F.when(F.col("parent").isNotNull() & (F.col("__n") == 1), F.array(own, above)).otherwise(F.array(own))))
    return out.select(*_out_columns(full))


def _mapped_swept(features: DataFrame, exons: DataFrame, filter_cuts: bool, grouped: bool, strict: bool) -> DataFrame:
    """The same however many features and exons a protein has."""
    exons = stored(exons, "exons")
    rows = stored(_wanted(features.join(_exon_counts(exons, strict), "id"), filter_cuts, grouped, near=False), "features")
    groups = rows.filter(_takes_number()).groupBy("id", "g", "type", "source").agg(F.min("feature_id").alias("first_id"))
    numbered = number_rows(groups, ["first_id"], out="index", keys=["id"]).withColumn("index", F.col("index") + 1)
    parents = numbered.select(F.col("id").alias("__id"), F.col("g").alias("__g"), _parent_id("index").alias("parent"))
    same = rows["id"].eqNullSafe(parents["__id"]) & rows["g"].eqNullSafe(parents["__g"])
    placed = rows.join(parents, same, "left").drop("__id", "__g", "g", "n_exons")

    children = _children(stored(_project_swept(placed, exons, strict), "pieces"))
    full = "attributes" in children.columns
    first = [F.min_by(F.struct("score", "attributes"), "feature_id").alias("__first")] if full else []
    above = children.filter(F.col("parent").isNotNull()).groupBy(
        "id", "source", "__of", "seqid", "strand", "parent").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), *first)
    top = _top_columns(children.schema["feature_id"].dataType, full)
    tops = above.select(*(top[c].alias(c) for c in children.columns if c != "__of"), F.col("parent").alias("own_id"))
    return tops.unionByName(children.drop("__of").withColumn("own_id", F.lit(None).cast("string"))).select(*_out_columns(full))


def _out_columns(full: bool) -> list[str]:
    names = ["id", "source", "type", "kind", "seqid", "start", "end", "strand", "feature_id", "own_id", "parent"]
    return names + ["score", "phase", "attributes"] if full else names


def _children(pieces: DataFrame) -> DataFrame:
    """Pieces as output rows, with their feature's type ``__of``."""
    many = F.col("parent").isNotNull() & F.col("type").isin(*MATCH_TYPES)
    kept = []
    if {"score", "attributes"} <= set(pieces.columns):
        own = F.coalesce("attributes", attributes()).withField("gap", F.lit(None).cast(GAP)).withField(
            "parent", F.when(F.col("parent").isNotNull(), F.array("parent")))
        kept = ["score", F.lit(".").alias("phase"), own.alias("attributes")]
    return pieces.select(
        "id", "source", F.when(many, "match_part").otherwise(F.col("type")).alias("type"),
        F.lit(None).cast("string").alias("kind"), "seqid", "start", "end", "strand",
        "feature_id", "parent", F.col("type").alias("__of"), *kept)


def _top_columns(feature_id: DataType, full: bool) -> dict[str, Column]:
    """The parent of a group of children as output columns."""
    is_match = F.col("__of").isin(*MATCH_TYPES)
    out = {c: F.col(c) for c in ("id", "source", "seqid", "start", "end", "strand")} | {
        "type": F.when(is_match, F.col("__of")).otherwise("region"), "kind": F.when(~is_match, F.col("__of")),
        "feature_id": F.lit(None).cast(feature_id), "parent": F.lit(None).cast("string")}
    if full:
        of_match = F.col("__first.attributes").withField("id", F.col("parent")).withField(
            "parent", F.lit(None).cast("array<string>"))
        of_region = attributes(id=F.col("parent"), custom=F.create_map(F.lit("kind"), F.array("__of")))
        out |= {"score": F.when(is_match, F.col("__first.score")), "phase": F.lit("."),
                "attributes": F.when(is_match, of_match).otherwise(of_region)}
    return out


def _exon_counts(exons: DataFrame, strict: bool) -> DataFrame:
    """``id, n_exons``; with ``strict`` proteins whose exons disagree fail the job."""
    single = [c for c in ("strand", "seqid", "source") if c in exons.columns]
    counts = exons.groupBy("id").agg(F.count(F.lit(1)).alias("n_exons"), *(
        x for c in single for x in (F.min(c).alias(f"__lo_{c}"), F.max(c).alias(f"__hi_{c}"))))
    if strict:
        n = F.col("n_exons")
        for c in single:
            failed = F.raise_error(F.concat(F.lit(f"several values of {c}: "), F.col("id").cast("string"))).cast("bigint")
            n = F.when(F.col(f"__lo_{c}") == F.col(f"__hi_{c}"), n).otherwise(failed)
        counts = counts.withColumn("n_exons", n)
    return counts.select("id", "n_exons")


def annotation_rows(annotations: DataFrame) -> DataFrame:
    """Protein features, as read from GFF3, ready for mapping: numbered, relabelled, without parts of signals.

    A signal peptide gives up its id, and what names it as a parent loses that parent.
    """
    rows = annotations.filter(~F.coalesce(F.col("type").isin(*SIGNAL_PARTS), F.lit(False)))
    rows = stored(rows.withColumn("feature_id", F.monotonically_increasing_id()) if "feature_id" not in rows.columns else rows, "annotations")
    # the number of parts follows the rows; all later steps of the mapping keep them
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(max(least, -(-rows.count() // ROWS_PER_TASK)), "seqid")
    a = F.col("attributes")
    signal = F.coalesce(F.col("type") == "signal_peptide", F.lit(False)) & a["id"].isNotNull()
    freed = rows.filter(signal).groupBy(F.col("seqid").alias("__seqid")).agg(F.collect_set(a["id"]).alias("__freed"))
    rows = rows.join(freed, F.col("seqid") == F.col("__seqid"), "left")
    kept = F.when(F.col("__freed").isNotNull(), F.array_except(a["parent"], "__freed")).otherwise(a["parent"])
    fixed = a.withField("id", F.when(~signal, a["id"])).withField("parent", kept)
    return rows.select(
        F.col("seqid").alias("id"), "feature_id", "type", relabel(F.col("source"), a["custom"]).alias("source"),
        F.to_json(a["target"]).alias("target"), F.col("start").alias("p_start"), F.col("end").alias("p_end"), "score", fixed.alias("attributes"))


def map_annotations(genes: DataFrame, annotations: DataFrame, field: str = "Parent", **how) -> DataFrame:
    """Annotations of proteins onto the genome: the coding exons of ``genes`` by the id in ``field``, then :func:`map_to_genome`.

    Both sides are features as :func:`protolith.sources.gff3.parse_gff3` gives them.  Annotations of proteins without exons are left out.
    """
    exons = coding_exons(genes, field).select("id", "seqid", "strand", "source", "start", "end")
    return map_to_genome(annotation_rows(annotations), exons, **how)
