"""The versioned result store: load, select, compare, decode.

On disk it is Parquet, ``results`` and ``decoder``.  Results are partitioned by analysis and, inside, bucketed
and sorted by checksum, so a question about one result kind reads only its folder and a join with a set
of checksums moves only the set.  Every row carries a digest of what makes it the same result as another.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..analyses import ANALYSES, MULTIPLE_OK, NEEDS_DATABASE, choose
from ..session import stored
from .ordered import number_rows

#: Targets in one list, and copies of a list so that no list is one task's work.
BUCKET, COPIES = 256, 64
#: Targets that may be broadcast.
SMALL = 50_000
#: Files of checksums in each analysis.
BUCKETS = 64
VERSION = ["analysis", "software_version", "database_version"]
RESULT_COLUMNS = [
    "analysis", "software", "software_version", "database", "database_version",
    "pipeline_version", "checksum", "md5sum", "data",
]


def needs_database(analysis: Column) -> Column:
    return analysis.isin(*NEEDS_DATABASE)


def name_column(analysis: Column) -> Column:
    special = [a.name for a in ANALYSES.values() if a.name_column == "query"]
    return F.when(analysis.isin(*special), "query").otherwise("name")


def record_name(analysis: Column, data: Column) -> Column:
    """The sequence name inside a payload."""
    return F.when(name_column(analysis) == "query", F.get_json_object(data, "$.query")).otherwise(
        F.get_json_object(data, "$.name"))


def coerce_payload(analysis: Column, data: Column, drop_name: bool = False) -> Column:
    """Payload JSON with exactly the declared columns, in declared order and type.

    Only the branch of the row's own kind is evaluated.
    """
    out = None
    for a in ANALYSES.values():
        kept = T.StructType([
            f for f in a.schema.fields if not (drop_name and f.name == a.name_column)])
        plain = F.to_json(F.from_json(data, kept), {"ignoreNullFields": "false"})
        out = F.when(analysis == a.name, plain) if out is None else out.when(analysis == a.name, plain)
    return out


def prepare(
    rows: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None,
    drop_name: bool = False, drop_null_dbversion: bool = False,
) -> DataFrame:
    """Typed payloads, plus ``name`` (NULL when dropped), for the wanted result kinds."""
    a = F.col("analysis")
    kept = rows.filter(a.isin(*choose(include, exclude)))
    if drop_null_dbversion:
        kept = kept.filter(~(needs_database(a) & F.col("database_version").isNull()))
    name = F.lit(None).cast("string") if drop_name else record_name(a, F.col("data"))
    # kinds without a database carry no database version in the store
    versioned = F.when(needs_database(a), F.col("database_version"))
    database = F.when(needs_database(a), F.col("database"))
    return (
        kept.withColumn("name", name)
        .withColumn("data", coerce_payload(a, F.col("data"), drop_name))
        .withColumn("database", database).withColumn("database_version", versioned)
    )


def conflict_digest() -> Column:
    """128 bits that rows of the same stored result share; kinds with many rows each are told apart by payload."""
    a = F.col("analysis")
    parts = ["analysis", "software_version", F.coalesce("database_version", F.lit("")), "checksum", "md5sum",
             F.when(a.isin(*MULTIPLE_OK), F.col("data")).otherwise("")]
    # a sign ahead of each part keeps NULL apart from the empty text
    marked = [F.coalesce(F.concat(F.lit("+"), F.col(x) if isinstance(x, str) else x), F.lit("-")) for x in parts]
    return F.unhex(F.md5(F.concat_ws("\u001f", *marked)))


def keep_first(rows: DataFrame, arrival: list[str], store: DataFrame | None = None) -> DataFrame:
    """Of rows with one key keep the earliest, and none that the store already holds.

    Rows are written once with their ``key``; what is aggregated and compared is the key and one number,
    so neither payloads of copies nor those of the store are shuffled.  Among rows that arrive together any one is kept.
    """
    keyed = rows.withColumn("key", conflict_digest())
    if len(arrival) == 1 and rows.schema[arrival[0]].dataType in (T.LongType(), T.IntegerType()):
        held = stored(keyed.withColumn("__row", F.monotonically_increasing_id()), "arrived")
        # arrival and row as one decimal, which a hash aggregate can hold
        turn = F.col(arrival[0]).cast("decimal(19,0)") * F.lit(Decimal(10) ** 19) + F.col("__row")
    else:
        held = stored(number_rows(keyed, arrival, out="__row"), "arrived")
        turn = F.col("__row").cast("decimal(38,0)")
    first = held.select("key", turn.cast("decimal(38,0)").alias("__turn")).groupBy("key").agg(F.min("__turn").alias("__turn"))
    if store is not None:
        known = store if "key" in store.columns else store.withColumn("key", conflict_digest())
        first = first.join(known.select("key"), "key", "left_anti")
    row = F.pmod(F.col("__turn"), F.lit(Decimal(10) ** 19)).cast("bigint")
    return held.join(first.select(row.alias("__row")), "__row", "left_semi").drop("__row")


def load_results(
    rows: DataFrame, arrival: list[str], store: DataFrame | None = None, **options
) -> DataFrame:
    """The rows an append would add, with their ``key``."""
    return keep_first(prepare(rows, **options), arrival, store)


def _table(spark, path: str) -> str:
    """The store at ``path`` as a bucketed table of this session."""
    name = "store_" + hashlib.md5(path.encode()).hexdigest()
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{c}` string" for c in RESULT_COLUMNS if c != "analysis")
        place = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {name} ({columns}, `key` binary, `analysis` string) USING parquet PARTITIONED BY (`analysis`) "
                  f"CLUSTERED BY (`checksum`) SORTED BY (`checksum`) INTO {BUCKETS} BUCKETS LOCATION '{place}/results'")
    return name


def append_store(rows: DataFrame, path: str) -> None:
    """Append result rows: one folder per analysis, and in it one file per bucket of checksums, sorted by them."""
    spark = rows.sparkSession
    keyed = rows if "key" in rows.columns else rows.withColumn("key", conflict_digest())
    out = keyed.select(*[c for c in RESULT_COLUMNS if c != "analysis"], "key", "analysis")
    name = _table(spark, path)
    (out.repartition(BUCKETS, "checksum").write.mode("append").format("parquet").partitionBy("analysis")
     .bucketBy(BUCKETS, "checksum").sortBy("checksum").saveAsTable(name))


def exists(spark, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def append_new(rows: DataFrame, path: str) -> None:
    """Append the distinct ``rows`` that ``path`` does not hold yet; NULLs equal each other."""
    spark, fresh = rows.sparkSession, rows.distinct()
    if exists(spark, path):
        held = spark.read.schema(rows.schema).parquet(path).select(*[F.col(c).alias(f"__{c}") for c in rows.columns])
        same = F.lit(True)
        for c in rows.columns:
            same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
        fresh = fresh.join(held, same, "left_anti")
    fresh.write.mode("append").parquet(path)


def append_decoder(rows: DataFrame, path: str) -> None:
    """Append the names of prepared ``rows`` that the store does not know yet."""
    append_new(build_decoder(rows), f"{path}/decoder")


def read_decoder(spark, path: str) -> DataFrame:
    return spark.read.schema("checksum string, md5sum string, filename string, name string").parquet(f"{path}/decoder")


def read_store(spark, path: str) -> DataFrame:
    """Result rows and their ``key``.  Joins on the checksum need no exchange of the store."""
    name = _table(spark, path)
    if exists(spark, f"{path}/results"):
        # folders that other sessions have added
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(name)
    return spark.table(name).select(*RESULT_COLUMNS, "key")


def batch_is_done(spark, path: str, run: str, batch: int) -> bool:
    """Whether a stream's batch was loaded to its end."""
    if not exists(spark, f"{path}/batches"):
        return False
    log = spark.read.schema("run string, batch bigint").parquet(f"{path}/batches")
    return not log.filter((F.col("run") == run) & (F.col("batch") == batch)).isEmpty()


def log_batch(spark, path: str, run: str, batch: int) -> None:
    spark.createDataFrame([(run, batch)], "run string, batch bigint").coalesce(1).write.mode("append").parquet(f"{path}/batches")


def build_decoder(rows: DataFrame) -> DataFrame:
    """Distinct ``checksum, md5sum, filename, name``."""
    return rows.select("checksum", "md5sum", "filename", "name").filter(
        F.col("name").isNotNull()).distinct()


def attach_checksums(rows: DataFrame, sequences: DataFrame, name: str = "name") -> DataFrame:
    """Predictor rows with the checksums of their sequence, NULL when it is unknown.

    ``sequences`` holds ``id, checksum, md5sum`` and ``ordinal``; of a repeated id
    the last one counts.
    """
    last = sequences.groupBy("id").agg(
        F.max_by(F.struct("checksum", "md5sum"), "ordinal").alias("s"))
    known = last.select(F.col("id").alias(name), "s.checksum", "s.md5sum")
    return rows.join(known, name, "left")


def _version_key() -> list[Column]:
    """Analysis and versions; the database version counts only where one is needed."""
    db = F.when(needs_database(F.col("analysis")), F.coalesce("database_version", F.lit(""))).otherwise("")
    return [F.col("analysis").alias("__a"), F.col("software_version").alias("__v"), db.alias("__db")]


def usable_targets(targets: DataFrame) -> DataFrame:
    """Targets that need a database version but name none are skipped."""
    return targets.filter(
        ~(needs_database(F.col("analysis")) & F.col("database_version").isNull())).distinct()


def select_target(
    results: DataFrame, targets: DataFrame, checksums: DataFrame | None = None
) -> DataFrame:
    """Stored results of the wanted versions, optionally only for a checksum set.

    Up to ``SMALL`` targets are broadcast, so the store stays where its buckets put it; longer
    lists are joined by version and a copy number that comes from the checksum, so that a version with
    very many results is not one task's work.
    """
    wanted = stored(targets.filter("software_version IS NOT NULL").select(*_version_key()).distinct(), "targets")
    many = wanted.count() > SMALL
    keyed = results.select("*", *_version_key())
    on = ["__a", "__v", "__db"]
    if many:
        wanted = wanted.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
        keyed = keyed.withColumn("__copy", F.pmod(F.hash("checksum"), F.lit(COPIES)))
        on = [*on, "__copy"]
    else:
        wanted = F.broadcast(wanted)
    hits = keyed.join(wanted, on, "left_semi").select(*results.columns)
    return hits if checksums is None else hits.join(
        checksums.select("checksum").distinct(), "checksum", "left_semi")


def find_remaining(results: DataFrame, targets: DataFrame, checksums: DataFrame) -> DataFrame:
    """Per target, the checksums with no stored result: ``*VERSION, checksum``.

    Targets are written in lists of about ``BUCKET``.  Each checksum meets every list once,
    beside the numbers of the targets of that list it already holds, and only what is missing is written out.
    """
    wanted = targets.select(*VERSION).distinct().select("*", *_version_key())
    wanted = wanted.groupBy("__a", "__v", "__db").agg(F.collect_set(F.struct("database_version")).alias("versions"))
    numbered = stored(number_rows(wanted, ["__a", "__v", "__db"], out="i").select(
        "*", F.floor(F.col("i") / BUCKET).cast("int").alias("bucket")), "targets")
    n = numbered.count()
    lists, copies = max(-(-n // BUCKET), 1), COPIES if n > SMALL else 1
    offered = numbered.groupBy("bucket").agg(F.collect_list("i").alias("offered"))
    # with many lists they are copied, so that none is one task's work
    offered = offered.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    names = numbered.select("i", F.col("__a").alias("analysis"), F.col("__v").alias("software_version"), "versions")
    keys = numbered.select("__a", "__v", "__db", "i", "bucket")

    small = F.broadcast if n <= SMALL else lambda df: df
    known = results.select("checksum", *_version_key()).join(small(keys), ["__a", "__v", "__db"])
    held = known.groupBy("checksum", "bucket").agg(F.collect_set("i").alias("held"))
    work = checksums.select("checksum").distinct().select(
        "checksum", F.pmod(F.hash("checksum"), F.lit(copies)).alias("copy"),
        F.explode(F.sequence(F.lit(0), F.lit(lists - 1))).alias("bucket"))
    work = work.join(small(offered), ["bucket", "copy"]).join(held, ["checksum", "bucket"], "left")
    missing = F.array_except("offered", F.coalesce("held", F.array().cast("array<bigint>")))
    left = work.select("checksum", F.explode(missing).alias("i"))
    return left.join(small(names), "i").select(
        "analysis", "software_version", F.explode("versions").alias("version"), "checksum").select(
        "analysis", "software_version", "version.database_version", "checksum")


def remaining_sequences(remaining: DataFrame, sequences: DataFrame) -> DataFrame:
    """Back from checksums to every original id that has them."""
    return remaining.join(sequences.select("checksum", "id", "seq"), "checksum")


def select_by_key(results: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """All distinct results whose ``checksum`` or ``md5sum`` is in a set."""
    return results.join(keys.select(key).distinct(), key, "left_semi").select(*RESULT_COLUMNS).distinct()


def _with_empty_database(results: DataFrame) -> DataFrame:
    a = F.col("analysis")
    return results.select(*[
        F.when(needs_database(a), F.col(c)).alias(c) if c in ("database", "database_version")
        else F.col(c) for c in RESULT_COLUMNS])


def select_all(results: DataFrame, checksums: DataFrame | None = None) -> DataFrame:
    """Everything in the store, each row once, database columns empty where unused."""
    rows = results
    if checksums is not None:
        rows = rows.join(checksums.select("checksum").distinct(), "checksum", "left_semi")
    return _with_empty_database(rows).distinct()


def distinct_results(results: DataFrame) -> DataFrame:
    """Distinct results without the MD5: what ranking and decoding see."""
    return _with_empty_database(results).drop("md5sum").distinct()


def rank_view(results: DataFrame, decoder: DataFrame) -> DataFrame:
    """Distinct results by name; the MD5 is not carried."""
    names = decoder.select("checksum", "name").distinct()
    return distinct_results(results).join(names, "checksum")


def fetch_targets(results: DataFrame) -> DataFrame:
    return results.select(
        "analysis", "software_version",
        F.when(needs_database(F.col("analysis")), F.col("database_version")).alias("database_version"),
    ).distinct()


def version_conflicts(results: DataFrame) -> DataFrame:
    """Analyses present in more than one version."""
    return fetch_targets(results).groupBy("analysis").agg(
        F.count(F.lit(1)).alias("n_versions")).filter("n_versions > 1")


def decode(results: DataFrame, decoder: DataFrame) -> DataFrame:
    """Results under their original names and files; rows without a file are skipped."""
    names = decoder.filter(F.coalesce("filename", F.lit("")) != "").select(
        "checksum", F.col("md5sum").alias("__md5"), "name", "filename").distinct()
    return (
        distinct_results(results).join(names, "checksum")
        .withColumnRenamed("__md5", "md5sum")
        .select(*RESULT_COLUMNS, "name", "filename")
    )


def empty_result_check(sequences: DataFrame, records: DataFrame) -> DataFrame:
    """One row: counts of both sides and whether sequences went in but nothing came out."""
    n_sequences = sequences.agg(F.count(F.lit(1)).alias("n_sequences"))
    return n_sequences.withColumn(
        "n_records", records.agg(F.count(F.lit(1)).alias("n")).scalar()
    ).withColumn("failed", (F.col("n_records") == 0) & (F.col("n_sequences") > 0))


def analysis_tables(results: DataFrame, kinds: list[str], decoder: DataFrame | None = None) -> dict[str, DataFrame]:
    """Typed tables of several kinds; a kind that is present in more than one version fails the job that reads it."""
    versions = version_conflicts(results).select(F.col("analysis").alias("__many"))
    failed = F.raise_error(F.concat(F.lit("several versions of "), F.col("analysis"))).cast("string")

    def checked(kind: str) -> DataFrame:
        # at most one row per kind of result is broadcast
        rows = results.filter(F.col("analysis") == kind).join(F.broadcast(versions), F.col("analysis") == F.col("__many"), "left")
        return rows.withColumn("data", F.when(F.col("__many").isNotNull(), failed).otherwise(F.col("data"))).select(*results.columns)

    return {kind: analysis_table(checked(kind), kind, decoder) for kind in kinds}


def analysis_table(results: DataFrame, name: str, decoder: DataFrame | None = None) -> DataFrame:
    """Typed columns of one result kind; with a decoder, under the original names."""
    kind = ANALYSES[name]
    rows = results.filter(F.col("analysis") == name)
    typed = F.from_json("data", kind.schema)
    if decoder is None:
        return rows.select(typed.alias("d")).select("d.*")
    rows = rows.join(decoder.select("checksum", F.col("name").alias("__name")), "checksum")
    out = [F.col("__name").alias(kind.name_column)]
    out += [F.col("d")[f].alias(f) for f in kind.schema.names if f != kind.name_column]
    return rows.withColumn("d", typed).select(*out)


def melt(df: DataFrame, name: str, columns: list[str], analysis: str) -> DataFrame:
    """Wide payload to ``name, analysis, parameter, value`` (values as text)."""
    wide = df.select(F.col(name).alias("name"), *[F.col(c).cast("string").alias(c) for c in columns])
    long = wide.unpivot(["name"], columns, "parameter", "value")
    return long.select("name", F.lit(analysis).alias("analysis"), "parameter", "value")
