"""Follow a folder of JSON-line results into the store.

Every micro-batch goes through the same load as a batch job: typed payloads, first
row per key, and an anti-join with what the store holds.  A batch that was loaded to its end is in the store's batch
log and is skipped when it comes again; one that broke off finds the rows it has stored and adds the
rest.  Lines that cannot be used go to ``quarantine`` beside the results, each text once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import store
from ..sources.results import bad_lines, parse_results


def load_batch(batch: DataFrame, store_path: str, run: str | None = None, number: int | None = None, **options) -> bool:
    """Append the new rows, names and bad lines of one batch of lines; False if the log has it already."""
    spark = batch.sparkSession
    if run is not None and store.batch_is_done(spark, store_path, run, number):
        return False
    rows = parse_results(batch.withColumn("ordinal", F.monotonically_increasing_id())).filter(
        "problem IS NULL").drop("problem")
    held = store.read_store(spark, store_path) if store.exists(spark, f"{store_path}/results") else None
    fresh = store.load_results(rows, ["ordinal"], store=held, **options)
    store.append_store(fresh, store_path)
    store.append_decoder(store.prepare(rows, **options), store_path)
    store.append_new(bad_lines(batch).select("line", "problem"), f"{store_path}/quarantine")
    if run is not None:
        store.log_batch(spark, store_path, run, number)
    return True


def follow(spark: SparkSession, source: str, store_path: str, checkpoint: str,
           available_now: bool = True, **options) -> StreamingQuery:
    """Start the stream; with ``available_now`` it ends when all files are loaded.

    ``checkpoint`` is a lasting shared folder: a restart with it reads only new files.
    """
    lines = spark.readStream.text(source)
    writer = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, number: load_batch(batch, store_path, checkpoint, number, **options))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
