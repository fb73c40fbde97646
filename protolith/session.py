"""Session helpers: settings that the jobs rely on, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # what a Python worker holds at a time is bounded by bytes, not by rows that may be long
    "spark.sql.execution.arrow.maxBytesPerBatch": "8MB",
    # the wide summary carries ~80 columns through several codegen stages
    "spark.sql.codegen.maxFields": "200",
    # the JVM never compiles methods of more bytecode; such stages run operator by operator
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

CHECKPOINT_KEY = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session somebody else made."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", app: str = "protolith", **conf: str) -> SparkSession:
    """A session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        # recording the Python call site of every column call is slow for large plans
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local-mode session
    may fall back to a folder on this machine.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder shared by all executors")
    folder = os.path.join(tempfile.gettempdir(), "protolith")
    os.makedirs(folder, exist_ok=True)
    return folder


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(jvm_path)
    fs.deleteOnExit(jvm_path)
    return path


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared folder, so lost executors cost no recompute."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager)


def stored(df, label: str):
    """Write a frame below the shared folder and read it back: cuts lineage, and columns are read by need."""
    path = scratch(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def spread(df, tasks_per_core: int = 4):
    """Rows dealt evenly to all cores: a small file is one split, however much work each of its rows makes."""
    return df.repartition(tasks_per_core * df.sparkSession.sparkContext.defaultParallelism)
