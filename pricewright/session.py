"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TASK_ROWS = 200_000
_LOCAL_SCRATCH: dict[str, str] = {}


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g",
                  **settings: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pricewright")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    A temporary folder stands in only where the setting is missing *and* the
    session is local, as in tests.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = context.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="pricewright-")
    return _LOCAL_SCRATCH[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; nothing is ever written twice to it."""
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small input out to all cores before costly work on each row.

    An input that already has a split per core, as any large one has, is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def dealt(df: DataFrame, key: str, most: int = TASK_ROWS) -> DataFrame:
    """Deal rows out by a key so that a task has about ``most`` rows; an input with enough splits is left alone."""
    parts = -(-df.count() // most)
    return df if df.rdd.getNumPartitions() >= parts else df.repartition(parts, key)


def staged(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as a table in the shared folder (a folder per value of ``partition_by``) and read it back.

    Cuts lineage, so that two later passes see the same rows even after an
    executor is lost, and lets each pass read only the columns it needs.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, partitionBy=partition_by)
    return df.sparkSession.read.schema(df.schema).parquet(path)
