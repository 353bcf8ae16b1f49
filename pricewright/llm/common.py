"""What several operators share: narrow views of their input, task helpers, edges of sorted parts."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BATCH_ROWS = 1000


def whole(text: str) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows, as whole texts can be long; a smaller setting is kept."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text``, so that other columns, whatever their names, cannot clash."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.col(key).cast("long").alias("doc_id"), whole(text).alias("text"))


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, all else unchanged."""
    return F.translate(text, UPPER, LOWER)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_store(operator: str) -> dict:
    """A dictionary for an operator's costly read-only things, that the Python worker keeps from task to task.

    Functions are sent to tasks by value, so their module's globals start anew in each task.
    A worker serves many operators, so what others have left in it goes.
    """
    module = sys.modules.setdefault("_pricewright_worker", types.ModuleType("_pricewright_worker"))
    stores = module.__dict__.setdefault("stores", {})
    for other in [name for name in stores if name != operator]:
        del stores[other]
    return stores.setdefault(operator, {})


BROADCAST_KEYS = 100_000
LARGE_KEYS = 1000


def checked(keys: DataFrame) -> DataFrame:
    """Keys of a written table, broadcast if there are at most ``BROADCAST_KEYS``, else left to a shuffle."""
    return F.broadcast(keys) if keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else keys


def without_keys(docs: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The rows whose key is not in the one column of ``gone``, a written table."""
    named = gone.toDF("_gone")
    return docs.join(checked(named), docs[f"`{key}`"].cast("long") == named["_gone"], "left_anti")


def salts_of_large_keys(sizes: DataFrame, key: str, size: str) -> DataFrame:
    """``key, salts`` for keys with more than a thousandth of all rows.

    There are fewer than a thousand of them, whatever the data. A key gets salts in
    proportion to its share, so that its part of a shuffle is no larger than others.
    """
    total = sizes.agg(F.sum(size)).first()[0] or 0
    parts = shuffle_parts(sizes.sparkSession)
    share = F.col(size) * (2 * parts) / F.lit(max(1, total))
    return sizes.filter(F.col(size) * LARGE_KEYS > total).select(key, F.ceil(share).cast("int").alias("salts"))


def salted_left_join(many: DataFrame, few: DataFrame, key: str, salts: DataFrame, dealt_by: str) -> DataFrame:
    """Left join on ``key``; large keys are dealt out by ``dealt_by`` and their few rows repeated as often."""
    one = F.coalesce("salts", F.lit(1))
    left = many.join(F.broadcast(salts), key, "left").withColumn(
        "salt", F.pmod(F.xxhash64(dealt_by), one).cast("int")).drop("salts")
    right = few.join(F.broadcast(salts), key, "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), one - 1))).drop("salts")
    return left.join(right, [key, "salt"], "left").drop("salt")
