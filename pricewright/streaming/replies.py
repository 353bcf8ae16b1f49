"""Following request batches: replies are picked up as their files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright.sources.readers import REPLY_SCHEMA
from pricewright.streaming.deals import put_batch, run_available, start_batch_table

_SEEN = "custom_id string"


def collect_replies(spark: SparkSession, folder: str, seen: str, checkpoint: str) -> None:
    """Note the ids that were answered, once per micro-batch."""
    start_batch_table(spark, seen, _SEEN)
    stream = spark.readStream.schema(REPLY_SCHEMA).json(folder)

    def each(batch: DataFrame, batch_id: int) -> None:
        put_batch(batch.select("custom_id").filter("custom_id is not null").distinct(), seen, batch_id)

    run_available(stream, each, checkpoint)


def batch_progress(requests: DataFrame, seen: DataFrame) -> DataFrame:
    """Requests and answers per batch, and whether it is done.

    ``requests``: batch, custom_id. An id answered twice counts once.
    """
    answered = seen.select("custom_id").distinct().withColumn("_answered", F.lit(1))
    counts = requests.join(answered, "custom_id", "left").groupBy("batch").agg(
        F.count(F.lit(1)).alias("n_requests"), F.count("_answered").alias("n_answered"))
    return counts.withColumn(
        "status", F.when(F.col("n_answered") == F.col("n_requests"), "done").otherwise("submitted"))
