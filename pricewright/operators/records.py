"""Made-up records derived from given ones, the same on any cluster layout."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.operators.splits import hashed

_HASH_RANGE = float(16**13)


def varied_products(base: DataFrame, copies: int, spread: float = 0.1) -> DataFrame:
    """``copies`` records per product, each price moved by up to ``spread`` either way."""
    number = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    records = base.withColumn("_copy", number).withColumn(
        "record_id", F.col("product_id") * copies + F.col("_copy"))
    factor = (1 - spread) + 2 * spread * (hashed(F.col("record_id")) / _HASH_RANGE)
    return records.select("record_id", "title", "category", (F.col("price") * factor).alias("price"))


def batch_sizes(wanted: DataFrame, largest: int) -> DataFrame:
    """Split ``n`` records per ``kind`` into numbered batches of at most ``largest``."""
    full = F.sequence(F.lit(0), F.ceil(F.col("n") / largest) - 1)
    rows = wanted.filter("n > 0").select("kind", "n", F.explode(full).alias("_i"))
    return rows.select(
        "kind", (F.col("_i") + 1).cast("long").alias("batch"),
        F.least(F.lit(largest).cast("long"), F.col("n") - F.col("_i") * largest).alias("size"))
