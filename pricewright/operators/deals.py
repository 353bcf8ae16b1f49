"""Deal feeds: what is new, what it is worth, what is worth telling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.operators.ordering import first_per_group


def feed_entries(entries: DataFrame, keys: list[str], limit: int = fixed.FEED_ENTRIES) -> DataFrame:
    """The first entries of each feed; those without an address are skipped."""
    return first_per_group(entries.filter("url is not null"), keys, ["ts", "event_id"], limit)


def new_deals(entries: DataFrame, memory: DataFrame) -> DataFrame:
    """Entries whose address is not remembered."""
    return entries.join(memory.select("url").distinct(), "url", "left_anti")


def positive_deals(deals: DataFrame) -> DataFrame:
    return deals.filter("price > 0")


def opportunities(deals: DataFrame, estimates: DataFrame, key: str,
                  limit: int = fixed.PRICED_PER_SCAN) -> DataFrame:
    """The first deals of each scan with their estimate and discount."""
    chosen = first_per_group(positive_deals(deals), ["scan"], ["ts", "event_id"], limit)
    return chosen.join(estimates, key).withColumn("discount", F.col("estimate") - F.col("price"))


def best_opportunity(rows: DataFrame) -> DataFrame:
    """The highest discount per scan; the earliest place wins a tie."""
    best = F.max_by(F.struct(*rows.columns), F.struct(F.col("discount"), -F.col("place")))
    return rows.groupBy("scan").agg(best.alias("_best")).select("_best.*")


def alerts(rows: DataFrame, threshold: float = fixed.ALERT_DISCOUNT) -> DataFrame:
    """The best opportunity per scan when its discount is above the threshold."""
    return best_opportunity(rows).filter(F.col("discount") > threshold)


def memory_stats(memory: DataFrame, index: DataFrame) -> DataFrame:
    """Opportunities kept, best discount (0 when none), positive discounts added up, index size."""
    gain = F.when(F.col("discount") > 0, F.col("discount")).otherwise(0.0)
    return memory.agg(
        F.count(F.lit(1)).alias("n_opportunities"),
        F.coalesce(F.max("discount"), F.lit(0.0)).alias("best_discount"),
        F.coalesce(F.sum(gain), F.lit(0.0)).alias("total_savings"),
    ).withColumn("n_indexed", index.agg(F.count(F.lit(1))).scalar())


def trimmed_memory(memory: DataFrame, order: list[str], keep: int = 2) -> DataFrame:
    return memory.orderBy(*order).limit(keep)


def neighbour_price(found: DataFrame, prices: DataFrame, queries: DataFrame) -> DataFrame:
    """Mean price of each question's nearest products, 0 when there are none."""
    means = found.join(prices, "chunk_id").groupBy("question_id").agg(F.avg("price").alias("price"))
    return queries.select("question_id").join(means, "question_id", "left").select(
        "question_id", F.coalesce("price", F.lit(0.0)).alias("price"))


def ensemble_price(neighbour, model):
    """The two estimates weighted."""
    first, second = fixed.ENSEMBLE_WEIGHTS
    return neighbour * first + model * second
