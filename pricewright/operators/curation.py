"""From raw product records to curated items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.functions.products import details_map, pounds, scrub, without_codes_in_line


def curate(raw: DataFrame, drop_codes=without_codes_in_line) -> DataFrame:
    """Keep priced products with enough text; the cheap price test runs before the text work."""
    priced = raw.withColumn("price", F.expr("try_cast(price as double)")).filter(
        F.col("price").between(fixed.MIN_PRICE, fixed.MAX_PRICE))
    parsed = priced.withColumn("_details", details_map(F.col("details")))
    full = scrub(F.col("title"), F.col("description"), F.col("features"), F.col("_details"), drop_codes)
    # exploding one element keeps the length filter above the text work, which
    # would otherwise run once for the filter and once more for the result
    return parsed.select(
        "doc_id", "title", "category", "price",
        pounds(F.col("_details")["Item Weight"]).alias("weight"),
        F.explode(F.array(full)).alias("full"),
    ).filter(F.length("full") >= fixed.MIN_TEXT_CHARS)
