"""Deal records as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.functions.products import strip

def split_features(entries: DataFrame) -> DataFrame:
    """Page content on one line, divided at its first "Features"; all fields cut.

    An entry without page content is described by its summary.
    """
    line = F.replace(F.replace("content", F.lit("\nmore"), F.lit("")), F.lit("\n"), F.lit(" "))
    at = F.locate(fixed.FEATURES_MARK, F.col("_line"))
    details = F.when(at > 0, F.substring("_line", F.lit(1), at - 1)).otherwise(F.col("_line"))
    features = F.when(at > 0, F.substring("_line", at + len(fixed.FEATURES_MARK), F.length("_line"))).otherwise("")
    return entries.withColumn("_line", line).select(
        *[c for c in entries.columns if c not in ("title", "content", "summary")],
        F.substring("title", 1, 100).alias("title"),
        F.substring(F.when(F.col("content").isNull(), F.col("summary")).otherwise(details), 1, 500)
        .alias("details"),
        F.substring(features, 1, 500).alias("features"),
    )


def describe_deal() -> Column:
    """Title, details, features and address of a deal, one per line."""
    return F.format_string(
        fixed.DEAL_TEXT, "title", strip(F.col("details")), strip(F.col("features")), "url")


def alert_text(description: Column, price: Column, estimate: Column, discount: Column) -> Column:
    """Headline with the first 50 characters, then price, value and saving."""
    return F.format_string(
        fixed.ALERT_TEXT, discount, F.substring(description, 1, 50), price, estimate, discount)
