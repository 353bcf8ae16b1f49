"""Connected components of links, without any of them on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.llm.common import salted_left_join, salts_of_large_keys
from pricewright.session import staged


def components(links: DataFrame) -> DataFrame:
    """``node, component``: the smallest node reachable, for nodes with a link; ``links`` has ``a, b``.

    Each round a node takes the least label among its neighbours' and its own, and
    then the label of its label, so that chains shorten by more than half. The links
    of a node with many, and the nodes of a frequent label, are dealt out to many
    tasks to meet their label; minima are combined before rows move.
    """
    both = staged(links.select("a", "b").union(links.select("b", "a")).toDF("node", "other").filter(
        "node <> other").distinct(), "links")
    degrees = staged(both.groupBy(F.col("node").alias("other")).agg(
        F.count(F.lit(1)).alias("n"), F.min("other").alias("least")), "degrees")
    hubs = salts_of_large_keys(degrees, "other", "n")
    labels = staged(degrees.select(F.col("other").alias("node"), F.least("other", "least").alias("component")), "labels")
    while True:
        near = salted_left_join(both, labels.toDF("other", "component"), "other", hubs, "node").groupBy("node").agg(
            F.min("component").alias("least"))
        hooked = staged(labels.join(near, "node").select(
            "node", F.col("component").alias("was"), F.least("component", "least").alias("next")), "hooked")
        sizes = hooked.groupBy("next").agg(F.count(F.lit(1)).alias("n"))
        salts = salts_of_large_keys(sizes, "next", "n")
        jump = hooked.select(F.col("node").alias("next"), F.col("next").alias("component"))
        moved = staged(salted_left_join(hooked, jump, "next", salts, "node").select(
            "node", "component", (F.col("component") != F.col("was")).alias("changed")), "labels")
        if moved.filter("changed").limit(1).count() == 0:
            return moved.select("node", "component")
        labels = moved.select("node", "component")
