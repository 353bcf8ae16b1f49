"""Documents changed, paired and put together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.functions.pages import absolute, page_links, page_text
from pricewright.operators.ordering import running_totals


def apply_patches(documents: DataFrame, updates: DataFrame) -> DataFrame:
    """Literal search/replace patches on documents, in patch order.

    A later patch sees what earlier ones changed. Returns every patched path
    with its new text and the numbers of the patches that found nothing; a path
    without a document has no text and only unmatched patches.
    """
    per_path = updates.select("patch", F.explode("paths").alias("path"), "search", "replacement")
    lists = per_path.groupBy("path").agg(
        F.array_sort(F.collect_list(F.struct("patch", "search", "replacement"))).alias("patches"))
    start = F.struct(
        F.col("text").alias("text"), F.array().cast("array<bigint>").alias("unmatched"))

    def one(state: Column, patch: Column) -> Column:
        hit = state["text"].contains(patch["search"])
        return F.struct(
            F.replace(state["text"], patch["search"], patch["replacement"]).alias("text"),
            F.when(hit, state["unmatched"])
            .otherwise(F.array_append(state["unmatched"], patch["patch"])).alias("unmatched"),
        )

    done = F.aggregate("patches", start, one)
    return lists.join(documents, "path", "left").select("path", done.alias("r")).select(
        "path", "r.text", "r.unmatched")


def pair_by_position(left: DataFrame, right: DataFrame, key: str, order: str) -> DataFrame:
    """n-th left text beside n-th right text per key; the shorter side is filled with ''."""

    def placed(df: DataFrame, name: str) -> DataFrame:
        rows = df.filter(F.trim("text") != "").select(key, order, F.trim("text").alias(name))
        # only keys are put in order; the texts join their place afterwards
        places = running_totals(rows.select(key, order), [key], [order], {})
        return places.join(rows, [key, order]).select(key, F.col("n").alias("place"), name)

    both = placed(left, "input").join(placed(right, "output"), [key, "place"], "full")
    return both.select(
        key, "place", F.coalesce("input", F.lit("")).alias("input"),
        F.coalesce("output", F.lit("")).alias("output"))


def joined_in_order(df: DataFrame, key: str, order: str, text: Column, separator: str,
                    stretch: int = 256) -> DataFrame:
    """All texts of a key in order as one text, put together stretch by stretch."""
    rows = df.select(key, F.col(order).alias("_at"), text.alias("_text")).withColumn(
        "_stretch", F.floor(F.col("_at") / stretch))

    def glue(order_column: str, text_column: str) -> Column:
        pairs = F.array_sort(F.collect_list(F.struct(order_column, text_column)))
        return F.array_join(F.transform(pairs, lambda p: p[text_column]), separator)

    partial = rows.groupBy(key, "_stretch").agg(glue("_at", "_text").alias("_part"))
    return partial.groupBy(key).agg(glue("_stretch", "_part").alias("joined"))


def site_bundles(pages: DataFrame) -> DataFrame:
    """Landing page text followed by the text of each linked page that is known, cut to its limit."""
    texts = pages.select("url", page_text(F.col("html")).alias("text"))
    links = pages.select(
        "page_id", "url", F.posexplode(page_links(F.col("html"))).alias("place", "link")
    ).select("page_id", "place", "link", absolute(F.col("url"), F.col("link")).alias("target"))
    linked = links.join(texts.withColumnRenamed("url", "target"), "target").select(
        "page_id", "place",
        F.concat(F.format_string(fixed.BUNDLE_LINK, "link"), "text").alias("part"))
    # every part has more characters than its heading, so later ones cannot reach the cut
    heading = len(fixed.BUNDLE_LINK % "")
    nth = F.row_number().over(Window.partitionBy("page_id").orderBy("place"))
    linked = linked.withColumn("nth", nth).filter(F.col("nth") <= fixed.BUNDLE_CHARS // heading)
    tail = linked.groupBy("page_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "part"))).alias("parts"))
    whole = F.concat(
        F.lit(fixed.BUNDLE_START), page_text(F.col("html")), F.lit(fixed.BUNDLE_LINKS),
        F.coalesce(F.array_join(F.transform("parts", lambda p: p["part"]), ""), F.lit("")))
    return pages.join(tail, "page_id", "left").select(
        "page_id", "url", F.substring(whole, 1, fixed.BUNDLE_CHARS).alias("bundle"))
