"""Raw products curated, cleaned and described."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright.functions.products import (
    details_map,
    pounds,
    description_of,
    scrub,
    shortened,
    simplify,
    without_code_tokens,
)
from pricewright.functions.prices import money
from pricewright.operators.curation import curate
from pricewright.plans.inputs import RAW_PRODUCTS, raw_products, table, with_part
from pricewright.plans.registry import query
from pricewright.sources.readers import products

_SIMPLE = """trim(replace(replace(replace(replace({0}, chr(10), ' '), chr(13), ''), chr(9), ''), '  ', ' '))[1:3000]"""
_POUNDS = """CASE split_part(item_weight, ' ', 2) WHEN 'pounds' THEN p_size / 1 WHEN 'ounces' THEN p_size / 16
  WHEN 'grams' THEN p_size / 453.592::DOUBLE WHEN 'kilograms' THEN p_size / 0.453592::DOUBLE ELSE 0 END"""
_FULL = RAW_PRODUCTS + """,
whole AS (SELECT *, title || chr(10) || """ + _SIMPLE.format("text") + """ || chr(10) ||
    p_brand || ' CODE' || p_partkey || 'X size ' || p_size || chr(10) ||
    '{"Brand": "' || p_brand || '", "Item Weight": "' || item_weight || '"}' || chr(10) AS joined FROM raw),
scrubbed AS (SELECT *, trim(array_to_string(list_transform(string_split(joined, ' '), lambda t:
    CASE WHEN regexp_full_match(t, '[A-Z0-9]{7,}') AND regexp_matches(t, '[A-Z]') AND regexp_matches(t, '[0-9]')
         THEN '' ELSE t END), ' '), ' ' || chr(10))[1:4000] AS full_text FROM whole)"""


@query("curate_products", f"""
  WITH {_FULL}
  SELECT doc_id, title, category, try_cast(price AS DOUBLE) AS price,
         round({_POUNDS}, 6) AS weight, full_text AS "full" FROM scrubbed
  WHERE try_cast(price AS DOUBLE) BETWEEN 0.5 AND 999.49 AND length(full_text) >= 600""")
def curate_products(spark, folder):
    return curate(raw_products(spark, folder), without_code_tokens).withColumn(
        "weight", F.round("weight", 6))


@query("curated_by_category", f"""
  WITH {_FULL},
  kept AS (SELECT * FROM scrubbed
    WHERE try_cast(price AS DOUBLE) BETWEEN 0.5 AND 999.49 AND length(full_text) >= 600)
  SELECT category, count(*) AS n, round(avg(price::DOUBLE), 4) AS mean_price, min(price::DOUBLE) AS min_price,
         max(price::DOUBLE) AS max_price, round(avg(length(full_text)), 4) AS mean_chars FROM kept GROUP BY 1""")
def curated_by_category(spark, folder):
    items = curate(raw_products(spark, folder), without_code_tokens)
    return items.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("price"), 4).alias("mean_price"),
        F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        F.round(F.avg(F.length("full")), 4).alias("mean_chars"))


@query("scan_products", """
  SELECT p_type AS category, count(*) AS n, round(sum(p_retailprice), 2) AS total FROM part
  GROUP BY 1""")
def scan_products(spark, folder):
    parts = table(spark, folder, "part")
    # one table holds all categories: each row brings its own tag
    tagged = parts.select("p_partkey", "p_retailprice", F.col("p_type").alias("category"))
    return tagged.groupBy("category").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("p_retailprice"), 2).alias("total"))


@query("simplify_text", f"SELECT doc_id, {_SIMPLE.format('text')} AS line FROM documents")
def simplify_text(spark, folder):
    return table(spark, folder, "documents").select("doc_id", simplify(F.array("text")).alias("line"))


@query("scrub_text", f"WITH {_FULL} SELECT doc_id, full_text AS cleaned FROM scrubbed")
def scrub_text(spark, folder):
    return raw_products(spark, folder).select(
        "doc_id",
        scrub(F.col("title"), F.col("description"), F.col("features"), details_map(F.col("details")),
              without_code_tokens).alias("cleaned"))


@query("scrub_text_by_line")
def scrub_text_by_line(spark, folder):
    return raw_products(spark, folder).select(
        "doc_id",
        scrub(F.col("title"), F.col("description"), F.col("features"), details_map(F.col("details")))
        .alias("cleaned"))


@query("item_weight", f"""
  WITH {RAW_PRODUCTS} SELECT doc_id, item_weight, round({_POUNDS}, 6) AS weight FROM raw""")
def item_weight(spark, folder):
    weight = details_map(F.col("details"))["Item Weight"]
    return raw_products(spark, folder).select(
        "doc_id", weight.alias("item_weight"), F.round(pounds(weight), 6).alias("weight"))


def _described(spark, folder):
    size = F.col("p_size")
    full = F.when(size % 3 == 0, F.concat(F.lit("Full text of "), "p_name")).otherwise("  ")
    summary = F.when(size % 3 == 1, F.concat(F.lit("Summary of "), "p_name"))
    return table(spark, folder, "part").select(
        "p_partkey",
        F.when(size % 7 != 0, F.col("p_name")).alias("title"), summary.alias("summary"), full.alias("full"),
        F.when(size % 5 != 0, F.concat(F.lit(" "), "p_type")).alias("category"),
        F.when(size % 4 != 0, F.col("p_retailprice")).alias("price"))


_DESCRIBED = """source AS (
  SELECT p_partkey, CASE WHEN p_size % 7 <> 0 THEN p_name ELSE '' END AS title, p_type, p_size, p_retailprice,
    CASE WHEN p_size % 3 = 0 THEN 'Full text of ' || p_name WHEN p_size % 3 = 1 THEN 'Summary of ' || p_name
         WHEN p_size % 7 <> 0 THEN p_name ELSE '' END AS base FROM part),
described AS (SELECT p_partkey, CASE WHEN p_size % 5 <> 0 AND base <> '' THEN title || '. ' || base || ' Category: ' || p_type || '.'
    WHEN title <> '' AND title <> base THEN title || '. ' || base
    WHEN base <> '' THEN base ELSE 'Unknown product' END AS description,
    CASE WHEN p_size % 4 <> 0 THEN p_retailprice ELSE 0 END AS price,
    CASE WHEN p_size % 5 <> 0 THEN p_type ELSE 'Unknown' END AS category FROM source)"""


@query("product_description", f"WITH {_DESCRIBED} SELECT p_partkey, description FROM described")
def product_description(spark, folder):
    return _described(spark, folder).select(
        "p_partkey",
        description_of(F.col("title"), F.col("summary"), F.col("full"), F.col("category")).alias("description"))


@query("drop_unpriced", f"WITH {_DESCRIBED} SELECT * FROM described WHERE description <> '' AND price > 0")
def drop_unpriced(spark, folder):
    return _described(spark, folder).select(
        "p_partkey",
        description_of(F.col("title"), F.col("summary"), F.col("full"), F.col("category")).alias("description"),
        F.coalesce("price", F.lit(0.0)).alias("price"),
        F.trim(F.coalesce(F.nullif("category", F.lit("")), F.lit("Unknown"))).alias("category"),
    ).filter((F.col("description") != "") & (F.col("price") > 0))


@query("table_view", """
  WITH d AS (SELECT doc_id, text, p_retailprice AS price, p_retailprice * 1.5 AS estimate
             FROM documents JOIN part ON doc_id % (SELECT count(*) FROM part) = p_partkey)
  SELECT doc_id, CASE WHEN length(text) > 100 THEN text[1:100] || '...' ELSE text END AS description,
         '$' || printf('%.2f', price) AS price, '$' || printf('%.2f', estimate) AS estimate FROM d""")
def table_view(spark, folder):
    rows = with_part(spark, folder, table(spark, folder, "documents"))
    return rows.select(
        "doc_id", shortened(F.col("text"), 100).alias("description"),
        money(F.col("p_retailprice")).alias("price"), money(F.col("p_retailprice") * 1.5).alias("estimate"))
