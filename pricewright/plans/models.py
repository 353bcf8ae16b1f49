"""Features, vectors and price models."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.functions.products import without_code_tokens
from pricewright.operators.boosting import fit_boosted
from pricewright.operators.curation import curate
from pricewright.operators.layout import neighbour_graph, neighbour_layout
from pricewright.operators.models import (
    bag_of_words,
    embed,
    forest_pricer,
    hashed_embedder,
    hashed_words,
    linear_pricer,
    log_target,
    normalised,
    numeric_features,
    priced,
    projected,
    restored,
    word_counts,
)
from pricewright.operators.network import fit_network
from pricewright.operators.splits import exact_split
from pricewright.plans.inputs import raw_products, table
from pricewright.plans.products import _FULL
from pricewright.plans.registry import query
from pricewright.session import dealt, scratch_path, spread, staged

_STOPS = ", ".join(f"'{word}'" for word in fixed.STOP_WORDS)


@query("bag_of_words", f"""
  WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS word FROM documents)
  SELECT word, count(*) AS n FROM w WHERE word NOT IN ({_STOPS}) GROUP BY 1 ORDER BY n DESC, word LIMIT 2000""")
def common_words(spark, folder):
    return word_counts(spread(table(spark, folder, "documents").select("text")), "text")


@query("bag_of_words_vectors")
def word_vectors(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    counted = bag_of_words(documents, "text").transform(documents)
    return counted.select(
        "doc_id", F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, b: a + b).alias("n_words"))


@query("hashed_features")
def hashed_features(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    hashed = hashed_words("text").transform(documents)
    return hashed.select(
        "doc_id", F.aggregate(vector_to_array("features"), F.lit(0.0), lambda a, b: a + b).alias("n_set"))


@query("embed_chunks", f"""
  WITH w AS (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'),
      lambda t: t NOT IN ({_STOPS})) AS words FROM documents)
  SELECT doc_id, 64 AS dimension, CASE WHEN len(words) > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS norm FROM w""")
def embed_chunks(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", "text")
    vectors = embed(documents, hashed_embedder(documents, "text"))
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    return vectors.select(
        "doc_id", F.size("vector").alias("dimension"), F.round(F.sqrt(squares), 4).alias("norm"))


@query("project_2d_3d")
def project_2d_3d(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "label", F.col("embedding").alias("vector"))
    flat, deep = projected(vectors, 2), projected(vectors, 3)
    return flat.select(
        "vec_id", "label", F.lit(2).alias("dimensions"), "point"
    ).unionByName(deep.select("vec_id", "label", F.lit(3).alias("dimensions"), "point"))


@query("neighbour_layout")
def neighbours_in_2d_3d(spark, folder):
    vectors = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    graph = staged(neighbour_graph(vectors.filter("vector is not null")), "graph")
    laid = [neighbour_layout(vectors, n, graph).withColumn("dimensions", F.lit(n)) for n in (2, 3)]
    return laid[0].unionByName(laid[1]).join(vectors.drop("vector"), "id").select(
        F.col("id").alias("vec_id"), "label", "dimensions", "point")


_TARGET = "(SELECT avg(ln(1 + l_extendedprice)) AS mean, stddev_samp(ln(1 + l_extendedprice)) AS dev FROM lineitem)"


@query("log_target_stats", f"""
  SELECT l_orderkey, l_linenumber, round(mean, 6) AS mean, round(dev, 6) AS deviation,
    round((ln(1 + l_extendedprice) - mean) / dev, 6) AS target, round(l_extendedprice, 2) AS restored FROM lineitem, {_TARGET}""")
def log_target_stats(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"))
    mean, deviation = log_target(lines)
    target = normalised(F.col("price"), mean, deviation)
    return lines.select(
        "l_orderkey", "l_linenumber", F.lit(round(mean, 6)).alias("mean"),
        F.lit(round(deviation, 6)).alias("deviation"), F.round(target, 6).alias("target"),
        F.round(restored(target, mean, deviation), 2).alias("restored"))


@query("linear_pricer", """
  WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS base FROM lineitem)
  SELECT l_orderkey, l_linenumber, round(greatest(0, base + slope * l_quantity - 20000), 2) AS guess FROM lineitem, m""")
def linear_model(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", (F.col("l_extendedprice") - 20000).alias("price"))
    model = Pipeline(stages=[numeric_features(["l_quantity"]), linear_pricer()]).fit(rows)
    return priced(model, rows).select("l_orderkey", "l_linenumber", F.round("guess", 2).alias("guess"))


def priced_texts(spark, folder):
    """Curated items with their split."""
    items = curate(raw_products(spark, folder), without_code_tokens)
    # fitting reads its rows many times; the text work runs once
    rows = staged(items.select("doc_id", F.col("full").alias("text"), "price"), "items")
    return exact_split(rows, "doc_id")


@query("linear_text_pricer")
def linear_text_model(spark, folder):
    rows = priced_texts(spark, folder)
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    words = bag_of_words(train, "text")
    model = linear_pricer().fit(words.transform(train))
    return priced(PipelineModel([*words.stages, model]), test).select("doc_id", "price", "guess")


@query("network_pricer")
def log_price_model(spark, folder):
    rows = priced_texts(spark, folder)
    model = fit_network(rows.filter("split = 'train'"))
    return rows.filter("split = 'test'").select("doc_id", "price", model.guess(F.col("text")).alias("guess"))


def order_features(spark, folder):
    """Orders with the totals of their lines, and their split."""
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).cast("double").alias("n_lines"), F.sum("l_quantity").alias("quantity"),
        F.sum("l_extendedprice").alias("value"), F.avg("l_discount").alias("discount"))
    orders = table(spark, folder, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    return staged(exact_split(orders, "o_orderkey").join(lines, "o_orderkey"), "features")


_FEATURES = ["n_lines", "quantity", "value", "discount"]


def _fitted(rows, model):
    return Pipeline(stages=[numeric_features(_FEATURES), model]).fit(rows.filter("split = 'train'"))


@query("forest_pricer")
def forest_model(spark, folder):
    rows = order_features(spark, folder)
    # a task keeps a row with a count for each tree, some hundred bytes more than it reads
    return priced(_fitted(dealt(rows, "o_orderkey"), forest_pricer()), rows.filter("split = 'test'")).select(
        "o_orderkey", "price", "guess")


@query("boosted_pricer")
def boosted_model(spark, folder):
    rows = order_features(spark, folder)
    model = fit_boosted(rows.filter("split = 'train'"), _FEATURES)
    return model.priced(rows.filter("split = 'test'")).select(
        "o_orderkey", "price", F.greatest("guess", F.lit(0.0)).alias("guess"))


@query("sink_model")
def sink_model(spark, folder):
    rows = order_features(spark, folder)
    path = scratch_path(spark, "model")
    _fitted(rows, linear_pricer()).write().overwrite().save(path)
    return priced(PipelineModel.load(path), rows.filter("split = 'test'")).select("o_orderkey", "price", "guess")


_PAIRS = _FULL + """,
pairs AS (SELECT doc_id, try_cast(price AS DOUBLE) AS price, length(full_text) AS n_chars,
   CASE split_part(item_weight, ' ', 2) WHEN 'pounds' THEN p_size / 1 WHEN 'ounces' THEN p_size / 16
   WHEN 'grams' THEN p_size / 453.592::DOUBLE WHEN 'kilograms' THEN p_size / 0.453592::DOUBLE ELSE 0 END AS weight
  FROM scrubbed WHERE try_cast(price AS DOUBLE) BETWEEN 0.5 AND 999.49 AND length(full_text) >= 600)"""


def _pairs(spark, folder):
    items = curate(raw_products(spark, folder), without_code_tokens)
    return items.select("doc_id", "price", F.length("full").cast("long").alias("n_chars"), "weight")


@query("price_vs_feature", f"WITH {_PAIRS} SELECT doc_id, price, n_chars, round(weight, 6) AS weight FROM pairs")
def price_vs_feature(spark, folder):
    return _pairs(spark, folder).withColumn("weight", F.round("weight", 6))


@query("price_feature_correlation", f"""
  WITH {_PAIRS} SELECT count(*) AS n, round(corr(n_chars, price), 6) AS with_length, round(corr(weight, price), 6) AS with_weight FROM pairs""")
def price_feature_correlation(spark, folder):
    return _pairs(spark, folder).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.corr("n_chars", "price"), 6).alias("with_length"),
        F.round(F.corr("weight", "price"), 6).alias("with_weight"))
