"""The business tables, derived from the given parquet tables, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.functions.terms import longest_words
from pricewright.session import spread


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_part(spark: SparkSession, folder: str, documents: DataFrame) -> DataFrame:
    """Documents with the part each belongs to: the parts are dealt out in turn."""
    parts = table(spark, folder, "part")
    return documents.join(parts, F.col("doc_id") % F.lit(parts.count()) == F.col("p_partkey"))


def booked_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The booking columns that need no join: ports, volume, price, channel, currency."""
    return table(spark, folder, "lineitem").select(
        F.concat(F.lit("S"), "l_suppkey").alias("pol"),
        F.concat(F.lit("P"), "l_partkey").alias("pod"),
        F.col("l_quantity").alias("teu"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_returnflag").alias("channel"),
        F.col("l_linestatus").alias("currency"),
    )


BOOKED_LINES = """booked AS (
  SELECT 'S' || l_suppkey AS pol, 'P' || l_partkey AS pod, l_quantity AS teu,
         l_extendedprice AS price, l_returnflag AS channel, l_linestatus AS currency
  FROM lineitem)"""


def bookings(spark: SparkSession, folder: str) -> DataFrame:
    """Freight bookings: line items with their order and commodity."""
    lines = spread(table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_returnflag",
        "l_extendedprice", "l_linestatus"))
    orders = table(spark, folder, "orders")
    parts = table(spark, folder, "part")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            "l_orderkey",
            "l_linenumber",
            F.concat(F.lit("S"), "l_suppkey").alias("pol"),
            F.concat(F.lit("P"), "l_partkey").alias("pod"),
            F.col("p_brand").alias("commodity_code"),
            F.concat_ws(" ", "p_type", "p_name").alias("commodity_desc"),
            F.col("l_quantity").alias("teu"),
            F.col("o_orderpriority").alias("booking_type"),
            F.year("o_orderdate").alias("year"),
            F.month("o_orderdate").alias("month"),
            F.col("l_returnflag").alias("channel"),
            F.col("l_extendedprice").alias("price"),
            F.col("l_linestatus").alias("currency"),
        )
    )


BOOKINGS = """bookings AS (
  SELECT l_orderkey, l_linenumber, 'S' || l_suppkey AS pol, 'P' || l_partkey AS pod,
         p_brand AS commodity_code, p_type || ' ' || p_name AS commodity_desc,
         l_quantity AS teu, o_orderpriority AS booking_type,
         year(o_orderdate) AS year, month(o_orderdate) AS month,
         l_returnflag AS channel, l_extendedprice AS price, l_linestatus AS currency
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    """Raw product records: a document text attached to a part, details as JSON."""
    documents = spread(table(spark, folder, "documents").select("doc_id", "text"))
    units = F.array(*[F.lit(u) for u in ("pounds", "ounces", "grams", "kilograms", "stone")])
    unit = F.element_at(units, F.pmod("doc_id", F.lit(5)).cast("int") + 1)
    details = F.create_map(
        F.lit("Part Number"), F.concat(F.lit("PN"), "p_partkey"),
        F.lit("Brand"), F.col("p_brand"),
        F.lit("Item Weight"), F.concat_ws(" ", F.col("p_size").cast("string"), unit),
    )
    return with_part(spark, folder, documents).select(
        "doc_id",
        F.col("p_type").alias("category"),
        F.when(F.col("p_size") == 13, "none").otherwise(
            F.col("p_retailprice").cast("string")).alias("price"),
        F.col("p_name").alias("title"),
        F.array("text").alias("description"),
        F.array("p_brand", F.concat(F.lit("CODE"), "p_partkey", F.lit("X")),
                F.concat(F.lit("size "), "p_size")).alias("features"),
        F.to_json(details).alias("details"),
    )


RAW_PRODUCTS = """raw AS (
  SELECT doc_id, p_type AS category,
         CASE WHEN p_size = 13 THEN 'none' ELSE CAST(p_retailprice AS VARCHAR) END AS price,
         p_name AS title, text, p_brand, p_partkey, p_size,
         CAST(p_size AS VARCHAR) || ' ' ||
           ['pounds','ounces','grams','kilograms','stone'][doc_id % 5 + 1] AS item_weight
  FROM documents JOIN part ON doc_id % (SELECT count(*) FROM part) = p_partkey)"""


def questions(spark: SparkSession, folder: str) -> DataFrame:
    """Evaluation questions: text, keywords (its longest words), category, decision."""
    item = F.col("item_id")
    return table(spark, folder, "benchmark").select(
        item.alias("question_id"),
        F.col("text").alias("question"),
        longest_words(F.col("text"), fixed.MAX_TERMS).alias("keywords"),
        F.when(item % 5 != 0, F.concat(F.lit("topic "), (item % 4).cast("string"))).alias("category"),
        F.when(item % 3 == 0, "approve").otherwise("deny").alias("final_decision"),
    )


QUESTIONS = """words AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS word FROM benchmark),
ranked_words AS (
  SELECT item_id, word, row_number() OVER (
    PARTITION BY item_id ORDER BY length(word) DESC, word) AS place FROM words),
keywords AS (SELECT item_id AS question_id, word AS keyword, place FROM ranked_words WHERE place <= 8),
questions AS (
  SELECT item_id AS question_id, text AS question,
         CASE WHEN item_id % 5 <> 0 THEN 'topic ' || (item_id % 4) END AS category,
         CASE WHEN item_id % 3 = 0 THEN 'approve' ELSE 'deny' END AS final_decision
  FROM benchmark)"""


def deals(spark: SparkSession, folder: str) -> DataFrame:
    """Deal feed entries: one scan per hour, event type as feed, value as price."""
    return table(spark, folder, "events").select(
        "event_id",
        "ts",
        F.col("event_type").alias("feed"),
        F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH").alias("scan"),
        F.concat(F.lit("deal/"), F.col("event_id").cast("string")).alias("url"),
        F.concat_ws(" ", F.lit("Offer of user"), F.col("user_id").cast("string"), F.lit("in"),
                    "event_type").alias("product_description"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )


DEALS = """deals AS (
  SELECT event_id, ts, event_type AS feed, strftime(ts, '%Y-%m-%d %H') AS scan,
         'deal/' || event_id AS url,
         'Offer of user ' || user_id || ' in ' || event_type AS product_description,
         value AS price, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events)"""


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Truth and guess per line: the guess is the part's mean price per unit times volume."""
    lines = table(spark, folder, "lineitem")
    rates = lines.groupBy("l_partkey").agg(
        F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("rate")
    )
    return lines.join(rates, "l_partkey").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        F.col("l_returnflag").alias("model"),
        F.col("l_extendedprice").alias("truth"),
        (F.col("l_quantity") * F.col("rate")).alias("guess"),
    )


PREDICTIONS = """rates AS (
  SELECT l_partkey, avg(l_extendedprice / l_quantity) AS rate FROM lineitem GROUP BY l_partkey),
predictions AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_returnflag AS model,
         l_extendedprice AS truth, l_quantity * rate AS guess
  FROM lineitem JOIN rates USING (l_partkey))"""
