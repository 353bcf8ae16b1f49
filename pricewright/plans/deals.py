"""Deals scanned, priced, alerted and remembered, in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.functions.deals import alert_text
from pricewright.functions.products import shortened
from pricewright.operators.deals import (
    best_opportunity,
    ensemble_price,
    feed_entries,
    memory_stats,
    neighbour_price,
    new_deals,
    opportunities,
    positive_deals,
    trimmed_memory,
)
from pricewright.operators.documents import joined_in_order
from pricewright.operators.ordering import first_per_group
from pricewright.operators.retrieval import nearest, with_texts
from pricewright.plans.inputs import DEALS, deals, table, with_part
from pricewright.plans.registry import query
from pricewright.plans.retrieval import _CORPUS, asked_vectors, corpus
from pricewright.session import scratch_path
from pricewright.sources.readers import opportunity_memory
from pricewright.sources.writers import with_batches
from pricewright.streaming.deals import (
    alert_deals,
    deal_stream,
    deal_table,
    forward_new_deals,
    price_deals,
    priced_table,
)
from pricewright.streaming.replies import batch_progress, collect_replies


@query("scan_deal_feed", f"""
  WITH {DEALS}, r AS (SELECT *, row_number() OVER (PARTITION BY feed ORDER BY ts, event_id) AS place FROM deals)
  SELECT feed, url, price FROM r WHERE place <= 10""")
def scan_deal_feed(spark, folder):
    return feed_entries(deals(spark, folder), ["feed"]).select("feed", "url", "price")


@query("feed_top_n", f"""
  WITH {DEALS}, r AS (SELECT *, row_number() OVER (PARTITION BY scan ORDER BY ts, event_id) AS place FROM deals)
  SELECT scan, place, url FROM r WHERE place <= 10""")
def feed_top_n(spark, folder):
    return first_per_group(deals(spark, folder), ["scan"], ["ts", "event_id"], 10).select("scan", "place", "url")


def written_memory(spark, folder, feed: str | None = None) -> str:
    """Earlier opportunities as JSON lines, among lines that are not JSON."""
    path = scratch_path(spark, "memory")
    rows = deals(spark, folder)
    if feed is not None:
        rows = rows.filter(F.col("feed") == feed)
    deal = F.struct("product_description", "price", "url")
    line = F.to_json(F.struct(
        deal.alias("deal"), (F.col("price") + F.col("k")).alias("estimate"),
        F.col("k").cast("double").alias("discount")))
    rows.select(F.explode(F.array(line, F.lit("{broken"))).alias("value")).write.text(path)
    return path


def remembered(spark, folder, feed: str | None = None):
    return opportunity_memory(spark, written_memory(spark, folder, feed)).select("deal.*", "estimate", "discount")


_MEMORY = f"""{DEALS}, memory AS (SELECT product_description, price, url, price + k AS estimate, k::DOUBLE AS discount
  FROM deals)"""
_BOUGHT = _MEMORY + ", bought AS (SELECT url FROM deals WHERE feed = 'purchase')"


@query("scan_memory", f"WITH {_MEMORY} SELECT url, product_description, price, round(estimate, 4) AS estimate, discount FROM memory")
def scan_memory(spark, folder):
    return remembered(spark, folder).withColumn("estimate", F.round("estimate", 4))


@query("new_deals", f"WITH {_BOUGHT} SELECT feed, url, price FROM deals WHERE url NOT IN (SELECT url FROM bought)")
def unseen_deals(spark, folder):
    return new_deals(deals(spark, folder), remembered(spark, folder, "purchase")).select("feed", "url", "price")


@query("positive_deals", f"WITH {DEALS} SELECT url, round(price - 20, 4) AS price FROM deals WHERE price - 20 > 0")
def deals_with_price(spark, folder):
    net = deals(spark, folder).withColumn("price", F.col("price") - 20)
    return positive_deals(net).select("url", F.round("price", 4).alias("price"))


@query("memory_stats", f"""
  WITH {_MEMORY}, m AS (SELECT discount - 50 AS discount FROM memory)
  SELECT count(*) AS n_opportunities, coalesce(max(discount), 0) AS best_discount,
   coalesce(sum(discount) FILTER (discount > 0), 0) AS total_savings, (SELECT count(*) FROM embeddings) AS n_indexed FROM m""")
def stats_of_memory(spark, folder):
    memory = remembered(spark, folder).withColumn("discount", F.col("discount") - 50)
    return memory_stats(memory, table(spark, folder, "embeddings"))


@query("trim_memory", f"WITH {_MEMORY} SELECT url, discount FROM memory ORDER BY url LIMIT 2")
def trim_memory(spark, folder):
    path = scratch_path(spark, "trimmed")
    trimmed_memory(remembered(spark, folder).select("url", "discount"), ["url"]).write.json(path)
    return spark.read.schema("url string, discount double").json(path)


def estimates(spark, folder):
    """What a deal with property k is worth: the mean price of the parts of that size class."""
    parts = table(spark, folder, "part")
    return parts.groupBy((F.col("p_partkey") % 100).alias("k")).agg(
        F.round(F.avg("p_retailprice") / 10, 6).alias("estimate"))


_PRICED = f"""{DEALS},
estimates AS (SELECT p_partkey % 100 AS k, round(avg(p_retailprice) / 10, 6) AS estimate FROM part GROUP BY 1),
chosen AS (SELECT *, row_number() OVER (PARTITION BY scan ORDER BY ts, event_id) AS place FROM deals WHERE price > 0),
priced AS (SELECT c.*, estimate, estimate - price AS discount FROM chosen c JOIN estimates USING (k) WHERE place <= 5),
best AS (SELECT *, row_number() OVER (PARTITION BY scan ORDER BY discount DESC, place) AS nth FROM priced)"""


@query("best_opportunity", f"""
  WITH {_PRICED} SELECT scan, url, price, estimate, round(discount, 4) AS discount FROM best WHERE nth = 1""")
def best_per_scan(spark, folder):
    rows = best_opportunity(opportunities(deals(spark, folder), estimates(spark, folder), "k"))
    return rows.select("scan", "url", "price", "estimate", F.round("discount", 4).alias("discount"))


@query("alert_text", f"""
  WITH {_PRICED}, a AS (SELECT url, '🔥 Great Deal! $' || printf('%.2f', discount) || ' off - ' || product_description[1:50] || '...' ||
    chr(10) || chr(10) || '💰 Price: $' || printf('%.2f', price) || chr(10) || '📊 Value: $' || printf('%.2f', estimate) ||
    chr(10) || '💵 Save: $' || printf('%.2f', discount) AS alert FROM best WHERE nth = 1 AND discount > 50)
  SELECT url, alert, CASE WHEN length(alert) > 200 THEN alert[1:200] || '...' ELSE alert END AS notice FROM a""")
def alert_texts(spark, folder):
    rows = best_opportunity(opportunities(deals(spark, folder), estimates(spark, folder), "k"))
    told = rows.filter(F.col("discount") > fixed.ALERT_DISCOUNT)
    alert = alert_text(F.col("product_description"), F.col("price"), F.col("estimate"), F.col("discount"))
    return told.select("url", alert.alias("alert"), shortened(alert, fixed.NOTICE_CHARS).alias("notice"))


_DISORDER = "40 days"  # files of a feed come in any order, and the feed spans a month


def scan_files(spark, folder) -> str:
    """What each scan fetches, the first entries of every feed, in files that split scans; the last has the end of the feed."""
    path = scratch_path(spark, "feed")
    fetched = feed_entries(deals(spark, folder), ["scan", "feed"]).drop("place")
    fetched.repartition(spark.sparkContext.defaultParallelism, "event_id").write.parquet(path)
    end = spark.read.parquet(path).agg((F.max("ts") + F.expr(f"INTERVAL {_DISORDER} 1 SECOND")).alias("ts"))
    end.selectExpr("ts", "cast(null as string) AS scan").coalesce(1).write.mode("append").parquet(path)
    return path


def _stream(spark, path):
    """The files of a folder in a few micro-batches."""
    return deal_stream(spark, path, max(1, spark.sparkContext.defaultParallelism // 4))


@query("stream_new_deals", """
  SELECT 'deal/' || event_type || '/' || CAST(json_extract_string(props, '$.k') AS BIGINT) AS url, event_type AS feed
  FROM events GROUP BY ALL""")
def stream_new_deals(spark, folder):
    memory, checkpoint = scratch_path(spark, "memory"), scratch_path(spark, "progress")
    url = F.concat_ws("/", F.lit("deal"), "feed", F.col("k").cast("string"))
    path = scratch_path(spark, "feed")
    deals(spark, folder).repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
    stream = _stream(spark, path).withColumn("url", url)
    forward_new_deals(stream, memory, checkpoint)
    return deal_table(spark, memory).select("url", "feed")


@query("stream_price_deals", f"""
  WITH {_PRICED} SELECT scan, place, url, price, estimate, round(discount, 4) AS discount FROM priced""")
def stream_price_deals(spark, folder):
    output, checkpoint = scratch_path(spark, "priced"), scratch_path(spark, "progress")
    price_deals(_stream(spark, scan_files(spark, folder)), estimates(spark, folder), "k", output, checkpoint, _DISORDER)
    return priced_table(spark, output).select(
        "scan", "place", "url", "price", "estimate", F.round("discount", 4).alias("discount"))


def _alerted(spark, folder):
    alert_path, memory = scratch_path(spark, "alerts"), scratch_path(spark, "memory")
    alert_deals(_stream(spark, scan_files(spark, folder)), estimates(spark, folder), "k",
                alert_path, memory, scratch_path(spark, "progress"), _DISORDER)
    return alert_path, memory


@query("stream_alerts", f"""
  WITH {_PRICED} SELECT scan, url, round(discount, 4) AS discount FROM best WHERE nth = 1 AND discount > 50""")
def stream_alerts(spark, folder):
    path, _ = _alerted(spark, folder)
    return priced_table(spark, path).select("scan", "url", F.round("discount", 4).alias("discount"))


@query("sink_memory", f"""
  WITH {_PRICED} SELECT url, price, estimate FROM best WHERE nth = 1 AND discount > 50""")
def sink_memory(spark, folder):
    _, memory = _alerted(spark, folder)
    return priced_table(spark, memory).select("url", "price", "estimate")


_REQUESTS = 100


@query("batch_progress", f"""
  WITH d AS (SELECT doc_id, n_chars, (row_number() OVER (ORDER BY doc_id) - 1) // {_REQUESTS} AS batch FROM documents)
  SELECT batch, count(*) AS n_requests, count(*) FILTER (batch % 2 = 0 OR n_chars % 3 = 0) AS n_answered,
    CASE WHEN count(*) = count(*) FILTER (batch % 2 = 0 OR n_chars % 3 = 0) THEN 'done' ELSE 'submitted' END AS status
  FROM d GROUP BY 1""")
def progress_of_batches(spark, folder):
    replies, seen = scratch_path(spark, "replies"), scratch_path(spark, "seen")
    rows = with_batches(table(spark, folder, "documents").select("doc_id", "n_chars"), "doc_id", _REQUESTS)
    requests = rows.select(
        (F.col("start") / _REQUESTS).cast("long").alias("batch"),
        F.col("doc_id").cast("string").alias("custom_id"), "n_chars")
    # every second batch is answered in full, the others in part
    answered = requests.filter("batch % 2 = 0 or n_chars % 3 = 0")
    answered.select(F.to_json(F.struct("custom_id")).alias("value")).write.text(replies)
    collect_replies(spark, replies, seen, scratch_path(spark, "progress"))
    return batch_progress(requests.drop("n_chars"), spark.read.schema("custom_id string").parquet(seen))


def chunk_prices(spark, folder):
    """The price of a chunk: that of the part its document belongs to."""
    documents = table(spark, folder, "documents").select("doc_id", F.length("text").alias("n_chars"))
    return with_part(spark, folder, documents).select(
        F.col("doc_id").alias("chunk_id"), F.col("p_retailprice").alias("price"), "n_chars")


_NEIGHBOURS = f"""{_CORPUS},
chunk_prices AS (SELECT doc_id AS chunk_id, p_retailprice AS price, length(text) AS n_chars FROM documents
  JOIN part ON doc_id % (SELECT count(*) FROM part) = p_partkey),
neighbours AS (SELECT question_id, rank, chunk_id, price FROM nearest JOIN chunk_prices USING (chunk_id) WHERE list_no = 1 AND rank <= 5),
means AS (SELECT question_id, avg(price) AS price FROM neighbours GROUP BY 1)"""


def _neighbours(spark, folder):
    return nearest(corpus(spark, folder), asked_vectors(spark, folder), fixed.NEIGHBOURS)


@query("nearest_products", f"""
  WITH {_NEIGHBOURS} SELECT n.question_id, n.rank, c.text AS description, n.price FROM neighbours n JOIN corpus c USING (chunk_id)""")
def nearest_products(spark, folder):
    n_results = asked_vectors(spark, folder).count() * fixed.NEIGHBOURS
    found = with_texts(_neighbours(spark, folder), corpus(spark, folder), n_results)
    return found.join(chunk_prices(spark, folder), "chunk_id").select(
        "question_id", "rank", F.col("text").alias("description"), "price")


@query("similar_products_block", f"""
  WITH {_NEIGHBOURS} SELECT n.question_id, string_agg(n.rank || '. ' || c.text || chr(10) || '   Price: $' || printf('%.2f', n.price) || chr(10),
    chr(10) ORDER BY n.rank) AS block FROM neighbours n JOIN corpus c USING (chunk_id) GROUP BY 1""")
def similar_products_block(spark, folder):
    """The nearest products of each question as one numbered text."""
    part = F.format_string(fixed.SIMILAR_PRODUCT, "rank", "description", "price")
    return joined_in_order(nearest_products(spark, folder), "question_id", "rank", part, "\n").select(
        "question_id", F.col("joined").alias("block"))


@query("neighbour_mean_price", f"WITH {_NEIGHBOURS} SELECT question_id, round(price, 6) AS price FROM means")
def neighbour_mean_price(spark, folder):
    found = neighbour_price(_neighbours(spark, folder), chunk_prices(spark, folder), asked_vectors(spark, folder))
    return found.withColumn("price", F.round("price", 6))


@query("ensemble_price", f"""
  WITH {_NEIGHBOURS},
  m AS (SELECT regr_slope(price, n_chars) AS slope, regr_intercept(price, n_chars) AS base FROM chunk_prices)
  SELECT question_id, round(0.8 * price + 0.2 * greatest(0, base + slope * length(text)), 4) AS price
  FROM means JOIN benchmark ON question_id = item_id, m""")
def ensemble_prices(spark, folder):
    prices = chunk_prices(spark, folder)
    near = neighbour_price(_neighbours(spark, folder), prices, asked_vectors(spark, folder))
    line = prices.agg(F.struct(
        F.regr_slope("price", "n_chars").alias("slope"), F.regr_intercept("price", "n_chars").alias("base"))).scalar()
    asked = table(spark, folder, "benchmark").select(
        F.col("item_id").alias("question_id"),
        F.greatest(F.lit(0.0), line["base"] + line["slope"] * F.length("text")).alias("model_price"))
    return near.join(asked, "question_id").select(
        "question_id", F.round(ensemble_price(F.col("price"), F.col("model_price")), 4).alias("price"))
