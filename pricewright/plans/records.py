"""Files in and out, patches, look-ups, pairs, made-up records."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.functions.prices import lookup_text
from pricewright.operators.documents import apply_patches, joined_in_order, pair_by_position
from pricewright.operators.records import batch_sizes, varied_products
from pricewright.plans.inputs import BOOKINGS, bookings, questions, table
from pricewright.plans.registry import query
from pricewright.session import scratch_path, spread
from pricewright.sources.packed import pack, packed
from pricewright.sources.readers import QUESTION_SCHEMA, booking_csv, nonblank_documents, typed_documents
from pricewright.sources.writers import append_documents, seed_lookup, write_questions


def written_csv(spark, folder) -> str:
    """Bookings as a CSV file; some volumes are words, some prices and years are missing."""
    path = scratch_path(spark, "csv")
    key = F.col("l_orderkey")
    columns = {
        "POL": F.col("pol"), "POD": F.col("pod"), "COMMODITY_CODE": F.col("commodity_code"),
        "COMMODITY_DESCRIPTION": F.col("commodity_desc"),
        "TOTAL_TEU": F.when(key % 50 == 0, "many").otherwise(F.col("teu").cast("string")),
        "BOOKING_TYPE": F.col("booking_type"),
        "BOOKING_YEAR": F.when(key % 60 != 1, F.col("year").cast("string")),
        "BOOKING_MONTH": F.col("month").cast("string"), "BOOKING_CHANNEL": F.col("channel"),
        "TOTAL_PRICE": F.when(key % 70 != 2, F.col("price").cast("string")),
        "CHG_CURRENCY": F.col("currency"),
    }
    bookings(spark, folder).select(
        *[columns[name].alias(name) for name in fixed.BOOKING_COLUMNS]).write.csv(path, header=True)
    return path


@query("scan_bookings", f"""
  WITH {BOOKINGS}
  SELECT pol, pod, commodity_code, commodity_desc, teu, booking_type, CAST(year AS INTEGER) AS year,
    CAST(month AS INTEGER) AS month, channel, CASE WHEN l_orderkey % 70 <> 2 THEN price END AS price, currency
  FROM bookings WHERE l_orderkey % 50 <> 0 AND l_orderkey % 60 <> 1""")
def scan_bookings(spark, folder):
    good, _ = booking_csv(spark, written_csv(spark, folder))
    return good


@query("rejected_bookings", f"""
  WITH {BOOKINGS}
  SELECT CASE WHEN l_orderkey % 50 = 0 THEN 'many' ELSE 'number' END AS teu, count(*) AS n FROM bookings
  WHERE l_orderkey % 50 = 0 OR l_orderkey % 60 = 1 GROUP BY 1""")
def rejected_bookings(spark, folder):
    _, bad = booking_csv(spark, written_csv(spark, folder))
    teu = F.when(F.col("TOTAL_TEU") == "many", "many").otherwise("number")
    return bad.groupBy(teu.alias("teu")).agg(F.count(F.lit(1)).alias("n"))


def written_markdown(spark, folder) -> str:
    """Documents packed below a folder per source; short texts become blank files."""
    path = scratch_path(spark, "markdown")
    text = F.when(F.col("n_chars") % 10 == 0, F.lit(" \n ")).otherwise(F.col("text"))
    name = F.format_string("source=%s/%d.md", "source", "doc_id")
    pack(spread(table(spark, folder, "documents")).select(
        name.alias("source"), F.concat(text, F.lit("\n")).cast("binary").alias("content")), path)
    return path


def _doc_id(source: str):
    return F.regexp_extract(source, r"/(-?\d+)\.md$", 1).cast("long").alias("doc_id")


@query("scan_markdown", """
  SELECT 'source=' || source AS type, doc_id, CASE WHEN n_chars % 10 = 0 THEN ' ' || chr(10) || ' ' ELSE text END || chr(10) AS text FROM documents""")
def scan_markdown(spark, folder):
    files = packed(spark, written_markdown(spark, folder))
    typed = typed_documents(files.select("source", F.col("content").cast("string").alias("text")))
    return typed.select("type", _doc_id("source"), "text")


@query("scan_markdown_nonblank", """
  SELECT doc_id, trim(text, ' ' || chr(10)) AS content FROM documents WHERE n_chars % 10 <> 0 AND trim(text, ' ' || chr(10)) <> ''""")
def scan_markdown_nonblank(spark, folder):
    files = packed(spark, written_markdown(spark, folder))
    return nonblank_documents(files.withColumnRenamed("source", "path")).select(_doc_id("path"), "content")


@query("scan_markdown_names", """
  SELECT 'source=' || source AS type, count(*) AS n FROM documents GROUP BY 1""")
def scan_markdown_names(spark, folder):
    files = packed(spark, written_markdown(spark, folder), contents=False)
    return files.groupBy(F.split_part("source", F.lit("/"), F.lit(1)).alias("type")).agg(F.count(F.lit(1)).alias("n"))


@query("sink_questions", """
  SELECT text AS question, 'answer ' || item_id AS reference_answer,
    CASE WHEN item_id % 5 <> 0 THEN 'topic ' || (item_id % 4) END AS category FROM benchmark""")
def sink_questions(spark, folder):
    path = scratch_path(spark, "questions")
    rows = questions(spark, folder).withColumn(
        "reference_answer", F.concat(F.lit("answer "), F.col("question_id").cast("string")))
    write_questions(rows.drop("question_id"), path)
    return spark.read.schema(QUESTION_SCHEMA).json(path).select("question", "reference_answer", "category")


@query("sink_documents", """
  SELECT CASE WHEN length(text) % 7 = 0 THEN 'failed' WHEN lang = 'en' THEN 'skipped' ELSE 'ok' END AS status, count(*) AS n
  FROM documents GROUP BY 1""")
def sink_documents(spark, folder):
    path = scratch_path(spark, "documents")
    documents = table(spark, folder, "documents")
    name = F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".md"))
    documents.filter("lang = 'en'").select(name.alias("path"), F.col("text").alias("content")).write.parquet(path)
    content = F.when(F.length("text") % 7 != 0, F.col("text"))
    wanted = documents.select(name.alias("path"), content.alias("content"))
    return append_documents(wanted, path)


@query("patch_join", """
  WITH p AS (SELECT doc_id, text, replace(text, 'an', 'AN') AS one FROM documents),
  q AS (SELECT *, CASE WHEN doc_id % 2 = 0 THEN replace(one, 'AN ', 'and, ') ELSE one END AS two FROM p)
  SELECT 'doc/' || doc_id AS path, replace(two, 'zzz', 'z') AS text,
   CASE WHEN contains(text, 'an') THEN '' ELSE '1,' END ||
   CASE WHEN doc_id % 2 <> 0 OR contains(one, 'AN ') THEN '' ELSE '2,' END || CASE WHEN contains(two, 'zzz') THEN '' ELSE '3,' END AS unmatched FROM q""")
def patch_join(spark, folder):
    documents = table(spark, folder, "documents").select(
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("path"), "text", "doc_id")

    def patch(number, search, replacement, applies):
        return F.struct(
            F.lit(number).cast("long").alias("patch"), F.lit(search).alias("search"),
            F.lit(replacement).alias("replacement"), F.array("path").alias("paths"),
            applies.alias("applies"))

    updates = documents.select(F.inline(F.array(
        patch(1, "an", "AN", F.lit(True)), patch(2, "AN ", "and, ", F.col("doc_id") % 2 == 0),
        patch(3, "zzz", "z", F.lit(True))))).filter("applies")
    done = apply_patches(documents.select("path", "text"), updates)
    numbers = F.transform("unmatched", lambda n: F.concat(n.cast("string"), F.lit(",")))
    return done.select("path", "text", F.array_join(numbers, "").alias("unmatched"))


def _prices(spark, folder):
    """City prices: nations with a derived price, some with decimals."""
    key = F.col("n_nationkey")
    price = F.when(key % 2 == 0, key * 37.0 + 100).otherwise(key * 37.0 + 99.25)
    return table(spark, folder, "nation").select(F.lower("n_name").alias("city"), price.alias("price"))


_PRICES = """prices AS (SELECT lower(n_name) AS city, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey * 37.0 + 100
  ELSE n_nationkey * 37.0 + 99.25 END::DOUBLE AS price FROM nation)"""


@query("lookup_price", f"""
  WITH {_PRICES},
  c AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN '  ' WHEN c_custkey % 7 = 0 THEN 'Atlantis' ELSE ' ' || n_name END AS city
        FROM customer JOIN nation ON c_nationkey = n_nationkey)
  SELECT c_custkey, CASE WHEN trim(c.city) = '' THEN 'Please provide a destination city.'
     WHEN price IS NULL THEN 'No price data available for ' || c.city || '.'
     ELSE 'The price of a ticket to ' || c.city || ' is $' || CASE WHEN price = floor(price) THEN CAST(CAST(price AS BIGINT) AS VARCHAR)
       ELSE printf('%.2f', price) END || '.' END AS answer
  FROM c LEFT JOIN prices p ON lower(trim(c.city)) = p.city""")
def lookup_price(spark, folder):
    nation = table(spark, folder, "nation")
    key = F.col("c_custkey")
    city = F.when(key % 11 == 0, "  ").when(key % 7 == 0, "Atlantis").otherwise(
        F.concat(F.lit(" "), "n_name"))
    asked = table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", city.alias("asked"))
    prices = seed_lookup(spark.createDataFrame([], "city string, price double"), _prices(spark, folder))
    return asked.join(prices, F.lower(F.trim("asked")) == F.col("city"), "left").select(
        "c_custkey", lookup_text(F.col("asked"), F.col("price")).alias("answer"))


@query("seed_lookup", f"""
  WITH {_PRICES} SELECT 'empty' AS start, * FROM prices UNION ALL SELECT 'filled', 'rome', 5.0 UNION ALL
  SELECT 'filled', lower(r_name), 1.0 FROM region""")
def seed_lookup_query(spark, folder):
    regions = table(spark, folder, "region").select(F.lower("r_name").alias("city"), F.lit(1.0).alias("price"))
    filled = regions.unionByName(spark.createDataFrame([("rome", 5.0)], "city string, price double"))
    seeds = _prices(spark, folder)
    both = [
        seed_lookup(lookup, seeds).withColumn("start", F.lit(name))
        for name, lookup in (("empty", seeds.filter(F.lit(False))), ("filled", filled))
    ]
    return both[0].unionByName(both[1])


@query("zip_examples", """
  WITH s AS (SELECT conv_id, role, trim(text) AS text, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS place
    FROM conversations WHERE trim(text) <> '')
  SELECT coalesce(u.conv_id, a.conv_id) AS conv_id, coalesce(u.place, a.place) AS place, coalesce(u.text, '') AS input, coalesce(a.text, '') AS output
  FROM (SELECT * FROM s WHERE role = 'user') u FULL JOIN (SELECT * FROM s WHERE role = 'assistant') a
    ON u.conv_id = a.conv_id AND u.place = a.place""")
def zip_examples(spark, folder):
    turns = table(spark, folder, "conversations")
    return pair_by_position(
        turns.filter("role = 'user'"), turns.filter("role = 'assistant'"), "conv_id", "turn")


@query("user_history", """
  SELECT conv_id, coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (role = 'user'), '') || chr(10)
    || 'Anything else in ' || conv_id || '?' AS combined
  FROM conversations GROUP BY conv_id""")
def user_history(spark, folder):
    asked = table(spark, folder, "conversations").filter("role = 'user'")
    question = F.concat(F.lit("\nAnything else in "), F.col("conv_id").cast("string"), F.lit("?"))
    history = joined_in_order(asked, "conv_id", "turn", F.col("text"), "\n")
    # a conversation in which the user said nothing keeps its place
    everyone = table(spark, folder, "conversations").select("conv_id").distinct()
    return everyone.join(history, "conv_id", "left").select(
        "conv_id", F.concat(F.coalesce("joined", F.lit("")), question).alias("combined"))


@query("synthetic_records", """
  WITH n AS (SELECT p_partkey, p_name, p_type, p_retailprice, unnest([0, 1, 2]) AS copy FROM part),
  u AS (SELECT *, CAST('0x' || substr(md5((p_partkey * 3 + copy) || '/42'), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u FROM n)
  SELECT p_partkey * 3 + copy AS record_id, p_name AS title, p_type AS category, round(p_retailprice * (0.9 + 0.2::DOUBLE * u), 4) AS price FROM u""")
def synthetic_records(spark, folder):
    base = table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("title"),
        F.col("p_type").alias("category"), F.col("p_retailprice").alias("price"))
    return varied_products(base, 3).withColumn("price", F.round("price", 4))


@query("batch_sizes", """
  WITH c AS (SELECT lang AS kind, count(*) AS n FROM documents GROUP BY 1),
  b AS (SELECT kind, n, unnest(range((n + 199) // 200)) AS i FROM c)
  SELECT kind, i + 1 AS batch, least(200, n - i * 200) AS size FROM b""")
def sizes_of_batches(spark, folder):
    wanted = table(spark, folder, "documents").groupBy(F.col("lang").alias("kind")).agg(
        F.count(F.lit(1)).alias("n"))
    return batch_sizes(wanted, 200)
