"""Splits, prompts, completions, batches and their files."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.functions.prices import (
    cut_at_price,
    freight_completion,
    freight_text,
    priced_prompt,
    prompt_route,
    prompt_title,
    unpriced_prompt,
    whole,
)
from pricewright.functions.terms import cut_tokens, token_count
from pricewright.operators.ordering import numbered
from pricewright.operators.splits import exact_split, holdout_split, sample_rows
from pricewright.plans.inputs import BOOKINGS, bookings, table, with_part
from pricewright.plans.registry import query
from pricewright.session import scratch_path, spread
from pricewright.sources.readers import reply_lines
from pricewright.sources.writers import (
    chat_line,
    with_batches,
    write_batch_requests,
    write_lines,
    write_prompts,
    write_splits,
)


def _hash_sql(key: str) -> str:
    return f"substr(md5({key} || '/42'), 1, 13)"


def _split_sql(source: str, key: str) -> str:
    return f"""ranked AS (
  SELECT *, row_number() OVER (ORDER BY {_hash_sql(key)}, {key}) AS place, count(*) OVER () AS total FROM {source}),
sized AS (SELECT *, ceil(0.1::DOUBLE * total) AS n_test FROM ranked),
split AS (SELECT * EXCLUDE (place, total, n_test), CASE WHEN place <= n_test THEN 'test'
  WHEN place <= n_test + ceil(0.1::DOUBLE / (0.8::DOUBLE + 0.1::DOUBLE) * (total - n_test)) THEN 'validation'
  ELSE 'train' END AS split FROM sized)"""


_DOC_SPLIT = _split_sql("documents", "doc_id")
_PART_SPLIT = _split_sql("part", "p_partkey")


@query("split_80_10_10", f"""
  WITH {_split_sql('orders', 'o_orderkey')} SELECT o_orderkey, split FROM split""")
def split_80_10_10(spark, folder):
    return exact_split(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@query("holdout_split", f"""
  SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY {_hash_sql('o_orderkey')}, o_orderkey)
    <= ceil(0.01::DOUBLE * count(*) OVER ()) THEN 'validation' ELSE 'train' END AS split FROM orders""")
def one_percent_holdout(spark, folder):
    return holdout_split(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey", 0.01)


@query("sample_rows", f"""
  SELECT doc_id, source, n_chars FROM documents ORDER BY {_hash_sql('doc_id')}, doc_id LIMIT 150""")
def sample(spark, folder):
    return sample_rows(table(spark, folder, "documents").select("doc_id", "source", "n_chars"), "doc_id", 150)


@query("head_rows", f"""
  WITH {_DOC_SPLIT} SELECT * FROM (
   (SELECT split, doc_id FROM split WHERE split = 'test' ORDER BY doc_id LIMIT 200)
   UNION ALL (SELECT split, doc_id FROM split WHERE split = 'train' ORDER BY doc_id LIMIT 100)
   UNION ALL (SELECT split, doc_id FROM split WHERE split = 'validation' ORDER BY doc_id LIMIT 50))""")
def head_rows(spark, folder):
    rows = exact_split(table(spark, folder, "documents").select("doc_id"), "doc_id")
    heads = [
        rows.filter(F.col("split") == name).orderBy("doc_id").limit(n).select("split", "doc_id")
        for name, n in (("test", 200), ("train", 100), ("validation", 50))
    ]
    return heads[0].unionByName(heads[1]).unionByName(heads[2])


@query("train_subset", f"""
  WITH {_split_sql('orders', 'o_orderkey')}
  SELECT o_orderkey, o_totalprice FROM split WHERE split = 'train' ORDER BY o_orderkey LIMIT 15000""")
def train_subset(spark, folder):
    rows = exact_split(table(spark, folder, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")
    return rows.filter("split = 'train'").orderBy("o_orderkey").limit(15000).drop("split")


@query("sink_splits", f"WITH {_DOC_SPLIT} SELECT doc_id, lang, n_chars, split FROM split")
def sink_splits(spark, folder):
    path = scratch_path(spark, "splits")
    documents = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    write_splits(exact_split(documents, "doc_id"), path)
    return spark.read.schema("doc_id long, lang string, n_chars long, split string").parquet(path)


@query("scan_splits", f"""
  WITH {_DOC_SPLIT} SELECT split, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM split GROUP BY 1""")
def scan_splits(spark, folder):
    stored = sink_splits(spark, folder)
    parts = [stored.filter(F.col("split") == name) for name in ("train", "validation", "test")]
    sums = [
        part.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars"))
        for part in parts
    ]
    return sums[0].unionByName(sums[1]).unionByName(sums[2])


@query("union_splits", f"WITH {_DOC_SPLIT} SELECT doc_id, split FROM split")
def union_splits(spark, folder):
    stored = sink_splits(spark, folder).select("doc_id", "split")
    train, validation, test = (
        stored.filter(F.col("split") == name) for name in ("train", "validation", "test"))
    return train.unionByName(validation).unionByName(test)


_PROMPT_SQL = "'What does this cost to the nearest dollar?' || chr(10) || chr(10) || {text} || chr(10) || chr(10) || 'Price is $'"
_TOKENS = "[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}\\s]"


@query("prompt_with_price", f"""
  SELECT p_partkey, {_PROMPT_SQL.format(text='p_name')} || CAST(round_even(p_retailprice, 0) AS BIGINT) || '.00' AS prompt,
         {_PROMPT_SQL.format(text='p_name')} AS test_prompt FROM part""")
def prompt_with_price(spark, folder):
    prompt = priced_prompt(F.col("p_name"), F.col("p_retailprice"))
    return table(spark, folder, "part").select(
        "p_partkey", prompt.alias("prompt"), cut_at_price(prompt).alias("test_prompt"))


def sft_pairs(spark, folder):
    """Document summaries cut to the token limit, priced by their part, whole prices but in test."""
    documents = exact_split(spread(table(spark, folder, "documents").select("doc_id", "text")), "doc_id")
    rows = with_part(spark, folder, documents)
    price = F.col("p_retailprice")
    exact = F.col("split") == "test"
    return rows.select(
        "doc_id", "split",
        unpriced_prompt(cut_tokens(F.col("text"), fixed.TOKEN_CUTOFF)).alias("prompt"),
        F.when(exact, price.cast("string")).otherwise(F.concat(whole(price), F.lit(".00")))
        .alias("completion"),
    )


_SFT = f"""{_DOC_SPLIT},
pieces AS (SELECT doc_id, split, text, regexp_extract_all(text, '{_TOKENS}') AS toks, p_retailprice AS price
  FROM split JOIN part ON doc_id % (SELECT count(*) FROM part) = p_partkey),
marked AS (SELECT doc_id, split, price, len(toks) AS n, text,
  regexp_replace(text, '{_TOKENS}', chr(1) || '\\0', 'g') AS flagged FROM pieces),
cut AS (SELECT doc_id, split, price, CASE WHEN n > 110 THEN
   rtrim(array_to_string(string_split(flagged, chr(1))[1:111], ''), ' ' || chr(10)) ELSE text END AS summary FROM marked),
sft AS (SELECT doc_id, split, {_PROMPT_SQL.format(text='summary')} AS prompt,
   CASE WHEN split = 'test' THEN CAST(price AS VARCHAR)
        ELSE CAST(round_even(price, 0) AS BIGINT) || '.00' END AS completion FROM cut)"""


@query("sft_pair", f"WITH {_SFT} SELECT doc_id, split, prompt, completion FROM sft")
def sft_pair(spark, folder):
    return sft_pairs(spark, folder)


@query("project_prompt_pair", f"WITH {_SFT} SELECT prompt, completion FROM sft")
def project_prompt_pair(spark, folder):
    return sft_pairs(spark, folder).select("prompt", "completion")


@query("sink_prompts", f"WITH {_SFT} SELECT prompt, completion, split FROM sft")
def sink_prompts(spark, folder):
    path = scratch_path(spark, "prompts")
    write_prompts(sft_pairs(spark, folder), path)
    return spark.read.schema("prompt string, completion string, split string").parquet(path)


_FREIGHT_TEXT = """'Estimate the freight rate for this shipment:' || chr(10) || chr(10) ||
  'Route: ' || pol || ' to ' || pod || chr(10) || 'Commodity: ' || commodity_desc || ' (HS ' || commodity_code || ')' ||
  chr(10) || 'Volume: ' || printf('%.1f', teu) || ' TEU' || chr(10) || 'Type: ' || booking_type || chr(10) ||
  'Date: ' || year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') || chr(10) || 'Channel: ' || channel ||
  chr(10) || chr(10) || 'Freight rate:'"""


@query("freight_pair", f"""
  WITH {BOOKINGS}, {_split_sql('orders', 'o_orderkey')}
  SELECT l_orderkey, l_linenumber, {_FREIGHT_TEXT} AS prompt,
    ' ' || CASE WHEN split = 'test' THEN printf('%.2f', price)
                ELSE CAST(CAST(round_even(price, 0) AS BIGINT) AS VARCHAR) END || ' ' || currency AS completion
  FROM bookings JOIN split ON l_orderkey = o_orderkey""")
def freight_pair(spark, folder):
    orders = exact_split(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")
    rows = bookings(spark, folder).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    text = cut_tokens(freight_text(), fixed.TOKEN_CUTOFF)
    return rows.select(
        "l_orderkey", "l_linenumber", F.concat(text, F.lit(fixed.FREIGHT_ANSWER)).alias("prompt"),
        freight_completion(F.col("split") != "test").alias("completion"))


@query("token_count", f"SELECT doc_id, len(regexp_extract_all(text, '{_TOKENS}')) AS n_tokens FROM documents")
def tokens_per_document(spark, folder):
    documents = spread(table(spark, folder, "documents").select("doc_id", "text"))
    return documents.select("doc_id", token_count(F.col("text")).alias("n_tokens"))


def _token_stats(counts):
    over = F.count_if(F.col("n_tokens") > fixed.TOKEN_CUTOFF)
    return counts.agg(
        F.round(F.avg("n_tokens"), 4).alias("mean_tokens"),
        F.max("n_tokens").alias("max_tokens"),
        over.alias("n_cut"),
        F.round(over * 100 / F.count(F.lit(1)), 4).alias("share_cut"),
    )


_STATS_SQL = """round(avg(n), 4) AS mean_tokens, max(n) AS max_tokens, count(*) FILTER (n > 110) AS n_cut,
  round(count(*) FILTER (n > 110) * 100 / count(*), 4) AS share_cut"""


@query("token_stats", f"""
  SELECT {_STATS_SQL} FROM (SELECT len(regexp_extract_all(text, '{_TOKENS}')) AS n FROM documents)""")
def token_stats(spark, folder):
    return _token_stats(tokens_per_document(spark, folder))


@query("prompt_token_stats", f"""
  WITH {_SFT}, {BOOKINGS},
  freight AS (SELECT {_FREIGHT_TEXT} || ' ' || CAST(CAST(round_even(price, 0) AS BIGINT) AS VARCHAR) || ' ' || currency AS t
    FROM bookings)
  SELECT 'product' AS kind, {_STATS_SQL} FROM (SELECT len(regexp_extract_all(prompt || completion, '{_TOKENS}')) AS n FROM sft)
  UNION ALL SELECT 'freight', {_STATS_SQL} FROM (SELECT len(regexp_extract_all(t, '{_TOKENS}')) AS n FROM freight)""")
def prompt_token_stats(spark, folder):
    pairs = sft_pairs(spark, folder)
    product = _token_stats(pairs.select(token_count(F.concat("prompt", "completion")).alias("n_tokens")))
    whole_text = F.concat(freight_text(), F.lit(fixed.FREIGHT_ANSWER), freight_completion(F.lit(True)))
    freight = _token_stats(bookings(spark, folder).select(token_count(whole_text).alias("n_tokens")))
    return product.withColumn("kind", F.lit("product")).unionByName(
        freight.withColumn("kind", F.lit("freight")))


@query("title_of_prompt", f"""
  WITH {BOOKINGS},
  t AS (SELECT l_orderkey, l_linenumber, {_FREIGHT_TEXT} AS prompt,
     CASE WHEN l_linenumber > 1 THEN 'Buy Title: ' ELSE '' END || commodity_desc || ' shipped from ' || pol || ' to ' || pod || chr(10) || 'x' AS product FROM bookings),
  r AS (SELECT l_orderkey, l_linenumber,
     CASE WHEN l_linenumber > 1 THEN regexp_extract(product, 'Title: ([^\\n]*)', 1) ELSE product END AS title,
     CASE WHEN l_linenumber = 2 THEN 'Route ' || l_orderkey ELSE
       regexp_extract(prompt, 'Route: (\\w+) to (\\w+)', 1) || '→' || regexp_extract(prompt, 'Route: (\\w+) to (\\w+)', 2) END AS route FROM t)
  SELECT l_orderkey, l_linenumber, CASE WHEN length(title) > 40 THEN title[1:40] || '...' ELSE title END AS title, route FROM r""")
def title_of_prompt(spark, folder):
    # first lines have no title, second lines no route
    mark = F.when(F.col("l_linenumber") > 1, "Buy " + fixed.TITLE_MARK).otherwise("")
    product = F.concat(
        mark, "commodity_desc", F.lit(" shipped from "), "pol", F.lit(" to "), "pod", F.lit("\nx"))
    prompt = F.when(F.col("l_linenumber") == 2, "").otherwise(freight_text())
    return bookings(spark, folder).select(
        "l_orderkey", "l_linenumber", prompt_title(product).alias("title"),
        prompt_route(prompt, F.col("l_orderkey")).alias("route"))


@query("row_ids", """
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position,
         'product_' || (row_number() OVER (ORDER BY doc_id) - 1) || '_' || md5(text) AS row_id FROM documents""")
def row_ids(spark, folder):
    documents = table(spark, folder, "documents").select("doc_id", F.md5("text").alias("digest"))
    rows = numbered(documents, ["doc_id"], "position").withColumn("position", F.col("position") - 1)
    name = F.concat_ws("_", F.lit("product"), F.col("position").cast("string"), "digest")
    return rows.select("doc_id", "position", name.alias("row_id"))


@query("batch_ids", """
  WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS p, count(*) OVER () AS total FROM orders)
  SELECT p // 1000 AS batch, any_value(p // 1000 * 1000) AS start,
         any_value(least(p // 1000 * 1000 + 1000, total)) AS "end",
         count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM r GROUP BY 1""")
def batch_ids(spark, folder):
    rows = with_batches(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")
    return rows.groupBy("start", "end").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
    ).withColumn("batch", (F.col("start") / fixed.BATCH_ROWS).cast("long"))


@query("sink_batch_requests", """
  WITH r AS (SELECT *, row_number() OVER (ORDER BY doc_id) - 1 AS p, count(*) OVER () AS total FROM documents)
  SELECT (p // 1000 * 1000) || '_' || least(p // 1000 * 1000 + 1000, total) AS file,
         CAST(doc_id AS VARCHAR) AS custom_id, 'POST' AS method, 'low' AS effort, text AS content FROM r""")
def sink_batch_requests(spark, folder):
    path = scratch_path(spark, "requests")
    write_batch_requests(table(spark, folder, "documents"), "doc_id", "text", path)
    line = (
        "custom_id string, method string, url string, body struct<model string, "
        "messages array<struct<role string, content string>>, reasoning_effort string>"
    )
    lines = spark.read.schema("value string, file string").text(path)
    return lines.select("file", F.from_json("value", line).alias("r")).select(
        "file", "r.custom_id", "r.method", F.col("r.body.reasoning_effort").alias("effort"),
        F.col("r.body.messages")[1]["content"].alias("content"))


@query("sink_chat_jsonl", """
  SELECT 'user' AS first_role, 'Estimate the price of this product. Respond with the price, no explanation'
    || chr(10) || chr(10) || p_name AS request, 'assistant' AS second_role,
    '$' || printf('%.2f', p_retailprice) AS reply FROM part""")
def sink_chat_jsonl(spark, folder):
    path = scratch_path(spark, "chat")
    user = F.concat(F.lit(fixed.ESTIMATE_REQUEST + "\n\n"), "p_name")
    reply = F.format_string("$%.2f", "p_retailprice")
    write_lines(table(spark, folder, "part").select(chat_line(user, reply).alias("value")), path)
    lines = spark.read.schema("messages array<struct<role string, content string>>").json(path)
    first, second = F.col("messages")[0], F.col("messages")[1]
    return lines.select(
        first["role"].alias("first_role"), first["content"].alias("request"),
        second["role"].alias("second_role"), second["content"].alias("reply"))


def written_replies(spark, folder) -> str:
    """A folder of reply lines: a draft for every document, a final one for some."""
    path = scratch_path(spark, "replies")
    documents = table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    for name, rows in (("1_draft", documents), ("2_final", documents.filter("n_chars % 3 = 0"))):
        content = F.concat_ws(" ", F.lit(name), "source", F.col("n_chars").cast("string"))
        message = F.struct(F.struct(content.alias("content")).alias("message"))
        response = F.struct(F.struct(F.array(message).alias("choices")).alias("body"))
        rows.select(
            F.to_json(F.struct(F.col("doc_id").cast("string").alias("custom_id"),
                               response.alias("response"))).alias("value")
        ).write.text(f"{path}/{name}")
    return path


@query("scan_batch_output", """
  SELECT CAST(doc_id AS VARCHAR) AS custom_id, '1_draft ' || source || ' ' || n_chars AS content FROM documents
  UNION ALL SELECT CAST(doc_id AS VARCHAR), '2_final ' || source || ' ' || n_chars FROM documents WHERE n_chars % 3 = 0""")
def scan_batch_output(spark, folder):
    return reply_lines(spark, written_replies(spark, folder)).drop("place")


@query("join_replies", """
  SELECT doc_id, CASE WHEN n_chars % 3 = 0 THEN '2_final ' ELSE '1_draft ' END || source || ' ' || n_chars AS summary
  FROM documents""")
def join_replies(spark, folder):
    replies = reply_lines(spark, written_replies(spark, folder))
    last = replies.groupBy(F.col("custom_id").cast("long").alias("doc_id")).agg(
        F.max_by("content", "place").alias("summary"))
    return table(spark, folder, "documents").select("doc_id").join(last, "doc_id", "left")


@query("usage_totals", """
  SELECT CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS input_tokens,
         CAST(sum(length(event_type)) AS BIGINT) AS output_tokens, round(sum(value) / 1000, 6) AS cost FROM events""")
def usage_totals(spark, folder):
    usage = F.from_json("props", "k long")
    return table(spark, folder, "events").agg(
        F.sum(usage["k"]).alias("input_tokens"),
        F.sum(F.length("event_type")).alias("output_tokens"),
        F.round(F.sum("value") / 1000, 6).alias("cost"))
