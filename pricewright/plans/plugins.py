"""Outside code plugged into the jobs: predictor, embedder, tokenizer, chunker, scorer."""

from __future__ import annotations

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.operators.evaluation import error_metrics
from pricewright.operators.models import linear_pricer, numeric_features, predictor, word_counts
from pricewright.operators.table_functions import register
from pricewright.plans.inputs import table
from pricewright.plans.models import _STOPS
from pricewright.plans.registry import query
from pricewright.plans.retrieval import judged, written_judgements
from pricewright.session import spread

_VOCABULARY, _WIDTH = 1000, 8
_WORDS = "regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}')"


@query("predictor", """
  WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS base FROM lineitem),
  p AS (SELECT l_returnflag AS model, l_extendedprice AS truth, greatest(0, base + slope * l_quantity) AS guess FROM lineitem, m)
  SELECT model, count(*) AS n, round(avg(abs(guess - truth)), 3) AS mae,
    round((1 - sum((guess - truth) ** 2) / (var_pop(truth) * count(*))) * 100, 5) AS r2_percent FROM p GROUP BY 1""")
def outside_predictor(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_returnflag", "l_quantity", F.col("l_extendedprice").alias("price"))
    fitted = Pipeline(stages=[numeric_features(["l_quantity"]), linear_pricer()]).fit(lines).stages[-1]
    slope, base = float(fitted.coefficients[0]), float(fitted.intercept)  # all that a task needs of the model

    def price(rows: pd.DataFrame) -> pd.Series:
        return (base + slope * rows["l_quantity"]).clip(lower=0)

    guesses = lines.select(F.col("l_returnflag").alias("model"), F.col("price").alias("truth"),
                           predictor(price)("l_quantity").alias("guess"))
    return error_metrics(guesses, ["model"]).select(
        "model", "n", F.round("mae", 3).alias("mae"), F.round("r2_percent", 5).alias("r2_percent"))


def _cut(spark, folder):
    """Chunks of the documents with their places, by the recursive chunker as a table function."""
    register(spark)
    documents = spread(table(spark, folder, "documents").select("doc_id", "text"))
    return spark.sql(
        f"""SELECT d.doc_id, c.* FROM {{documents}} d, LATERAL
            chunks(d.text, {fixed.CHUNK_CHARS}, {fixed.CHUNK_OVERLAP}, true) c""", documents=documents)


def _split(pieces: str, separator: str) -> str:
    """SQL for a list of pieces, those that are too long cut before each separator."""
    return f"""flatten(list_transform({pieces}, lambda p: CASE WHEN length(p) <= {fixed.CHUNK_CHARS} THEN [p] ELSE
      list_transform(string_split(p, {separator}), lambda x, i: CASE WHEN i = 1 THEN x ELSE {separator} || x END) END))"""


_BLANKS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(32) || chr(133) || chr(160)"


@query("chunker", f"""
  WITH RECURSIVE pieces AS (SELECT doc_id, text, flatten(list_transform({_split(_split(_split("[text]", "chr(10) || chr(10)"), "chr(10)"), "' '")},
      lambda p: CASE WHEN length(p) <= {fixed.CHUNK_CHARS} THEN [p] ELSE string_split(p, '') END)) AS pieces FROM documents WHERE text <> ''),
  parts AS (SELECT doc_id, generate_subscripts(pieces, 1) AS i, unnest(pieces) AS piece FROM pieces),
  spots AS (SELECT doc_id, CAST(sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i) AS BIGINT) AS stop,
    length(piece) AS n FROM parts WHERE piece <> ''),
  ends AS (SELECT doc_id, list(stop ORDER BY stop) AS stops, list(n ORDER BY stop) AS sizes FROM spots GROUP BY 1),
  chunks AS (
    SELECT doc_id, 0::BIGINT AS span, 0::BIGINT AS start,
      len(list_filter(stops, lambda e: e <= {fixed.CHUNK_CHARS})) AS done FROM ends
    UNION ALL
    SELECT doc_id, span + 1, start, len(list_filter(stops, lambda e: e <= start + {fixed.CHUNK_CHARS})) FROM (
      SELECT doc_id, span, stops, list_min(list_filter(list_concat([0::BIGINT], stops[:done]),
        lambda e: stops[done] - e <= least({fixed.CHUNK_OVERLAP}, {fixed.CHUNK_CHARS} - sizes[done + 1]))) AS start
      FROM chunks JOIN ends USING (doc_id) WHERE done < len(stops))),
  texts AS (SELECT c.doc_id, c.span, trim(substring(d.text, c.start + 1, e.stops[c.done] - c.start), {_BLANKS}) AS text
    FROM chunks c JOIN ends e USING (doc_id) JOIN documents d USING (doc_id))
  SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY span) - 1 AS chunk_no, text FROM texts WHERE text <> ''""")
def outside_chunker(spark, folder):
    return _cut(spark, folder).select("doc_id", "chunk_no", "text")


@query("chunker_coverage", f"""
  SELECT doc_id, CAST(length(regexp_replace(text, '\\s+', '', 'g')) AS BIGINT) AS n_covered, true AS within_size, true AS within_overlap
  FROM documents WHERE regexp_matches(text, '\\S')""")
def chunker_coverage(spark, folder):
    # what any sound chunking has in common: all signs are covered, sizes and overlaps keep their limits
    before = F.lag(F.col("start") + F.col("length"), 1, 0).over(Window.partitionBy("doc_id").orderBy("chunk_no"))
    cut = _cut(spark, folder).withColumn("shared", F.greatest(before - F.col("start"), F.lit(0)))
    fresh = F.expr("substring(text, int(shared) + 1)")
    return cut.groupBy("doc_id").agg(
        F.sum(F.length(F.regexp_replace(fresh, r"\s+", ""))).alias("n_covered"),
        F.bool_and(F.col("length") <= fixed.CHUNK_CHARS).alias("within_size"),
        F.bool_and(F.col("shared") <= fixed.CHUNK_OVERLAP).alias("within_overlap"))


@query("embedder", f"""
  WITH d AS (SELECT doc_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS parts FROM documents),
  c AS (SELECT doc_id, unnest(range(0, len(parts), 50)) AS first, parts FROM d WHERE len(parts) > 0),
  t AS (SELECT doc_id, array_to_string(parts[first + 1 : first + 50], ' ') AS text FROM c),
  w AS (SELECT doc_id, list_transform(list_filter({_WORDS}, lambda x: x NOT IN ({_STOPS})),
    lambda x: CAST('0x' || md5(x)[1:8] AS BIGINT) % {_WIDTH}) AS places FROM t)
  SELECT doc_id, count(*) AS n_texts, """ + ", ".join(
    f"round(sum(len(list_filter(places, lambda p: p = {i}))) / count(*), 6) AS v{i}" for i in range(_WIDTH)) + """
  FROM w GROUP BY 1""")
def outside_embedder(spark, folder):
    register(spark)
    documents = spread(table(spark, folder, "documents").select("doc_id", "text"))
    words = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    pieces = documents.select("doc_id", words.alias("w")).filter("size(w) > 0").select(
        "doc_id", "w", F.explode(F.sequence(F.lit(0), F.size("w") - 1, F.lit(50))).alias("at")).select(
        "doc_id", F.array_join(F.slice("w", F.col("at") + 1, 50), " ").alias("text"))
    vectors = spark.sql(f"SELECT * FROM embedded_groups(TABLE({{pieces}}), 'doc_id', 'text', {_WIDTH})", pieces=pieces)
    return vectors.select(
        F.col("key").alias("doc_id"), "n_texts", *[F.round(F.col("vector")[i], 6).alias(f"v{i}") for i in range(_WIDTH)])


@query("tokenizer", f"""
  WITH w AS (SELECT doc_id, {_WORDS} AS words FROM documents),
  t AS (SELECT doc_id, unnest(words) AS word FROM w),
  v AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) - 1 AS id FROM (
    SELECT word, count(*) AS n FROM t WHERE word NOT IN ({_STOPS}) GROUP BY 1 ORDER BY n DESC, word LIMIT {_VOCABULARY}))
  SELECT doc_id, count(*) AS n_tokens, count(id) AS n_known,
    CAST(sum(coalesce(id, (SELECT count(*) FROM v))) AS BIGINT) AS sum_ids FROM t LEFT JOIN v USING (word) GROUP BY 1""")
def outside_tokenizer(spark, folder):
    register(spark)
    documents = spread(table(spark, folder, "documents").select("doc_id", "text"))
    known = [row.word for row in word_counts(documents, "text", _VOCABULARY).collect()]  # ``_VOCABULARY`` words
    tokens = spark.sql(
        "SELECT d.doc_id, t.* FROM {documents} d, LATERAL vocabulary(d.text, :known) t", args={"known": F.array(
            *[F.lit(word) for word in known])}, documents=documents)
    return tokens.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_tokens"), F.count_if(F.col("token_id") < len(known)).alias("n_known"),
        F.sum("token_id").alias("sum_ids"))


@query("scorer", """
  SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 1 ELSE 1 + (event_id % 9) * 0.5 END::DOUBLE AS accuracy,
     CASE WHEN event_id % 10 = 0 THEN 1 ELSE 1 + (user_id % 5) END::DOUBLE AS completeness,
     CASE WHEN event_id % 10 = 0 THEN 1 ELSE 5 - (user_id % 3) END::DOUBLE AS relevance FROM events""")
def outside_scorer(spark, folder):
    return judged(written_judgements(spark, folder)).drop("user_id")
