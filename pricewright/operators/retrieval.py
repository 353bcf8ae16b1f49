"""Nearest vectors, term matches, merged and reranked results for all questions at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.functions.terms import term_score
from pricewright.operators.cells import QUERY_BLOCK, build_cells, search_cells
from pricewright.operators.trigrams import best_by_terms

BROADCAST_RESULTS = 500_000


def _ranked(found: DataFrame, order: list, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("question_id").orderBy(*order))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).withColumn("rank", F.col("rank").cast("long"))


def nearest(chunks: DataFrame, queries: DataFrame, k: int, metric: str = "l2",
            block: int = QUERY_BLOCK) -> DataFrame:
    """The exact k nearest chunks per query: (question_id, rank, chunk_id, distance).

    ``chunks``: chunk_id, vector. ``queries``: question_id, vector. ``metric`` is "l2"
    (squared) or "cosine"; ties go to the smaller chunk_id. Chunks are indexed by cells
    and a query only meets the cells that can hold one of its results.
    """
    return search_cells(build_cells(chunks, metric), queries, k, block)[0]


def lexical(chunks: DataFrame, terms: DataFrame, top: int = fixed.LEXICAL_TOP,
            index: DataFrame | None = None) -> DataFrame:
    """The ``top`` chunks per question by number of its terms they contain, ignoring case.

    ``chunks``: chunk_id, text. ``terms``: question_id, terms (its first 8 count). With an
    ``index`` of trigrams only the segments that can hold a term are read.
    """
    wanted = terms.select("question_id", F.slice("terms", 1, fixed.MAX_TERMS).alias("terms"))
    return _ranked(best_by_terms(chunks, wanted, top, index), [F.desc("score"), "chunk_id"], top)


def with_texts(found: DataFrame, chunks: DataFrame, n_results: int) -> DataFrame:
    """Results with the text and source of their chunk.

    ``n_results`` bounds the rows of ``found`` (questions times results): up to a
    size that fits every task they are sent to the chunks, so that no text moves
    but those found; beyond it both sides are shuffled.
    """
    small = F.broadcast(found) if n_results <= BROADCAST_RESULTS else found
    return chunks.select("chunk_id", "text", "source").join(small, "chunk_id")


def merged(lists: DataFrame) -> DataFrame:
    """Chained merge of ranked lists: a text stays out of a list when an earlier list has it.

    ``lists``: question_id, list_no, rank, chunk_id, text and more. Copies inside
    one list stay. Adds ``position``, the place in the merged list.
    """
    first = F.min("list_no").over(Window.partitionBy("question_id", "text"))
    kept = lists.withColumn("_first", first).filter("list_no = _first").drop("_first")
    place = F.row_number().over(Window.partitionBy("question_id").orderBy("list_no", "rank"))
    return kept.withColumn("position", place.cast("long"))


def reordered(ranked: DataFrame, orders: DataFrame) -> DataFrame:
    """Apply 1-based orders: repeated numbers repeat a chunk, missing ones drop it."""
    wanted = orders.select(
        "question_id", F.posexplode("order").alias("_at", "rank")
    ).withColumn("rank", F.col("rank").cast("long"))
    return wanted.join(ranked, ["question_id", "rank"]).select(
        "question_id", (F.col("_at") + 1).cast("long").alias("position"), "chunk_id", "rank")


def nearest_lists(chunks: DataFrame, queries: DataFrame, k: int, lists: int = 3) -> DataFrame:
    """Several vector searches per question in one scan: ``queries`` also has list_no (1..)."""
    width = lists + 1
    keyed = queries.select((F.col("question_id") * width + F.col("list_no")).alias("question_id"), "vector")
    found = nearest(chunks, keyed, k)
    return found.select(
        F.floor(F.col("question_id") / width).alias("question_id"),
        F.pmod("question_id", F.lit(width)).cast("int").alias("list_no"),
        "rank", "chunk_id", "distance")


def retrieved_lists(chunks: DataFrame, queries: DataFrame, terms: DataFrame, k: int = fixed.SEARCHED,
                    library: DataFrame | None = None) -> DataFrame:
    """The results of three vector searches (lists 1..3) and one term search (list 4), with texts.

    Terms are searched in ``library`` (chunk_id, text, source), which also holds
    texts without a vector; by default in the chunks.
    """
    library = chunks if library is None else library
    by_terms = lexical(library, terms).select(
        "question_id", F.lit(4).alias("list_no"), "rank", "chunk_id",
        F.lit(None).cast("double").alias("distance"))
    found = nearest_lists(chunks, queries, k).unionByName(by_terms)
    n_results = queries.count() * k + terms.count() * fixed.LEXICAL_TOP
    return with_texts(found, library, n_results)


def hybrid(chunks: DataFrame, queries: DataFrame, terms: DataFrame, keep: int = fixed.RETRIEVED,
           k: int = fixed.SEARCHED, library: DataFrame | None = None) -> DataFrame:
    """Three vector searches and a term search, merged, reranked and cut to ``keep``.

    ``queries``: question_id, list_no (1..3), vector. The reranker counts the
    question's terms in the text, then prefers near vectors, then earlier places.
    """
    found = merged(retrieved_lists(chunks, queries, terms, k, library))
    scored = found.join(terms, "question_id").withColumn(
        "score", term_score(F.col("text"), F.col("terms"), fixed.MAX_TERMS))
    order = Window.partitionBy("question_id").orderBy(
        F.desc("score"), F.asc_nulls_last("distance"), "position")
    return (
        scored.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= keep)
        .select("question_id", F.col("rank").cast("long").alias("rank"), "chunk_id", "score", "source", "text")
    )


def keyword_ranks(questions: DataFrame, retrieved: DataFrame) -> DataFrame:
    """Per question and keyword: the ranks of the retrieved chunks that contain it.

    ``questions``: question_id, keywords. ``retrieved``: question_id, rank, text.
    Questions without results keep their keywords with no ranks.
    """
    lowered = F.lower("text")
    hits = F.filter(
        F.transform("keywords", lambda kw, i: F.when(lowered.contains(F.lower(kw)), i)),
        lambda i: i.isNotNull())
    found = (
        retrieved.join(questions, "question_id")
        .select("question_id", "rank", F.explode(hits).alias("place"))
        .groupBy("question_id", "place")
        .agg(F.sort_array(F.collect_list("rank")).alias("ranks"))
    )
    wanted = questions.select("question_id", F.posexplode("keywords").alias("place", "keyword"))
    return wanted.join(found, ["question_id", "place"], "left").withColumn(
        "ranks", F.coalesce("ranks", F.array().cast("array<bigint>")))


def keyword_scores(ranks: DataFrame, depth: int = fixed.NDCG_DEPTH) -> DataFrame:
    """Reciprocal rank over all results and binary nDCG at ``depth`` per keyword.

    The ideal order is that of the results found, so nothing found scores 0.
    """
    def gain(positions):
        return F.aggregate(
            positions, F.lit(0.0), lambda total, r: total + 1 / F.log2(r.cast("double") + 1))

    within = F.filter("ranks", lambda r: r <= depth)
    n = F.size(within)
    ideal = gain(F.when(n > 0, F.sequence(F.lit(1), n)))
    return ranks.select(
        "question_id", "keyword",
        F.when(F.size("ranks") > 0, 1 / F.element_at("ranks", 1)).otherwise(0.0).alias("reciprocal_rank"),
        F.when(n > 0, gain(within) / ideal).otherwise(0.0).alias("ndcg"),
    )


def retrieval_scores(questions: DataFrame, scores: DataFrame) -> DataFrame:
    """Per question: mean reciprocal rank, mean nDCG, keywords found and coverage in percent."""
    per_question = scores.groupBy("question_id").agg(
        F.avg("reciprocal_rank").alias("mrr"), F.avg("ndcg").alias("ndcg"),
        F.count_if(F.col("reciprocal_rank") > 0).alias("keywords_found"),
        F.count(F.lit(1)).alias("total_keywords"))
    zero = F.lit(0)
    return questions.select("question_id", "label").join(per_question, "question_id", "left").select(
        "question_id", "label",
        F.coalesce("mrr", F.lit(0.0)).alias("mrr"), F.coalesce("ndcg", F.lit(0.0)).alias("ndcg"),
        F.coalesce("keywords_found", zero).alias("keywords_found"),
        F.coalesce("total_keywords", zero).alias("total_keywords"),
        F.coalesce(F.col("keywords_found") * 100 / F.col("total_keywords"), F.lit(0.0)).alias("coverage"),
    )


def group_label(category, final_decision):
    """The category, or the final decision where there is no category of its own."""
    own = F.nullif(F.nullif(category, F.lit("uncategorized")), F.lit(""))
    return F.coalesce(own, final_decision, F.lit("uncategorized"))
