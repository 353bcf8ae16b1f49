import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewright.operators import cells, trigrams
from pricewright.operators.retrieval import (
    group_label,
    hybrid,
    keyword_ranks,
    keyword_scores,
    lexical,
    merged,
    nearest,
    reordered,
    retrieval_scores,
)
from pricewright.session import staged


def _vectors(n, seed):
    points = np.random.default_rng(seed).normal(size=(n, 8)).round(2)
    points[n // 3 : 2 * n // 3] = points[0]  # a third are copies
    return points


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("block, rows", [(4, 10), (4096, 1024)])
def test_nearest_equals_brute_force(spark, monkeypatch, metric, block, rows):
    monkeypatch.setattr(cells, "CELL_ROWS", rows)
    monkeypatch.setattr(cells, "PART_ROWS", 3 * rows)
    chunks, asked = _vectors(120, 1), _vectors(15, 2)
    asked[1] = chunks[0]
    chunk_rows = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(chunks)], "chunk_id long, vector array<double>").repartition(5)
    query_rows = spark.createDataFrame(
        [(i, v.tolist()) for i, v in enumerate(asked)], "question_id long, vector array<double>")
    got = {(r.question_id, r.rank): (r.chunk_id, r.distance)
           for r in nearest(chunk_rows, query_rows, 7, metric, block).collect()}
    assert len(got) == 15 * 7
    for q, point in enumerate(asked):
        if metric == "l2":
            distance = ((chunks - point) ** 2).sum(axis=1)
        else:
            distance = 1 - chunks @ point / np.linalg.norm(chunks, axis=1) / np.linalg.norm(point)
        order = sorted(range(len(chunks)), key=lambda c: (round(distance[c], 9), c))[:7]
        assert [got[q, r + 1][0] for r in range(7)] == order
        assert np.allclose([got[q, r + 1][1] for r in range(7)], distance[order], atol=1e-8)


def test_a_query_reads_few_cells_and_misses_nothing(spark, monkeypatch):
    monkeypatch.setattr(cells, "CELL_ROWS", 50)
    random = np.random.default_rng(3)
    points = (random.normal(size=(20, 6)) * 10)[random.integers(0, 20, 1000)] + random.normal(size=(1000, 6)) * 0.2
    chunks = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)] + [(5000, None)], "chunk_id long, vector array<double>")
    asked = spark.createDataFrame([(i, points[i * 25].tolist()) for i in range(40)], "question_id long, vector array<double>")
    index = cells.build_cells(chunks)
    found, visits = cells.search_cells(index, asked, 5)
    got = {}
    for row in found.orderBy("question_id", "rank").collect():
        got.setdefault(row.question_id, []).append(row.chunk_id)
    for question, own in got.items():
        away = ((points - points[question * 25]) ** 2).sum(axis=1).round(9)
        assert own == sorted(range(1000), key=lambda c: (away[c], c))[:5]
    assert len(got) == 40 and cells.share_read(index, visits) < 0.25
    assert len(index.centres) == 20 and index.sizes.sum() == 1000


def test_queries_without_clusters_travel_once_to_a_group_of_cells(spark, monkeypatch):
    monkeypatch.setattr(cells, "CELL_ROWS", 50)
    points = np.random.default_rng(5).normal(size=(1500, 16))
    chunks = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(points)], "chunk_id long, vector array<double>")
    sent, meet = [], cells._meet
    monkeypatch.setattr(cells, "_meet", lambda *args: sent.append(args[1].count()) or meet(*args))
    index = cells.build_cells(chunks)
    found, visits = cells.search_cells(index, chunks.withColumnRenamed("chunk_id", "question_id"), 6)
    got = {}
    for row in found.orderBy("question_id", "rank").collect():
        got.setdefault(row.question_id, []).append(row.chunk_id)
    away = ((points[:, None] - points[None]) ** 2).sum(axis=2).round(9)
    assert got == {i: np.lexsort((np.arange(1500), own))[:6].tolist() for i, own in enumerate(away)}
    # all cells are open to all queries, but they lie in one group
    assert len(index.centres) == 30 and cells.share_read(index, visits) > 0.9
    assert sent == [1500, 1500]


def test_no_chunks_or_no_queries_give_no_results(spark):
    none = spark.createDataFrame([], "chunk_id long, vector array<float>")
    one = spark.createDataFrame([(1, [1.0, 2.0])], "question_id long, vector array<double>")
    assert nearest(none, one, 3).count() == 0
    assert nearest(one.toDF("chunk_id", "vector"), one.limit(0), 3).count() == 0


@pytest.mark.parametrize("scan_above", [0, 100])
def test_grams_are_a_filter_that_loses_nothing(spark, monkeypatch, scan_above):
    monkeypatch.setattr(trigrams, "SCAN_ABOVE", scan_above)
    monkeypatch.setattr(trigrams, "ASKED_BLOCK", 4)
    texts = ["The CAT", "ca", "cÄt 語x", "tac", "", None, "𝒳yz cat", "catch a tcat"]
    chunks = spark.createDataFrame(list(enumerate(texts)), "chunk_id long, text string")
    terms = [t for t in ("cat", "c", "ca", "語", "Ät", "", None, "the cat", "𝒳Y", "zz", "tcat", "ch a")]
    rows = spark.createDataFrame([(t,) for t in terms], "term string")
    want = {t.lower(): sum(t.lower() in (x or "").lower() for x in texts if x is not None) for t in terms if t is not None}
    index = staged(trigrams.postings(chunks.repartition(3)), "index")
    for own in (None, index):
        got = {r.term: r.n_chunks for r in trigrams.term_counts(chunks, rows, own).collect()}
        assert got == {term: n for term, n in want.items() if n}


def test_a_segment_holds_no_more_text_than_its_bound(spark):
    texts = [f"{mark} abcdefgh " * 120_000 for mark in ("one", "two", "six")] * 2 + ["", None, "x" * 5_000_000, "two"]
    chunks = spark.createDataFrame(list(enumerate(texts)), "chunk_id long, text string").coalesce(1)
    index = staged(trigrams.postings(chunks), "index")
    sizes = index.filter("text IS NOT NULL").groupBy("segment").agg(
        F.sum(F.octet_length("text")).alias("bytes"), F.count_if(F.col("text") != "").alias("n")).collect()
    assert len(sizes) > 3 and all(r.bytes <= trigrams.SEGMENT_BYTES or r.n == 1 for r in sizes)
    terms = spark.createDataFrame([("two",), ("xxxx",), ("six abc",), ("",)], "term string")
    got = {r.term: r.n_chunks for r in trigrams.term_counts(chunks, terms, index).collect()}
    assert got == {"two": 3, "xxxx": 1, "six abc": 2, "": 9}


def test_lexical_equals_brute_force(spark):
    texts = ["The Cat sat", "a dog", "cat and DOG and bird", "", None, "caterpillar"] * 4
    terms = {1: ["cat", "dog"], 2: ["BIRD", "zebra"], 3: [], 4: ["cat", "cat"], 5: ["nothing here"]}
    chunks = spark.createDataFrame(list(enumerate(texts)), "chunk_id long, text string").repartition(3)
    wanted = spark.createDataFrame(list(terms.items()), "question_id long, terms array<string>")
    got = {}
    for r in lexical(chunks, wanted, 5).orderBy("question_id", "rank").collect():
        got.setdefault(r.question_id, []).append((r.chunk_id, r.score))
    want = {}
    for q, words in terms.items():
        scored = [(i, sum(w.lower() in (t or "").lower() for w in words)) for i, t in enumerate(texts)]
        best = sorted([s for s in scored if s[1] > 0], key=lambda s: (-s[1], s[0]))[:5]
        if best:
            want[q] = best
    assert got == want


def test_only_the_first_eight_terms_count(spark):
    chunks = spark.createDataFrame([(1, "i")], "chunk_id long, text string")
    wanted = spark.createDataFrame([(1, list("abcdefghi"))], "question_id long, terms array<string>")
    assert lexical(chunks, wanted).count() == 0


def test_term_counts(spark):
    chunks = spark.createDataFrame([(1, "Abc abc"), (2, "bcd"), (3, None)], "chunk_id long, text string")
    terms = spark.createDataFrame([("abc",), ("BC",), ("zzz",)], "term string")
    got = {r.term: r.n_chunks for r in trigrams.term_counts(chunks, terms).collect()}
    assert got == {"abc": 1, "bc": 2}


def test_merge_drops_only_what_earlier_lists_hold(spark):
    rows = [(1, 1, 1, 10, "a"), (1, 1, 2, 11, "a"), (1, 2, 1, 12, "a"), (1, 2, 2, 13, "b"), (1, 2, 3, 14, "b"),
            (1, 3, 1, 15, "b"), (1, 3, 2, 16, "c")]
    lists = spark.createDataFrame(rows, "question_id long, list_no int, rank long, chunk_id long, text string")
    got = [r.chunk_id for r in merged(lists).orderBy("position").collect()]
    assert got == [10, 11, 13, 14, 16]


def test_reorder_repeats_and_drops(spark):
    ranked = spark.createDataFrame([(1, 1, 10), (1, 2, 20), (1, 3, 30)], "question_id long, rank long, chunk_id long")
    orders = spark.createDataFrame([(1, [3, 1, 1, 9])], "question_id long, order array<int>")
    got = [(r.position, r.chunk_id) for r in reordered(ranked, orders).orderBy("position").collect()]
    assert got == [(1, 30), (2, 10), (3, 10)]


def test_keyword_scores(spark):
    questions = spark.createDataFrame(
        [(1, ["Hit", "late", "never"]), (2, []), (3, ["x"])], "question_id long, keywords array<string>")
    texts = ["a HIT", "hit", *["nothing"] * 8, "too late"]
    found = spark.createDataFrame([(1, i + 1, t) for i, t in enumerate(texts)], "question_id long, rank long, text string")
    scores = keyword_scores(keyword_ranks(questions, found))
    got = {(r.question_id, r.keyword): (r.reciprocal_rank, r.ndcg) for r in scores.collect()}
    assert got[1, "Hit"] == (1.0, 1.0)
    assert got[1, "late"] == (1 / 11, 0.0)  # found, but below the depth
    assert got[1, "never"] == (0.0, 0.0)
    assert got[3, "x"] == (0.0, 0.0)  # nothing retrieved
    labelled = questions.select("question_id", F.lit("l").alias("label"))
    summary = {r.question_id: r for r in retrieval_scores(labelled, scores).collect()}
    assert (summary[1].keywords_found, summary[1].total_keywords) == (2, 3)
    assert math.isclose(summary[1].coverage, 200 / 3)
    assert (summary[2].mrr, summary[2].coverage, summary[2].total_keywords) == (0.0, 0.0, 0)


def test_second_place_ndcg(spark):
    questions = spark.createDataFrame([(1, ["k"])], "question_id long, keywords array<string>")
    found = spark.createDataFrame([(1, 1, "a"), (1, 2, "k"), (1, 4, "k")], "question_id long, rank long, text string")
    row = keyword_scores(keyword_ranks(questions, found)).first()
    want = (1 / math.log2(3) + 1 / math.log2(5)) / (1 + 1 / math.log2(3))
    assert math.isclose(row.ndcg, want)


def test_group_label(spark):
    rows = spark.createDataFrame(
        [("a", "x"), ("uncategorized", "x"), (None, "x"), (None, None)], "c string, d string")
    got = [r[0] for r in rows.select(group_label(F.col("c"), F.col("d"))).collect()]
    assert got == ["a", "x", "x", "uncategorized"]


def test_hybrid_prefers_terms_then_nearness(spark):
    chunks = spark.createDataFrame(
        [(1, "far cat", "s", [9.0, 9.0]), (2, "near", "s", [0.0, 0.0]), (3, "nearer dog cat", "s", [0.1, 0.0])],
        "chunk_id long, text string, source string, vector array<double>")
    queries = spark.createDataFrame([(7, i, [0.0, 0.0]) for i in (1, 2, 3)], "question_id long, list_no int, vector array<double>")
    terms = spark.createDataFrame([(7, ["cat", "dog"])], "question_id long, terms array<string>")
    got = [r.chunk_id for r in hybrid(chunks, queries, terms, keep=3, k=2).orderBy("rank").collect()]
    assert got == [3, 1, 2]
