"""Table functions: computed schemas, refused arguments, groups and plug-ins."""

import numpy as np
import pytest
from pyspark.errors import AnalysisException

from __spark_entry__ import PLANS
from pricewright.operators.chunking import recursive_chunks, recursive_spans
from pricewright.operators.table_functions import hashed_words_vector, register

TEXTS = ["one two\n\nthree " * 40, "x" * 1200, "", None, " \n ", "short"]


@pytest.fixture
def documents(spark):
    register(spark)
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")


def test_schema_follows_the_arguments(spark, documents):
    plain = spark.sql("SELECT c.* FROM {d} d, LATERAL chunks(d.text, 100, 20) c", d=documents)
    placed = spark.sql("SELECT c.* FROM {d} d, LATERAL chunks(d.text, 100, 20, true) c", d=documents)
    assert plain.columns == ["chunk_no", "text"]
    assert placed.columns == ["chunk_no", "text", "start", "length"]


def test_chunks_are_those_of_the_chunker(spark, documents):
    rows = spark.sql("SELECT d.doc_id, d.text AS whole, c.* FROM {d} d, LATERAL chunks(d.text, 100, 20, true) c",
                     d=documents).collect()
    wanted = [(i, n, c) for i, t in enumerate(TEXTS) if t for n, c in enumerate(recursive_chunks(t, 100, 20))]
    assert sorted((r.doc_id, r.chunk_no, r.text) for r in rows) == wanted
    assert all(r.whole[r.start:r.start + r.length] == r.text for r in rows)


def test_spans_overlap_and_cover():
    text = "ab cd. " * 200 + "y" * 700
    spans = recursive_spans(text, 120, 30)
    assert all(end - begin <= 120 for begin, end in spans)
    assert all(0 <= a_end - b_begin <= 30 or not text[a_end:b_begin].strip()
               for (_, a_end), (b_begin, _) in zip(spans, spans[1:], strict=False))
    covered = set().union(*(range(*span) for span in spans))
    assert all(sign.isspace() or at in covered for at, sign in enumerate(text))


@pytest.mark.parametrize("call", [
    "LATERAL chunks(d.text, 20, 20)", "LATERAL chunks(d.text, d.doc_id, 0)", "LATERAL chunks(d.doc_id, 20, 2)",
    "LATERAL vocabulary(d.text, array('a', 'a'))"])
def test_arguments_that_cannot_work_are_refused(spark, documents, call):
    with pytest.raises(AnalysisException):
        spark.sql("SELECT * FROM {d} d, " + call, d=documents).schema


def test_groups_have_mean_vectors(spark, documents):
    rows = spark.createDataFrame([("a", "cat dog"), ("a", None), ("b", "cat"), (None, "dog dog")], "k string, words string")
    got = {r.key: (r.n_texts, r.vector) for r in spark.sql(
        "SELECT * FROM embedded_groups(TABLE({rows}), 'k', 'words', 16)", rows=rows).collect()}
    assert {key: n for key, (n, _) in got.items()} == {"a": 2, "b": 1, None: 1}
    assert np.allclose(got["a"][1], hashed_words_vector("cat dog", 16) / 2)
    with pytest.raises(AnalysisException):
        spark.sql("SELECT * FROM embedded_groups(TABLE({rows}), 'nothing', 'words', 16)", rows=rows).schema


def test_tokens_and_plug_ins(spark, documents):
    register(spark, chunkers={"halves": lambda text, size, overlap: [(0, len(text) // 2), (len(text) // 2, len(text))]},
             tokenizers={"letters": list})
    halves = spark.sql("SELECT c.text FROM LATERAL halves('abcd', 9, 0) c").collect()
    assert [r.text for r in halves] == ["ab", "cd"]
    tokens = spark.sql("SELECT t.* FROM LATERAL letters('abz', array('a', 'b'), true) t").collect()
    assert [(r.position, r.token_id, r.token) for r in tokens] == [(0, 0, "a"), (1, 1, "b"), (2, 2, "z")]
    none = spark.sql("SELECT t.* FROM {d} d, LATERAL vocabulary(d.text, array('one')) t WHERE d.text IS NULL", d=documents)
    assert none.columns == ["position", "token_id"] and none.count() == 0


def test_the_chunker_query_gives_every_chunk_with_its_text(spark, folder):
    got = PLANS["chunker"](spark, folder)
    own = PLANS["chunk_recursive"](spark, folder)
    assert sorted(got.columns) == ["chunk_no", "doc_id", "text"]
    assert sorted(map(tuple, got.select(*own.columns).collect())) == sorted(map(tuple, own.collect()))
