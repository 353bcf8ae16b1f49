"""Substring search with an inverted index of character trigrams.

Building reads each text once. Texts that follow each other become a segment of at most
``SEGMENT_BYTES``: its lower-cased texts, and a row for each different trigram (and single letter and pair, for
short terms) with the sorted chunks that have it. A question visits the segments that
have the rarest gram of one of its terms. There the lists of all grams of a term are
intersected, the texts of what is left decide, and only results leave the task. Terms,
visits and segments are rows that meet in joins: nothing is collected, and more
questions mean more rows, not more scans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.session import staged

GRAM = 3
ASKED_BLOCK, SLICE_ROWS = 4096, 4096
SEGMENT_BYTES = 4 << 20  # of the texts of a segment
SCAN_ABOVE = 4  # candidates a text from which on all texts are read
_BITS = 21  # of a code point


def grams_of(text: str) -> np.ndarray:
    """The different grams of one to three signs of a text, as numbers."""
    signs = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64) + 1
    out, code = [], signs
    for size in range(1, GRAM + 1):
        if size > 1:
            code = code[:-1] << _BITS | signs[size - 1:]
        out.append(np.unique(code))
        if len(code) < 2:
            break
    return np.concatenate(out)


def _cuts(texts: pa.Array) -> list[int]:
    """Where slices of ``SEGMENT_BYTES`` begin, and the end; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    cuts, held = [0], 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > SEGMENT_BYTES:
            cuts.append(i)
            held = 0
        held += size
    return [*cuts, len(sizes)]


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId() << 32, 0
    for batch in batches:
        cuts = _cuts(batch.column("text")) if len(batch) else []
        for begin, end in zip(cuts[:-1], cuts[1:], strict=True) if cuts else ():
            yield from _segment(part | number, batch.slice(begin, end - begin))
            number += 1


def _segment(number: int, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    found = [grams_of(text) if text else np.zeros(0, dtype=np.int64) for text in batch.column("text").to_pylist()]
    order = np.argsort(batch.column("chunk_id").to_numpy(), kind="stable")
    ids = np.repeat(batch.column("chunk_id").to_numpy()[order], [len(found[i]) for i in order])
    grams = np.concatenate([found[i] for i in order])
    by_gram = np.argsort(grams, kind="stable")
    grams, ids = grams[by_gram], ids[by_gram]
    begins = np.flatnonzero(np.diff(grams, prepend=-1))
    lists = pa.ListArray.from_arrays(pa.array(np.append(begins, len(ids)), pa.int32()), pa.array(ids))
    names = ["segment", "gram", "chunks", "chunk_id", "text"]
    count, size = len(begins), len(batch)
    yield pa.RecordBatch.from_arrays([
        pa.array(np.full(count, number)), pa.array(grams[begins]), lists, pa.nulls(count, pa.int64()),
        pa.nulls(count, pa.string())], names=names)
    yield pa.RecordBatch.from_arrays([
        pa.array(np.full(size, number)), pa.nulls(size, pa.int64()), pa.nulls(size, pa.list_(pa.int64())),
        batch.column("chunk_id"), batch.column("text").cast(pa.string())], names=names)


def _longest_grams(term: str) -> list[int]:
    """The trigrams of a term, or what a shorter one has; '' has none."""
    own = grams_of(term) if term else np.zeros(0, dtype=np.int64)
    return own[own >> _BITS * (min(len(term), GRAM) - 1) > 0].tolist() if term else []


def _term_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [_longest_grams(term) for term in batch.column("term").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("term"), pa.array(lists, pa.list_(pa.int64()))], names=["term", "grams"])


def postings(chunks: DataFrame) -> DataFrame:
    """The index of ``chunk_id, text``, in one scan; to be written before it is searched."""
    texts = chunks.select(F.col("chunk_id").cast("long").alias("chunk_id"), F.lower("text").alias("text")).filter(
        "text IS NOT NULL")
    return texts.mapInArrow(_segments, "segment long, gram long, chunks array<long>, chunk_id long, text string")


def _common(lists: list[np.ndarray]) -> np.ndarray:
    """What all sorted lists have."""
    lists = sorted(lists, key=len)
    left = lists[0]
    for other in lists[1:]:
        if not len(left):
            break
        left = left[other[np.minimum(np.searchsorted(other, left), len(other) - 1)] == left]
    return left


class Segment:
    """The texts and postings of one segment; texts are numbered in order of their chunks."""

    def __init__(self, rows: pa.Table):
        texts, lists = rows.filter(pc.is_null(rows["gram"])), rows.filter(pc.is_valid(rows["gram"]))
        texts = texts.take(pc.sort_indices(texts, [("chunk_id", "ascending")]))
        self.chunks, self.texts = texts["chunk_id"].to_numpy(), texts["text"].to_pylist()
        chunks = lists["chunks"].combine_chunks()
        self._places = np.searchsorted(self.chunks, chunks.flatten().to_numpy())
        self._bounds = np.concatenate([[0], np.cumsum(chunks.value_lengths().to_numpy())]).astype(np.int64)
        self._at = {gram: i for i, gram in enumerate(lists["gram"].to_pylist())}

    def _near(self, term: str) -> np.ndarray:
        """The texts that have all grams of a term."""
        at = [self._at.get(gram) for gram in _longest_grams(term)]
        if None in at:
            return np.zeros(0, dtype=np.int64)
        return _common([self._places[self._bounds[i]:self._bounds[i + 1]] for i in at]) if at else np.arange(len(self.texts))

    def with_terms(self, terms: list[str]) -> dict[str, np.ndarray]:
        """The texts that contain each lower-cased term; an empty one is in all."""
        if not self._at:  # a plain slice of texts
            return {"": np.arange(len(self.texts))} | self._scanned([term for term in terms if term])
        found = {term: self._near(term) for term in terms}
        unsure = [term for term in terms if len(term) > GRAM and len(found[term])]
        if sum(len(found[term]) for term in unsure) > SCAN_ABOVE * len(self.texts):
            return found | self._scanned(unsure)  # cheaper to read each text once for all of them
        return found | {term: np.array([i for i in found[term].tolist() if term in self.texts[i]], dtype=np.int64)
                        for term in unsure}

    def _scanned(self, terms: list[str]) -> dict[str, np.ndarray]:
        search = _searcher(terms)
        hits = [np.array(search(text), dtype=np.int64) for text in self.texts]
        which = np.repeat(np.arange(len(hits)), [len(one) for one in hits])
        terms_hit = np.concatenate(hits) if hits else np.zeros(0, dtype=np.int64)
        order = np.argsort(terms_hit, kind="stable")
        parts = np.split(which[order], np.cumsum(np.bincount(terms_hit, minlength=len(terms)))[:-1])
        return dict(zip(terms, parts, strict=True))


def _searcher(terms: list[str]):
    """text -> numbers of the different terms it contains, in one pass over the text."""
    try:
        import ahocorasick
    except ImportError:  # slower, same result
        return lambda text: [i for i, term in enumerate(terms) if term in text]
    automaton = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        automaton.add_word(term, i)
    automaton.make_automaton()
    return lambda text: list({i for _, i in automaton.iter(text)})


def _counts(key: tuple, segment: pa.Table, terms: pa.Table) -> pa.Table:
    names = terms["term"].to_pylist()
    found = Segment(segment).with_terms(names)
    return pa.table({"term": pa.array(names, pa.string()), "n_chunks": pa.array(
        [len(found[term]) for term in names], pa.int64())})


def _best(top: int):
    def apply(key: tuple, segment: pa.Table, questions: pa.Table) -> pa.Table:
        here, lists = Segment(segment), questions["terms"].to_pylist()
        found = here.with_terms(sorted({term for terms in lists for term in terms}))
        out: list[np.ndarray] = [np.zeros((0, 3), dtype=np.int64)]
        for question, terms in zip(questions["question_id"].to_pylist(), lists, strict=True):
            # a term listed twice counts twice
            scores = np.bincount(np.concatenate([found[term] for term in terms]).astype(np.int64), minlength=len(here.texts))
            best = np.lexsort((here.chunks, -scores))[:top]
            best = best[scores[best] > 0]
            out.append(np.stack([np.full(len(best), question), here.chunks[best], scores[best]], axis=1))
        rows = np.concatenate(out)
        return pa.table({name: rows[:, i] for i, name in enumerate(("question_id", "chunk_id", "score"))})

    return apply


def _visits(index: DataFrame, asked: DataFrame, terms: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The rows of the index that ``terms`` (``key, term``) need, and ``asked`` with the segments to visit."""
    different = staged(terms.select("term").distinct().mapInArrow(_term_grams, "term string, grams array<long>"), "terms")
    grams = different.select("term", F.explode("grams").alias("gram"))
    sizes = index.filter("gram IS NOT NULL").groupBy("gram").agg(F.sum(F.size("chunks")).alias("n"))
    # a gram that no text has excludes its term
    weighed = grams.join(sizes, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = weighed.groupBy("term").agg(F.min(F.struct("n", "gram"))["gram"].alias("gram"))
    places = rarest.join(index.select("gram", "segment"), "gram").select("term", "segment")
    everywhere = different.filter("term = ''").select("term", F.lit(True).alias("all")).join(
        index.select("segment").distinct().withColumn("all", F.lit(True)), "all").select("term", "segment")
    visits = asked.join(terms.join(places.union(everywhere), "term").select(key, "segment").distinct(), key)
    needed = index.join(grams.select(F.col("gram").alias("needed")).distinct(), F.col("gram") == F.col("needed"), "left")
    return needed.filter("gram IS NULL OR needed IS NOT NULL").drop("needed"), visits


def _slices(chunks: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All texts in slices of a bounded size, without postings, and ``asked`` once for each slice."""
    texts = chunks.select(F.col("chunk_id").cast("long").alias("chunk_id"), F.lower("text").alias("text")).filter(
        "text IS NOT NULL")
    parts = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    count = max(parts, -(-texts.count() // SLICE_ROWS))
    slices = texts.select(
        F.pmod(F.xxhash64("chunk_id"), F.lit(count)).alias("segment"), F.lit(None).cast("long").alias("gram"),
        F.expr("cast(null as array<long>)").alias("chunks"), "chunk_id", "text")
    return slices, asked.withColumn("segment", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))))


def _met(chunks: DataFrame, asked: DataFrame, terms: DataFrame, index: DataFrame | None, key: str, function,
         schema: str) -> DataFrame:
    """``asked`` (``key`` and more) met with the texts that can hold one of its ``terms``."""
    needed, visits = _slices(chunks, asked) if index is None else _visits(index, asked, terms, key)
    blocks = max(1, -(-asked.count() // ASKED_BLOCK))
    needed = needed.withColumn("block", F.explode(F.lit(list(range(blocks)))))
    visits = visits.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"))
    by = ["segment", "block"]
    return needed.groupBy(*by).cogroup(visits.groupBy(*by)).applyInArrow(function, schema)


def term_counts(chunks: DataFrame, terms: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """``term, n_chunks``: how many chunks contain each different term, ignoring case; terms in none are left out.

    ``index`` is the written result of ``postings``; without it all texts are read once
    for each block of terms. An empty term is in every text, null terms and texts are in none.
    """
    wanted = staged(terms.select(F.lower("term").alias("term")).filter("term IS NOT NULL").distinct(), "wanted")
    found = _met(chunks, wanted, wanted, index, "term", _counts, "term string, n_chunks long")
    return found.groupBy("term").agg(F.sum("n_chunks").alias("n_chunks")).filter("n_chunks > 0")


def best_by_terms(chunks: DataFrame, questions: DataFrame, top: int, index: DataFrame | None = None) -> DataFrame:
    """``question_id, chunk_id, score``: the ``top`` chunks of each segment by how many of ``terms`` they contain."""
    lowered = F.filter(F.transform("terms", lambda term: F.lower(term)), lambda term: term.isNotNull())
    asked = staged(questions.select(F.col("question_id").cast("long").alias("question_id"), lowered.alias("terms")).filter(
        F.size("terms") > 0), "asked")
    terms = asked.select("question_id", F.explode("terms").alias("term"))
    return _met(chunks, asked, terms, index, "question_id", _best(top), "question_id long, chunk_id long, score long")
