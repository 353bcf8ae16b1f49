"""Homomorphic multiset hashes of documents.

A paragraph (a line that is not blank) hashes to a wide vector; the fingerprint of a
document is the sum of its paragraphs' vectors. Lanes are sums modulo powers of two,
so the order of paragraphs has no effect, and paragraphs can be put in or taken out
without the rest of the document. A vector has two parts: ``EQUAL_LANES`` 64-bit
lanes from an extendable digest of the paragraph, which tell multisets apart, and
``LIKE_LANES`` 16-bit lanes in which every different run of ``GRAM`` words of the
paragraph adds or takes one, a sketch whose products estimate how much two documents share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.llm.common import shuffle_parts, texts
from pricewright.llm.words import Words, mixed, pieces_of

EQUAL_LANES = 16
LIKE_LANES = 128
GRAM = 3
BLOCK_SLACK = 4
MOST = (1 << 63) - 1


def paragraphs(text: bytes) -> list[bytes]:
    return [line for line in text.split(b"\n") if line.strip()]


def equal_part(lines: list[bytes]) -> np.ndarray:
    """Sum modulo 2 to the 64 of the paragraphs' digests."""
    digests = b"".join(hashlib.shake_128(line).digest(8 * EQUAL_LANES) for line in lines)
    return np.frombuffer(digests, dtype="<u8").reshape(-1, EQUAL_LANES).sum(axis=0, dtype=np.uint64)


def like_parts(lines: list[bytes], owners: np.ndarray, count: int) -> np.ndarray:
    """For each of ``count`` owners the sketch of its paragraphs, modulo 2 to the 16.

    A paragraph of fewer than ``GRAM`` words counts as one run.
    """
    out = np.zeros((count, LIKE_LANES), dtype=np.int64)
    if lines:
        for row, data, offsets in pieces_of(pa.array(lines, pa.large_binary())):
            words = Words(data, offsets)
            hashes = words.hashes()
            counts = np.diff(words.first)
            grams, _ = words.grams(hashes, GRAM)
            line = np.repeat(np.arange(len(counts)), np.maximum(counts - GRAM + 1, 0))
            for size in range(1, GRAM):
                short = np.flatnonzero(counts == size)
                if len(short):
                    whole, at = words.grams(hashes, size)
                    keep = np.isin(at, words.first[short])
                    of = np.searchsorted(words.first, at[keep], side="right") - 1
                    inside = counts[of] == size
                    grams, line = np.concatenate([grams, whole[keep][inside]]), np.concatenate([line, of[inside]])
            _, once = np.unique(mixed(grams ^ (line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))), return_index=True)
            grams, line = grams[once], line[once]
            cell = owners[row + line] * LIKE_LANES + (grams % np.uint64(LIKE_LANES)).astype(np.int64)
            sign = 1 - 2 * ((grams >> np.uint64(40)) & np.uint64(1)).astype(np.int64)
            out += np.bincount(cell, weights=sign, minlength=out.size).astype(np.int64).reshape(out.shape)
    return out.astype(np.uint16)


class Fingerprint:
    """A sum of paragraph vectors; paragraphs can be added and removed."""

    def __init__(self, equal: np.ndarray | None = None, like: np.ndarray | None = None):
        self.equal = np.zeros(EQUAL_LANES, dtype=np.uint64) if equal is None else equal
        self.like = np.zeros(LIKE_LANES, dtype=np.uint16) if like is None else like

    @classmethod
    def of(cls, text: str) -> Fingerprint:
        lines = paragraphs(text.encode())
        return cls(equal_part(lines), like_parts(lines, np.zeros(len(lines), dtype=np.int64), 1)[0])

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.equal + other.equal, self.like + other.like)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.equal - other.equal, self.like - other.like)

    def __str__(self) -> str:
        return encoded(self.equal, self.like)


def encoded(equal: np.ndarray, like: np.ndarray) -> str:
    return equal.astype("<u8").tobytes().hex() + like.astype("<u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, equal: np.ndarray) -> np.ndarray:
    """Of two rows of sketches: 1 where the documents are equal, else twice the product over the squares, 0 to 1."""
    x, y = a.view(np.int16).astype(np.float64), b.view(np.int16).astype(np.float64)
    squares = (x * x).sum(axis=1) + (y * y).sum(axis=1)
    shared = np.divide(2 * (x * y).sum(axis=1), squares, out=np.zeros(len(x)), where=squares > 0)
    return np.where(equal, 1.0, np.clip(shared, 0.0, 1.0))


def fingerprints(texts_: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Both parts of the fingerprint of each text."""
    lines = [paragraphs(text.encode()) for text in texts_]
    owners = np.repeat(np.arange(len(lines)), [len(own) for own in lines])
    equal = np.stack([equal_part(own) for own in lines]) if lines else np.zeros((0, EQUAL_LANES), dtype=np.uint64)
    return equal, like_parts([line for own in lines for line in own], owners, len(lines))


def fingerprinted(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every document; null text has the fingerprint of an empty one, all zeros."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("text").to_pylist()
            equal, like = fingerprints(whole)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([encoded(e, s) for e, s in zip(equal, like, strict=True)], pa.string())],
                names=["doc_id", "fingerprint"])

    return texts(docs, key, text).mapInArrow(apply, "doc_id long, fingerprint string")


def edited_text(text: str, following: str) -> str:
    """The last half of the signs replaced by as many first signs of the following text, or all it has."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_PAIRS_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
_PAIRS = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
CHUNK_CHARS = 1 << 21


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by block and order; each row meets the next row of its block, the last only serves the one before."""

    def results(rows: list[tuple]) -> pa.RecordBatch:
        own = [row[2] for row in rows]
        edited = [edited_text(a, b) for a, b in zip(own[:-1], own[1:], strict=True)]
        equal, like = fingerprints(own)
        new_equal, new_like = fingerprints(edited)
        same = (equal[:-1] == new_equal).all(axis=1) & (like[:-1] == new_like).all(axis=1)
        same_next = (equal[:-1] == equal[1:]).all(axis=1) & (like[:-1] == like[1:]).all(axis=1)
        keep = [i for i in range(len(rows) - 1) if rows[i][0] == rows[i + 1][0] and not rows[i][3]]
        near, following = likeness(like[:-1], new_like, same), likeness(like[:-1], like[1:], same_next)
        return pa.RecordBatch.from_arrays([
            pa.array([rows[i][1] for i in keep], pa.int64()), pa.array([len(own[i]) for i in keep], pa.int64()),
            pa.array([hashlib.sha256(edited[i].encode()).hexdigest() for i in keep], pa.string()),
            pa.array([encoded(equal[i], like[i]) for i in keep], pa.string()),
            pa.array([encoded(new_equal[i], new_like[i]) for i in keep], pa.string()),
            pa.array(near[keep], pa.float64()), pa.array(following[keep], pa.float64())], schema=_PAIRS)

    held: list[tuple] = []
    size = 0
    for batch in batches:
        columns = [batch.column(name) for name in ("block", "doc_id", "text", "visits")]
        for row in zip(*(column.to_pylist() for column in columns), strict=True):
            held.append(row)
            size += len(row[2])
            if size > CHUNK_CHARS and len(held) > 1:
                yield results(held)
                held, size = held[-1:], len(row[2])
    if len(held) > 1:
        yield results(held)


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document with its fingerprint, that of its edited text, and their likeness (see ``_PAIRS_DDL``).

    The edited text takes its last half from the next document in ascending order
    of the key, the last from the first; a document alone is its own next. Documents
    are dealt to blocks of that order by sampled splitters, and each block also gets
    the first document of the one after it, so no row is compared across tasks.
    Null text counts as empty; null keys come first; rows that repeat a key follow
    each other by their text's hash. An empty table gives an empty result.
    """
    rows = texts(docs, key, text)
    blocks = BLOCK_SLACK * shuffle_parts(docs.sparkSession)
    found = rows.select("doc_id").approxQuantile("doc_id", [i / blocks for i in range(1, blocks)], 0.25 / blocks)

    def numbered(borders: list[int], place: str) -> Column:
        """How many borders are at or below a place, found by halves; 0 for a null place."""

        def branch(low: int, high: int) -> str:
            if low == high:
                return str(low)
            middle = (low + high + 1) // 2
            return (f"CASE WHEN {place} >= {borders[middle - 1]}L THEN {branch(middle, high)} "
                    f"ELSE {branch(low, middle - 1)} END")

        return F.expr(branch(0, len(borders)))

    # sampled borders went through doubles: the least identifier from each border on begins its block
    sampled = sorted({min(int(value), MOST) for value in found})
    firsts = rows.groupBy(numbered(sampled, "doc_id").alias("block")).agg(F.min("doc_id").alias("first")).collect()
    known = sorted(row["first"] for row in firsts if row["first"] is not None)
    # identifiers that begin a block: bounded by the number of blocks
    least, splitters = (known[0], known[1:]) if known else (0, [])
    block = numbered(splitters, f"coalesce(doc_id, {least}L)")
    last = len(splitters)
    first_of_all = F.coalesce(F.col("doc_id"), F.lit(least)) == F.lit(least)
    opens = first_of_all | F.coalesce(F.col("doc_id").isin(splitters), F.lit(False))
    visits = F.when(opens, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    dealt = rows.select("*", block.alias("home"), F.explode(visits).alias("visits")).withColumn(
        "block", F.when(~F.col("visits"), F.col("home")).when(F.col("home") == 0, F.lit(last)).otherwise(F.col("home") - 1))
    ordered = (
        dealt.drop("home").withColumn("tie", F.xxhash64("text"))
        .repartition(shuffle_parts(docs.sparkSession), "block")
        .sortWithinPartitions("block", "visits", F.col("doc_id").asc_nulls_first(), "tie").drop("tie")
    )
    return ordered.mapInArrow(_compared, _PAIRS_DDL)
