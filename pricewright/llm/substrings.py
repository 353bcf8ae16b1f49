"""Removal of word windows that occur again, behind a count-min prefilter.

Documents are dealt to blocks, written once and bucketed by block, so that every
later pass meets its decisions without moving a text again. Three passes:

1. Each block hashes its windows into ``DEPTH`` rows of a count-min sketch whose width
   grows with the number of windows. It sends the cells it has touched, as sorted
   gaps, to the owner of that slice of the sketch; owners merge the blocks' sketches.
   Counters stop at two, all that is asked of them. A block learns for each of its
   cells whether it counts two or more; a window is estimated repeated if all its
   cells do. Cells hold every window that falls on them, so none is underestimated.
2. Of windows estimated repeated, blocks send 128 bits of content, and owners of
   slices group those exactly.
3. Each block takes out the words that repeated windows cover.

A block names a window once however often it occurs there, so a passage that all
documents share is one entry per block, and no task sees more than its slice. Buckets
grow with the bytes of all texts and slices with the number of all windows, so that
neither a task's read nor an owner's memory grows with the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.llm.common import shuffle_parts, texts
from pricewright.llm.words import Words, pieces_of, span_hashes
from pricewright.session import scratch_path, staged

WINDOW = 35
DEPTH = 2
CELLS_PER_WINDOW = 4
BLOCK_BYTES = 2 << 20
BUCKET_BYTES = 32 << 20
MOST_BUCKETS = 100_000  # what Spark allows by default
SLICE_WINDOWS = 1 << 22
_SECOND_BASE = 0xA0761D6478BD642F
_SECOND_BYTE_BASE = 0xE7037ED1A0B428DB

_BLOCK_DDL = "block long, doc_id long, text string, windows long"


def _blocks(window: int):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys, column = batch.column("doc_id"), batch.column("text")
            for row, data, offsets in pieces_of(column, BLOCK_BYTES):
                counts = np.diff(Words(data, offsets).first)
                rows = len(counts)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(rows, (part << 32) + at)), keys.slice(row, rows), column.slice(row, rows),
                    pa.array(np.maximum(counts - window + 1, 0))], names=["block", "doc_id", "text", "windows"])
                at += 1

    return apply


class _Windows:
    """All windows of a block: content in 128 bits, both halves from the bytes on, and the word each begins at."""

    def __init__(self, column: pa.Array, window: int):
        _, data, offsets = next(pieces_of(column, 1 << 62))
        self.words = Words(data, offsets)
        hashes = self.words.hashes()
        self.low, self.at = self.words.grams(hashes, window)
        self.high = span_hashes(self.words.hashes(_SECOND_BYTE_BASE), self.at, self.at + window, _SECOND_BASE)

    def cells(self, row: int, width: int) -> np.ndarray:
        return (self.low if row == 0 else self.high) & np.uint64(width - 1)


def _width(windows: int) -> int:
    """Cells of one row of the sketch: a power of two."""
    return 1 << max(10, (CELLS_PER_WINDOW * max(1, windows) - 1).bit_length())


def _sliced(values: np.ndarray, slices: int, width: int) -> list[np.ndarray]:
    """Sorted cells cut into equal slices of the width."""
    bounds = np.searchsorted(values, (np.arange(slices + 1, dtype=np.float64) * (width / slices)).astype(np.uint64))
    return [values[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def _gaps(values: np.ndarray) -> bytes:
    """Sorted values as the first one and the gaps, in two bytes where they fit and else in eight."""
    if not len(values):
        return b""
    gaps = np.diff(values)
    small = bool((gaps < 1 << 16).all())
    return bytes([small]) + values[:1].astype("<u8").tobytes() + gaps.astype("<u2" if small else "<u8").tobytes()


def _from_gaps(data: bytes) -> np.ndarray:
    gaps = np.frombuffer(data, dtype="<u2" if data[0] else "<u8", offset=9).astype(np.uint64)
    return np.cumsum(np.concatenate([np.frombuffer(data, dtype="<u8", offset=1, count=1), gaps]), dtype=np.uint64)


_SENT = pa.schema([("row", pa.int32()), ("slice", pa.int32()), ("block", pa.int64()), ("entries", pa.binary())])
_SENT_DDL = "row int, slice int, block long, entries binary"
_MASK_DDL = "row int, slice int, block long, mask binary"


def _whole_blocks(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[int, pa.Table]]:
    """Rows sorted by block, a block at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        blocks = batch.column("block").to_numpy()
        bounds = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(batch)]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if a == b:
                continue
            if held and held[0].column("block")[0].as_py() != int(blocks[a]):
                yield held[0].column("block")[0].as_py(), pa.Table.from_batches(held).select(names)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield held[0].column("block")[0].as_py(), pa.Table.from_batches(held).select(names)


def _sketches(window: int, width: int, slices: int):
    """Each block's part of the sketch: for each row and slice the cells it has touched."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _whole_blocks(batches, ["text"]):
            found = _Windows(rows["text"].combine_chunks(), window)
            out = [(row, place, block, _gaps(part)) for row in range(DEPTH) for place, part in enumerate(
                _sliced(np.unique(found.cells(row, width)), slices, width)) if len(part)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, field.type) for column, field in zip(zip(*out, strict=True), _SENT, strict=True)],
                    schema=_SENT)

    return apply


def _merged(decode):
    """Entries of all blocks in one slice: which of them more than one block has."""

    def apply(rows: pa.Table) -> pa.Table:
        lists = [decode(entries.as_py()) for entries in rows["entries"]]
        sizes = [len(one) for one in lists]
        values = np.concatenate(lists)
        _, of, counts = np.unique(values, return_inverse=True, return_counts=True)
        again = counts[of] > 1
        masks = [np.packbits(part).tobytes() for part in np.split(again, np.cumsum(sizes)[:-1])]
        return pa.table({"row": rows["row"], "slice": rows["slice"], "block": rows["block"],
                         "mask": pa.array(masks, pa.binary())})

    return apply


def _marks(masks: pa.Table, row: int, parts: list[np.ndarray]) -> np.ndarray:
    """The owners' answers for a block's sorted entries of one row."""
    answers = dict(zip(zip(masks["row"].to_pylist(), masks["slice"].to_pylist(), strict=True), masks["mask"].to_pylist(),
                       strict=True))
    return np.concatenate([
        np.unpackbits(np.frombuffer(answers[row, place], dtype=np.uint8), count=len(part)).astype(bool)
        if len(part) else np.zeros(0, dtype=bool) for place, part in enumerate(parts)])


def _estimated(found: _Windows, masks: pa.Table, width: int, slices: int) -> np.ndarray:
    """Which windows all rows of the merged sketch count at least twice."""
    twice = np.ones(len(found.low), dtype=bool)
    if not len(twice):
        return twice
    for row in range(DEPTH):
        cells, of, counts = np.unique(found.cells(row, width), return_inverse=True, return_counts=True)
        elsewhere = _marks(masks, row, _sliced(cells, slices, width))
        twice &= (elsewhere | (counts > 1))[of]
    return twice


_CONTENT = np.dtype([("low", "<u8"), ("high", "<u8")])


def _contents(found: _Windows, chosen: np.ndarray):
    """Different contents of the chosen windows in order, which one each window has, and how often."""
    values = np.empty(int(chosen.sum()), dtype=_CONTENT)
    values["low"], values["high"] = found.low[chosen], found.high[chosen]
    order = np.lexsort((values["high"], values["low"]))
    ranked = values[order]
    new = np.ones(len(ranked), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    of = np.empty(len(ranked), dtype=np.int64)
    of[order] = np.cumsum(new) - 1
    return ranked[new], of, np.bincount(of, minlength=int(new.sum()))


def _by_low(values: np.ndarray, slices: int) -> list[np.ndarray]:
    bounds = np.searchsorted(values["low"], (np.arange(1, slices, dtype=np.float64) * (2.0 ** 64 / slices)).astype(np.uint64))
    return np.split(values, bounds)


def _candidates(window: int, width: int, slices: int):
    def apply(key: tuple, rows: pa.Table, masks: pa.Table) -> pa.Table:
        found = _Windows(rows["text"].combine_chunks(), window)
        values, _, _ = _contents(found, _estimated(found, masks, width, slices))
        block = key[0].as_py()
        out = [(DEPTH, place, block, part.tobytes()) for place, part in enumerate(_by_low(values, slices)) if len(part)]
        return pa.Table.from_arrays([pa.array([one[i] for one in out], field.type) for i, field in enumerate(_SENT)],
                                    schema=_SENT)

    return apply


def _exact(entries: bytes) -> np.ndarray:
    return np.frombuffer(entries, dtype=_CONTENT)


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def _removed(window: int, width: int, slices: int, digests: bool):
    def apply(key: tuple, rows: pa.Table, masks: pa.Table) -> pa.Table:
        found = _Windows(rows["text"].combine_chunks(), window)
        chosen = _estimated(found, masks, width, slices)
        values, of, counts = _contents(found, chosen)
        again = np.zeros(len(chosen), dtype=bool)
        if len(values):
            again[chosen] = (_marks(masks, DEPTH, _by_low(values, slices)) | (counts > 1))[of]
        words = found.words
        total = len(words.starts)
        step = np.zeros(total + 1, dtype=np.int64)
        np.add.at(step, found.at[again], 1)
        np.add.at(step, found.at[again] + window, -1)
        gone = np.cumsum(step[:total]) > 0
        before = np.concatenate([[0], np.cumsum(gone)])
        out = []
        for key_, a, b in zip(rows["doc_id"].to_pylist(), words.first[:-1], words.first[1:], strict=True):
            lost = int(before[b] - before[a])
            raw = words.data[words.starts[a]:words.ends[b - 1]].tobytes().split() if b > a else []
            kept = b" ".join(raw if not lost else [word for word, out_ in zip(raw, gone[a:b], strict=True) if not out_])
            out.append((key_, int(b - a), lost, hashlib.sha256(kept).hexdigest() if digests else kept.decode()))
        return pa.Table.from_arrays([pa.array([one[i] for one in out], field.type) for i, field in enumerate(_RESULT)],
                                    schema=_RESULT)

    return apply


def without_repeats(docs: DataFrame, window: int = WINDOW, digests: bool = False,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every row.

    Words are runs of signs other than ASCII white space, unchanged. A word goes if
    a window of ``window`` words that covers it also begins anywhere else, in any
    row, the same included. ``kept`` is the rest joined by spaces, or with
    ``digests`` its SHA-256. Null and empty texts have no words; texts shorter than
    a window keep all; repeated rows repeat each other; an empty table gives an
    empty result.
    """
    spark = docs.sparkSession
    parts = shuffle_parts(spark)
    rows = texts(docs, key, text)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = min(MOST_BUCKETS, max(parts, -(-size // BUCKET_BYTES)))
    folder = scratch_path(spark, "blocks")
    name = "blocks_" + folder.rpartition("-")[2]
    rows.mapInArrow(_blocks(window), _BLOCK_DDL).write.bucketBy(buckets, "block").sortBy("block").option(
        "path", folder).option("compression", "zstd").saveAsTable(name)
    blocks = spark.table(name)
    windows = blocks.agg(F.sum("windows")).first()[0] or 0
    spark.sql(f"DROP TABLE {name}")  # leaves the files, which the plan already knows, and no entry in the catalog
    slices = max(parts, -(-windows // SLICE_WINDOWS))
    width = _width(windows)
    by_block = blocks.select("block", "doc_id", "text").groupBy("block")

    sent = blocks.select("block", "text").sortWithinPartitions("block").mapInArrow(
        _sketches(window, width, slices), _SENT_DDL)
    masks = staged(sent.groupBy("row", "slice").applyInArrow(_merged(_from_gaps), _MASK_DDL), "sketch")
    unsure = by_block.cogroup(masks.groupBy("block")).applyInArrow(_candidates(window, width, slices), _SENT_DDL)
    exact = staged(unsure.groupBy("row", "slice").applyInArrow(_merged(_exact), _MASK_DDL), "windows")
    both = masks.union(exact)
    return by_block.cogroup(both.groupBy("block")).applyInArrow(
        _removed(window, width, slices, digests), "doc_id long, n_words long, n_removed long, kept string")
