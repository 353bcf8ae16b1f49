"""Documents cut into chunks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed

HELD_CHARS = 1 << 20  # of chunks, before they leave a task
SEPARATORS = ("\n\n", "\n", " ", "")


def _pieces(text: str, size: int, separators: tuple[str, ...]) -> list[str]:
    """Consecutive pieces of at most ``size`` that add up to the text.

    Cut at the coarsest separator that occurs; only pieces still too long are
    cut at finer ones, at last into characters, so that chunks overlap in any text.
    Each piece keeps its separator at the front.
    """
    if len(text) <= size:
        return [text]
    separator = next(s for s in separators if s in text)
    if separator == "":
        return list(text)
    finer = separators[separators.index(separator) + 1 :]
    parts = text.split(separator)
    result = []
    for i, part in enumerate(parts):
        whole = part if i == 0 else separator + part
        result.extend([whole] if len(whole) <= size else _pieces(whole, size, finer))
    return [piece for piece in result if piece]


def recursive_spans(text: str, size: int = fixed.CHUNK_CHARS, overlap: int = fixed.CHUNK_OVERLAP) -> list[tuple[int, int]]:
    """Where the chunks of ``recursive_chunks`` begin and end in the text."""
    pieces = _pieces(text, size, SEPARATORS)
    spans, start, begin, end = [], 0, 0, 0
    for at, piece in enumerate(pieces):
        if end - begin + len(piece) > size:
            spans.append((begin, end))
            while start < at and (end - begin > overlap or end - begin + len(piece) > size):
                begin += len(pieces[start])
                start += 1
        end += len(piece)
    spans.append((begin, end))
    chunks = [(begin, text[begin:end]) for begin, end in spans]
    bare = [(begin + len(chunk) - len(chunk.lstrip()), chunk.strip()) for begin, chunk in chunks]
    return [(begin, begin + len(chunk)) for begin, chunk in bare if chunk]


def recursive_chunks(text: str, size: int = fixed.CHUNK_CHARS, overlap: int = fixed.CHUNK_OVERLAP) -> list[str]:
    """Pieces packed greedily up to ``size``; each chunk starts with the last ``overlap`` at most."""
    return [text[begin:end] for begin, end in recursive_spans(text, size, overlap)]


def chunk_table(documents: DataFrame, chunker: Callable[[str], list[str]] = recursive_chunks) -> DataFrame:
    """(doc_id, chunk_no, text) by any function from one text to its chunks.

    A task holds one batch of texts as Arrow has it and the chunks of ``HELD_CHARS``.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, numbers, chunks, held = [], [], [], 0

        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(numbers, pa.int64()), pa.array(chunks, pa.string())],
                names=["doc_id", "chunk_no", "text"])

        for batch in batches:
            for key, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                parts = chunker(text.as_py() or "")
                ids += [key.as_py()] * len(parts)
                numbers += range(len(parts))
                chunks += parts
                held += sum(map(len, parts))
                if held >= HELD_CHARS:
                    yield batch_of()
                    ids, numbers, chunks, held = [], [], [], 0
        if chunks:
            yield batch_of()

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        cut, "doc_id long, chunk_no long, text string")


def window_chunks(documents: DataFrame, words: int, overlap: int) -> DataFrame:
    """(doc_id, chunk_no, text) as windows of ``words`` words that share ``overlap``."""
    step = words - overlap
    split = F.filter(F.split("text", r"\s+"), lambda w: w != "")
    last = F.greatest(F.ceil((F.size("_w") - overlap) / step), F.lit(1)).cast("int") - 1
    windows = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice("_w", i * step + 1, words), " "))
    return (
        documents.select("doc_id", split.alias("_w"))
        .select("doc_id", F.posexplode(windows).alias("chunk_no", "text"))
        .filter("text <> ''")  # a text without words has one empty window
        .withColumn("chunk_no", F.col("chunk_no").cast("long"))
    )


def target_chunks(text: Column) -> Column:
    """How many chunks a text should at least give."""
    return F.floor(F.length(text) / fixed.CHUNK_TARGET_CHARS).cast("long") + 1


def headline(text: Column) -> Column:
    return F.split_part(text, F.lit("\n"), F.lit(1))


def first_sentence(text: Column) -> Column:
    return F.regexp_extract(text, r"^(?s)(.*?[.!?])(?:\s|$)", 1)


def page_content(text: Column) -> Column:
    """Headline, summary and the text itself, blank lines between."""
    return F.concat_ws("\n\n", headline(text), first_sentence(text), text)
