"""Outside code as table functions: each says from its arguments which columns it will give.

    SELECT d.doc_id, c.* FROM documents d, LATERAL chunks(d.text, 500, 200) c
    SELECT * FROM embedded_groups(TABLE(SELECT doc_id, text FROM chunks) PARTITION BY doc_id, 'text', 64)
    SELECT d.doc_id, t.* FROM documents d, LATERAL vocabulary(d.text, array('the', 'of')) t

A function is a plug-in (a name of ``CHUNKERS``, ``EMBEDDERS``, ``TOKENIZERS`` or one the
user adds with ``register``) behind one of three shapes: a text to its chunks, a group
of rows to one vector, a text to numbered tokens. ``analyze`` refuses arguments that
cannot work before a task starts, and computes the schema, so that further columns
(places, tokens) are there only where they are asked for.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructType,
)
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, PartitioningColumn

from pricewright import fixed_values as fixed
from pricewright.operators.chunking import recursive_spans

Span = tuple[int, int]
WORD = re.compile(r"\w{2,}")


def constant(argument: AnalyzeArgument, name: str, kind: type) -> object:
    """The value of an argument that must be known before a row is read."""
    if not argument.isConstantExpression or not isinstance(argument.value, kind):
        raise ValueError(f"{name} must be a constant {kind.__name__}")
    return argument.value


def of_type(argument: AnalyzeArgument, name: str, kind: type[DataType]) -> None:
    if argument.isTable or not isinstance(argument.dataType, kind):
        raise ValueError(f"{name} must be a {kind.__name__}")


def chunks_function(spans: Callable[[str, int, int], list[Span]]) -> type:
    """Table function ``(text, size, overlap[, places])`` of a chunker that gives spans of its text.

    Gives ``chunk_no, text`` and, with ``places``, ``start, length``. A null text has no chunks.
    """

    class Chunks:
        @staticmethod
        def analyze(text: AnalyzeArgument, size: AnalyzeArgument, overlap: AnalyzeArgument,
                    places: AnalyzeArgument | None = None) -> AnalyzeResult:
            of_type(text, "text", StringType)
            if not 0 <= constant(overlap, "overlap", int) < constant(size, "size", int):
                raise ValueError("overlap must be 0 or more and below size")
            schema = StructType().add("chunk_no", LongType()).add("text", StringType())
            if places is not None and constant(places, "places", bool):
                schema = schema.add("start", LongType()).add("length", LongType())
            return AnalyzeResult(schema)

        def eval(self, text: str | None, size: int, overlap: int, places: bool = False) -> Iterator[tuple]:
            for number, (start, end) in enumerate(spans(text, size, overlap) if text else ()):
                row = (number, text[start:end])
                yield (*row, start, end - start) if places else row

    return Chunks


def embedded_function(embedder: Callable[[str, int], np.ndarray]) -> type:
    """Table function ``(TABLE ... PARTITION BY key, column, width)``: the mean vector of each group's texts.

    Gives the partitioning key as ``key``, how many texts the group has and ``vector``. A
    group is read row by row and held as one sum, whatever its size. Null texts count
    as texts without words.
    """

    class EmbeddedGroups:
        def __init__(self, _analyzed: AnalyzeResult | None = None):
            self.key, self.sum, self.n = None, None, 0

        @staticmethod
        def analyze(rows: AnalyzeArgument, key: AnalyzeArgument, column: AnalyzeArgument,
                    width: AnalyzeArgument) -> AnalyzeResult:
            if not rows.isTable:
                raise ValueError("the first argument must be a table")
            names = {field.name: field.dataType for field in rows.dataType.fields}
            by, text = constant(key, "key", str), constant(column, "column", str)
            if by not in names or not isinstance(names.get(text), StringType):
                raise ValueError(f"the table needs {by} and a text column {text}")
            if constant(width, "width", int) < 1:
                raise ValueError("width must be positive")
            schema = StructType().add("key", names[by]).add("n_texts", LongType()).add("vector", ArrayType(DoubleType()))
            return AnalyzeResult(schema, partitionBy=[PartitioningColumn(by)])

        def eval(self, rows: Row, key: str, column: str, width: int) -> None:
            vector = embedder(rows[column] or "", width)
            self.key, self.n = rows[key], self.n + 1
            self.sum = vector if self.sum is None else self.sum + vector

        def terminate(self) -> Iterator[tuple]:
            if self.n:
                yield self.key, self.n, (self.sum / self.n).tolist()

    return EmbeddedGroups


def tokens_function(split: Callable[[str], list[str]]) -> type:
    """Table function ``(text, vocabulary[, words])``: numbered tokens with their place in a constant vocabulary.

    Gives ``position, token_id`` and, with ``words``, ``token``. Unknown words have the id of
    the vocabulary's size. A null text has no tokens.
    """

    class Tokens:
        def __init__(self):
            self.known: dict[str, int] | None = None

        @staticmethod
        def analyze(text: AnalyzeArgument, vocabulary: AnalyzeArgument,
                    words: AnalyzeArgument | None = None) -> AnalyzeResult:
            of_type(text, "text", StringType)
            known = constant(vocabulary, "vocabulary", list)
            if len(set(known)) < len(known):
                raise ValueError("a word of the vocabulary stands there twice")
            schema = StructType().add("position", LongType()).add("token_id", LongType())
            return AnalyzeResult(schema.add("token", StringType()) if words is not None and constant(words, "words", bool)
                                 else schema)

        def eval(self, text: str | None, vocabulary: list[str], words: bool = False) -> Iterator[tuple]:
            if self.known is None:
                self.known = {word: number for number, word in enumerate(vocabulary)}
            for position, token in enumerate(split(text or "")):
                row = (position, self.known.get(token, len(self.known)))
                yield (*row, token) if words else row

    return Tokens


def lower_words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def hashed_words_vector(text: str, width: int) -> np.ndarray:
    """How many words fall on each of ``width`` places by the first 32 bits of their MD5, stop words left out."""
    stops = set(fixed.STOP_WORDS)
    places = [int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % width for word in lower_words(text) if word not in stops]
    return np.bincount(places, minlength=width).astype(np.float64)


CHUNKERS: dict[str, Callable] = {"chunks": recursive_spans}
EMBEDDERS: dict[str, Callable] = {"embedded_groups": hashed_words_vector}
TOKENIZERS: dict[str, Callable] = {"vocabulary": lower_words}


def register(spark: SparkSession, chunkers: dict[str, Callable] | None = None,
             embedders: dict[str, Callable] | None = None, tokenizers: dict[str, Callable] | None = None) -> None:
    """Name table functions in a session: the package's own and any plug-ins given."""
    shapes = [(chunks_function, {**CHUNKERS, **(chunkers or {})}), (embedded_function, {**EMBEDDERS, **(embedders or {})}),
              (tokens_function, {**TOKENIZERS, **(tokenizers or {})})]
    for shape, plugins in shapes:
        for name, plugin in plugins.items():
            spark.udtf.register(name, F.udtf(shape(plugin)))
