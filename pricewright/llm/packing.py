"""Vector best-fit packing of token pieces into sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum of
squared piece lengths unless another cost is given). A piece's demand depends on
its length alone, so the choice of bins needs only how many pieces have each
length. That table has at most as many rows as a sequence has tokens, whatever the
size of the corpus; the decreasing best-fit rule runs on it with whole ranges of
equal bins at once, and gives exactly what it would give piece by piece. Pieces
then find their place from their rank among pieces of the same length, which is
computed by sorted ranges without one task seeing them all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.llm.common import texts
from pricewright.llm.tokens import checksum, encoded
from pricewright.operators.ordering import numbered
from pricewright.session import staged


@dataclass(frozen=True)
class Capacity:
    """What one sequence holds, and how its bins are scored (``dot`` or ``norm``)."""

    tokens: int = 1024
    documents: int = 1024
    attention: float | None = None  # none: tokens squared, which never binds
    weights: tuple[float, float, float] = (1.0, 0.0625, 0.25)
    score: str = "norm"


_PIECES = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                     ("length", pa.int64()), ("ids_crc32", pa.int64())])
_PIECES_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int, tokens: int = 1024, keep_ids: bool = False,
                 key: str = "doc_id", text: str = "text", added: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, ``ids`` of each piece.

    Documents longer than ``tokens`` are cut so that all pieces but the first are
    full. A null or empty text is its end id alone.
    """
    tail = np.array([end_id], dtype="<u4").tobytes()
    schema = _PIECES.append(pa.field("ids", pa.binary())) if keep_ids else _PIECES

    def columns(keys: pa.Array, ids: list[bytes]) -> list[pa.Array]:
        owners, places, starts, lengths, sums, parts = [], [], [], [], [], []
        for row, one in enumerate(ids):
            data = one + tail
            size = len(data) // 4
            first = size % tokens or tokens
            begins = [0, *range(first, size, tokens)]
            for place, (a, b) in enumerate(zip(begins, [*begins[1:], size], strict=True)):
                part = data[4 * a:4 * b]
                owners.append(row)
                places.append(place)
                starts.append(a)
                lengths.append(b - a)
                sums.append(checksum(part))
                if keep_ids:
                    parts.append(part)
        out = [keys.take(pa.array(owners, pa.int64())), pa.array(places, pa.int32()), pa.array(starts, pa.int64()),
               pa.array(lengths, pa.int64()), pa.array(sums, pa.int64())]
        return [*out, pa.array(parts, pa.binary())] if keep_ids else out

    rows = texts(docs, key, text)
    ddl = _PIECES_DDL + (", ids binary" if keep_ids else "")
    return rows.mapInArrow(encoded(vocabulary, columns, schema, added), ddl)


def best_fit(counts: dict[int, int], capacity: Capacity,
             cost: Callable[[int], float] | None = None) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, as ranges of ranks.

    Lengths are taken in decreasing order. A piece goes to the bin that fits it under
    every constraint and leaves the least: by ``norm``, the weighted norm of what
    remains after it; by ``dot``, the weighted product of what remains before it with
    the piece's demand. All demands are shares of the capacity. Ties go to the bin
    opened first. Pieces of ``length`` with ranks from ``rank_from`` on go, ``each``
    to a bin, to sequences from ``sequence`` on, the first at ``offset``.
    """
    cost = cost or (lambda length: float(length) ** 2)
    full = np.array([capacity.tokens, capacity.documents, capacity.attention or float(capacity.tokens) ** 2], dtype=float)
    weights = np.array(capacity.weights, dtype=float)
    # ranges of equal bins: first sequence, how many, and what remains of each capacity
    first, many, rest = [], [], []
    opened = 0
    out: dict[str, list[int]] = {name: [] for name in ("length", "rank_from", "each", "sequence", "offset")}

    def put(length: int, rank: int, each: int, sequence: int, used: int) -> None:
        for name, value in zip(out, (length, rank, each, sequence, used), strict=True):
            out[name].append(value)

    for length in sorted(counts, reverse=True):
        demand = np.array([length, 1, cost(length)], dtype=float)
        if (demand > full).any():
            raise ValueError(f"a piece of {length} tokens exceeds an empty sequence")
        left, rank = counts[length], 0
        while left:
            best = -1
            if first:
                remains = np.array(rest)
                fits = (remains >= demand).all(axis=1)
                if fits.any():
                    if capacity.score == "dot":
                        scores = (remains / full) @ (weights * demand / full)
                    else:
                        scores = np.sqrt((weights * ((remains - demand) / full) ** 2).sum(axis=1))
                    scores[~fits] = np.inf
                    best = int(np.argmin(scores))
            if best < 0:  # open as many bins as the remaining pieces fill
                room = int((full // demand).min())
                first.append(opened)
                many.append(-(-left // room))
                rest.append(full.copy())
                opened += many[-1]
                best = len(first) - 1
            each = min(int((rest[best] // demand).min()), left)
            bins = min(many[best], left // each)
            used = int(full[0] - rest[best][0])
            put(length, rank, each, first[best], used)
            filled = rest[best] - each * demand
            if bins < many[best]:
                first.append(first[best] + bins)
                many.append(many[best] - bins)
                rest.append(rest[best])
            many[best], rest[best] = bins, filled
            left, rank = left - bins * each, rank + bins * each
        # bins without room for the smallest piece need no further look
        smallest = min(counts)
        open_bins = [i for i, r in enumerate(rest) if (r >= [smallest, 1, cost(smallest)]).all()]
        first, many, rest = ([column[i] for i in open_bins] for column in (first, many, rest))
    return {name: np.array(values, dtype=np.int64) for name, values in out.items()} | {
        "sequences": np.array([opened])}


def packed(pieces: DataFrame, capacity: Capacity | None = None,
           cost: Callable[[int], float] | None = None) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; ``pieces`` has ``doc_id, piece, length`` and more.

    Rows that repeat a document and piece are packed as often as they occur. An
    empty table gives an empty result.
    """
    capacity = capacity or Capacity()
    counts = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = best_fit(counts, capacity, cost) if counts else {name: np.zeros(0, dtype=np.int64) for name in (
        "length", "rank_from", "each", "sequence", "offset")}
    lengths = np.array(sorted(counts), dtype=np.int64)
    before = np.concatenate([[0], np.cumsum([counts[n] for n in lengths])])[:-1].astype(np.int64)
    # ranges in the order of the global place: by length, then by rank
    place = before[np.searchsorted(lengths, plan["length"])] + plan["rank_from"] if len(lengths) else plan["length"]
    order = np.argsort(place, kind="stable")
    place = place[order]
    each, sequence, offset = (plan[name][order] for name in ("each", "sequence", "offset"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("place").to_numpy() - 1
            found = np.searchsorted(place, at, side="right") - 1
            step = at - place[found]
            length = batch.column("length").to_numpy()
            columns = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "place"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence[found] + step // each[found]),
                 pa.array(offset[found] + step % each[found] * length)],
                names=[*[n for n in batch.schema.names if n != "place"], "sequence_id", "offset"])

    ranked = numbered(pieces, ["length", "doc_id", "piece"], "place")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "place")
    return ranked.mapInArrow(assign, f"{ddl}, sequence_id long, offset long")


def packed_documents(docs: DataFrame, vocabulary: str, end_id: int, capacity: Capacity | None = None,
                     keep_ids: bool = False, key: str = "doc_id", text: str = "text",
                     added: bool = False) -> DataFrame:
    """Cut, tokenise and pack whole documents; ``added`` as for the ``Encoder``."""
    capacity = capacity or Capacity()
    pieces = token_pieces(docs, vocabulary, end_id, capacity.tokens, keep_ids, key, text, added)
    return packed(staged(pieces, "pieces"), capacity)


def sequences(packed_pieces: DataFrame) -> DataFrame:
    """The token ids of each sequence, from packed pieces that kept theirs; one sequence is one bounded group."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda done, part: F.concat(done, part["ids"]))
    return packed_pieces.groupBy("sequence_id").agg(
        joined.alias("ids"), F.sum("length").alias("tokens"), F.count(F.lit(1)).alias("pieces"))
