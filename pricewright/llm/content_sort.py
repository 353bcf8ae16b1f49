"""Exact duplicates by sorting the content.

Sampled splitters cut the order of the normalised bytes into ranges, Spark's
external sort puts equal texts next to each other, and each text is compared in
full with its neighbour. The order is that of the first bytes, then of the digest
of the whole text, then of the text, then of the identifier. The first three keep
equals together; splitters hold the first bytes, the digest and the identifier, so
the sample on the driver is small whatever the length of the texts, and a group of
copies that holds a third of all rows is cut into as many ranges as it needs.
Runs that cross a border are joined by comparing the two texts at the border.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewright.llm.common import ascii_lower, bounded_batches, whole
from pricewright.session import staged

SPLITTER_BYTES = 32

_RUNS = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("run", T.LongType()),
    T.StructField("doc_id", T.LongType()), T.StructField("sha", T.StringType()),
    T.StructField("size", T.LongType()), T.StructField("last", T.LongType()),
    T.StructField("closes", T.BooleanType()), T.StructField("opens_part", T.BooleanType()),
    T.StructField("closes_part", T.BooleanType()), T.StructField("edge", T.StringType()),
])
def _runs_of_equals(carry: bool):
    """Rows of a sorted part to rows with their run; only the row that closes a run keeps its other columns."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run = TaskContext.get().partitionId(), 0
        held, text, opening = None, None, True  # rows of the open run, its text

        def emitted(rows: pa.Table, starts: np.ndarray, last_text: str | None) -> pa.RecordBatch:
            """Rows of closed runs; with ``last_text`` they end the part."""
            nonlocal run, opening, first_text
            count = len(rows)
            sizes = np.diff(np.append(starts, count))
            ends = starts + sizes - 1
            closes = np.zeros(count, dtype=bool)
            closes[ends] = True
            places = np.arange(count)
            ids = rows["doc_id"].combine_chunks()
            edges = [None] * count
            if opening:
                edges[0] = first_text
            if last_text is not None:
                edges[-1] = last_text
            arrays = [
                pa.array(np.full(count, part, dtype=np.int32)), pa.array(run + np.repeat(np.arange(len(sizes)), sizes)),
                ids, rows["digest"].combine_chunks(), pa.array(np.repeat(sizes, sizes)),
                ids.take(pa.array(np.repeat(ends, sizes))), pa.array(closes),
                pa.array((places == 0) & opening), pa.array((places == count - 1) & (last_text is not None)),
                pa.array(edges, pa.string()),
            ]
            names = list(_RUNS.names)
            if carry:
                arrays.append(rows["carried"].combine_chunks().take(pa.array(places, mask=~closes)))
                names.append("carried")
            run, opening, first_text = run + len(sizes), False, None
            return pa.RecordBatch.from_arrays(arrays, names=names)

        first_text = None
        narrow = ["doc_id", "digest", *(["carried"] if carry else [])]
        for batch in batches:
            if not len(batch):
                continue
            norm = batch.column("norm")
            same = np.empty(len(batch), dtype=bool)
            same[0] = held is not None and norm[0].as_py() == text
            same[1:] = pc.equal(norm[1:], norm[:-1]).to_numpy(zero_copy_only=False)
            if held is None:
                first_text = norm[0].as_py()
            text = norm[len(norm) - 1].as_py()
            rows = pa.Table.from_arrays([batch.column(name) for name in narrow], names=narrow)
            if held is not None:
                waiting = len(held)
                rows = pa.concat_tables([held, rows])
                same = np.concatenate([np.arange(waiting) > 0, same])
            starts = np.flatnonzero(~same)
            if starts[-1]:
                yield emitted(rows.slice(0, starts[-1]), starts[:-1], None)
            held = rows.slice(starts[-1])
            if carry and len(held) > 1:  # of an open run only the latest row can stay
                latest = np.arange(len(held)) == len(held) - 1
                slim = held["carried"].combine_chunks().take(pa.array(np.arange(len(held)), mask=~latest))
                held = held.set_column(narrow.index("carried"), "carried", slim)
        if held is not None:
            yield emitted(held, np.zeros(1, dtype=np.int64), text)

    return compare


def equal_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: bool = False) -> DataFrame:
    """One row per row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A to Z. The row with the
    largest identifier stays; a null identifier is smaller than any other, and of
    rows that repeat an identifier one stays. A null text is an empty one, and
    empty texts are equal. An empty table gives an empty result. With ``carry``
    the rows that stay also have the input's columns, in struct ``carried``.
    """
    bounded_batches(docs.sparkSession)
    norm = ascii_lower(whole(text))
    own = F.struct(*[F.col(f"`{name}`") for name in docs.columns]) if carry else whole(text)
    rows = docs.select(
        F.col(key).cast("long").alias("doc_id"), own.alias("carried"), F.sha2(norm, 256).alias("digest"),
        F.substring(F.encode(norm, "UTF-8"), 1, SPLITTER_BYTES).alias("head"))
    # the text travels once: it is normalised again behind the exchange
    ranges = rows.repartitionByRange("head", "digest", "doc_id").withColumn(
        "norm", ascii_lower(whole(f"carried.`{text}`" if carry else "carried")))
    ordered = ranges.sortWithinPartitions("head", "digest", "norm", "doc_id").select(
        "doc_id", "norm", "digest", *(["carried"] if carry else []))
    schema = T.StructType(list(_RUNS.fields))
    if carry:
        schema.add("carried", rows.schema["carried"].dataType)
    runs = staged(ordered.mapInArrow(_runs_of_equals(carry), schema), "content-sort")

    # at most two rows per part from here on
    edges = runs.filter("edge IS NOT NULL")
    by_part = Window.orderBy("part")
    firsts = edges.filter("opens_part").select("part", F.lag("part").over(by_part).alias("before"), "edge")
    joined = (
        firsts.alias("f")
        .join(edges.filter("closes_part").alias("l"),
              (F.col("f.before") == F.col("l.part")) & (F.col("f.edge") == F.col("l.edge")))
        .select(F.col("f.part").alias("part"), F.lit(True).alias("goes_on"))
    )
    at_edge = edges.groupBy("part", "run").agg(
        F.max("size").alias("size"), F.max("last").alias("last"), F.max("opens_part").alias("opens"))
    broken = at_edge.join(joined, "part", "left").withColumn(
        "breaks", (~(F.col("opens") & F.coalesce("goes_on", F.lit(False)))).cast("long"))
    order = Window.orderBy("part", "run")
    chains = broken.withColumn("chain", F.sum("breaks").over(order))
    one = Window.partitionBy("chain")
    totals = chains.select(
        "part", "run", F.sum("size").over(one).alias("all_size"), F.max("last").over(one).alias("all_last"),
        (F.row_number().over(one.orderBy(F.desc("part"), F.desc("run"))) == 1).alias("ends_chain"))
    found = runs.join(F.broadcast(totals), ["part", "run"], "left")
    result = found.select(
        "doc_id",
        F.coalesce("all_last", "last").alias("keep_id"),
        F.coalesce("all_size", "size").alias("group_size"),
        (F.col("closes") & F.coalesce("ends_chain", F.lit(True))).alias("kept"),
        F.col("sha").alias("text_sha256"),
        *(["carried"] if carry else []),
    )
    return result


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with the columns of the input."""
    kept = equal_texts(docs, key, text, carry=True).filter("kept")
    return kept.select(*[F.col("carried").getField(name).alias(name) for name in docs.columns])
