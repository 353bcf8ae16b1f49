"""Token ids as Parquet list columns that can be read selectively.

Spark writes the files, so they are committed as a whole and can lie in any store
it reaches. Row groups, pages and the encoding of the ids are set per writer; page
indexes let a filter on ``doc_id`` skip pages, and metadata columns are read without
touching the ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricewright.llm.common import texts
from pricewright.llm.tokens import checksum, encoded

ROW_GROUP_BYTES = 8 << 20
PAGE_ROWS = 256

_ROWS = pa.schema([("shard", pa.int32()), ("position", pa.int64()), ("doc_id", pa.int64()),
                   ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])
_DDL = "shard int, position long, doc_id long, n_tokens long, ids array<int>"


def _rows_in_order(path: str, end_id: int, added: bool):
    tail = np.array([end_id], dtype="<u4").tobytes()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, at = TaskContext.get().partitionId(), 0

        def columns(keys: pa.Array, ids: list[bytes]) -> list[pa.Array]:
            nonlocal at
            rows = [one + tail for one in ids]
            sizes = np.array([len(one) // 4 for one in rows], dtype=np.int64)
            bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = np.frombuffer(b"".join(rows), dtype="<i4")
            at += len(rows)
            return [
                pa.array(np.full(len(rows), shard, dtype=np.int32)), pa.array(np.arange(at - len(rows), at)),
                keys, pa.array(sizes), pa.ListArray.from_arrays(pa.array(bounds), pa.array(values)),
            ]

        yield from encoded(path, columns, _ROWS, added)(batches)

    return apply


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int, encoding: str = "dictionary",
                      row_group_bytes: int = ROW_GROUP_BYTES, page_rows: int = PAGE_ROWS,
                      key: str = "doc_id", text: str = "text", added: bool = False) -> None:
    """Encode whole texts and write them in ascending order of the key.

    Columns: ``shard`` (the file), ``position`` (the row in it), ``doc_id``,
    ``n_tokens`` and ``ids`` with the end id. ``encoding`` of the ids is
    ``dictionary`` or ``delta``; ``added`` as for the ``Encoder``. Null text is empty and gives the end id alone, null
    keys come first, rows that repeat a key follow each other in the order of
    their text's hash, and an empty table gives files without rows.
    """
    if encoding not in ("dictionary", "delta"):
        raise ValueError(f"encoding {encoding}")
    rows = texts(docs, key, text).repartitionByRange("doc_id").withColumn("tie", F.xxhash64("text"))
    ordered = rows.sortWithinPartitions("doc_id", "tie").drop("tie")
    options = {
        "compression": "snappy",
        "parquet.block.size": str(row_group_bytes),
        "parquet.page.row.count.limit": str(page_rows),
        "parquet.writer.version": "PARQUET_1_0" if encoding == "dictionary" else "PARQUET_2_0",
        "parquet.enable.dictionary": str(encoding == "dictionary").lower(),
    }
    ordered.mapInArrow(_rows_in_order(vocabulary, end_id, added), _DDL).write.options(**options).parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(_DDL).parquet(folder)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        bounds = ids.offsets.to_numpy()
        values = ids.values.to_numpy().astype("<u4")
        sums = [checksum(values[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("shard"), batch.column("position"), batch.column("doc_id"),
             pa.array(np.diff(bounds).astype(np.int64)), pa.array(sums, pa.int64())],
            names=["shard", "position", "doc_id", "n_tokens", "ids_crc32"])


def token_spans(rows: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from rows read back; ``start`` counts the ids of all earlier rows."""
    read = rows.select("shard", "position", "doc_id", "ids").mapInArrow(
        _digests, "shard int, position long, doc_id long, n_tokens long, ids_crc32 long")
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = rows.groupBy("shard").agg(F.sum("n_tokens").alias("tokens")).select(
        "shard", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("shard").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    # one row per file: the broadcast is bounded by their number
    return (
        read.withColumn("upto", F.sum("n_tokens").over(inside))
        .join(F.broadcast(shards), "shard")
        .select("doc_id", (F.col("before") + F.col("upto") - F.col("n_tokens")).alias("start"),
                "n_tokens", "ids_crc32")
    )
