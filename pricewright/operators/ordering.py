"""Row numbers and running totals over a global order, without a one-task window."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from pricewright.session import staged

_POSITION_MASK = (1 << 33) - 1


def numbered(df: DataFrame, order: list, name: str = "row_number") -> DataFrame:
    """1-based row number over ``order``, which must be a total order.

    Range partitions are sorted and written once with their position; only one
    count per partition is then accumulated and sent back to the rows.
    """
    parts = staged(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit(_POSITION_MASK))),
        "numbered",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        parts.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # one row per range partition, so the broadcast is bounded by the partition count
    return (
        parts.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_at") + 1)
        .drop("_part", "_at", "_offset")
    )


def running_totals(
    df: DataFrame, by: list[str], order: list[str], totals: dict[str, Column]
) -> DataFrame:
    """Running sums (and ``n``, the running count) per ``by`` group in ``order``.

    A group may hold any share of the rows: the order is cut into ranges that
    ignore group borders, summed per range, and the sums of earlier ranges added.
    """
    totals = {"n": F.lit(1), **totals}
    keys = [*by, "_part"]
    values = df.select("*", *[value.alias(f"_v_{name}") for name, value in totals.items()])
    parts = staged(
        values.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()),
        "running",
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = (
        Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        parts.groupBy(*keys)
        .agg(*[F.sum(f"_v_{name}").alias(f"_t_{name}") for name in totals])
        .select(
            *[F.col(key).alias(f"_k_{key}") for key in keys],
            *[
                F.coalesce(F.sum(f"_t_{name}").over(earlier), F.lit(0)).alias(f"_o_{name}")
                for name in totals
            ],
        )
    )
    local = parts.select(
        "*", *[F.sum(f"_v_{name}").over(inside).alias(f"_l_{name}") for name in totals]
    )
    same = reduce(
        lambda left, right: left & right,
        [F.col(key).eqNullSafe(F.col(f"_k_{key}")) for key in keys],
    )
    return local.join(offsets, same).select(
        *df.columns,
        *[(F.col(f"_l_{name}") + F.col(f"_o_{name}")).alias(name) for name in totals],
    )


def _sums_in_order(by: list[str], names: list[str]):
    """Running sums per group over the sorted rows of one partition; the group and its sums are carried on."""
    def same(one, two) -> bool:
        return one == two or one != one and two != two

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, sums = TaskContext.get().partitionId(), None, np.zeros(len(names))
        for batch in batches:
            size = len(batch)
            if not size:
                continue
            columns = [batch.column(key) for key in by]
            borders = {0, size}
            for column in columns:
                borders.update(pc.run_end_encode(column).run_ends.to_pylist())
            borders = sorted(borders)
            values = [batch.column(f"_v_{name}").fill_null(0).to_numpy() for name in names]
            out = np.empty((len(names), size))
            for begin, end in zip(borders[:-1], borders[1:], strict=True):
                key = [column[begin].as_py() for column in columns]
                if last is None or not all(map(same, key, last)):
                    last, sums = key, np.zeros(len(names))
                for i, value in enumerate(values):
                    out[i, begin:end] = np.cumsum(np.concatenate([[sums[i]], value[begin:end]]))[1:]
                sums = out[:, end - 1].copy()
            kept = [name for name in batch.schema.names if not name.startswith("_v_")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in kept], *[pa.array(row) for row in out], pa.array(np.full(size, part, dtype=np.int32))],
                names=[*kept, *[f"_l_{name}" for name in names], "_part"])

    return run


def running_sums(df: DataFrame, by: list[str], order: list[str], totals: dict[str, Column]) -> DataFrame:
    """As ``running_totals``, for sums as doubles (null counts as 0), with a single exchange of the rows.

    The sorted range partitions are summed up as they are read. Only a group that goes
    on from an earlier partition needs more, and a partition has one at most.
    """
    totals = {"n": F.lit(1), **totals}
    names = list(totals)
    values = df.select("*", *[value.cast("double").alias(f"_v_{name}") for name, value in totals.items()])
    schema = StructType([*df.schema.fields, *[StructField(f"_l_{name}", DoubleType()) for name in names],
                         StructField("_part", IntegerType())])
    parts = staged(values.repartitionByRange(*by, *order).sortWithinPartitions(*by, *order).mapInArrow(
        _sums_in_order(by, names), schema), "running")
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ends = parts.groupBy(*by, "_part").agg(F.max(F.struct(*[f"_l_{name}" for name in names])).alias("_end"))
    offsets = ends.select(
        *[F.col(key).alias(f"_k_{key}") for key in by], F.col("_part").alias("_k_part"),
        *[F.sum(f"_end._l_{name}").over(earlier).alias(f"_o_{name}") for name in names]).filter("_o_n IS NOT NULL")
    same = reduce(lambda left, right: left & right, [F.col(key).eqNullSafe(F.col(f"_k_{key}")) for key in by],
                  F.col("_part") == F.col("_k_part"))
    # one row per partition at most
    found = parts.join(F.broadcast(offsets), same, "left")
    whole = {name: F.col(f"_l_{name}") + F.coalesce(f"_o_{name}", F.lit(0.0)) for name in names}
    return found.select(*df.columns, whole.pop("n").cast("long").alias("n"), *[value.alias(name) for name, value in whole.items()])


def first_per_group(rows: DataFrame, keys: list[str], order: list, limit: int) -> DataFrame:
    """The first ``limit`` rows per key, numbered in ``place``.

    The bare filter on the row number lets each task drop the rest before the
    shuffle, so a hot key sends no more than the others.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("place", place).filter(F.col("place") <= limit).withColumn(
        "place", F.col("place").cast("long"))
