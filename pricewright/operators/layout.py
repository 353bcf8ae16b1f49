"""Vectors laid out in few dimensions so that neighbours stay neighbours.

Principal components keep large distances; which vectors lie next to each other is
mostly lost. Here a graph links each vector to its ``k`` nearest ones (the exact cell
search), and the points, which begin on the main axes, move in rounds: each is drawn to
the mean of its neighbours and pushed away from a sample of ``SAMPLE`` points, drawn anew
each round, with a force that falls with the distance. Steps shrink from round to round.

A round is one join of the graph's ``k`` rows a vector with the points and one
aggregation back; only the sample, whose size is fixed, passes the driver. Every round is
written, so a lost executor costs at most the round it was in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewright.operators.models import projected
from pricewright.operators.retrieval import nearest
from pricewright.session import staged

NEIGHBOURS = 10
ROUNDS = 8
SAMPLE = 256
ATTRACTION = 0.8
REPULSION = 0.1
_NEAR = 0.01  # keeps the force between points of one place finite


def neighbour_graph(vectors: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """``id, other`` for the ``k`` nearest other vectors of each, from rows of ``id, vector``."""
    found = nearest(vectors.select(F.col("id").alias("chunk_id"), "vector"),
                    vectors.select(F.col("id").alias("question_id"), "vector"), k + 1)
    # a vector finds itself unless more than k others lie on the same place
    return found.filter("question_id <> chunk_id").groupBy(F.col("question_id").alias("id")).agg(
        F.slice(F.array_sort(F.collect_list(F.struct("rank", "chunk_id"))), 1, k).alias("near")).select(
        "id", F.explode("near.chunk_id").alias("other"))


def neighbours_kept(graph: DataFrame, points: DataFrame, k: int = NEIGHBOURS) -> float:
    """The share of a graph's links that the ``k`` nearest points (``id, point``) also have."""
    laid = neighbour_graph(points.select("id", F.col("point").cast("array<float>").alias("vector")), k)
    total = graph.count()
    return graph.join(laid, ["id", "other"], "left_semi").count() / total if total else 1.0


def _moved(sample: np.ndarray, step: float):
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            own = np.array(batch.column("point").to_pylist(), dtype=np.float64)
            # a point without neighbours is only pushed
            drawn = np.array([t or p for t, p in zip(batch.column("target").to_pylist(), own.tolist(), strict=True)])
            push = np.zeros_like(own)
            for other in sample:
                apart = own - other
                push += apart / (_NEAR + (apart * apart).sum(axis=1, keepdims=True))
            moved = own + step * (ATTRACTION * (drawn - own) + REPULSION * push / max(1, len(sample)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(moved.tolist(), pa.list_(pa.float64()))], names=["id", "point"])

    return apply


def neighbour_layout(vectors: DataFrame, dimensions: int, graph: DataFrame | None = None,
                     rounds: int = ROUNDS) -> DataFrame:
    """``id, point`` for every row of ``id, vector``; identifiers must be unique, vectors of one length.

    Null vectors have no point, a vector alone lies at the origin. The graph may be given
    where several layouts share it. An empty table gives an empty result.
    """
    known = vectors.filter("id is not null and vector is not null").select("id", "vector")
    if known.limit(2).count() < 2:  # nothing to compare with
        return known.select("id", F.array_repeat(F.lit(0.0), dimensions).alias("point"))
    links = staged(neighbour_graph(known), "links") if graph is None else graph
    points = staged(projected(known, dimensions), "points")
    spread = points.agg(F.stddev_pop(F.col("point")[0])).first()[0] or 1.0  # the first axis has unit deviation
    points = points.withColumn("point", F.transform("point", lambda x: x / F.lit(spread)))
    for at in range(rounds):
        drawn = points.orderBy(F.xxhash64("id", F.lit(at)), "id").limit(SAMPLE)
        sample = np.array([row.point for row in drawn.collect()])  # at most ``SAMPLE`` rows
        near = links.join(points.withColumnRenamed("id", "other"), "other")
        means = near.groupBy("id").agg(F.array(*[F.avg(F.col("point")[i]) for i in range(dimensions)]).alias("target"))
        met = points.join(means, "id", "left")
        points = staged(met.mapInArrow(_moved(sample, 1 - at / rounds), points.schema), "points")
    return points
