"""The neighbour graph against brute force; the layout keeps more neighbours than the main axes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricewright.operators.layout import neighbour_graph, neighbour_layout, neighbours_kept
from pricewright.operators.models import projected

SCHEMA = "id long, vector array<float>"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(10, 24))
    matrix = centres[rng.integers(0, 10, 300)] + rng.normal(size=(300, 24)) * 0.6
    return spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(matrix)], SCHEMA).cache()


def test_graph_is_exact(vectors):
    matrix = np.array([r.vector for r in vectors.orderBy("id").collect()], dtype=np.float64)
    distance = ((matrix[:, None] - matrix[None]) ** 2).sum(-1)
    np.fill_diagonal(distance, np.inf)
    got = {}
    for row in neighbour_graph(vectors, 5).collect():
        got.setdefault(row.id, set()).add(row.other)
    assert got == {i: set(np.argsort(own)[:5].tolist()) for i, own in enumerate(distance)}


def test_more_neighbours_stay_than_on_the_main_axes(vectors):
    graph = neighbour_graph(vectors).cache()
    plain = neighbours_kept(graph, projected(vectors, 2))
    laid = neighbour_layout(vectors, 2, graph)
    again = neighbour_layout(vectors.repartition(3), 2, graph)
    assert laid.count() == 300
    assert neighbours_kept(graph, laid) > 1.2 * plain
    both = laid.join(again.withColumnRenamed("point", "other"), "id").select(
        F.max(F.abs(F.col("point")[0] - F.col("other")[0])).alias("off")).first()
    assert both.off < 1e-6  # the same on any layout of the input


def test_copies_nulls_few_rows_and_none(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(30)] + [(30, [5.0, 1.0, 0.0]), (31, None), (None, [1.0, 1.0, 1.0])]
    points = {r.id: r.point for r in neighbour_layout(spark.createDataFrame(rows, SCHEMA), 2, rounds=2).collect()}
    assert set(points) == set(range(31))
    assert all(np.isfinite(point).all() and len(point) == 2 for point in points.values())
    links = neighbour_graph(spark.createDataFrame(rows[:30], SCHEMA), 4).groupBy("id").count().collect()
    assert len(links) == 30 and {r["count"] for r in links} == {4}
    assert neighbour_layout(spark.createDataFrame([], SCHEMA), 2).count() == 0
    assert neighbour_layout(spark.createDataFrame(rows[:1], SCHEMA), 3).first().point == [0.0, 0.0, 0.0]
