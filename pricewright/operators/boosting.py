"""Gradient-boosted regression trees on the counts and sums of feature cells.

Features are cut into bins at approximate quantiles. With squared errors a tree needs
no more of the rows than, for each different vector of bins, how many there are and
the sum of their labels: residuals of later rounds follow from these, as all rows of a
vector have one prediction. One aggregation over all rows makes this table. All bins are
kept, however many rows it gets: ``n`` features have at most ``BINS`` to the power of ``n``
vectors, whatever the data. All rounds then run over the table in one task, ``SLICE`` of its
rows at a time, and Spark repeats it if its executor is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.session import spread, staged

DEPTH, BINS, SHRINKAGE = 6, 32, 1.0
SLICE = 1 << 17  # rows of the table looked at at once; a sum over rows is one of slices' sums
MOST_CELLS: int | None = None  # a number asks for coarser bins: halved until the table has at most so many rows


@dataclass
class BoostedTrees:
    """Trees as arrays: for each inner node a feature and the last bin that goes left; a value per leaf."""

    features: list[str]
    edges: list[np.ndarray]
    base: float
    split_on: np.ndarray
    split_at: np.ndarray
    values: np.ndarray
    losses: np.ndarray  # mean squared error before each round

    def predict(self, frame: pd.DataFrame) -> pd.Series:
        return pd.Series(self._valued(
            _binned([frame[name].to_numpy(dtype=np.float64) for name in self.features], self.edges)))

    def _valued(self, bins: np.ndarray) -> np.ndarray:
        rows, out = np.arange(len(bins)), np.full(len(bins), self.base)
        depth = int(np.log2(self.values.shape[1])) if len(self.values) else 0
        for on, at, values in zip(self.split_on, self.split_at, self.values, strict=True):
            node = np.zeros(len(bins), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (bins[rows, on[node]] > at[node])
            out += values[node - len(on)]
        return out

    def guess(self) -> Column:
        """The prediction as a column of the features."""
        @F.pandas_udf("double")
        def apply(frame: pd.DataFrame) -> pd.Series:
            return self.predict(frame)

        return apply(F.struct(*[F.col(name).cast("double").alias(name) for name in self.features]))

    def priced(self, rows: DataFrame) -> DataFrame:
        """Rows with ``guess``. Trees see only bins, so each different vector of bins is predicted once."""
        binned = rows.withColumn("_bins", F.array(*[
            _bin(F.coalesce(F.col(name).cast("double"), F.lit(float("nan"))), edge)  # as ``guess`` takes nulls
            for name, edge in zip(self.features, self.edges, strict=True)]))

        @F.pandas_udf("double")
        def apply(bins: pd.Series) -> pd.Series:
            return pd.Series(self._valued(np.stack(bins.to_numpy())) if len(bins) else np.zeros(0))

        different = spread(staged(binned.select("_bins").distinct(), "bins"))
        return binned.join(staged(different.withColumn("guess", apply("_bins")), "guesses"), "_bins").drop("_bins")


def _binned(columns: list[np.ndarray], edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(edge, column, side="right") for column, edge in zip(columns, edges, strict=True)],
                    axis=1).astype(np.uint8)


def _bin(value: Column, edges: np.ndarray) -> Column:
    """How many edges are at or below the value."""
    listed = F.lit([float(edge) for edge in edges])
    return F.size(F.filter(listed, lambda edge: edge <= value)).cast("int")


def _best_splits(sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node the feature and bin with the largest gain; a node without one sends all rows left."""
    left_sum, left_count = sums.cumsum(axis=2), counts.cumsum(axis=2)
    all_sum, all_count = left_sum[:, :1, -1:], left_count[:, :1, -1:]
    right_sum, right_count = all_sum - left_sum, all_count - left_count
    gain = (left_sum ** 2 / (left_count + SHRINKAGE) + right_sum ** 2 / (right_count + SHRINKAGE)
            - all_sum ** 2 / (all_count + SHRINKAGE))
    gain = np.where((left_count >= 1) & (right_count >= 1), gain, 0.0).reshape(len(sums), -1)
    best = gain.argmax(axis=1)
    found = gain[np.arange(len(sums)), best] > 1e-9
    on, at = np.divmod(best, sums.shape[2])
    return np.where(found, on, 0), np.where(found, at, sums.shape[2])


def _packed(batches: Iterator[pa.RecordBatch], wide: int, n_bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The table's bins, a row per feature, its numbers of rows and its sums of labels."""
    kind, parts = np.min_scalar_type(n_bins), []
    for batch in batches:
        bins = batch.column("bins").flatten().to_numpy().reshape(-1, wide).astype(kind)
        parts.append((bins, batch.column("rows").to_numpy().astype(np.float64), batch.column("labels").to_numpy()))
    bins, rows, labels = zip(*parts, strict=True)
    return np.ascontiguousarray(np.concatenate(bins).T), np.concatenate(rows), np.concatenate(labels)


def _grow(wide: int, n_bins: int, base: float, squares: float, rounds: int, rate: float, depth: int):
    inner, leaves, size = 2 ** depth - 1, 2 ** depth, SLICE

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, rows, labels = _packed(batches, wide, n_bins)
        guess, node, every = np.full(len(rows), base), np.zeros(len(rows), dtype=np.int64), np.arange(len(rows))
        slices = [slice(start, start + size) for start in range(0, len(rows), size)]

        def weights(here: slice) -> tuple[np.ndarray, np.ndarray]:
            return labels[here] - rows[here] * guess[here], rows[here]

        def histograms(here: slice, count: int) -> np.ndarray:
            """Sums and counts by node, feature and bin; below the root only of the left child of each node."""
            at, columns, weighed = node[here], bins[:, here], weights(here)
            if count > 1:
                cells = np.flatnonzero((at & 1) == 0)
                at, columns, weighed = at.take(cells) >> 1, columns.take(cells, axis=1), [weight.take(cells) for weight in weighed]
                count //= 2
            at = at * n_bins
            places = [at + column for column in columns]
            return np.stack([[np.bincount(place, weight, count * n_bins) for place in places] for weight in weighed]).reshape(
                2, wide, count, n_bins).swapaxes(1, 2)

        for number in range(rounds):
            loss = (squares - 2 * sum((guess[here] * labels[here]).sum() for here in slices)
                    + sum((rows[here] * guess[here] ** 2).sum() for here in slices))
            on, at = np.zeros(inner, dtype=np.int16), np.full(inner, n_bins, dtype=np.int16)
            node[:], above = 0, None
            for level in range(depth):
                count = 2 ** level
                found = sum(histograms(here, count) for here in slices)
                if above is not None:  # the right child is the rest
                    found = np.stack([found, above - found], axis=2).reshape(2, count, wide, n_bins)
                above = found
                split_on, split_at = _best_splits(*above)
                on[count - 1:2 * count - 1], at[count - 1:2 * count - 1] = split_on, split_at
                for here in slices:
                    was = node[here]
                    node[here] = 2 * was + (bins.take((split_on * len(rows)).take(was) + every[here]) > split_at.take(was))
            sums, counts = sum(np.stack([np.bincount(node[here], weight, leaves) for weight in weights(here)]) for here in slices)
            values = rate * sums / (counts + SHRINKAGE)
            for here in slices:
                guess[here] += values[node[here]]
            yield pa.RecordBatch.from_pydict({
                "round": pa.array([number], pa.int32()), "split_on": [on.tobytes()], "split_at": [at.tobytes()],
                "leaf": [values.tobytes()], "loss": [float(loss / rows.sum())]})

    return apply


def fit_boosted(rows: DataFrame, features: list[str], label: str = "price", rounds: int = fixed.BOOST_ROUNDS,
                rate: float = fixed.BOOST_RATE, depth: int = DEPTH, bins: int = BINS) -> BoostedTrees:
    """Boosted trees for ``label``; rows without a label or a feature are left out."""
    columns = [*features, label]
    numbers = rows.select(*[F.col(name).cast("double").alias(name) for name in columns]).dropna()
    numbers = staged(numbers, "boosted-rows")
    base, squares = numbers.agg(F.avg(label), F.sum(F.col(label) ** 2)).first()
    if base is None:
        raise ValueError("there are no rows to learn from")
    found = numbers.approxQuantile(features, [i / bins for i in range(1, bins)], 0.001)
    edges = [np.unique(np.array(cuts, dtype=np.float64)) for cuts in found]
    places = F.array(*[_bin(F.col(name), edge) for name, edge in zip(features, edges, strict=True)])
    cells = staged(numbers.groupBy(places.alias("bins")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(label).alias("labels")), "cells")
    while MOST_CELLS is not None and cells.count() > MOST_CELLS:
        if bins <= 2:
            raise ValueError(f"more than {MOST_CELLS} different rows even with two bins: leave features out")
        # every second edge stays, so wider cells are sums of these: the rows are not read again
        bins, found, finer = bins // 2, [cuts[1::2] for cuts in found], edges
        edges = [np.unique(np.array(cuts, dtype=np.float64)) for cuts in found]
        wider = [F.lit([0, *np.searchsorted(edge, fine, side="right").tolist()]) for edge, fine in zip(edges, finer, strict=True)]
        cells = staged(cells.groupBy(F.array(*[
            F.element_at(one, F.col("bins")[i] + 1) for i, one in enumerate(wider)]).alias("bins")).agg(
            F.sum("rows").alias("rows"), F.sum("labels").alias("labels")), "cells")
    n_bins = max(len(edge) for edge in edges) + 1
    grown = cells.repartition(1).sortWithinPartitions("bins").mapInArrow(
        _grow(len(features), n_bins, base, squares, rounds, rate, depth),
        "round int, split_on binary, split_at binary, leaf binary, loss double")
    trees = sorted(grown.collect(), key=lambda row: row["round"])  # the model: rounds times nodes
    return BoostedTrees(
        features, edges, base,
        np.array([np.frombuffer(row["split_on"], np.int16) for row in trees], dtype=np.int64),
        np.array([np.frombuffer(row["split_at"], np.int16) for row in trees], dtype=np.int64),
        np.array([np.frombuffer(row["leaf"]) for row in trees]), np.array([row["loss"] for row in trees]))
