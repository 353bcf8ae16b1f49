"""A feed-forward net on hashed words for the log price, trained by all tasks on each mini-batch.

An epoch has a fixed number of steps, so a mini-batch grows with the rows and the number
of jobs does not; rows are stored by the step they belong to and read once an epoch. In
a step each task sends the sums of its rows' gradients, cut into slices that are added
up by slice, and the driver moves the weights by Adam. Only the weights (features times
the first layer, mostly) and their sums travel, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.operators.models import WORD, log_target, normalised
from pricewright.session import staged

HIDDEN = (128, 64, 64, 64, 64, 64, 64)
EPOCHS, STEPS, RATE, DECAY, CLIP = 5, 10, 0.003, 0.01, 1.0
_SLICES, _ROWS = 8, 256
_MEANS, _SQUARES, _TINY = 0.9, 0.999, 1e-8


def word_places(text: Column, features: int = fixed.HASHED_FEATURES) -> Column:
    """The places of a text's different words, stop words left out."""
    words = F.array_except(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)), F.lit(list(fixed.STOP_WORDS)))
    return F.array_distinct(F.transform(words, lambda word: F.pmod(F.xxhash64(word), F.lit(features)).cast("int")))


def _blocks(places: pa.ListArray, features: int) -> Iterator[tuple[int, np.ndarray]]:
    """The inputs of a block of rows at a time, from the lists' numbers as Arrow holds them: its first row, and the inputs."""
    sizes = pc.list_value_length(places).fill_null(0).to_numpy()
    flat, bounds = places.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes)])
    for at in range(0, len(places), _ROWS):
        own = sizes[at:at + _ROWS]
        out = np.zeros((len(own), features), dtype=np.float32)
        out[np.repeat(np.arange(len(own)), own), flat[bounds[at]:bounds[at + len(own)]]] = 1.0
        yield at, out


def _layers(weights: list[np.ndarray], inputs: np.ndarray) -> list[np.ndarray]:
    """What each layer passes on; the last is the value."""
    out = [inputs]
    for i in range(0, len(weights), 2):
        value = out[-1] @ weights[i] + weights[i + 1]
        out.append(np.maximum(value, 0) if i + 2 < len(weights) else value)
    return out


def gradients(weights: list[np.ndarray], inputs: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """The sum of squared errors and of its gradients."""
    layers = _layers(weights, inputs)
    miss = layers[-1][:, 0] - target
    slope, out = 2 * miss[:, None].astype(np.float32), []
    for i in range(len(weights) - 2, -1, -2):
        below = layers[i // 2]
        out += [slope.sum(axis=0), below.T @ slope]
        slope = (slope @ weights[i].T) * (below > 0)
    return float((miss ** 2).sum()), out[::-1]


@dataclass
class Network:
    weights: list[np.ndarray]
    mean: float
    deviation: float
    losses: list[float] = field(default_factory=list)  # mean squared error of each epoch, as it was trained

    def guess(self, text: Column) -> Column:
        """The price of a text, never below 0."""
        weights, features = self.weights, len(self.weights[0])

        @F.pandas_udf("double")
        def apply(places: pd.Series) -> pd.Series:
            parts = [_layers(weights, inputs)[-1][:, 0]
                     for _, inputs in _blocks(pa.array(places, pa.list_(pa.int32())), features)]
            return pd.Series(np.concatenate(parts) if parts else np.zeros(0), dtype="float64")

        value = apply(word_places(F.coalesce(text, F.lit("")), features))
        return F.greatest(F.expm1(value * self.deviation + self.mean), F.lit(0.0))


def _step(rows: DataFrame, weights: list[np.ndarray]) -> tuple[float, int, np.ndarray]:
    """Error, rows and gradients of a mini-batch, added up slice by slice."""
    spark, features = rows.sparkSession, len(weights[0])
    sent = spark.sparkContext.broadcast(weights)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, error, count, total = sent.value, 0.0, 0, None
        for batch in batches:
            target = batch.column("target").to_numpy().astype(np.float32)
            for at, inputs in _blocks(batch.column("places"), features):
                lost, found = gradients(own, inputs, target[at:at + _ROWS])
                error, count = error + lost, count + len(inputs)
                if total is None:
                    total = found
                else:
                    for sums, more in zip(total, found, strict=True):
                        sums += more
        if total is not None:
            slices = np.array_split(np.concatenate([one.ravel() for one in total]), _SLICES)
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array(range(_SLICES), pa.int32()), "error": [error] * _SLICES, "n": [count] * _SLICES,
                "sums": [one.astype(np.float32).tobytes() for one in slices]})

    def added(table: pa.Table) -> pa.Table:
        sums = np.sum([np.frombuffer(one, dtype=np.float32) for one in table["sums"].to_pylist()], axis=0, dtype=np.float32)
        return pa.table({"slice": table["slice"][:1], "error": [sum(table["error"].to_pylist())],
                         "n": [sum(table["n"].to_pylist())], "sums": [sums.tobytes()]})

    schema = "slice int, error double, n long, sums binary"
    found = sorted(rows.mapInArrow(part, schema).groupBy("slice").applyInArrow(added, schema).collect(), key=lambda row: row["slice"])
    sent.destroy()
    if not found:
        return 0.0, 0, np.zeros(sum(one.size for one in weights), dtype=np.float32)
    return found[0]["error"], found[0]["n"], np.concatenate([np.frombuffer(row["sums"], dtype=np.float32) for row in found])


def fit_network(rows: DataFrame, text: str = "text", price: str = "price", hidden: tuple[int, ...] = HIDDEN,
                features: int = fixed.HASHED_FEATURES, epochs: int = EPOCHS, steps: int = STEPS, rate: float = RATE,
                seed: int = 42) -> Network:
    """A net for the normalised log price; rows without a text or a price are left out."""
    known = rows.select(F.col(text).alias("text"), F.col(price).cast("double").alias("price")).dropna()
    mean, deviation = log_target(known)
    if mean is None:
        raise ValueError("there are no rows to learn from")
    deviation = deviation or 1.0
    stored = staged(known.select(
        word_places(F.col("text"), features).alias("places"), normalised(F.col("price"), mean, deviation).alias("target"),
        F.pmod(F.xxhash64("text", "price"), F.lit(steps)).cast("int").alias("step")), "steps", partition_by="step")
    random, sizes = np.random.default_rng(seed), [features, *hidden, 1]
    weights: list[np.ndarray] = []
    for i, (one, two) in enumerate(zip(sizes[:-1], sizes[1:], strict=True)):
        # a text has some dozens of words, not all features
        spread = np.sqrt(2.0 / (one if i else min(one, 64)))
        weights += [(random.normal(size=(one, two)) * spread).astype(np.float32), np.zeros(two, dtype=np.float32)]
    shapes = [one.shape for one in weights]
    bounds = np.cumsum([one.size for one in weights])[:-1]
    flat = np.concatenate([one.ravel() for one in weights])
    means, squares = np.zeros_like(flat), np.zeros_like(flat)
    model, turn = Network(weights, mean, deviation), 0
    for epoch in range(epochs):
        errors, seen = 0.0, 0
        for step in random.permutation(steps):
            error, count, slope = _step(stored.filter(F.col("step") == int(step)).select("places", "target"), model.weights)
            if not count:
                continue
            errors, seen, turn = errors + error, seen + count, turn + 1
            slope = slope / count
            slope *= min(1.0, CLIP / max(float(np.sqrt((slope ** 2).sum())), 1e-12))
            means = _MEANS * means + (1 - _MEANS) * slope
            squares = _SQUARES * squares + (1 - _SQUARES) * slope ** 2
            pace = rate * (1 + np.cos(np.pi * epoch / epochs)) / 2
            flat = flat - pace * (means / (1 - _MEANS ** turn) / (np.sqrt(squares / (1 - _SQUARES ** turn)) + _TINY) + DECAY * flat)
            model.weights = [part.reshape(shape) for part, shape in zip(np.split(flat.astype(np.float32), bounds), shapes, strict=True)]
        model.losses.append(errors / max(1, seen))
    return model
