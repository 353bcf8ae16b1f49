"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of hashed runs of one to three letters; anything that
is not a letter is one space. The weights are learnt by the follow-the-regularised-
leader rule with an elastic net, which keeps most of them at zero, and a temperature
fitted on rows that were not learnt from makes the probabilities honest.

Document frequencies cover all rows that may be learnt from. The weights are fitted
on the driver on at most ``SAMPLE_PER_LANGUAGE`` rows of each language (whole texts),
chosen by a hash of the identifier: a bound that does not grow with the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.llm.common import bounded_batches, worker_store

BUCKETS = 1 << 15
SAMPLE_PER_LANGUAGE = 800
MOST_LANGUAGES = 256  # the commonest; weights of each are on the driver
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.01
UNKNOWN = "und"
_STEP = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


def _letters() -> np.ndarray:
    store = worker_store("language")
    if "letters" not in store:
        store["letters"] = np.array([chr(code).isalpha() for code in range(0x110000)])
    return store["letters"]


def features(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Buckets and their weights (log of one plus the count), or nothing for a text without letters."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = _letters()[codes]
    if not letter.any():
        return None
    codes = np.where(letter, codes, np.uint32(32))
    codes = codes[letter | np.concatenate([[True], letter[:-1]])]  # one space between words
    codes = np.concatenate([[32], codes, [32]]).astype(np.uint32)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    runs = np.zeros(len(codes), dtype=np.uint32)
    for size, step in enumerate(_STEP):
        runs = runs[:len(codes) - size] * np.uint32(0x01000193) + codes[size:] * np.uint32(step)
        buckets = (runs * np.uint32(0x9E3779B1)) >> np.uint32(17)
        counts += np.bincount(buckets, minlength=BUCKETS)
    found = np.flatnonzero(counts)
    return found, np.log1p(counts[found])


@dataclass(frozen=True)
class Model:
    """Weights by language and bucket, inverse document frequencies and the temperature."""

    languages: tuple[str, ...]
    weights: np.ndarray
    inverse: np.ndarray
    temperature: float = 1.0

    def scores(self, found: np.ndarray, value: np.ndarray) -> np.ndarray:
        weighted = value * self.inverse[found]
        norm = np.sqrt((weighted * weighted).sum())
        return self.weights[:, found] @ (weighted / norm)

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        raised = np.exp((scores - scores.max()) / self.temperature)
        return raised / raised.sum()

    def predict(self, text: str | None) -> tuple[str, float]:
        row = features(text) if text else None
        if row is None or not self.languages:
            return UNKNOWN, 0.0
        chances = self.probabilities(self.scores(*row))
        best = int(np.argmax(chances))
        return self.languages[best], float(chances[best])


def document_frequencies(rows: DataFrame, text: str) -> tuple[int, np.ndarray]:
    """How many texts have each bucket, and how many there are; one short vector per task is added up."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.zeros(BUCKETS, dtype=np.int64), 0
        for batch in batches:
            for one in batch.column(0).to_pylist():
                row = features(one) if one else None
                if row is not None:
                    seen[row[0]] += 1
                    total += 1
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), pa.array(np.append(seen[used], total))], names=["bucket", "n"])

    found = rows.select(text).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect()
    out, total = np.zeros(BUCKETS, dtype=np.int64), 0
    for bucket, n in found:
        if bucket < 0:
            total = n
        else:
            out[bucket] = n
    return total, out


def _fit(rows: list[tuple[int, np.ndarray, np.ndarray]], languages: tuple[str, ...], inverse: np.ndarray) -> np.ndarray:
    """Follow the regularised leader, coordinate by coordinate, over rows of language, buckets and weights."""
    sums = np.zeros((len(languages), BUCKETS))
    squares = np.zeros_like(sums)

    def leader(at: np.ndarray) -> np.ndarray:
        z = sums[:, at]
        pull = np.maximum(np.abs(z) - L1, 0.0)
        return -np.sign(z) * pull / ((BETA + np.sqrt(squares[:, at])) / ALPHA + L2)

    random = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            label, at, value = rows[i]
            weighted = value * inverse[at]
            weighted /= np.sqrt((weighted * weighted).sum())
            w = leader(at)
            raw = w @ weighted
            chances = np.exp(raw - raw.max())
            chances /= chances.sum()
            chances[label] -= 1.0
            slope = chances[:, None] * weighted
            grown = squares[:, at] + slope * slope
            sums[:, at] += slope - (np.sqrt(grown) - np.sqrt(squares[:, at])) / ALPHA * w
            squares[:, at] = grown
    return leader(np.arange(BUCKETS))


def _temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores with the least log loss, by golden section on its logarithm."""

    def loss(log_t: float) -> float:
        scaled = scores / np.exp(log_t)
        top = scaled.max(axis=1)
        return float((top + np.log(np.exp(scaled - top[:, None]).sum(axis=1)) - scaled[np.arange(len(labels)), labels]).mean())

    low, high, part = -3.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(rows: DataFrame, sample_per_language: int = SAMPLE_PER_LANGUAGE,
          key: str = "doc_id", text: str = "text", label: str = "lang") -> Model:
    """A model from the rows with a label. Without any, all predictions are ``und``.

    It is fitted on at most ``sample_per_language`` rows, those with the smallest hashes, of each of the
    ``MOST_LANGUAGES`` commonest labels; frequencies are those of all rows.
    """
    known = rows.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"),
                        F.col(label).cast("string").alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    total, frequency = document_frequencies(known, "text")
    inverse = np.log((1 + total) / (1 + frequency)) + 1.0
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "lang").limit(MOST_LANGUAGES)
    # the smallest hashes of a language: about twice the sample is ranked, whatever its size
    near = F.xxhash64("doc_id") / F.lit(2.0 ** 64) + 0.5 < F.lit(2.0 * sample_per_language + 100) / F.col("rows")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.select("doc_id", "lang").join(F.broadcast(sizes), "lang").filter(near).withColumn(
        "nth", F.row_number().over(order)).filter(F.col("nth") <= sample_per_language)
    # at most sample_per_language identifiers for each language
    sample = known.join(F.broadcast(chosen.select("doc_id", "nth").dropDuplicates(["doc_id"])), "doc_id")

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, nth, one in zip(*(batch.column(name).to_pylist() for name in ("lang", "nth", "text")), strict=True):
                row = features(one)
                if row is not None:
                    out.append((lang, nth, row[0].astype("<u2").tobytes(), row[1].astype("<f4").tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(
                    zip(*out, strict=True), (pa.string(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
                    names=["lang", "nth", "at", "value"])

    found = sample.select("lang", "nth", "text").mapInArrow(
        rows_of, "lang string, nth int, at binary, value binary").collect()
    found.sort(key=lambda row: (row["lang"], row["nth"]))
    languages = tuple(sorted({row["lang"] for row in found}))
    if not languages:
        return Model((), np.zeros((0, BUCKETS)), inverse)
    data = [(row["nth"], languages.index(row["lang"]), np.frombuffer(row["at"], "<u2").astype(np.int64),
             np.frombuffer(row["value"], "<f4").astype(np.float64)) for row in found]
    weights = _fit([row[1:] for row in data if row[0] % 5], languages, inverse)  # each fifth row calibrates
    model = Model(languages, weights, inverse)
    kept = [row for row in data if not row[0] % 5]
    if not kept:
        return model
    scores = np.stack([model.scores(at, value) for _, _, at, value in kept])
    return Model(languages, weights, inverse, _temperature(scores, np.array([row[1] for row in kept])))


def predicted(model: Model, docs: DataFrame, text: str = "text") -> Column:
    """``struct<lang, score>`` for a text column; ``und`` with score 0 where there is no letter."""
    # languages times buckets numbers, whatever the size of the data
    sent = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.weights, model.inverse, model.temperature))

    @F.pandas_udf("lang string, score double")
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Model(*sent.value)
        for batch in batches:
            yield pd.DataFrame([known.predict(one) for one in batch], columns=["lang", "score"])

    return apply(F.col(f"`{text}`").cast("string"))


def fold(key: str = "doc_id") -> Column:
    """A fixed quarter of the rows is number 2, by the checksum of the identifier as text."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4, F.lit(0))


def identified(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row, learnt from the rows that are not held out.

    Only the text is looked at for a prediction. Null or empty texts and texts without
    letters are ``und`` with score 0; so are all where there is nothing to learn from.
    """
    bounded_batches(docs.sparkSession)
    model = train(docs.filter(fold(key) != 2), key=key, text=text, label=label)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), (fold(key) == 2).alias("held_out"),
                       predicted(model, docs, text).alias("guess"))
    return rows.select("doc_id", "held_out", F.col("guess.lang").alias("lang_pred"), F.col("guess.score").alias("score"))


def with_language(docs: DataFrame, least_score: float, key: str = "doc_id", text: str = "text",
                  label: str = "lang") -> DataFrame:
    """The documents whose language is known with at least ``least_score``, their columns unchanged."""
    bounded_batches(docs.sparkSession)
    model = train(docs.filter(fold(key) != 2), key=key, text=text, label=label)
    names = [F.col(f"`{name}`") for name in docs.columns]
    marked = docs.select(F.struct(*names).alias("row"), predicted(model, docs, text).alias("guess"))
    stay = marked.filter((F.col("guess.lang") != UNKNOWN) & (F.col("guess.score") >= least_score))
    return stay.select("row.*")
