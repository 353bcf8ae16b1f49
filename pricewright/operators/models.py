"""Features from text and price models on Spark ML, with plug-in points for outside code."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    HashingTF,
    Normalizer,
    PCA,
    RegexTokenizer,
    StopWordsRemover,
    VectorAssembler,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.operators.splits import SEED

WORD = r"[\p{L}\p{N}_]{2,}"


def _tokens(text: str) -> list:
    return [
        RegexTokenizer(inputCol=text, outputCol="_tokens", pattern=WORD, gaps=False, toLowercase=True),
        StopWordsRemover(inputCol="_tokens", outputCol="_words", stopWords=fixed.STOP_WORDS),
    ]


def word_counts(documents: DataFrame, text: str, limit: int = fixed.VOCABULARY) -> DataFrame:
    """The ``limit`` commonest words, stop words left out; equal counts in word order."""
    words = F.explode(F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0)))
    return (
        documents.select(words.alias("word")).filter(~F.col("word").isin(*fixed.STOP_WORDS))
        .groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "word").limit(limit)
    )


def bag_of_words(documents: DataFrame, text: str, limit: int = fixed.VOCABULARY) -> PipelineModel:
    """Counts of the commonest words as the vector column ``features``."""
    vocabulary = [row.word for row in word_counts(documents, text, limit).collect()]  # ``limit`` words
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_words", outputCol="features")
    return PipelineModel([*_tokens(text), counter])


def hashed_words(text: str, features: int = fixed.HASHED_FEATURES) -> PipelineModel:
    """Which words occur, hashed to a fixed width, as the vector column ``features``."""
    hashing = HashingTF(inputCol="_words", outputCol="features", numFeatures=features, binary=True)
    return PipelineModel([*_tokens(text), hashing])


def hashed_embedder(documents: DataFrame, text: str, width: int = 64) -> PipelineModel:
    """Unit vectors from hashed, frequency-weighted words: an embedder that needs no network."""
    steps = [
        *_tokens(text),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=width),
        IDF(inputCol="_counts", outputCol="_weighted"),
        Normalizer(inputCol="_weighted", outputCol="features"),
    ]
    return Pipeline(stages=steps).fit(documents)


def embed(documents: DataFrame, model: Transformer) -> DataFrame:
    """Add ``vector``, an array, by any fitted model that fills ``features``."""
    dropped = ("_tokens", "_words", "_counts", "_weighted", "features")
    done = model.transform(documents)
    return done.withColumn("vector", vector_to_array("features", "float32")).drop(*dropped)


def embedder(function: Callable[[list[str]], np.ndarray]) -> Callable[[Column], Column]:
    """An outside embedding function, texts to matrix, as a column function in Arrow batches."""

    @F.pandas_udf("array<float>")
    def apply(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(list(np.asarray(function(batch.tolist()), dtype=np.float32)))

    return apply


def tokenizer(function: Callable[[str], list[str]]) -> Callable[[Column], Column]:
    """An outside tokenizer as a column function."""

    @F.pandas_udf("array<string>")
    def apply(texts: pd.Series) -> pd.Series:
        return texts.map(function)

    return apply


def predictor(function: Callable[[pd.DataFrame], pd.Series]) -> Callable[..., Column]:
    """An outside price model, a frame of columns to numbers, as a column function."""

    @F.pandas_udf("double")
    def apply(columns: pd.DataFrame) -> pd.Series:
        return function(columns).astype("float64")

    return lambda *columns: apply(F.struct(*columns))


def linear_pricer(features: str = "features") -> LinearRegression:
    return LinearRegression(featuresCol=features, labelCol="price", predictionCol="guess")


def forest_pricer(trees: int = fixed.FOREST_TREES) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="features", labelCol="price", predictionCol="guess", numTrees=trees, seed=SEED)


def log_target(prices: DataFrame) -> tuple[float, float]:
    """Mean and sample deviation of log(price + 1)."""
    row = prices.agg(F.avg(F.log1p("price")), F.stddev_samp(F.log1p("price"))).first()
    return row[0], row[1]


def normalised(price: Column, mean: float, deviation: float) -> Column:
    return (F.log1p(price) - mean) / deviation


def restored(value: Column, mean: float, deviation: float) -> Column:
    return F.expm1(value * deviation + mean)


def priced(model: Transformer, rows: DataFrame) -> DataFrame:
    """Guesses of a fitted model, never below 0."""
    return model.transform(rows).withColumn("guess", F.greatest(F.col("guess"), F.lit(0.0)))


def numeric_features(columns: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip")


def projected(vectors: DataFrame, dimensions: int) -> DataFrame:
    """Vectors laid out on their ``dimensions`` main axes (column ``point``)."""
    rows = vectors.withColumn("_v", array_to_vector(F.col("vector").cast("array<double>")))
    model = PCA(k=dimensions, inputCol="_v", outputCol="_p").fit(rows)
    return model.transform(rows).withColumn("point", vector_to_array("_p")).drop("_v", "_p", "vector")
