"""Repeatable samples and exact splits by hashed order."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright.operators.ranks import values_at_ranks

SEED = 42
_HASH_DIGITS = 13  # 52 bits: exact in a double


def hashed(key: Column, seed: int = SEED) -> Column:
    """A uniform whole number per key, the same on any cluster layout."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f"/{seed}")))
    return F.conv(F.substring(digest, 1, _HASH_DIGITS), 16, 10).cast("long")


def sample_rows(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """``n`` rows without replacement: the first in hashed order."""
    return (
        df.withColumn("_hash", hashed(F.col(key), seed)).orderBy("_hash", key).limit(n).drop("_hash"))


def _first_in_hashed_order(rows: DataFrame, key: str, counts: list[int]) -> list[Column]:
    """For each count, the test that a row is among that many first ones.

    Only the hash at the border is looked up; the few keys that share it are
    told apart by the key itself. No row moves.
    """
    found = values_at_ranks(rows, [("_hash", count - 1) for count in counts if count > 0])
    borders = [int(found["_hash", count - 1]) if count > 0 else -1 for count in counts]
    at = F.col("_hash")
    sizes = rows.agg(
        *[F.count_if(at < border) for border in borders], *[F.count_if(at == border) for border in borders]
    ).first()
    tests = []
    for i, (count, border) in enumerate(zip(counts, borders, strict=True)):
        below, equal = sizes[i], sizes[len(borders) + i]
        if below + equal == count:
            tests.append(at <= border)
        else:
            last = rows.filter(at == border).orderBy(key).limit(count - below).agg(F.max(key)).first()[0]
            tests.append((at < border) | ((at == border) & (F.col(key) <= last)))
    return tests


def exact_split(df: DataFrame, key: str, train: float = 0.8, validation: float = 0.1,
                test: float = 0.1, seed: int = SEED) -> DataFrame:
    """Add ``split`` with exact sizes: ceil of the test share, then ceil of the rest's share."""
    rows = df.select(key).withColumn("_hash", hashed(F.col(key), seed))
    n = rows.count()
    n_test = math.ceil(test * n)
    n_validation = math.ceil(validation / (train + validation) * (n - n_test))
    in_test, in_either = _first_in_hashed_order(rows, key, [n_test, n_test + n_validation])
    split = F.when(in_test, "test").when(in_either, "validation").otherwise("train")
    return df.withColumn("_hash", hashed(F.col(key), seed)).withColumn("split", split).drop("_hash")


def holdout_split(df: DataFrame, key: str, share: float, seed: int = SEED) -> DataFrame:
    """Add ``split``: exactly ceil(share) rows for validation, the others for training."""
    rows = df.select(key).withColumn("_hash", hashed(F.col(key), seed))
    (held,) = _first_in_hashed_order(rows, key, [math.ceil(share * rows.count())])
    return (
        df.withColumn("_hash", hashed(F.col(key), seed))
        .withColumn("split", F.when(held, "validation").otherwise("train"))
        .drop("_hash")
    )
