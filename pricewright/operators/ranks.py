"""Exact order statistics from bounded scalars: no global sort, no value map in one task."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000
MAX_CANDIDATES = 1_000_000


@dataclass
class _Bracket:
    """The closed value range known to hold one 0-based rank."""

    column: str
    rank: int
    low: float | int | None = None
    high: float | int | None = None
    below: int = 0
    inside: int = 0

    def holds(self) -> Column:
        value = F.col(self.column)
        test = value.isNotNull()
        if self.low is not None:
            test = test & (value >= self.low)
        if self.high is not None:
            test = test & (value <= self.high)
        return test

    def under(self) -> Column:
        return F.lit(False) if self.low is None else F.col(self.column) < self.low


def values_at_ranks(df: DataFrame, wanted: list[tuple[str, int]],
                    sizes: dict[str, int] | None = None) -> dict[tuple[str, int], float]:
    """The value at each 0-based rank of each column, nulls left out.

    Quantile sketches bracket every rank, exact counts confirm the bracket, and
    brackets narrow until few distinct values are left; only these are ranked.
    Equal values travel as one row with a count, so a hot value costs nothing.
    """
    wanted = sorted(set(wanted))
    if not wanted:
        return {}
    df = _numbers(df, sorted({column for column, _ in wanted}))
    sizes = sizes or _sizes(df, sorted({column for column, _ in wanted}))
    brackets = [
        _Bracket(column, rank, inside=sizes[column]) for column, rank in wanted if rank < sizes[column]
    ]
    if not brackets:
        return {}
    while any(b.inside > MAX_CANDIDATES and b.low != b.high or b.low is None for b in brackets):
        before = [(b.low, b.high, b.inside) for b in brackets]
        _narrow(df, brackets)
        if before == [(b.low, b.high, b.inside) for b in brackets]:
            _halve(df, brackets)
    settled = [b for b in brackets if b.low is not None and b.low == b.high]
    found = {(b.column, b.rank): b.low for b in settled}
    left = [b for b in brackets if b not in settled]
    return {**found, **_pick(df, left)} if left else found


def quantiles(df: DataFrame, columns: list[str], shares: list[float]) -> dict[tuple[str, float], float | None]:
    """Linear-interpolation quantiles (the usual table-statistics definition), none of a column without values."""
    df = _numbers(df, columns)
    sizes = _sizes(df, columns)
    spots = {
        (column, share): (sizes[column] - 1) * share
        for column in columns
        for share in shares
        if sizes[column]
    }
    wanted = [
        (column, rank)
        for (column, _), spot in spots.items()
        for rank in (math.floor(spot), math.ceil(spot))
    ]
    found = values_at_ranks(df, wanted, sizes)
    result: dict[tuple[str, float], float | None] = {(column, share): None for column in columns for share in shares}
    for (column, share), spot in spots.items():
        low, high = float(found[column, math.floor(spot)]), float(found[column, math.ceil(spot)])
        # between equal or infinite neighbours there is nothing to weigh
        result[column, share] = low if low == high or spot == math.floor(spot) else low + (high - low) * (spot - math.floor(spot))
    return result


def _numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns alone, not-a-number counted as missing."""
    types = dict(df.dtypes)
    return df.select(*[
        F.when(~F.isnan(c), F.col(c)).alias(c) if types[c] in ("double", "float") else F.col(c)
        for c in columns
    ])


def _sizes(df: DataFrame, columns: list[str]) -> dict[str, int]:
    return df.agg(*[F.count(column).alias(column) for column in columns]).first().asDict()


def _narrow(df: DataFrame, brackets: list[_Bracket]) -> None:
    margin = 2 / ACCURACY
    # ranks in the same bracket share one sketch
    shared: dict[tuple, list[int]] = {}
    for i, b in enumerate(brackets):
        shared.setdefault((b.column, b.low, b.high), []).append(i)
    sketches = []
    for members in shared.values():
        ends = []
        for b in (brackets[i] for i in members):
            share = (b.rank - b.below + 0.5) / b.inside
            ends += [max(0.0, share - margin), min(1.0, share + margin)]
        b = brackets[members[0]]
        sketches.append(F.percentile_approx(F.when(b.holds(), F.col(b.column)), ends, ACCURACY))
    found = df.agg(*[sketch.alias(f"s{j}") for j, sketch in enumerate(sketches)]).first()
    tries = list(brackets)
    for j, members in enumerate(shared.values()):
        for at, i in enumerate(members):
            b = brackets[i]
            tries[i] = _Bracket(b.column, b.rank, found[j][2 * at], found[j][2 * at + 1])
    # neighbouring ranks mostly come out with the same ends: count these once
    distinct = list({(t.column, t.low, t.high): t for t in tries}.items())
    counts = df.agg(
        *[F.count_if(t.under()).alias(f"b{j}") for j, (_, t) in enumerate(distinct)],
        *[F.count_if(t.holds()).alias(f"i{j}") for j, (_, t) in enumerate(distinct)],
    ).first()
    counted = {key: (counts[f"b{j}"], counts[f"i{j}"]) for j, (key, _) in enumerate(distinct)}
    for b, t in zip(brackets, tries, strict=True):
        t.below, t.inside = counted[t.column, t.low, t.high]
        if t.below <= b.rank < t.below + t.inside:
            b.low, b.high, b.below, b.inside = t.low, t.high, t.below, t.inside


def _halve(df: DataFrame, brackets: list[_Bracket]) -> None:
    """Cut brackets that a sketch no longer narrows at the middle of their values."""
    for b in brackets:
        if b.low is None:  # no sketch was confirmed: the whole range
            b.low, b.high = df.agg(F.min(b.column), F.max(b.column)).first()
        if b.inside <= MAX_CANDIDATES or b.low == b.high:
            continue
        whole = isinstance(b.low, int) and isinstance(b.high, int)
        middle = (b.low + b.high) // 2 if whole else b.low + (b.high - b.low) / 2
        lower = _Bracket(b.column, b.rank, b.low, middle)
        inside = df.agg(F.count_if(lower.holds())).first()[0]
        if b.rank < b.below + inside:
            b.high, b.inside = middle, inside
        else:
            b.low = middle + 1 if whole else math.nextafter(middle, math.inf)
            b.below, b.inside = b.below + inside, b.inside - inside


def _pick(df: DataFrame, brackets: list[_Bracket]) -> dict[tuple[str, int], float]:
    types = dict(df.dtypes)

    def value(column: str) -> list[Column]:
        """Whole numbers stay whole: a double would round those above 2 to the 53."""
        whole = types[column] in ("tinyint", "smallint", "int", "bigint")
        none = F.lit(None)
        return [(F.col(column) if whole else none).cast("long").alias("w"),
                (none if whole else F.col(column)).cast("double").alias("v")]

    tagged = F.array(
        *[F.when(b.holds(), F.struct(F.lit(i).alias("i"), *value(b.column))) for i, b in enumerate(brackets)])
    # few rows are in any bracket; the others stop at this filter
    near = reduce(lambda a, b: a | b, [b.holds() for b in brackets])
    counts = (
        df.filter(near).select(F.explode(F.filter(tagged, lambda x: x.isNotNull())).alias("c"))
        .groupBy("c.i", "c.w", "c.v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = Window.partitionBy("i").orderBy("w", "v").rowsBetween(Window.unboundedPreceding, 0)
    target = F.lit(None).cast("long")
    for i, b in enumerate(brackets):
        target = F.when(F.col("i") == i, F.lit(b.rank - b.below)).otherwise(target)
    rows = (
        counts.withColumn("end", F.sum("n").over(upto))
        .withColumn("target", target)
        .filter((F.col("target") < F.col("end")) & (F.col("target") >= F.col("end") - F.col("n")))
        .select("i", F.coalesce("w", "v").alias("v"), "w")
        .collect()  # one value per wanted rank
    )
    return {(brackets[row.i].column, brackets[row.i].rank): row.v if row.w is None else row.w for row in rows}
