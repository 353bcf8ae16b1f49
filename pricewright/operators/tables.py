"""Whole-table counts, shares, histograms and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewright.operators.ordering import first_per_group
from pricewright.operators.ranks import quantiles


def counts_with_share(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and their percentage of all rows.

    The total adds up the counts, whose exchange it shares, so that the rows are read once.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.round(F.col("n") * 100 / total, 4))


def top_counts(df: DataFrame, key: str, limit: int, *extra: Column) -> DataFrame:
    """The ``limit`` commonest keys; equal counts in key order, missing keys never listed.

    The roll-up's total row gives the share's base in the same pass; it sorts first.
    """
    top = (
        df.rollup(key)
        .agg(F.grouping_id().alias("_total"), F.count(F.lit(1)).alias("n"), *extra)
        .filter((F.col("_total") == 1) | F.col(key).isNotNull())
        .orderBy(F.desc("_total"), F.desc("n"), key)
        .limit(limit + 1)
    )
    base = F.max(F.when(F.col("_total") == 1, F.col("n"))).over(Window.partitionBy(F.lit(1)))
    return (
        top.withColumn("share", F.round(F.col("n") * 100 / base, 4))
        .filter("_total = 0")
        .drop("_total")
    )


def top_counts_of_each(df: DataFrame, kinds: dict[str, Column], limit: int) -> DataFrame:
    """The ``limit`` commonest values of several columns in one pass: kind, value, n, share."""
    pairs = [F.struct(F.lit(kind).alias("kind"), value.alias("value")) for kind, value in kinds.items()]
    counts = (
        df.select(F.inline(F.array(*pairs))).filter("value is not null")
        .groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))
    )
    top = first_per_group(counts, ["kind"], [F.desc("n"), "value"], limit).drop("place")
    return top.withColumn("share", F.round(F.col("n") * 100 / F.lit(df.count()), 4))


def stepped_histogram(df: DataFrame, value: Column, width: int, top: int) -> DataFrame:
    """Counts per ``width``-wide bin over 0..``top`` (top included), with overall statistics.

    Values outside the bins stay in the statistics only.
    """
    v = F.col("v")
    low = F.least((F.floor(v / width) * width).cast("long"), F.lit(top - width))
    bins = (
        df.select(value.alias("v"))
        .groupBy(F.when((v >= 0) & (v <= top), low).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"), F.count("v").alias("known"), F.sum("v").alias("total"),
             F.min("v").alias("lo"), F.max("v").alias("hi"))
    )
    every = Window.partitionBy(F.lit(1))  # a row per bin
    return bins.select(
        "bin", "n", F.round(F.sum("total").over(every) / F.sum("known").over(every), 4).alias("avg_value"),
        F.min("lo").over(every).alias("min_value"), F.max("hi").over(every).alias("max_value"),
    ).filter("bin is not null")


def even_histograms(df: DataFrame, columns: list[str], bins: int) -> DataFrame:
    """``bins`` equal bins between minimum and maximum, over all and over positive values."""
    pairs = ", ".join(f"'{c}', 'all', {c}, '{c}', 'positive', if({c} > 0, {c}, null)" for c in columns)
    long = df.selectExpr(f"stack({2 * len(columns)}, {pairs}) as (metric, subset, v)").filter(
        "v is not null"
    )
    edges = long.groupBy("metric", "subset").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    # a column of one value has no width: all in the first bin
    step = F.coalesce(F.floor(F.try_divide(F.col("v") - F.col("lo"), width)), F.lit(0))
    spot = F.least(step, F.lit(bins - 1))
    return (
        # one row of edges per metric and subset
        long.join(F.broadcast(edges), ["metric", "subset"])
        .groupBy("metric", "subset", spot.cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Missing values per column, only where there are any."""
    one = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return one.unpivot([], df.columns, "column_name", "n_missing").filter("n_missing > 0")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per numeric column."""
    cuts = quantiles(df, columns, [0.25, 0.5, 0.75])
    types = dict(df.dtypes)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(types[c]).alias("data_type"),
                F.count(c).alias("n"),
                F.round(F.avg(c), 4).alias("mean"),
                F.round(F.stddev_samp(c), 4).alias("std"),
                F.min(c).alias("min_value"),
                rounded(cuts[c, 0.25], 6).alias("p25"),
                rounded(cuts[c, 0.5], 6).alias("p50"),
                rounded(cuts[c, 0.75], 6).alias("p75"),
                F.max(c).alias("max_value"),
            )
            for c in columns
        ]
    )
    return df.agg(rows.alias("rows")).select(F.inline("rows"))


def rounded(value: float | None, places: int) -> Column:
    """A number, or a missing one, as a column."""
    return F.lit(None if value is None else round(value, places)).cast("double")


def outlier_bounds(df: DataFrame, column: str) -> tuple[float | None, float | None]:
    """The 1.5 x interquartile-range fences, none of a column without values."""
    cuts = quantiles(df, [column], [0.25, 0.75])
    if cuts[column, 0.25] is None:
        return None, None
    spread = cuts[column, 0.75] - cuts[column, 0.25]
    return cuts[column, 0.25] - 1.5 * spread, cuts[column, 0.75] + 1.5 * spread
