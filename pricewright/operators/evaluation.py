"""Scoring price guesses against the truth, and answers against criteria."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.operators.ordering import numbered, running_sums


def error_of(truth: str = "truth", guess: str = "guess") -> Column:
    return F.abs(F.col(guess) - F.col(truth))


def band(error: Column, truth: Column, limits: tuple[float, float], ratio_at_zero: float | None) -> Column:
    """green / orange / red by absolute error or by error relative to the truth.

    ``ratio_at_zero`` is the ratio where the truth is not positive; None leaves
    it to the division, which has no ratio (null) only at a truth of zero.
    """
    ratio = F.try_divide(error, truth)
    if ratio_at_zero is not None:
        ratio = F.when(truth > 0, ratio).otherwise(F.lit(ratio_at_zero))
    green, orange = limits
    green_ratio, orange_ratio = fixed.BAND_RATIOS
    return (
        F.when((error < green) | (ratio < green_ratio), "green")
        .when((error < orange) | (ratio < orange_ratio), "orange")
        .otherwise("red")
    )


def product_band(error: Column, truth: Column) -> Column:
    return band(error, truth, fixed.PRODUCT_BAND, None)


def freight_band(error: Column, truth: Column) -> Column:
    return band(error, truth, fixed.FREIGHT_BAND, 1.0)


def error_metrics(df: DataFrame, by: list[str]) -> DataFrame:
    """MAE, MSE, RMSE, R2 in percent (one minus residual over total) and MAPE.

    MAPE sums over positive truths but divides by all rows.
    """
    error = error_of()
    residual = F.sum(error * error)
    # total sum of squares around the mean, as a mergeable variance aggregate
    total = F.var_pop("truth") * F.count("truth")
    mape = F.sum(F.when(F.col("truth") > 0, error / F.col("truth")).otherwise(0.0))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        ((1 - F.try_divide(residual, total)) * 100).alias("r2_percent"),
        (mape / F.count(F.lit(1)) * 100).alias("mape"),
    )


def running_error(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Running mean error with its 95 % interval, in evaluation order per group."""
    error = F.col("error")
    totals = running_sums(df, by, order, {"total": error, "squares": error * error})
    n = F.col("n")
    mean = F.col("total") / n
    spread = F.sqrt(F.greatest(F.lit(0.0), F.col("squares") / n - mean * mean))
    spread = F.when(n > 1, spread).otherwise(0.0)
    half = F.when(n > 1, 1.96 * spread / F.sqrt(n)).otherwise(0.0)
    return totals.select(
        *df.columns, "n", mean.alias("mean"), spread.alias("std"), half.alias("half_width"),
        (mean + half).alias("upper"), (mean - half).alias("lower"),
    )


def success_metrics(df: DataFrame, by: list[str]) -> DataFrame:
    """MAE and RMSE over successful predictions; failures are only counted."""
    good = F.when(F.col("ok"), F.col("error"))
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("ok")).alias("n_success"),
        F.count_if(~F.col("ok")).alias("n_failed"),
        F.avg(good).alias("mae"),
        F.sqrt(F.avg(good * good)).alias("rmse"),
    )


def criteria_scores(wanted: DataFrame, given: DataFrame) -> DataFrame:
    """Each wanted criterion's score, matched by trimmed lower-case name.

    Non-numeric scores do not count; of several numeric ones the last wins.
    """
    name = F.lower(F.trim("criterion"))
    scores = (
        given.select("model", "place", name.alias("_name"), F.expr("try_cast(score as double)").alias("_score"))
        .filter("_score is not null")
        .groupBy("model", "_name")
        .agg(F.max_by("_score", "place").alias("score"))
    )
    return (
        wanted.withColumn("_name", name)
        .join(scores, ["model", "_name"], "left")
        .select("model", "criterion", "score")
    )


def overall_scores(scores: DataFrame) -> DataFrame:
    """Mean of the valid criterion scores on a 0-100 scale, one decimal, half to even."""
    return scores.groupBy("model").agg(
        F.bround(F.avg("score") * 10, 1).alias("overall"), F.count("score").alias("n_scores")
    )


def leaderboard(models: DataFrame) -> DataFrame:
    """Rank and medal per model; models without a score come last, ties by name."""
    ranked = numbered(models.select("model", "overall"), [F.desc_nulls_last("overall"), "model"], "place")
    place = F.col("place")
    medals = F.when(place == 1, "gold").when(place == 2, "silver").when(place == 3, "bronze")
    return ranked.withColumn("medal", medals)


def answer_label(place: Column) -> Column:
    """A..Z for the first 26 places, then Answer27 and so on."""
    return F.when(place <= 26, F.char(F.lit(64) + place)).otherwise(
        F.concat(F.lit("Answer"), place.cast("string")))


def score_summary(models: DataFrame) -> DataFrame:
    """Best and worst model (first name wins a tie), mean score, how many were scored."""
    scored = models.filter("overall is not null")
    best = F.min_by("model", F.struct(-F.col("overall"), F.col("model")))
    worst = F.min_by("model", F.struct(F.col("overall"), F.col("model")))
    return scored.agg(
        best.alias("best_model"), F.max("overall").alias("best_score"),
        worst.alias("worst_model"), F.min("overall").alias("worst_score"),
        F.round(F.avg("overall"), 1).alias("mean_score"), F.count(F.lit(1)).alias("n_models"),
    )


def metric_band(metric: Column, value: Column) -> Column:
    """green / orange / red against the fixed limits of each metric, black when it has none."""
    colour = F.lit("black")
    for name, (green, orange) in fixed.METRIC_BANDS.items():
        colour = F.when(
            metric == name,
            F.when(value >= green, "green").when(value >= orange, "orange").otherwise("red"),
        ).otherwise(colour)
    return colour
