"""Price guesses and model answers, scored."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import Window
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.functions.prices import plain_number
from pricewright.operators.evaluation import (
    answer_label,
    criteria_scores,
    error_metrics,
    error_of,
    freight_band,
    leaderboard,
    overall_scores,
    product_band,
    running_error,
    score_summary,
    success_metrics,
)
from pricewright.operators.models import linear_pricer, numeric_features, priced
from pricewright.operators.ordering import numbered
from pricewright.plans.inputs import PREDICTIONS, predictions, table
from pricewright.plans.registry import query

_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "truth"]


@query("join_predictions", f"""
  WITH {PREDICTIONS}
  SELECT l_orderkey, l_linenumber, truth, round(guess, 4) AS guess,
         round(abs(guess - truth), 4) AS error FROM predictions""")
def join_predictions(spark, folder):
    return predictions(spark, folder).select(
        "l_orderkey", "l_linenumber", "truth", F.round("guess", 4).alias("guess"),
        F.round(error_of(), 4).alias("error"))


_METRICS_SQL = """count(*) AS n, round(avg(abs(guess - truth)), 4) AS mae,
  round(avg((guess - truth) ** 2), 2) AS mse, round(sqrt(avg((guess - truth) ** 2)), 4) AS rmse,
  round((1 - sum((guess - truth) ** 2) / (var_pop(truth) * count(*))) * 100, 6) AS r2_percent"""


def _rounded_metrics(df):
    return df.select(
        *[c for c in df.columns if c not in ("mae", "mse", "rmse", "r2_percent", "mape")],
        F.round("mae", 4).alias("mae"), F.round("mse", 2).alias("mse"),
        F.round("rmse", 4).alias("rmse"), F.round("r2_percent", 6).alias("r2_percent"),
        F.round("mape", 6).alias("mape"))


@query("error_metrics", f"WITH {PREDICTIONS} SELECT model, {_METRICS_SQL} FROM predictions GROUP BY 1")
def error_report(spark, folder):
    return _rounded_metrics(error_metrics(predictions(spark, folder), ["model"])).drop("mape")


@query("mape", f"""
  WITH {PREDICTIONS},
  shifted AS (SELECT model, truth - 5000 AS truth, guess - 5000 AS guess FROM predictions)
  SELECT model, round(sum(CASE WHEN truth > 0 THEN abs(guess - truth) / truth ELSE 0 END)
                      / count(*) * 100, 6) AS mape FROM shifted GROUP BY 1""")
def mape(spark, folder):
    # prices net of a fixed charge, so that some truths are not positive
    net = predictions(spark, folder).select(
        "model", (F.col("truth") - 5000).alias("truth"), (F.col("guess") - 5000).alias("guess"))
    return _rounded_metrics(error_metrics(net, ["model"])).select("model", "mape")


@query("error_bands", f"""
  WITH {PREDICTIONS},
  b AS (SELECT 'product' AS kind, abs(guess - truth) / 50 AS e, truth / 50 AS t FROM predictions
        UNION ALL SELECT 'freight', abs(guess - truth), truth - 5000 FROM predictions),
  r AS (SELECT kind, e, CASE WHEN kind = 'product' THEN e / nullif(t, 0)
                             WHEN t > 0 THEN e / t ELSE 1.0 END AS ratio,
          CASE WHEN kind = 'product' THEN 40 ELSE 1000 END AS g,
          CASE WHEN kind = 'product' THEN 80 ELSE 3000 END AS o FROM b)
  SELECT kind, CASE WHEN e < g OR ratio < 0.2 THEN 'green' WHEN e < o OR ratio < 0.4 THEN 'orange'
                    ELSE 'red' END AS band, count(*) AS n FROM r GROUP BY 1, 2""")
def error_bands(spark, folder):
    rows = predictions(spark, folder)
    error, truth = error_of(), F.col("truth")
    both = F.array(
        F.struct(F.lit("product").alias("kind"), product_band(error / 50, truth / 50).alias("band")),
        F.struct(F.lit("freight").alias("kind"), freight_band(error, truth - 5000).alias("band")),
    )
    return (
        rows.select(F.inline(both)).groupBy("kind", "band").agg(F.count(F.lit(1)).alias("n"))
    )


@query("success_metrics", """
  WITH p AS (SELECT event_type AS model, event_id % 7 <> 0 AS ok, value AS actual,
       CASE WHEN event_id % 7 <> 0 THEN abs(CAST(json_extract_string(props, '$.k') AS DOUBLE) - value)
            ELSE value END AS error FROM events)
  SELECT model, count(*) AS n, count(*) FILTER (ok) AS n_success, count(*) FILTER (NOT ok) AS n_failed,
         round(avg(error) FILTER (ok), 6) AS mae, round(sqrt(avg(error * error) FILTER (ok)), 6) AS rmse
  FROM p GROUP BY 1""")
def success(spark, folder):
    ok = F.col("event_id") % 7 != 0
    guess = F.get_json_object("props", "$.k").cast("double")
    rows = table(spark, folder, "events").select(
        F.col("event_type").alias("model"), ok.alias("ok"),
        F.when(ok, F.abs(guess - F.col("value"))).otherwise(F.col("value")).alias("error"))
    return success_metrics(rows, ["model"]).select(
        "model", "n", "n_success", "n_failed", F.round("mae", 6).alias("mae"),
        F.round("rmse", 6).alias("rmse"))


@query("running_error", f"""
  WITH {PREDICTIONS},
  e AS (SELECT *, abs(guess - truth) AS error FROM predictions),
  r AS (SELECT *, row_number() OVER w AS n, sum(error) OVER w AS s, sum(error * error) OVER w AS q
        FROM e WINDOW w AS (PARTITION BY model ORDER BY l_orderkey, l_linenumber, l_partkey, l_quantity, truth
                            ROWS UNBOUNDED PRECEDING)),
  d AS (SELECT model, l_orderkey, l_linenumber, n, s / n AS mean,
          CASE WHEN n > 1 THEN sqrt(greatest(0, q / n - (s / n) ** 2)) ELSE 0 END AS std FROM r)
  SELECT model, l_orderkey, l_linenumber, n, round(mean, 2) AS mean, round(std, 2) AS std,
         round(CASE WHEN n > 1 THEN 1.96 * std / sqrt(n) ELSE 0 END, 2) AS half_width,
         round(mean + CASE WHEN n > 1 THEN 1.96 * std / sqrt(n) ELSE 0 END, 2) AS upper,
         round(mean - CASE WHEN n > 1 THEN 1.96 * std / sqrt(n) ELSE 0 END, 2) AS lower FROM d""")
def error_trend(spark, folder):
    rows = predictions(spark, folder).withColumn("error", error_of())
    trend = running_error(rows, ["model"], _KEYS)
    return trend.select(
        "model", "l_orderkey", "l_linenumber", "n",
        *[F.round(c, 2).alias(c) for c in ("mean", "std", "half_width", "upper", "lower")])


@query("evaluate_predictor", """
  WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS slope, regr_intercept(l_extendedprice, l_quantity) AS base FROM lineitem),
  f AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS truth, greatest(0, base + slope * l_quantity) AS guess FROM lineitem, m),
  p AS (SELECT 'fitted' AS predictor, * FROM f
    UNION ALL SELECT 'reply', l_orderkey, l_linenumber, truth, floor(guess / 10) * 10 FROM f)
  SELECT predictor, l_orderkey, l_linenumber, truth, round(guess, 2) AS guess, round(abs(guess - truth), 2) AS error,
         CASE WHEN abs(guess - truth) < 1000 OR abs(guess - truth) / truth < 0.2 THEN 'green'
              WHEN abs(guess - truth) < 3000 OR abs(guess - truth) / truth < 0.4 THEN 'orange'
              ELSE 'red' END AS band
  FROM p""")
def evaluate_predictor(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("l_extendedprice").alias("truth"))
    model = Pipeline(stages=[numeric_features(["l_quantity"]), linear_pricer()]).fit(
        lines.withColumnRenamed("truth", "price"))

    def fitted(rows):
        return priced(model, rows)

    def reply(rows):
        """A model that answers in words, to tens."""
        tens = F.format_number(F.floor(F.col("guess") / 10) * 10, 0)
        return fitted(rows).withColumn("guess", F.concat(F.lit("I would say $"), tens, F.lit(", at a guess.")))

    keys = ["l_orderkey", "l_linenumber"]
    scored = [evaluate(lines, predictor, keys).withColumn("predictor", F.lit(name))
              for name, predictor in (("fitted", fitted), ("reply", reply))]
    return scored[0].unionByName(scored[1])


def evaluate(data, predictor, order: list[str], size: int | None = None):
    """Score the test rows, or the first ``size`` of them, with any DataFrame-to-DataFrame predictor.

    The predictor adds ``guess``, a number or a text that holds one.
    """
    scored = predictor(data if size is None else data.orderBy(*order).limit(size))
    if dict(scored.dtypes)["guess"] == "string":
        scored = scored.withColumn("guess", plain_number(F.col("guess")))
    return scored.select(
        "l_orderkey", "l_linenumber", "truth", F.round("guess", 2).alias("guess"),
        F.round(error_of(), 2).alias("error"),
        freight_band(error_of(), F.col("truth")).alias("band"))


_SCORES = """given AS (
  SELECT 'model ' || user_id AS model, event_id AS place,
         CASE event_type WHEN 'click' THEN ' Accuracy ' WHEN 'view' THEN 'COMPLETENESS'
              WHEN 'purchase' THEN 'clarity' ELSE 'other' END AS criterion,
         CASE WHEN event_id % 9 = 0 THEN 'n/a' ELSE CAST(event_id % 11 AS VARCHAR) END AS score FROM events),
wanted AS (
  SELECT DISTINCT 'model ' || user_id AS model, c.criterion
  FROM events, (VALUES ('Accuracy'), ('Completeness'), ('Clarity')) c(criterion)),
valid AS (SELECT model, lower(trim(criterion)) AS name, max_by(try_cast(score AS DOUBLE), place) AS score
  FROM given WHERE try_cast(score AS DOUBLE) IS NOT NULL GROUP BY 1, 2),
scores AS (SELECT w.model, w.criterion, v.score FROM wanted w
  LEFT JOIN valid v ON v.model = w.model AND v.name = lower(trim(w.criterion)))"""
_OVERALL = _SCORES + """, overall AS (
  SELECT model, round_even(avg(score) * 10, 1) AS overall, count(score) AS n_scores FROM scores GROUP BY 1)"""


def _scores(spark, folder):
    events = table(spark, folder, "events")
    model = F.concat(F.lit("model "), F.col("user_id").cast("string"))
    kind = F.col("event_type")
    given = events.select(
        model.alias("model"),
        F.col("event_id").alias("place"),
        F.when(kind == "click", " Accuracy ").when(kind == "view", "COMPLETENESS")
        .when(kind == "purchase", "clarity").otherwise("other").alias("criterion"),
        F.when(F.col("event_id") % 9 == 0, "n/a")
        .otherwise((F.col("event_id") % 11).cast("string")).alias("score"),
    )
    names = F.array(F.lit("Accuracy"), F.lit("Completeness"), F.lit("Clarity"))
    wanted = events.select(model.alias("model")).distinct().withColumn("criterion", F.explode(names))
    return criteria_scores(wanted, given)


@query("criteria_scores", f"WITH {_SCORES} SELECT model, criterion, score FROM scores")
def scores_by_criterion(spark, folder):
    return _scores(spark, folder)


@query("overall_score", f"WITH {_OVERALL} SELECT * FROM overall")
def overall_score(spark, folder):
    return overall_scores(_scores(spark, folder))


@query("leaderboard", f"""
  WITH {_OVERALL}, r AS (SELECT model, overall,
    row_number() OVER (ORDER BY overall DESC NULLS LAST, model) AS place FROM overall)
  SELECT model, overall, place,
    CASE place WHEN 1 THEN 'gold' WHEN 2 THEN 'silver' WHEN 3 THEN 'bronze' END AS medal FROM r""")
def ranked_models(spark, folder):
    return leaderboard(overall_scores(_scores(spark, folder)))


@query("score_summary", f"""
  WITH {_OVERALL}, s AS (SELECT * FROM overall WHERE overall IS NOT NULL)
  SELECT (SELECT model FROM s ORDER BY overall DESC, model LIMIT 1) AS best_model,
         max(overall) AS best_score,
         (SELECT model FROM s ORDER BY overall, model LIMIT 1) AS worst_model,
         min(overall) AS worst_score, round(avg(overall), 1) AS mean_score, count(*) AS n_models FROM s""")
def summary_of_scores(spark, folder):
    return score_summary(overall_scores(_scores(spark, folder)))


@query("answer_labels", """
  WITH a AS (SELECT user_id, 'model ' || user_id AS model, count(*) FILTER (event_type <> 'error') AS n_ok,
               sum(value) AS total FROM events GROUP BY 1),
  l AS (SELECT model, row_number() OVER (ORDER BY user_id) AS place FROM a WHERE n_ok >= 50),
  named AS (SELECT model, CASE WHEN place <= 26 THEN chr(CAST(64 + place AS INTEGER))
                          ELSE 'Answer' || place END AS label FROM l),
  verdicts AS (SELECT label, length(label) * 2 AS score FROM named WHERE label NOT IN ('C', 'Answer30'))
  SELECT a.model, n.label, CAST(v.score AS BIGINT) AS score,
         CASE WHEN n.label IS NULL THEN 'Evaluation failed.'
              WHEN v.label IS NULL THEN 'Evaluation parse failed.' ELSE 'ok' END AS summary
  FROM a LEFT JOIN named n ON a.model = n.model LEFT JOIN verdicts v ON n.label = v.label""")
def answer_labels(spark, folder):
    models = table(spark, folder, "events").groupBy("user_id").agg(
        F.count_if(F.col("event_type") != "error").alias("n_ok")
    ).withColumn("model", F.concat(F.lit("model "), F.col("user_id").cast("string")))
    placed = numbered(models.filter("n_ok >= 50").select("user_id", "model"), ["user_id"], "place")
    named = placed.select("model", answer_label(F.col("place").cast("int")).alias("label"))
    # the judge answers by label only and forgets some labels
    verdicts = named.filter(~F.col("label").isin("C", "Answer30")).select(
        "label", (F.length("label") * 2).cast("long").alias("score"), F.lit(True).alias("judged"))
    joined = models.join(named, "model", "left").join(verdicts, "label", "left")
    return joined.select(
        "model", "label", "score",
        F.when(F.col("label").isNull(), fixed.NO_ANSWER)
        .when(F.col("judged").isNull(), fixed.NO_VERDICT).otherwise("ok").alias("summary"))


@query("run_timing_avg", """
  WITH t AS (SELECT user_id, value, event_type <> 'error' AS ok,
               row_number() OVER (PARTITION BY user_id, event_type <> 'error' ORDER BY event_id) AS run,
               event_id FROM events),
  a AS (SELECT user_id, round(avg(value) FILTER (ok AND run <= 3), 6) AS avg_time,
          string_agg(CAST(value AS VARCHAR), ', ' ORDER BY event_id) FILTER (ok AND run <= 3) AS runs FROM t GROUP BY 1)
  SELECT user_id, avg_time, runs, row_number() OVER (ORDER BY avg_time NULLS LAST, user_id) AS place FROM a""")
def run_timing_avg(spark, folder):
    """Mean of the first three good runs per model; models without one come last."""
    events = table(spark, folder, "events").withColumn("ok", F.col("event_type") != "error")
    nth = F.row_number().over(Window.partitionBy("user_id", "ok").orderBy("event_id"))
    # three rows per model and outcome remain before anything is gathered
    runs = events.withColumn("run", nth).filter("run <= 3")
    ordered = F.array_sort(F.collect_list(F.when(F.col("ok"), F.struct("event_id", "value"))))
    timed = runs.groupBy("user_id").agg(
        F.round(F.avg(F.when(F.col("ok"), F.col("value"))), 6).alias("avg_time"),
        F.array_join(F.transform(ordered, lambda r: r["value"].cast("string")), ", ").alias("runs"),
    )
    listed = timed.withColumn("runs", F.nullif("runs", F.lit("")))
    return numbered(listed, [F.asc_nulls_last("avg_time"), "user_id"], "place")
