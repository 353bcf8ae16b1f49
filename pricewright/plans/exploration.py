"""Exploring bookings and products: counts, spreads, histograms, quality."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.operators.ordering import numbered
from pricewright.operators.ranks import quantiles, values_at_ranks
from pricewright.operators.tables import (
    counts_with_share,
    describe,
    even_histograms,
    null_counts,
    outlier_bounds,
    rounded,
    stepped_histogram,
    top_counts,
    top_counts_of_each,
)
from pricewright.plans.inputs import BOOKED_LINES, BOOKINGS, booked_lines, bookings, table
from pricewright.plans.registry import query
from pricewright.session import staged


@query("text_length_hist", """
  WITH l AS (SELECT coalesce(length(text), 0) AS v FROM documents),
  s AS (SELECT round(avg(v), 4) AS a, min(v) AS lo, max(v) AS hi FROM l)
  SELECT least(v // 50 * 50, 3950) AS bin, count(*) AS n, any_value(a) AS avg_value,
         any_value(lo) AS min_value, any_value(hi) AS max_value
  FROM l, s WHERE v <= 4000 GROUP BY 1""")
def text_length_hist(spark, folder):
    length = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    return stepped_histogram(table(spark, folder, "documents"), length, 50, 4000)


@query("price_hist", """
  WITH s AS (SELECT round(avg(value), 4) AS a, min(value) AS lo, max(value) AS hi FROM events)
  SELECT least(CAST(floor(value / 10) * 10 AS BIGINT), 980) AS bin, count(*) AS n,
         any_value(a) AS avg_value, any_value(lo) AS min_value, any_value(hi) AS max_value
  FROM events, s WHERE value BETWEEN 0 AND 990 GROUP BY 1""")
def price_hist(spark, folder):
    return stepped_histogram(table(spark, folder, "events"), F.col("value"), 10, 990)


@query("fixed_count_hist", f"""
  WITH {BOOKED_LINES},
  long AS (SELECT 'price' AS metric, 'all' AS subset, price AS v FROM booked
    UNION ALL SELECT 'price', 'positive', price FROM booked WHERE price > 0
    UNION ALL SELECT 'teu', 'all', teu FROM booked
    UNION ALL SELECT 'teu', 'positive', teu FROM booked WHERE teu > 0),
  edges AS (SELECT metric, subset, min(v) AS lo, max(v) AS hi FROM long GROUP BY 1, 2)
  SELECT metric, subset,
         CAST(least(floor((v - lo) / ((hi - lo) / 50)), 49) AS BIGINT) AS bin, count(*) AS n
  FROM long JOIN edges USING (metric, subset) GROUP BY 1, 2, 3""")
def fixed_count_hist(spark, folder):
    return even_histograms(booked_lines(spark, folder), ["price", "teu"], 50)


@query("category_counts", """
  SELECT p_type, count(*) AS n, round(count(*) * 100 / (SELECT count(*) FROM part), 4) AS share
  FROM part GROUP BY 1""")
def category_counts(spark, folder):
    return counts_with_share(table(spark, folder, "part"), "p_type")


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_table", " UNION ALL ".join(f"""
  SELECT '{c}' AS column_name, 'double' AS data_type, count({c}) AS n, round(avg({c}), 4) AS mean,
         round(stddev_samp({c}), 4) AS std, min({c}) AS min_value,
         round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
         round(quantile_cont({c}, 0.75), 6) AS p75, max({c}) AS max_value
  FROM lineitem""" for c in _MEASURES))
def describe_table(spark, folder):
    return describe(table(spark, folder, "lineitem"), _MEASURES)


@query("null_counts", """
  WITH j AS (SELECT * FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey),
  c AS (SELECT """ + ", ".join(
    f"count(*) FILTER ({c} IS NULL) AS {c}"
    for c in ["o_orderkey", "o_custkey", "o_totalprice", "l_orderkey", "l_partkey", "l_suppkey",
              "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"]) + """ FROM j)
  SELECT column_name, n_missing FROM (UNPIVOT c ON COLUMNS(*) INTO NAME column_name VALUE n_missing)
  WHERE n_missing > 0""")
def missing_values(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_shipdate")
    return null_counts(orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left"))


_SHARES = [0.25, 0.5, 0.75, 0.95, 0.99]


@query("price_percentiles", f"""
  WITH {BOOKED_LINES}
  SELECT count(price) AS n, round(avg(price), 4) AS mean, round(stddev_samp(price), 4) AS std,
         min(price) AS min_price, max(price) AS max_price,
         {", ".join(f"round(quantile_cont(price, {s}), 6) AS p{round(s * 100)}" for s in _SHARES)}
  FROM booked""")
def price_percentiles(spark, folder):
    lines = booked_lines(spark, folder)
    cuts = quantiles(lines, ["price"], _SHARES)
    return lines.agg(
        F.count("price").alias("n"),
        F.round(F.avg("price"), 4).alias("mean"),
        F.round(F.stddev_samp("price"), 4).alias("std"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
    ).select("*", *[rounded(cuts["price", s], 6).alias(f"p{round(s * 100)}") for s in _SHARES])


@query("iqr_outliers", f"""
  WITH {BOOKED_LINES},
  q AS (SELECT quantile_cont(price, 0.25) AS a, quantile_cont(price, 0.75) AS b FROM booked),
  f AS (SELECT a - 1.5 * (b - a) AS low, b + 1.5 * (b - a) AS high FROM q)
  SELECT round(any_value(low), 4) AS lower_bound, round(any_value(high), 4) AS upper_bound,
         count(*) FILTER (price < low OR price > high) AS n_outliers,
         round(count(*) FILTER (price < low OR price > high) * 100 / count(*), 4) AS share
  FROM booked, f""")
def iqr_outliers(spark, folder):
    lines = booked_lines(spark, folder)
    low, high = outlier_bounds(lines, "price")
    outside = F.count_if((F.col("price") < F.lit(low)) | (F.col("price") > F.lit(high)))
    return lines.agg(
        rounded(low, 4).alias("lower_bound"),
        rounded(high, 4).alias("upper_bound"),
        outside.alias("n_outliers"),
        F.round(outside * 100 / F.count(F.lit(1)), 4).alias("share"),
    )


@query("volume_buckets", f"""
  WITH {BOOKED_LINES}
  SELECT CASE WHEN teu < 20 THEN 'small' WHEN teu < 100 THEN 'medium'
              WHEN teu < 500 THEN 'large' ELSE 'extra large' END AS volume,
         count(*) AS n, round(count(*) * 100 / (SELECT count(*) FROM booked), 4) AS share
  FROM booked GROUP BY 1""")
def volume_buckets(spark, folder):
    teu = F.col("teu")
    volume = (
        F.when(teu < 20, "small").when(teu < 100, "medium").when(teu < 500, "large")
        .otherwise("extra large")
    )
    return counts_with_share(booked_lines(spark, folder).select(volume.alias("volume")), "volume")


def _top_values_sql(kind: str, key: str) -> str:
    return f"""(SELECT '{kind}' AS kind, {key} AS value, count(*) AS n,
      round(count(*) * 100 / (SELECT count(*) FROM booked), 4) AS share
      FROM booked GROUP BY 2 ORDER BY n DESC, value LIMIT 10)"""


@query("top_values", f"WITH {BOOKED_LINES} " + " UNION ALL ".join(
    _top_values_sql(kind, key)
    for kind, key in [("origin", "pol"), ("destination", "pod"), ("route", "pol || ' → ' || pod")]))
def top_values(spark, folder):
    route = F.concat("pol", F.lit(fixed.ROUTE), "pod")
    kinds = {"origin": F.col("pol"), "destination": F.col("pod"), "route": route}
    return top_counts_of_each(booked_lines(spark, folder), kinds, 10)


@query("distinct_counts", f"""
  WITH {BOOKINGS}
  SELECT count(DISTINCT pol || ' → ' || pod) AS n_routes, count(DISTINCT pol) AS n_origins,
         count(DISTINCT pod) AS n_destinations, count(DISTINCT currency) AS n_currencies,
         count(DISTINCT commodity_desc) AS n_commodities FROM bookings""")
def distinct_counts(spark, folder):
    return bookings(spark, folder).agg(
        F.countDistinct(F.concat("pol", F.lit(fixed.ROUTE), "pod")).alias("n_routes"),
        F.countDistinct("pol").alias("n_origins"),
        F.countDistinct("pod").alias("n_destinations"),
        F.countDistinct("currency").alias("n_currencies"),
        F.countDistinct("commodity_desc").alias("n_commodities"),
    )


@query("group_mean_share", f"""
  WITH {BOOKINGS}, t AS (SELECT count(*) AS total FROM bookings)
  SELECT 'currency' AS kind, currency AS value, count(*) AS n,
         round(count(*) * 100 / any_value(total), 4) AS share, round(avg(price), 4) AS mean_price
  FROM bookings, t GROUP BY currency
  UNION ALL
  SELECT 'booking_type', booking_type, count(*), round(count(*) * 100 / any_value(total), 4),
         round(avg(price), 4) FROM bookings, t GROUP BY booking_type""")
def group_mean_share(spark, folder):
    by_kind = bookings(spark, folder).groupingSets(
        [["currency"], ["booking_type"]], "currency", "booking_type"
    ).agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"),
        F.round(F.avg("price"), 4).alias("mean_price"),
    )
    is_currency = F.col("gid") == 1
    # currencies and booking types are short lists; each kind adds up to all rows
    base = F.sum("n").over(Window.partitionBy("gid"))
    return by_kind.select(
        F.when(is_currency, "currency").otherwise("booking_type").alias("kind"),
        F.when(is_currency, F.col("currency")).otherwise(F.col("booking_type")).alias("value"),
        "n", F.round(F.col("n") * 100 / base, 4).alias("share"), "mean_price",
    ).filter("value is not null")


@query("top_groups_mean", f"""
  WITH {BOOKINGS}
  SELECT CASE WHEN length(commodity_desc) > 50 THEN commodity_desc[1:50] || '...'
              ELSE commodity_desc END AS commodity,
         count(*) AS n, round(count(*) * 100 / (SELECT count(*) FROM bookings), 4) AS share,
         round(avg(price), 4) AS mean_price
  FROM bookings GROUP BY commodity_desc ORDER BY n DESC, commodity_desc LIMIT 15""")
def top_groups_mean(spark, folder):
    rows = bookings(spark, folder).select("commodity_desc", "price")
    top = top_counts(
        rows, "commodity_desc", 15, F.round(F.avg("price"), 4).alias("mean_price"))
    name = F.col("commodity_desc")
    short = F.when(F.length(name) > 50, F.concat(F.substring(name, 1, 50), F.lit("..."))).otherwise(name)
    return top.select(short.alias("commodity"), "n", "share", "mean_price")


@query("count_by_period", """
  WITH t AS (SELECT count(*) AS total FROM orders)
  SELECT 'year' AS period, CAST(year(o_orderdate) AS BIGINT) AS place,
         CAST(year(o_orderdate) AS VARCHAR) AS label, count(*) AS n,
         round(count(*) * 100 / any_value(total), 4) AS share FROM orders, t GROUP BY year(o_orderdate)
  UNION ALL
  SELECT 'month', month(o_orderdate), ['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct',
         'Nov','Dec'][month(o_orderdate)], count(*), round(count(*) * 100 / any_value(total), 4)
  FROM orders, t GROUP BY month(o_orderdate)""")
def count_by_period(spark, folder):
    rows = table(spark, folder, "orders").select(
        F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    counted = rows.groupingSets([["year"], ["month"]], "year", "month").agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"))
    names = F.array(*[F.lit(m) for m in fixed.MONTH_NAMES])
    by_year = F.col("gid") == 1
    # a few years and twelve months; each kind adds up to all rows
    base = F.sum("n").over(Window.partitionBy("gid"))
    return counted.select(
        F.when(by_year, "year").otherwise("month").alias("period"),
        F.when(by_year, F.col("year")).otherwise(F.col("month")).cast("long").alias("place"),
        F.when(by_year, F.col("year").cast("string"))
        .otherwise(F.try_element_at(names, F.col("month"))).alias("label"),
        "n", F.round(F.col("n") * 100 / base, 4).alias("share"),
    ).filter("place is not null")


@query("channel_counts", """
  SELECT o_orderstatus AS channel, count(*) AS n,
         round(count(*) * 100 / (SELECT count(*) FROM orders), 4) AS share FROM orders GROUP BY 1""")
def channel_counts(spark, folder):
    orders = table(spark, folder, "orders").select(F.col("o_orderstatus").alias("channel"))
    return counts_with_share(orders, "channel").filter("channel is not null")


@query("upper_median", f"""
  WITH {BOOKED_LINES},
  r AS (SELECT price, teu, row_number() OVER (ORDER BY price) AS rp,
               row_number() OVER (ORDER BY teu) AS rt, count(*) OVER () AS n FROM booked)
  SELECT max(price) FILTER (rp = n // 2 + 1) AS median_price,
         max(teu) FILTER (rt = n // 2 + 1) AS median_teu, count(*) AS n FROM r""")
def upper_median(spark, folder):
    lines = booked_lines(spark, folder)
    n = lines.count()
    found = values_at_ranks(lines, [("price", n // 2), ("teu", n // 2)])
    return lines.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(found.get(("price", n // 2))).cast("double").alias("median_price"),
        F.lit(found.get(("teu", n // 2))).cast("double").alias("median_teu"),
        "n",
    )


@query("filter_thresholds", """
  SELECT CASE WHEN l_extendedprice < 5000 OR l_extendedprice > 80000 THEN 'price'
              WHEN l_quantity < 3 THEN 'teu' ELSE 'kept' END AS outcome, count(*) AS n,
         round(count(*) * 100 / (SELECT count(*) FROM lineitem), 4) AS share FROM lineitem GROUP BY 1""")
def filter_thresholds(spark, folder):
    return counts_with_share(
        with_threshold_outcome(booked_lines(spark, folder), 5000.0, 80000.0, 3.0, None)
        .select("outcome"), "outcome")


def with_threshold_outcome(df, min_price, max_price, min_teu, max_teu):
    """'price', 'teu' or 'kept' per row; the price rule comes first, a max of 0 or None is off."""
    price, teu = F.col("price"), F.col("teu")
    bad_price, bad_teu = price < min_price, teu < min_teu
    if max_price:
        bad_price = bad_price | (price > max_price)
    if max_teu:
        bad_teu = bad_teu | (teu > max_teu)
    return df.withColumn(
        "outcome", F.when(bad_price, "price").when(bad_teu, "teu").otherwise("kept"))


@query("invalid_rows", """
  SELECT count(*) FILTER (l_tax = 0) AS zero_price, count(*) FILTER (l_tax < 0) AS negative_price,
         count(*) FILTER (l_tax <= 0) AS invalid_price, count(*) FILTER (l_discount = 0) AS zero_teu,
         count(*) FILTER (l_discount <= 0) AS invalid_teu FROM lineitem""")
def invalid_rows(spark, folder):
    # tax and discount hold zeros, which prices and volumes here do not
    lines = table(spark, folder, "lineitem")
    price, teu = F.col("l_tax"), F.col("l_discount")
    return lines.agg(
        F.count_if(price == 0).alias("zero_price"),
        F.count_if(price < 0).alias("negative_price"),
        F.count_if(price <= 0).alias("invalid_price"),
        F.count_if(teu == 0).alias("zero_teu"),
        F.count_if(teu <= 0).alias("invalid_teu"),
    )


@query("derive_ratio", """
  WITH r AS (SELECT l_extendedprice / nullif(l_quantity, 0) AS x FROM lineitem WHERE l_quantity <> 0)
  SELECT count(x) AS n, round(avg(x), 4) AS mean, round(quantile_cont(x, 0.5), 4) AS median,
         round(min(x), 4) AS min_ratio, round(max(x), 4) AS max_ratio FROM r WHERE x IS NOT NULL""")
def derive_ratio(spark, folder):
    lines = booked_lines(spark, folder).select(F.expr("try_divide(price, teu)").alias("ratio"))
    median = quantiles(lines, ["ratio"], [0.5])["ratio", 0.5]
    return lines.agg(
        F.count("ratio").alias("n"),
        F.round(F.avg("ratio"), 4).alias("mean"),
        rounded(median, 4).alias("median"),
        F.round(F.min("ratio"), 4).alias("min_ratio"),
        F.round(F.max("ratio"), 4).alias("max_ratio"),
    )


@query("derive_route", f"""
  WITH {BOOKED_LINES}
  SELECT pol, pod, pol || ' → ' || pod AS route, price FROM booked""")
def derive_route(spark, folder):
    return booked_lines(spark, folder).select(
        "pol", "pod", F.concat("pol", F.lit(fixed.ROUTE), "pod").alias("route"), "price")


@query("cumulative_share", """
  SELECT l_extendedprice AS price,
         round(row_number() OVER (ORDER BY l_extendedprice) * 100 / count(*) OVER (), 6) AS cumulative
  FROM lineitem""")
def cumulative_share(spark, folder):
    lines = booked_lines(spark, folder)
    # equal prices are told apart by position only, so the rows need no further key
    return numbered(lines.select("price", "pol", "pod", "teu"), ["price", "pol", "pod", "teu"]).select(
        "price",
        F.round(F.col("row_number") * 100 / F.lit(lines.count()), 6)
        .alias("cumulative"))


@query("readiness_advice", f"""
  WITH {BOOKINGS},
  q AS (SELECT quantile_cont(price, 0.25) AS a, quantile_cont(price, 0.75) AS b FROM bookings),
  f AS (SELECT a - 1.5 * (b - a) AS low, b + 1.5 * (b - a) AS high FROM q),
  s AS (SELECT count(*) AS n, count(*) FILTER (price <= 0) AS bad_price,
          count(*) FILTER (teu <= 0) AS bad_teu,
          count(*) FILTER (price < low OR price > high) AS outliers,
          count(DISTINCT currency) AS currencies, count(DISTINCT pol) AS ports,
          min(price) AS lo, max(price) AS hi FROM bookings, f)
  SELECT * FROM (
    SELECT 1 AS step, 'remove rows with price <= 0' AS advice, CAST(bad_price AS DOUBLE) AS amount FROM s WHERE bad_price > 0
    UNION ALL SELECT 1, 'remove rows with volume <= 0', bad_teu FROM s WHERE bad_teu > 0
    UNION ALL SELECT 1, 'review outliers', outliers FROM s WHERE outliers > 0
    UNION ALL SELECT 2, CASE WHEN n < 10000 THEN 'too few rows, extract at least 25,000'
      WHEN n < 25000 THEN 'enough rows for lite mode' ELSE 'enough rows for training' END, n FROM s
    UNION ALL SELECT 3, 'several currencies', currencies FROM s WHERE currencies > 1
    UNION ALL SELECT 4, 'group less frequent ports', ports FROM s WHERE ports > 100
    UNION ALL SELECT 5, 'lowest price', lo FROM s
    UNION ALL SELECT 5, 'highest price', hi FROM s
    UNION ALL SELECT 5, 'range is very wide, use a log transform', round(hi / lo, 4) FROM s WHERE hi > 100 * lo)""")
def readiness_advice(spark, folder):
    # several passes follow; the join runs once
    rows = staged(bookings(spark, folder).select("price", "teu", "currency", "pol"), "bookings")
    low, high = outlier_bounds(rows, "price")
    price = F.col("price")
    one = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(price <= 0).alias("bad_price"),
        F.count_if(F.col("teu") <= 0).alias("bad_teu"),
        F.count_if((price < low) | (price > high)).alias("outliers"),
        F.countDistinct("currency").alias("currencies"),
        F.countDistinct("pol").alias("ports"),
        F.min("price").alias("lo"),
        F.max("price").alias("hi"),
    )
    size = (
        F.when(F.col("n") < 10000, "too few rows, extract at least 25,000")
        .when(F.col("n") < 25000, "enough rows for lite mode")
        .otherwise("enough rows for training")
    )
    wide = F.col("hi") > 100 * F.col("lo")
    advice = [
        (1, F.lit("remove rows with price <= 0"), F.col("bad_price"), F.col("bad_price") > 0),
        (1, F.lit("remove rows with volume <= 0"), F.col("bad_teu"), F.col("bad_teu") > 0),
        (1, F.lit("review outliers"), F.col("outliers"), F.col("outliers") > 0),
        (2, size, F.col("n"), F.lit(True)),
        (3, F.lit("several currencies"), F.col("currencies"), F.col("currencies") > 1),
        (4, F.lit("group less frequent ports"), F.col("ports"), F.col("ports") > 100),
        (5, F.lit("lowest price"), F.col("lo"), F.lit(True)),
        (5, F.lit("highest price"), F.col("hi"), F.lit(True)),
        (5, F.lit("range is very wide, use a log transform"),
         F.round(F.try_divide("hi", "lo"), 4), wide),
    ]
    lines = F.array(*[
        F.struct(F.lit(step).alias("step"), text.alias("advice"),
                 amount.cast("double").alias("amount"), applies.alias("applies"))
        for step, text, amount, applies in advice
    ])
    return one.select(F.inline(lines)).filter("applies").drop("applies")
