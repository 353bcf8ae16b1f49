import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricewright.operators import ranks
from pricewright.operators.ordering import numbered, running_sums, running_totals
from pricewright.operators.ranks import quantiles, values_at_ranks
from pricewright.operators.splits import exact_split, holdout_split, sample_rows
from pricewright.operators.tables import top_counts


def test_row_numbers_follow_the_order(spark):
    rows = spark.range(0, 5000, 1, 7).withColumn("v", F.col("id") % 3)
    got = numbered(rows, [F.desc("v"), "id"]).toPandas().sort_values("row_number")
    want = rows.toPandas().sort_values(["v", "id"], ascending=[False, True])
    assert got["row_number"].tolist() == list(range(1, 5001))
    assert got["id"].tolist() == want["id"].tolist()


@pytest.mark.parametrize("running", [running_totals, running_sums])
def test_running_totals_with_a_hot_and_a_missing_group(spark, running):
    rows = spark.range(0, 4000, 1, 5).select(
        "id", F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 5 == 0, "cold").alias("g"),
        (F.col("id") % 11).cast("double").alias("v"))
    got = running(rows, ["g"], ["id"], {"total": F.col("v")}).toPandas().sort_values("id")
    want = rows.toPandas().sort_values("id")
    groups = want.groupby("g", dropna=False)
    assert got["n"].tolist() == (groups.cumcount() + 1).tolist()
    assert np.allclose(got["total"], groups["v"].cumsum())


def test_running_sums_go_on_over_batches_and_ranges_and_move_rows_once(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "37")
    try:
        rows = spark.range(0, 3000, 1, 4).select(
            "id", (F.col("id") % 2).alias("a"), F.when(F.col("id") % 7 > 0, F.lit(float("nan"))).alias("b"),
            F.when(F.col("id") % 5 > 0, F.col("id") % 9).alias("v"))
        summed = running_sums(rows, ["a", "b"], ["id"], {"total": F.col("v")})
        got = summed.toPandas().sort_values("id")
        want = rows.withColumn("b", F.col("b").isNull()).toPandas().sort_values("id")
        groups = want.assign(v=want["v"].fillna(0)).groupby(["a", "b"])
        assert got["n"].tolist() == (groups.cumcount() + 1).tolist()
        assert np.allclose(got["total"], groups["v"].cumsum())
        assert summed.columns == ["id", "a", "b", "v", "n", "total"]
    finally:
        spark.conf.set(name, before)
    # the rows come from the written ranges; only the ends of groups are shuffled, and broadcast
    plan = summed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_quantiles_equal_numpy(spark):
    values = np.concatenate([np.full(3000, 7.25), np.random.default_rng(1).lognormal(3, 2, 6000)])
    rows = spark.createDataFrame(pd.DataFrame({"v": values})).union(
        spark.createDataFrame([(None,), (float("nan"),)], "v double"))
    shares = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = quantiles(rows, ["v"], shares)
    for share in shares:
        assert np.isclose(got["v", share], np.quantile(values, share), rtol=1e-12)


def test_brackets_narrow_until_few_candidates_are_left(spark, monkeypatch):
    monkeypatch.setattr(ranks, "MAX_CANDIDATES", 20)
    monkeypatch.setattr(ranks, "ACCURACY", 50)
    values = np.random.default_rng(2).normal(size=20_000)
    rows = spark.createDataFrame(pd.DataFrame({"v": values}))
    wanted = [("v", 0), ("v", 777), ("v", 10_000), ("v", 19_999)]
    got = values_at_ranks(rows, wanted)
    ordered = np.sort(values)
    assert got == {(c, r): ordered[r] for c, r in wanted}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=40))
def test_any_rank_of_any_small_list(spark, values):
    rows = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = values_at_ranks(rows, [("v", r) for r in range(len(values))])
    assert [got["v", r] for r in range(len(values))] == sorted(float(v) for v in values)


def test_ranks_of_an_empty_column(spark):
    assert values_at_ranks(spark.createDataFrame([], "v double"), [("v", 0)]) == {}
    assert quantiles(spark.createDataFrame([(None,)], "v double"), ["v"], [0.5]) == {("v", 0.5): None}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "id long, v double")
    assert numbered(empty, ["id"]).count() == 0
    assert running_totals(empty, ["v"], ["id"], {}).count() == running_sums(empty, ["v"], ["id"], {}).count() == 0
    assert exact_split(empty, "id").count() == 0


def test_split_sizes_are_exact_and_repeatable(spark):
    rows = spark.range(0, 1003, 1, 4)
    first = exact_split(rows, "id").toPandas().sort_values("id")["split"].tolist()
    again = exact_split(rows.repartition(9), "id").toPandas().sort_values("id")["split"].tolist()
    assert first == again
    assert (first.count("test"), first.count("validation")) == (101, 101)
    assert holdout_split(rows, "id", 0.01).filter("split = 'validation'").count() == 11


def test_sample_has_its_size_and_no_repeats(spark):
    ids = [r.id for r in sample_rows(spark.range(500), "id", 50).collect()]
    assert len(set(ids)) == 50
    assert sample_rows(spark.range(20), "id", 50).count() == 20


def test_top_counts_leave_out_missing_keys_but_count_them(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    got = [(r.k, r.n, r.share) for r in top_counts(rows, "k", 5).collect()]
    assert sorted(got) == [("a", 2, 50.0), ("b", 1, 25.0)]


def test_constant_and_empty_columns_have_statistics(spark):
    from pricewright.operators.tables import describe, even_histograms, outlier_bounds

    rows = spark.range(5).selectExpr("cast(7 as double) as same", "cast(null as double) as none")
    bins = {(r["metric"], r["subset"]): (r["bin"], r["n"]) for r in even_histograms(rows, ["same"], 4).collect()}
    assert bins == {("same", "all"): (0, 5), ("same", "positive"): (0, 5)}
    described = {r["column_name"]: r for r in describe(rows, ["same", "none"]).collect()}
    assert described["same"]["p50"] == 7.0 and described["none"]["p50"] is None and described["none"]["n"] == 0
    assert outlier_bounds(rows, "none") == (None, None)


def test_quantiles_of_infinite_and_large_whole_numbers(spark):
    from pricewright.operators.ranks import quantiles, values_at_ranks

    rows = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),)], "x double")
    assert quantiles(rows, ["x"], [0.5, 1.0]) == {("x", 0.5): 2.0, ("x", 1.0): float("inf")}
    large = spark.range(5).selectExpr("id + 9007199254740992 as n")
    assert values_at_ranks(large, [("n", 1), ("n", 3)]) == {("n", 1): 2 ** 53 + 1, ("n", 3): 2 ** 53 + 3}


def test_stuck_brackets_are_halved(spark, monkeypatch):
    from pricewright.operators import ranks

    monkeypatch.setattr(ranks, "MAX_CANDIDATES", 10)
    monkeypatch.setattr(ranks, "_narrow", lambda df, brackets: [
        setattr(b, "low", 0) or setattr(b, "high", 999) or setattr(b, "inside", 1000) for b in brackets if b.low is None])
    rows = spark.range(1000).selectExpr("id as n")
    assert ranks.values_at_ranks(rows, [("n", 0), ("n", 617), ("n", 999)]) == {("n", 0): 0, ("n", 617): 617, ("n", 999): 999}
