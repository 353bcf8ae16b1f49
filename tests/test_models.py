import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.operators import boosting
from pricewright.operators.boosting import fit_boosted
from pricewright.operators.models import (
    bag_of_words,
    embed,
    forest_pricer,
    hashed_embedder,
    hashed_words,
    linear_pricer,
    numeric_features,
    priced,
    projected,
    word_counts,
)
from pricewright.operators.network import _blocks, fit_network, gradients
from pricewright.plans import models
from pricewright.session import dealt
from pricewright.streaming.replies import batch_progress, collect_replies


@pytest.fixture(scope="module")
def lines(spark):
    return spark.range(600).select(
        (F.col("id") % 20).cast("double").alias("x"),
        F.when(F.col("id") % 20 < 10, 100.0).otherwise(400.0).alias("step"),
        (F.col("id") % 20 * 3.0 - 6).alias("price"))


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(
        [(i, "the red cheap pen" if i % 2 else "a golden watch, golden", 5.0 if i % 2 else 800.0) for i in range(60)],
        "id long, text string, price double")


def test_linear_guesses_are_exact_and_never_below_zero(lines):
    model = Pipeline(stages=[numeric_features(["x"]), linear_pricer()]).fit(lines)
    rows = priced(model, lines).collect()
    assert all(abs(r.guess - max(r.price, 0)) < 1e-6 for r in rows)
    assert min(r.guess for r in rows) == 0.0


def test_a_forest_learns_a_step(lines):
    rows = lines.select("x", F.col("step").alias("price"))
    fitted = Pipeline(stages=[numeric_features(["x"]), forest_pricer(10)]).fit(rows)
    assert all(abs(r.guess - r.price) < 40 for r in priced(fitted, rows).collect())


def test_boosting_learns_a_step_and_its_error_falls_with_every_round(lines):
    rows = lines.select("x", F.col("step").alias("price")).union(lines.select(F.lit(None), F.lit(1.0)))
    fitted = fit_boosted(rows, ["x"], rounds=60)
    assert all(abs(r.g - r.price) < 1 for r in rows.dropna().withColumn("g", fitted.guess()).collect())
    assert len(fitted.losses) == 60 and (np.diff(fitted.losses) < 0).all()
    assert abs(fitted.losses[0] - 150.0 ** 2) < 1e-6


def waves(spark):
    return spark.range(3000).select(
        "id", (F.col("id") % 60 / 10.0).alias("x"), (F.col("id") % 7).cast("double").alias("y")).withColumn(
        "price", F.sin("x") * 100 + F.when(F.col("y") > 3, 50 * F.col("x")).otherwise(0))


def test_boosting_is_nearer_than_the_forest_on_rows_it_has_not_seen(spark):
    train, test = waves(spark).filter("id % 3 > 0"), waves(spark).filter("id % 3 = 0")
    forest = Pipeline(stages=[numeric_features(["x", "y"]), forest_pricer(20)]).fit(train)
    boosted = fit_boosted(train, ["x", "y"], rounds=200)
    miss = test.select(F.avg(F.abs(boosted.guess() - F.col("price")))).first()[0]
    assert miss < forest.transform(test).select(F.avg(F.abs(F.col("guess") - F.col("price")))).first()[0]


def test_bins_are_halved_until_the_cells_fit(spark, monkeypatch):
    monkeypatch.setattr(boosting, "MOST_CELLS", 60)
    fitted = fit_boosted(waves(spark), ["x", "y"], rounds=5)
    assert 1 < (len(fitted.edges[0]) + 1) * (len(fitted.edges[1]) + 1) <= 60 * 2
    monkeypatch.setattr(boosting, "MOST_CELLS", 1)
    with pytest.raises(ValueError):
        fit_boosted(waves(spark), ["x", "y"], rounds=5)


def test_the_boosted_query_runs_all_rounds(spark, folder, monkeypatch):
    fitted = []
    monkeypatch.setattr(models, "fit_boosted", lambda *args: fitted.append(fit_boosted(*args)) or fitted[0])
    assert models.boosted_model(spark, folder).count() > 0
    assert len(fitted[0].values) == fixed.BOOST_ROUNDS == 1000


def pairs(spark, low, high):
    """The price depends on whether one or both of two words are there, which no sum of words says."""
    n = F.col("id")
    text = F.concat_ws(" ", F.when(n % 2 == 0, "gold"), F.when(n % 4 < 2, "watch"), F.concat(F.lit("other"), n % 7), F.lit("piece"))
    return spark.range(low, high).select("id", text.alias("text"), F.when((n % 2 == 0) != (n % 4 < 2), 400.0).otherwise(10.0).alias("price"))


def test_the_net_beats_the_linear_model_on_rows_it_has_not_seen(spark):
    train, test = pairs(spark, 0, 400), pairs(spark, 1000, 1200)
    net = fit_network(train, hidden=(32, 16), features=200, epochs=20, steps=2, rate=0.02)
    assert len(net.losses) == 20 and net.losses[-1] < 0.2 < net.losses[0]
    words = bag_of_words(train, "text")
    line = linear_pricer().fit(words.transform(train))
    miss = F.avg(F.abs(F.col("guess") - F.col("price")))
    by_line = priced(PipelineModel([*words.stages, line]), test).agg(miss).first()[0]
    by_net = test.withColumn("guess", net.guess(F.col("text"))).agg(miss).first()[0]
    assert by_net < by_line / 2
    assert fit_network(train, hidden=(4,), features=50, epochs=1, steps=2).guess(F.lit(None).cast("string")) is not None


def test_inputs_come_block_by_block_from_lists_as_arrow_holds_them():
    random = np.random.default_rng(3)
    rows = [sorted({int(at) for at in random.integers(0, 50, n % 9)}) for n in range(600)] + [None, []]
    whole = pa.array(rows, pa.list_(pa.int32()))
    for column, kept in ((whole, rows), (whole.slice(7, 300), rows[7:307]), (whole.slice(600), rows[600:]), (whole.slice(602), [])):
        blocks = list(_blocks(column, 50))
        assert sum(len(block) for _, block in blocks) == len(kept) and max([0, *(len(block) for _, block in blocks)]) <= 256
        for first, block in blocks:
            assert [list(np.flatnonzero(row)) for row in block] == [row or [] for row in kept[first:first + len(block)]]


def test_gradients_are_slopes_of_the_error():
    random = np.random.default_rng(1)
    weights = [random.normal(size=shape) for shape in ((6, 5), (5,), (5, 4), (4,), (4, 1), (1,))]
    inputs, target = (random.random((7, 6)) > 0.5).astype(float), random.normal(size=7)
    _, slopes = gradients(weights, inputs, target)
    for weight, slope in zip(weights, slopes):
        for at in list(np.ndindex(weight.shape))[::3]:
            errors = []
            for step in (1e-6, -1e-6):
                weight[at] += step
                errors.append(gradients(weights, inputs, target)[0])
                weight[at] -= step
            assert abs((errors[0] - errors[1]) / 2e-6 - slope[at]) < 1e-3 * max(1, abs(slope[at]))


def test_words_are_counted_without_stop_words(texts):
    got = [(r.word, r.n) for r in word_counts(texts, "text", 3).collect()]
    assert got == [("golden", 60), ("cheap", 30), ("pen", 30)]
    vectors = bag_of_words(texts, "text").transform(texts).select(vector_to_array("features").alias("v"))
    assert {sum(r.v) for r in vectors.collect()} == {3.0}


def test_hashed_words_are_binary(texts):
    vectors = hashed_words("text").transform(texts).select(vector_to_array("features").alias("v")).collect()
    assert {max(r.v) for r in vectors} == {1.0} and len(vectors[0].v) == 5000


def test_embeddings_have_unit_length_and_equal_texts_agree(texts):
    rows = embed(texts, hashed_embedder(texts, "text", 4096)).orderBy("id").collect()
    assert np.allclose([np.linalg.norm(r.vector) for r in rows], 1, atol=1e-6)
    assert rows[0].vector == rows[2].vector != rows[1].vector


def test_layout_keeps_the_main_axis(spark):
    points = spark.createDataFrame([(i, [float(i), 0.01 * (i % 2), 0.0]) for i in range(20)], "id long, vector array<double>")
    got = [r.point[0] for r in projected(points, 2).orderBy("id").collect()]
    steps = np.diff(got)
    assert np.all(steps > 0.9) or np.all(steps < -0.9)


def test_a_stored_model_guesses_the_same(lines, tmp_path):
    model = Pipeline(stages=[numeric_features(["x"]), linear_pricer()]).fit(lines)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert [r.guess for r in priced(model, lines).collect()] == [r.guess for r in priced(again, lines).collect()]


def test_replies_are_noted_once_over_restarts(spark, tmp_path):
    replies, seen, progress = (str(tmp_path / n) for n in ("replies", "seen", "progress"))
    requests = spark.createDataFrame([(0, "1"), (0, "2"), (1, "3")], "batch long, custom_id string")

    def arrive(*ids):
        lines = spark.createDataFrame([(f'{{"custom_id": "{i}"}}',) for i in ids], "value string")
        lines.coalesce(1).write.mode("append").text(replies)
        collect_replies(spark, replies, seen, progress)
        state = batch_progress(requests, spark.read.schema("custom_id string").parquet(seen))
        return {r.batch: (r.n_requests, r.n_answered, r.status) for r in state.collect()}

    assert arrive("1", "1") == {0: (2, 1, "submitted"), 1: (1, 0, "submitted")}
    assert arrive("2", "1") == {0: (2, 2, "done"), 1: (1, 0, "submitted")}


def test_each_vector_of_bins_is_predicted_once_and_as_each_row(spark, monkeypatch):
    reads = []
    quantiles = type(spark.range(1)).approxQuantile
    monkeypatch.setattr(type(spark.range(1)), "approxQuantile", lambda *args: reads.append(1) or quantiles(*args))
    monkeypatch.setattr(boosting, "MOST_CELLS", 60)
    rows = waves(spark).union(spark.createDataFrame([(-1, None, 3.0, 1.0), (-2, float("nan"), None, 2.0)], "id long, x double, y double, price double"))
    fitted = fit_boosted(rows, ["x", "y"], rounds=20)
    assert len(reads) == 1  # wider bins come from the cells
    both = fitted.priced(rows).withColumn("row", fitted.guess()).select("id", "guess", "row").collect()
    assert len(both) == 3002 and all(r.guess == r.row for r in both)


def test_all_bins_are_kept_however_many_cells_there_are(spark):
    names = ["a", "b", "c", "d"]
    rows = spark.range(200_000).select(*[
        F.pmod(F.xxhash64("id", F.lit(name)), F.lit(32_000)).cast("double").alias(name) for name in names])
    rows = rows.withColumn("price", F.when(F.col("a") < 1000, 400.0).otherwise(0.0))  # the first of 32 bins
    fitted = fit_boosted(rows, names, rounds=30)
    assert [len(edge) for edge in fitted.edges] == [31] * 4
    far = fitted.priced(rows).filter(F.abs(F.col("guess") - F.col("price")) > 50).count()
    assert far < 0.005 * 200_000  # with 16 bins 0.06


def test_trees_are_the_same_in_slices(spark, monkeypatch):
    whole = fit_boosted(waves(spark), ["x", "y"], rounds=20)
    monkeypatch.setattr(boosting, "SLICE", 7)
    sliced = fit_boosted(waves(spark), ["x", "y"], rounds=20)
    assert (whole.split_on == sliced.split_on).all() and (whole.split_at == sliced.split_at).all()
    assert np.allclose(whole.values, sliced.values) and np.allclose(whole.losses, sliced.losses)


def test_rows_are_dealt_to_tasks_of_a_bounded_size(spark):
    one = spark.range(1000).coalesce(1)
    sizes = [r["count"] for r in dealt(one, "id", 100).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) < 200
    assert dealt(one, "id", 1000) is one
