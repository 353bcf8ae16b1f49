import os
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.operators.chunking import chunk_table, recursive_chunks, window_chunks
from pricewright.operators.deals import alerts, memory_stats
from pricewright.operators.evaluation import (
    answer_label,
    criteria_scores,
    error_metrics,
    freight_band,
    metric_band,
    overall_scores,
    product_band,
    success_metrics,
)
from pricewright.operators.models import embedder, normalised, predictor, restored, tokenizer
from pricewright.operators.records import batch_sizes
from pricewright.plans.evaluation import evaluate
from pricewright.plans.exploration import with_threshold_outcome
from pricewright.session import scratch_path, shared_folder, spread
from pricewright.sources.readers import booking_csv, markdown_files, nonblank_markdown, opportunity_memory
from pricewright.sources.writers import append_documents, seed_lookup, write_prompts, write_questions
from pricewright.streaming import deals as stream


def test_bookings_need_their_columns(spark, tmp_path):
    (tmp_path / "b.csv").write_text("POL,POD\nA,B\n")
    with pytest.raises(ValueError, match="TOTAL_TEU"):
        booking_csv(spark, str(tmp_path))


def test_bookings_with_bad_cells_are_set_aside(spark, tmp_path):
    head = ",".join(fixed.BOOKING_COLUMNS)
    lines = ["A,B,1,x,2.5,T,2024,1,W,10.5,USD", "A,B,1,x,many,T,2024,1,W,1,USD", "A,B,1,x,2,T,,1,W,1,USD",
             "A,B,1,x,2,T,2024,1,W,,USD"]
    (tmp_path / "b.csv").write_text("\n".join([head, *lines]))
    good, bad = booking_csv(spark, str(tmp_path))
    assert sorted((r.teu, r.price) for r in good.collect() if r.price) == [(2.5, 10.5)]
    assert (good.count(), bad.count()) == (2, 2)


def test_markdown_folders(spark, tmp_path):
    root = tmp_path / "base"
    for name, content in {"top.md": b"t", "faq/a.md": b" a\n", "faq/deep/b.md": b"b\xff!", "law/c.md": b" \n", "law/d.txt": b"d"}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_bytes(content)
    typed = {r.source: (r.type, r.text) for r in markdown_files(spark, str(root)).collect()}
    assert set(typed) == {"faq/a.md", "faq/deep/b.md", "law/c.md"}
    assert typed["faq/a.md"] == ("faq", " a\n")
    kept = {r.path: r.content for r in nonblank_markdown(spark, str(root)).collect()}
    assert kept == {"top.md": "t", "faq/a.md": "a", "faq/deep/b.md": "b!"}


def test_memory_may_be_missing_or_broken(spark, tmp_path):
    assert opportunity_memory(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "m.json").write_text('{"deal": {"url": "u", "price": 1.0}, "estimate": 2.0, "discount": 1.0}\n{oops\n')
    assert [r.deal.url for r in opportunity_memory(spark, str(tmp_path)).collect()] == ["u"]


def test_questions_are_not_replaced_unasked(spark, tmp_path):
    rows = spark.createDataFrame([("q",)], "question string")
    write_questions(rows, str(tmp_path / "q"))
    with pytest.raises(AnalysisException):
        write_questions(rows, str(tmp_path / "q"))
    write_questions(rows, str(tmp_path / "q"), overwrite=True)


def test_prompts_must_be_whole(spark, tmp_path):
    rows = spark.createDataFrame([("p", "c", "train"), ("p", None, "test")], "prompt string, completion string, split string")
    with pytest.raises(ValueError):
        write_prompts(rows, str(tmp_path / "p"))


def test_documents_are_written_once(spark, tmp_path):
    path = str(tmp_path / "d")
    spark.createDataFrame([("a", "old")], "path string, content string").write.parquet(path)
    wanted = spark.createDataFrame([("a", "new"), ("b", "x"), ("c", " ")], "path string, content string")
    counts = {r.status: r.n for r in append_documents(wanted, path).collect()}
    assert counts == {"skipped": 1, "ok": 1, "failed": 1}
    assert {(r.path, r.content) for r in spark.read.parquet(path).collect()} == {("a", "old"), ("b", "x\n")}


def test_seeds_fill_only_an_empty_table(spark):
    seeds = spark.createDataFrame([("a", 1.0)], "city string, price double")
    empty, filled = seeds.filter("false"), spark.createDataFrame([("b", 2.0)], "city string, price double")
    assert [r.city for r in seed_lookup(empty, seeds).collect()] == ["a"]
    assert [r.city for r in seed_lookup(filled, seeds).collect()] == ["b"]


def test_scratch_is_in_the_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_folder(spark) + "/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_spread_leaves_large_inputs_alone(spark):
    many = spark.range(0, 100, 1, 64)
    assert spread(many) is many
    assert spread(spark.range(0, 100, 1, 1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


# --- scores ---------------------------------------------------------------


def _bands(spark, function, pairs):
    rows = spark.createDataFrame([(float(e), float(t)) for e, t in pairs], "e double, t double")
    return [r[0] for r in rows.select(function(F.col("e"), F.col("t"))).collect()]


def test_bands(spark):
    pairs = [(39, 1), (40, 201), (40, 100), (79, 100), (80, 201), (80, 100), (40, 0), (90, 0)]
    assert _bands(spark, product_band, pairs) == ["green", "green", "orange", "orange", "orange", "red", "orange", "red"]
    pairs = [(999, 1), (1000, 5001), (1000, 1), (3000, 7501), (3000, 0), (1500, -5)]
    assert _bands(spark, freight_band, pairs) == ["green", "green", "orange", "orange", "red", "orange"]


def test_error_metrics(spark):
    rows = spark.createDataFrame([("m", 0.0, 1.0), ("m", 2.0, 1.0), ("m", 4.0, 4.0)], "model string, truth double, guess double")
    row = error_metrics(rows, ["model"]).first()
    assert row.mae == pytest.approx(2 / 3) and row.mse == pytest.approx(2 / 3)
    assert row.r2_percent == pytest.approx(75.0)
    assert row.mape == pytest.approx(0.5 / 3 * 100)  # the zero truth adds nothing but counts


def test_success_metrics_without_any(spark):
    rows = spark.createDataFrame([("m", False, 5.0)], "model string, ok boolean, error double")
    row = success_metrics(rows, ["model"]).first()
    assert (row.n_success, row.n_failed, row.mae) == (0, 1, None)


def test_criteria_and_overall_score(spark):
    wanted = spark.createDataFrame([("m", "Speed "), ("m", "Style"), ("n", "Speed")], "model string, criterion string")
    given_rows = spark.createDataFrame(
        [("m", 1, " speed", "3"), ("m", 2, "SPEED", "8.25"), ("m", 3, "speed", "good")],
        "model string, place long, criterion string, score string")
    scores = criteria_scores(wanted, given_rows)
    assert {(r.model, r.criterion): r.score for r in scores.collect()} == {
        ("m", "Speed "): 8.25, ("m", "Style"): None, ("n", "Speed"): None}
    assert {r.model: r.overall for r in overall_scores(scores).collect()} == {"m": 82.5, "n": None}


def test_answer_labels(spark):
    got = [r[0] for r in spark.range(1, 29).select(answer_label(F.col("id").cast("int"))).collect()]
    assert got[0] == "A" and got[25] == "Z" and got[26:] == ["Answer27", "Answer28"]


def test_metric_bands(spark):
    rows = spark.createDataFrame([("mrr", 0.9), ("coverage", 75.0), ("accuracy", 3.9), ("other", 1.0)], "m string, v double")
    got = [r[0] for r in rows.select(metric_band(F.col("m"), F.col("v"))).collect()]
    assert got == ["green", "orange", "red", "black"]


def test_thresholds_with_limits_off(spark):
    rows = spark.createDataFrame([(1.0, 1.0), (9.0, 1.0), (9.0, 9.0)], "price double, teu double")
    for off in (None, 0):
        got = [r.outcome for r in with_threshold_outcome(rows, 5, off, 5, off).collect()]
        assert got == ["price", "teu", "kept"]
    assert with_threshold_outcome(rows, 0, 8, 0, None).filter("outcome = 'price'").count() == 2


def test_any_predictor_can_be_evaluated(spark):
    rows = spark.createDataFrame([(1, 1, 10.0), (2, 1, 20.0), (3, 1, 30.0)], "l_orderkey long, l_linenumber long, truth double")
    doubled = predictor(lambda frame: frame["truth"] * 2)
    got = evaluate(rows, lambda df: df.withColumn("guess", doubled("truth", "l_orderkey")), ["l_orderkey"], 2)
    assert [(r.guess, r.error, r.band) for r in got.orderBy("l_orderkey").collect()] == [
        (20.0, 10.0, "green"), (40.0, 20.0, "green")]
    texts = evaluate(rows, lambda df: df.withColumn("guess", F.lit("about $15.50")), ["l_orderkey"], 1)
    assert texts.first().guess == 15.5


# --- chunks and plug-ins --------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([" ", "\n", "\n\n", "  \n", ""]), st.integers(1, 9)), max_size=60),
       st.integers(5, 40), st.integers(0, 20))
def test_chunks_are_short_ordered_and_cover(parts, size, overlap):
    # no character comes twice but blanks, so every chunk has one place in the text
    letters = iter(range(0x4E00, 0x9FFF))
    text = "".join(gap + "".join(chr(next(letters)) for _ in range(n)) for gap, n in parts)
    chunks = recursive_chunks(text, size, min(overlap, size - 1))
    assert all(0 < len(c) <= size for c in chunks)
    at, covered = 0, set()
    for chunk in chunks:
        spot = text.find(chunk, max(0, at))
        assert spot >= 0
        covered.update(range(spot, spot + len(chunk)))
        at = spot
    assert all(i in covered or text[i].isspace() for i in range(len(text)))


def test_chunks_overlap_whole_pieces():
    text = " ".join(f"w{i:03d}" for i in range(100))
    first, second = recursive_chunks(text, 100, 40)[:2]
    assert first.split()[-6:] == second.split()[:6] or first.split()[-8:] == second.split()[:8]


def test_chunks_of_unbroken_text_overlap():
    text = "".join(map(chr, range(0x4E00, 0x4E00 + 700)))
    assert recursive_chunks(text, 500, 200) == [text[:500], text[300:]]
    assert recursive_chunks("ab " + text, 500, 200)[-1][:200] == recursive_chunks("ab " + text, 500, 200)[-2][-200:]


def test_chunks_leave_a_task_in_small_batches(spark):
    class Caught:  # gives back the function that tasks would run
        def select(self, *columns):
            return self

        def mapInArrow(self, function, schema):
            return function

    texts = [("ab " * 300_000), None, "", *["word " * 4000] * 60]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
    out = list(chunk_table(Caught())(iter([batch, batch.slice(0, 0)])))
    assert len(out) > 2 and max(sum(map(len, one["text"].to_pylist())) for one in out) < 3_000_000
    rows = [tuple(row.values()) for one in out for row in one.to_pylist()]
    assert rows == [(i, n, chunk) for i, text in enumerate(texts) for n, chunk in enumerate(recursive_chunks(text or ""))]


def test_any_chunker_can_be_used(spark):
    documents = spark.createDataFrame([(1, "a b"), (2, ""), (3, None)], "doc_id long, text string")
    got = sorted((r.doc_id, r.chunk_no, r.text) for r in chunk_table(documents, str.split).collect())
    assert got == [(1, 0, "a"), (1, 1, "b")]


def test_windows_cover_all_words(spark):
    documents = spark.createDataFrame([(n, " ".join(map(str, range(n)))) for n in (1, 9, 10, 11, 18, 19, 50)], "doc_id long, text string")
    rows = window_chunks(documents, 10, 2).toPandas()
    for n, part in rows.groupby("doc_id"):
        words = [int(w) for t in part.sort_values("chunk_no")["text"] for w in t.split()]
        assert set(words) == set(range(n)) and len(words) == n + 2 * (len(part) - 1)


def test_outside_functions(spark):
    rows = spark.createDataFrame([("a b",), ("ccc",)], "t string")
    lengths = embedder(lambda texts: np.array([[len(t), 1.0] for t in texts]))
    assert [list(r[0]) for r in rows.select(lengths(F.col("t"))).collect()] == [[3.0, 1.0], [3.0, 1.0]]
    assert [list(r[0]) for r in rows.select(tokenizer(str.split)(F.col("t"))).collect()] == [["a", "b"], ["ccc"]]


def test_log_target_comes_back(spark):
    price = F.col("id").cast("double")
    got = spark.range(5).select(restored(normalised(price, 1.5, 0.5), 1.5, 0.5)).collect()
    assert np.allclose([r[0] for r in got], range(5))


def test_batches(spark):
    rows = spark.createDataFrame([("a", 401), ("b", 200), ("c", 0)], "kind string, n long")
    got = sorted((r.kind, r.batch, r.size) for r in batch_sizes(rows, 200).collect())
    assert got == [("a", 1, 200), ("a", 2, 200), ("a", 3, 1), ("b", 1, 200)]


# --- deals and streams ----------------------------------------------------


def _deal(event_id, url, price, scan="s", minute=0, k=1):
    return (event_id, datetime(2024, 1, 1, 0, minute), "f", scan, url, "d", float(price), k)


def _write(spark, path, rows):
    frame = spark.createDataFrame(rows, stream.DEAL_SCHEMA)
    frame.coalesce(1).write.mode("append").parquet(path)


def test_memory_stats_when_empty(spark):
    row = memory_stats(spark.createDataFrame([], "discount double"), spark.range(3)).first()
    assert tuple(row) == (0, 0.0, 0.0, 3)


def test_discount_must_exceed_the_threshold(spark):
    rows = spark.createDataFrame([("a", 1, 50.0), ("b", 1, 50.5), ("b", 2, 50.5)], "scan string, place long, discount double")
    assert [(r.scan, r.place) for r in alerts(rows).collect()] == [("b", 1)]


def test_known_deals_stay_out_after_a_restart(spark, tmp_path):
    feed, memory, progress = (str(tmp_path / n) for n in ("feed", "memory", "progress"))
    _write(spark, feed, [_deal(2, "u", 5, minute=3), _deal(1, "u", 6, minute=1), _deal(3, "v", 7)])
    stream.forward_new_deals(stream.deal_stream(spark, feed), memory, progress)
    _write(spark, feed, [_deal(4, "u", 5), _deal(5, "w", 8)])
    stream.forward_new_deals(stream.deal_stream(spark, feed), memory, progress)
    got = sorted((r.url, r.event_id) for r in stream.deal_table(spark, memory).collect())
    assert got == [("u", 1), ("v", 3), ("w", 5)]


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    stream.start_batch_table(spark, path, stream.DEAL_SCHEMA)
    rows = spark.createDataFrame([_deal(1, "u", 5)], stream.DEAL_SCHEMA)
    for _ in range(2):
        stream.put_batch(rows, path, 0)
    assert stream.deal_table(spark, path).count() == 1
    assert stream.earlier_batches(spark, path, stream.DEAL_SCHEMA, 0).count() == 0
    assert stream.earlier_batches(spark, path, stream.DEAL_SCHEMA, 1).count() == 1


def _pulse(hour):
    """A row without a scan, which only moves the watermark."""
    return (None, datetime(2024, 1, 1, hour), None, None, None, None, None, None)


def test_an_address_is_forgotten_behind_the_watermark(spark, tmp_path):
    feed, memory, progress = (str(tmp_path / n) for n in ("feed", "memory", "progress"))
    for rows in ([_deal(1, "u", 5), _deal(2, "v", 5)], [_deal(3, "u", 5, minute=50)], [_pulse(2)], [_pulse(3)],
                 [(*_deal(4, "u", 6)[:1], datetime(2024, 1, 1, 3), *_deal(4, "u", 6)[2:])]):
        _write(spark, feed, rows)
        stream.forward_new_deals(stream.deal_stream(spark, feed), memory, progress, "1 hour")
    assert sorted((r.url, r.event_id) for r in stream.deal_table(spark, memory).collect()) == [("u", 1), ("u", 4), ("v", 2)]


def test_no_batch_reads_what_others_have_remembered(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(stream, "earlier_batches", None)
    test_known_deals_stay_out_after_a_restart(spark, tmp_path)


def test_a_scan_over_three_batches_gives_five_deals_and_one_alert(spark, tmp_path):
    feed = str(tmp_path / "feed")
    estimates = spark.createDataFrame([(1, 100.0)], "k long, estimate double")
    parts = [[_deal(9, "i", 1, minute=9), _deal(3, "c", 30, minute=3), _deal(8, "h", 0, minute=0)],
             [_deal(1, "a", 45, minute=1), _deal(5, "e", 20, minute=5), _deal(7, "g", 2, minute=7), _deal(20, "z", 95, "t", minute=8)],
             [_deal(2, "b", 10, minute=2), _deal(4, "d", 40, minute=4)], [_pulse(4)]]
    for rows in parts:
        _write(spark, feed, rows)
        # each run is a restart from the progress of the one before
        stream.price_deals(stream.deal_stream(spark, feed, 1), estimates, "k", *(str(tmp_path / n) for n in ("out", "p1")))
        stream.alert_deals(stream.deal_stream(spark, feed, 1), estimates, "k", *(str(tmp_path / n) for n in ("told", "memory", "p2")))
    got = sorted((r.scan, r.place, r.url) for r in stream.priced_table(spark, str(tmp_path / "out")).collect())
    assert got == [("s", 1, "a"), ("s", 2, "b"), ("s", 3, "c"), ("s", 4, "d"), ("s", 5, "e"), ("t", 1, "z")]
    for name in ("told", "memory"):
        assert [(r.scan, r.url, r.discount) for r in stream.priced_table(spark, str(tmp_path / name)).collect()] == [("s", "b", 90.0)]


def test_alerts_are_given_once(spark, tmp_path):
    feed, told, memory, progress = (str(tmp_path / n) for n in ("feed", "told", "memory", "progress"))
    estimates = spark.createDataFrame([(1, 100.0)], "k long, estimate double")
    run = lambda: stream.alert_deals(
        stream.deal_stream(spark, feed), estimates, "k", told, memory, progress)
    _write(spark, feed, [_deal(1, "u", 10), _deal(2, "v", 5), _deal(3, "w", 60, "t"), _deal(4, "x", 0, "t"), _pulse(2)])
    run()
    late = datetime(2024, 1, 1, 2, 30)
    _write(spark, feed, [(d[0], late, *d[2:]) for d in (_deal(5, "v", 1, "r"), _deal(6, "y", 20, "r"))] + [_pulse(5)])
    run()
    want = [("r", "y", 80.0), ("s", "v", 95.0)]
    for path in (told, memory):
        assert sorted((r.scan, r.url, r.discount) for r in stream.priced_table(spark, path).collect()) == want


def test_bounded_memory_drops_near_repeats(spark, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    _write(spark, feed, [_deal(1, "u", 5), _deal(2, "u", 6, minute=1), _deal(3, "v", 7)])
    recent = stream.recent_new_deals(stream.deal_stream(spark, feed), "1 hour")
    query = recent.writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(out).collect()) == ["u", "v"]
    assert os.path.isdir(out)
