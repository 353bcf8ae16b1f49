"""The deal loop as Structured Streaming: fetch, drop the known, price, alert, remember.

What has to be known about earlier batches is keyed state: whether an address was
seen, and the first deals of each open scan. State goes when the watermark has passed
it, so no batch reads what earlier ones have written, and a scan may be split over any
number of batches. Tables written per micro-batch live in one folder per batch id. A
batch that is run again after a failure overwrites its own folder, so nothing is
forwarded or remembered twice.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from pricewright import fixed_values as fixed
from pricewright.operators.deals import alerts, new_deals

DEAL_SCHEMA = (
    "event_id long, ts timestamp, feed string, scan string, url string, "
    "product_description string, price double, k long"
)


KEPT, SCAN_DELAY = "400 days", "1 hour"


def deal_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Deal files as they arrive; one file holds whole scans."""
    reader = spark.readStream.schema(DEAL_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def start_batch_table(spark: SparkSession, path: str, schema: str) -> None:
    """An empty table to which batches are added; left alone when it is there."""
    empty = spark.createDataFrame([], schema)
    empty.write.mode("ignore").parquet(f"{path}/batch_id=-1")


def earlier_batches(spark: SparkSession, path: str, schema: str, batch_id: int) -> DataFrame:
    rows = spark.read.schema(f"{schema}, batch_id long").parquet(path)
    return rows.filter(F.col("batch_id") < batch_id).drop("batch_id")


def put_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write the rows of one batch; a second run of it replaces the first."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def run_available(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run over all files that are there, batch by batch, then stop."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


_NAMES = ["event_id", "us", "feed", "scan", "url", "product_description", "price", "k"]
_ROWS = "event_id long, us long, feed string, scan string, url string, product_description string, price double, k long"


def _plain(frame: pd.DataFrame) -> list[list]:
    """Rows of plain Python values; a missing number is None."""
    return [[None if value is None or value != value else getattr(value, "item", lambda value=value: value)()
             for value in row] for row in frame[_NAMES].itertuples(index=False)]


def _frame(rows: list[list]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=_NAMES).astype({"k": "Int64"})


def _expires(state: GroupState, latest: int) -> None:
    """The state goes when the watermark has passed ``latest``, in microseconds."""
    state.setTimeoutTimestamp(max(latest // 1000, state.getCurrentWatermarkMs()) + 1)


def _keyed(stream: DataFrame, delay: str, key: str, step, output: str, state: str) -> DataFrame:
    rows = stream.withColumn("us", F.unix_micros("ts")).withWatermark("ts", delay).groupBy(key).applyInPandasWithState(
        step, output, state, "append", GroupStateTimeout.EventTimeTimeout)
    return rows.withColumn("ts", F.timestamp_micros("us")).drop("us")


def unseen_deals(stream: DataFrame, keep: str) -> DataFrame:
    """The first deal of every address; of several in a batch, the earliest.

    An address is forgotten once the watermark, ``keep`` behind the latest deal, has
    passed its last deal. Deals older than the watermark are dropped, as are those
    without an address.
    """
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        latest, first = (state.get[0], None) if state.exists else (0, [])
        for frame in frames:
            latest = max(latest, int(frame["us"].max()))
            if first is not None:  # one row at a time is held, whatever the batch brings
                first = sorted([*first, *_plain(frame.sort_values(["us", "event_id"]).head(1))], key=lambda row: (row[1], row[0]))[:1]
        if key[0] is None:
            return
        state.update((latest,))
        _expires(state, latest)
        if first:
            yield _frame(first)

    return _keyed(stream, keep, "url", step, _ROWS, "latest long")


def first_deals(stream: DataFrame, delay: str, limit: int = fixed.PRICED_PER_SCAN) -> DataFrame:
    """The first ``limit`` deals with a price of each scan, with their ``place``, once the scan is closed.

    A scan is closed when the watermark, ``delay`` behind the latest deal, has passed
    its last deal; state holds ``limit`` deals for each open scan. Rows without a scan
    only move the watermark: a feed that ends sends one to close its scans.
    """
    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            rows = json.loads(state.get[1])
            state.remove()
            if rows:
                yield _frame(rows).assign(place=range(1, len(rows) + 1))
            return
        latest, rows = (state.get[0], json.loads(state.get[1])) if state.exists else (0, [])
        for frame in frames:
            latest = max(latest, int(frame["us"].max()))
            ahead = frame[frame["price"] > 0].sort_values(["us", "event_id"]).head(limit)
            rows = sorted([*rows, *_plain(ahead)], key=lambda row: (row[1], row[0]))[:limit]
        if key[0] is not None:
            state.update((latest, json.dumps(rows)))
            _expires(state, latest)

    return _keyed(stream, delay, "scan", step, f"{_ROWS}, place long", "latest long, rows string")


def forward_new_deals(stream: DataFrame, memory: str, checkpoint: str, keep: str = KEPT) -> None:
    """Remember every deal whose address was not seen within ``keep``."""
    start_batch_table(stream.sparkSession, memory, DEAL_SCHEMA)
    columns = stream.columns
    run_available(unseen_deals(stream, keep), lambda batch, batch_id: put_batch(batch.select(*columns), memory, batch_id),
                  checkpoint)


def recent_new_deals(stream: DataFrame, delay: str) -> DataFrame:
    """The bounded form: an address is forgotten once the watermark has passed it by ``delay``."""
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["url"])


_PRICED = f"{DEAL_SCHEMA}, place long, estimate double, discount double"


def _with_discount(batch: DataFrame, estimates: DataFrame, key: str) -> DataFrame:
    columns = [field.strip().split(" ")[0] for field in _PRICED.split(",")]
    return batch.join(estimates, key).withColumn("discount", F.col("estimate") - F.col("price")).select(*columns)


def price_deals(stream: DataFrame, estimates: DataFrame, key: str, output: str, checkpoint: str,
                delay: str = SCAN_DELAY) -> None:
    """Estimate and discount of the first deals of every scan that is closed."""
    start_batch_table(stream.sparkSession, output, _PRICED)
    run_available(first_deals(stream, delay), lambda batch, batch_id: put_batch(
        _with_discount(batch, estimates, key), output, batch_id), checkpoint)


def alert_deals(stream: DataFrame, estimates: DataFrame, key: str, alert_table: str, memory: str,
                checkpoint: str, delay: str = SCAN_DELAY) -> None:
    """Per closed scan the best of its first deals above the threshold, unless told before: alerted, then remembered.

    The memory holds what was alerted, at most one deal a scan.
    """
    for path in (alert_table, memory):
        start_batch_table(stream.sparkSession, path, _PRICED)

    def each(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        fresh = new_deals(batch, earlier_batches(session, memory, _PRICED, batch_id))
        told = alerts(_with_discount(fresh, estimates, key)).select(*_with_discount(fresh, estimates, key).columns)
        put_batch(told, alert_table, batch_id)
        put_batch(session.read.schema(_PRICED).parquet(f"{alert_table}/batch_id={batch_id}"), memory, batch_id)

    run_available(first_deals(stream, delay), each, checkpoint)


def batch_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All that the batches have written."""
    return spark.read.schema(schema).parquet(path)


def priced_table(spark: SparkSession, path: str) -> DataFrame:
    return batch_table(spark, path, f"{_PRICED}, batch_id long").drop("batch_id")


def deal_table(spark: SparkSession, path: str) -> DataFrame:
    return batch_table(spark, path, f"{DEAL_SCHEMA}, batch_id long").drop("batch_id")
