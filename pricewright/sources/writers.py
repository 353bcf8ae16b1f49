"""Writing tables and JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.operators.ordering import numbered
from pricewright.session import staged


def write_splits(df: DataFrame, path: str) -> None:
    """One folder per split, so that reading a split reads only its files."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_prompts(df: DataFrame, path: str) -> None:
    """Prompt and completion only; refused when any row lacks one."""
    lacking = df.filter(F.col("prompt").isNull() | F.col("completion").isNull())
    if not lacking.isEmpty():
        raise ValueError("some rows have no prompt or completion")
    write_splits(df.select("prompt", "completion", "split"), path)


def batch_request(key: Column, text: Column) -> Column:
    """One request line as JSON."""
    message = [
        F.struct(F.lit("system").alias("role"), F.lit(fixed.SUMMARY_REQUEST).alias("content")),
        F.struct(F.lit("user").alias("role"), text.alias("content")),
    ]
    return F.to_json(
        F.struct(
            key.cast("string").alias("custom_id"),
            F.lit("POST").alias("method"),
            F.lit(fixed.BATCH_ENDPOINT).alias("url"),
            F.struct(
                F.lit(fixed.BATCH_MODEL).alias("model"),
                F.array(*message).alias("messages"),
                F.lit("low").alias("reasoning_effort"),
            ).alias("body"),
        )
    )


def with_batches(df: DataFrame, key: str, size: int = fixed.BATCH_ROWS) -> DataFrame:
    """Add the row's place and its batch's first and last-plus-one place."""
    rows = numbered(df, [key], "place").withColumn("place", F.col("place") - 1)
    start = F.floor(F.col("place") / size) * size
    total = F.lit(df.count())
    return rows.withColumn("start", start.cast("long")).withColumn(
        "end", F.least(F.col("start") + size, total))


def write_batch_requests(df: DataFrame, key: str, text: str, path: str) -> None:
    """Request lines, one folder ``file=start_end`` of at most 1,000 lines per batch."""
    # only the keys are put in order; the texts join their batch afterwards
    rows = with_batches(df.select(key), key).join(df.select(key, text), key)
    name = F.concat_ws("_", F.col("start").cast("string"), F.col("end").cast("string"))
    (
        rows.select(name.alias("file"), "place", batch_request(F.col(key), F.col(text)).alias("value"))
        .repartition("file")
        .sortWithinPartitions("file", "place")
        .drop("place")
        .write.mode("overwrite").partitionBy("file").text(path)
    )


def chat_line(user: Column, assistant: Column) -> Column:
    """A user and an assistant message as one JSON line."""
    turns = [
        F.struct(F.lit(role).alias("role"), text.alias("content"))
        for role, text in (("user", user), ("assistant", assistant))
    ]
    return F.to_json(F.struct(F.array(*turns).alias("messages")))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def write_questions(df: DataFrame, path: str, overwrite: bool = False) -> None:
    """JSON lines; an existing file is replaced only on request."""
    df.write.mode("overwrite" if overwrite else "errorifexists").json(path)


def write_index(chunks: DataFrame, path: str, buckets: int) -> None:
    """Replace the index: id, vector, text and metadata, clustered by a hash bucket."""
    bucket = F.pmod(F.xxhash64("chunk_id"), F.lit(buckets)).cast("int")
    (
        chunks.withColumn("bucket", bucket).repartition(buckets, "bucket")
        .sortWithinPartitions("bucket", "chunk_id")
        .write.mode("overwrite").partitionBy("bucket").parquet(path)
    )


def append_documents(wanted: DataFrame, path: str) -> DataFrame:
    """Write the documents whose path is new; returns how many were ok, skipped or failed."""
    stored = wanted.sparkSession.read.schema("path string, content string").parquet(path)
    known = stored.select("path").distinct().withColumn("_there", F.lit(True))
    status = (
        F.when(F.coalesce(F.trim("content"), F.lit("")) == "", "failed")
        .when(F.col("_there"), "skipped").otherwise("ok")
    )
    # the outcome is fixed before anything is added to the folder it was read from
    checked = staged(wanted.join(known, "path", "left").withColumn("status", status), "documents")
    new = checked.filter("status = 'ok'")
    new.select("path", F.concat("content", F.lit("\n")).alias("content")).write.mode("append").parquet(path)
    return checked.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def seed_lookup(lookup: DataFrame, seeds: DataFrame) -> DataFrame:
    """The lookup table, filled with the seeds only when it holds nothing yet."""
    return seeds.select(*lookup.columns) if lookup.isEmpty() else lookup
