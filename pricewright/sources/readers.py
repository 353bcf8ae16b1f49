"""Reading files: every reader takes a schema, none infers one."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewright import fixed_values as fixed
from pricewright.functions.products import strip

_BOOKING_CASTS = {
    "POL": ("pol", "string"), "POD": ("pod", "string"),
    "COMMODITY_CODE": ("commodity_code", "string"),
    "COMMODITY_DESCRIPTION": ("commodity_desc", "string"),
    "TOTAL_TEU": ("teu", "double"), "BOOKING_TYPE": ("booking_type", "string"),
    "BOOKING_YEAR": ("year", "int"), "BOOKING_MONTH": ("month", "int"),
    "BOOKING_CHANNEL": ("channel", "string"), "TOTAL_PRICE": ("price", "double"),
    "CHG_CURRENCY": ("currency", "string"),
}
QUESTION_SCHEMA = (
    "question string, keywords array<string>, reference_answer string, "
    "final_decision string, reason string, category string"
)
REPLY_SCHEMA = (
    "custom_id string, response struct<body struct<choices array<struct<message struct<content string>>>>>"
)
OPPORTUNITY_SCHEMA = (
    "deal struct<product_description string, price double, url string>, estimate double, discount double"
)


def products(categories: dict[str, DataFrame]) -> DataFrame:
    """One table of several raw categories, each row tagged with its own."""
    tagged = [df.withColumn("category", F.lit(name)) for name, df in categories.items()]
    return reduce(DataFrame.unionByName, tagged)


def booking_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Good rows (typed) and rejected rows (as read) of a booking file with a header."""
    text = spark.read.csv(path, header=True, inferSchema=False, multiLine=False)
    missing = [c for c in fixed.BOOKING_COLUMNS if c not in text.columns]
    if missing:
        raise ValueError(f"missing booking columns: {missing}")
    typed = [F.col(c).try_cast(kind).alias(name) for c, (name, kind) in _BOOKING_CASTS.items()]
    # an empty number cell stays a missing value, text in a number column rejects the row
    broken = reduce(
        lambda a, b: a | b,
        [F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()
         for c, (_, kind) in _BOOKING_CASTS.items() if kind != "string"],
    ) | F.col("BOOKING_YEAR").isNull() | F.col("BOOKING_MONTH").isNull()
    return text.filter(~broken).select(*typed), text.filter(broken)


def markdown_files(spark: SparkSession, root: str, names: str = "*.md") -> DataFrame:
    """Every file of the given name below a first-level folder, which gives the document type."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter=names)
    relative = F.regexp_replace(F.col("_metadata.file_path"), "^.*?" + _tail(root) + "/", "")
    return typed_documents(files.select(relative.alias("source"), F.col("value").alias("text")))


def typed_documents(files: DataFrame) -> DataFrame:
    """Documents (``source``, ``text``) below a first-level folder, which gives their type."""
    return files.filter(F.col("source").contains("/")).select(
        F.split_part("source", F.lit("/"), F.lit(1)).alias("type"), "source", "text")


def nonblank_markdown(spark: SparkSession, root: str, names: str = "*.md") -> DataFrame:
    """Every file with trimmed text; undecodable bytes are left out, blank files dropped."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", names).option(
        "recursiveFileLookup", "true").load(root)
    relative = F.regexp_replace("path", "^.*?" + _tail(root) + "/", "")
    return nonblank_documents(files.select(relative.alias("path"), "content"))


def nonblank_documents(files: DataFrame) -> DataFrame:
    """Documents (``path``, ``content`` as bytes) as trimmed text, blank ones dropped."""
    # invalid bytes decode to the replacement character
    text = strip(F.replace(F.make_valid_utf8(F.col("content").cast("string")), F.lit("�"), F.lit("")))
    return files.select("path", text.alias("content")).filter("content <> ''")


def _tail(root: str) -> str:
    return "\\Q" + root.rstrip("/").rsplit("/", 1)[-1] + "\\E"


def question_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines questions; blank lines skipped, category defaulted."""
    lines = spark.read.schema(QUESTION_SCHEMA).json(path)
    return lines.withColumn("category", F.coalesce("category", F.lit("uncategorized")))


def reply_lines(spark: SparkSession, path: str) -> DataFrame:
    """Batch replies with their id and the position of their line."""
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return (
        spark.read.schema(REPLY_SCHEMA).option("recursiveFileLookup", "true").json(path)
        .select("custom_id", F.col("response.body.choices")[0]["message"]["content"].alias("content"),
                place.alias("place"))
        .filter("custom_id is not null")
    )


def opportunity_memory(spark: SparkSession, path: str) -> DataFrame:
    """Earlier opportunities; an empty table when there is no file, corrupt rows left out."""
    try:
        rows = spark.read.schema(OPPORTUNITY_SCHEMA).option("mode", "DROPMALFORMED").json(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in (error.getCondition() or ""):
            raise
        return spark.createDataFrame([], OPPORTUNITY_SCHEMA)
    return rows.filter("deal is not null")
