"""Clickstream input: raw CSV, cleaning, and the cleaned event view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_COLUMNS = (
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
)
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])
MALFORMED = "_malformed"


def _csv(spark: SparkSession, path: str, multi_line: bool) -> DataFrame:
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    names = reader.csv(path).columns
    missing = [name for name in RAW_COLUMNS if name not in names]
    if missing:
        raise ValueError(f"the header lacks {missing}")
    fields = [T.StructField(name, T.StringType()) for name in (*names, MALFORMED)]
    # With enforceSchema off, a file whose header differs from the first one's raises an error.
    return (
        reader.schema(T.StructType(fields))
        .option("enforceSchema", False)
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("columnPruning", False)  # else fields are not counted
        .csv(path)
    )


def read_events_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Headed CSV as text columns, found by their names; types are set by ``clean_raw_events``, never inferred.

    Quotes inside quoted fields are doubled; an empty field is NULL, quoted or not. All files must have the same header. ``multi_line=True`` also reads line
    breaks inside quotes, but then no file can be split. ``malformed_rows`` lists what does not fit the header.
    """
    return _csv(spark, path, multi_line).select(*RAW_COLUMNS)


def malformed_rows(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """The text of rows with more or fewer fields than the header, and the time that was read from it."""
    return _csv(spark, path, multi_line).where(F.col(MALFORMED).isNotNull()).select(F.col(MALFORMED).alias("row"), "event_time")


def _text(name: str) -> Column:
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def _whole_number(name: str) -> Column:
    # Through a 38-digit decimal: exact for 19-digit ids and able to read exponent notation.
    return F.col(name).try_cast("decimal(38,0)").try_cast("bigint")


def _decimal_number(name: str) -> Column:
    """A plain decimal or exponent form; suffixes such as ``7.0d`` are no numbers."""
    text = F.trim(F.col(name))
    return F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))


def _wall_clock(text: Column) -> Column:
    """Time of day as written, whatever the session zone; a full date is required, other text gives NULL."""
    return F.when(text.rlike(r"^\s*\d+-\d+-\d+"), text.try_cast("timestamp_ntz"))


def clean_raw_events(raw: DataFrame) -> DataFrame:
    """Typed events from text columns; what cannot be parsed becomes NULL."""
    written = F.col("event_time")
    event_ts = F.coalesce(_wall_clock(F.replace(written, F.lit(" UTC"), F.lit(""))), _wall_clock(written))
    return raw.select(
        event_ts.alias("event_ts"),
        F.lower(F.trim(F.col("event_type"))).alias("event_type"),
        _whole_number("product_id").alias("product_id"),
        _whole_number("category_id").alias("category_id"),
        _text("category_code").alias("category_code"),
        _text("brand").alias("brand"),
        _decimal_number("price").alias("price"),
        _whole_number("user_id").alias("user_id"),
        _text("user_session").alias("user_session"),
    )


def events_clean(raw: DataFrame) -> DataFrame:
    """Events that have a time and a user, with their day; an ``event_id`` is kept if there is one."""
    tie_break = ["event_id"] if "event_id" in raw.columns else []
    return raw.where(F.col("event_ts").isNotNull() & F.col("user_id").isNotNull()).select(
        *tie_break,
        "event_ts",
        F.to_date("event_ts").alias("event_date"),
        "event_type",
        "product_id",
        "category_id",
        "category_code",
        "brand",
        "price",
        "user_id",
        F.col("user_session").alias("session_id"),
    )
