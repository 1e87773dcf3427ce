"""Clickstream and ticket inputs derived from the given star-schema tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.events import RAW_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed raw events (the shape ``clean_raw_events`` returns) plus ``event_id``."""
    event_id = F.col("event_id")
    k = F.col("k")
    base = (
        table(spark, sf_dir, "events")
        .withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
        .withColumn("category", F.when(event_id % 5 == 0, (k + 1) % 10).otherwise(k % 10))
    )
    code = F.concat(F.lit("cat."), F.col("category").cast("string"))
    return base.select(
        "event_id",
        F.col("ts").alias("event_ts"),
        F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type")).alias("event_type"),
        k.alias("product_id"),
        F.col("category").alias("category_id"),
        F.when((F.col("category") == 3) | (event_id % 2 == 1), None)
        .when(event_id % 3 == 0, F.concat(code, F.lit(".alt")))
        .otherwise(code)
        .alias("category_code"),
        F.when(event_id % 7 == 0, None)
        .otherwise(F.concat(F.lit("brand_"), ((k + event_id % 3) % 13).cast("string")))
        .alias("brand"),
        F.when(event_id % 50 == 0, -F.col("value")).otherwise(F.col("value")).alias("price"),
        "user_id",
        F.when(event_id % 500 == 0, None)
        .otherwise(F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string")))
        .alias("user_session"),
    )


def raw_event_strings(spark: SparkSession, sf_dir: str, odd_brands: bool = False) -> DataFrame:
    """The nine CSV columns as text, with the blemishes the cleaning step must cope with.

    Every 11th time has microseconds and no zone, every 97th product id is in exponent notation, every 101st price
    and every 103rd user is no number. With ``odd_brands`` every 10th brand has quotes, a comma and a backslash.
    """
    event_id = F.col("event_id")
    brand = F.coalesce("brand", F.lit(""))
    odd = F.concat(F.lit('a "'), brand, F.lit('", \\ inc'))
    second = F.concat(F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))
    micros = F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return (
        raw_events(spark, sf_dir)
        .select(
            F.when(event_id % 11 == 0, micros).otherwise(second).alias("event_time"),
            F.concat(F.lit("  "), F.upper("event_type"), F.lit(" ")).alias("event_type"),
            F.when(event_id % 97 == 0, F.lit("1.5e18")).otherwise(F.col("product_id").cast("string")).alias(
                "product_id"
            ),
            F.col("category_id").cast("string").alias("category_id"),
            F.coalesce("category_code", F.lit(" ")).alias("category_code"),
            (F.when(event_id % 10 == 0, odd).otherwise(brand) if odd_brands else brand).alias("brand"),
            F.when(event_id % 101 == 0, F.lit("n/a")).otherwise(F.col("price").cast("string")).alias("price"),
            F.when(event_id % 103 == 0, F.lit("?")).otherwise(F.col("user_id").cast("string")).alias("user_id"),
            F.coalesce("user_session", F.lit("")).alias("user_session"),
        )
        .select(*RAW_COLUMNS)
    )


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets from orders: one per order, resolved when its last line shipped."""
    key = F.col("o_orderkey")
    even = key % 2 == 0
    shipped = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.max("l_shipdate").alias("resolved"))
    )
    segments = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("queue_name")
    )
    status = (
        F.when(key % 211 == 0, None)
        .when(F.col("o_orderstatus") == "F", F.when(even, "Resolved").otherwise("Closed"))
        .when(F.col("o_orderstatus") == "O", F.when(even, "Open").otherwise("In Progress"))
        .otherwise(F.when(even, "Pending").otherwise("Reopened"))
    )
    resolved = F.col("resolved").isNotNull()
    return (
        table(spark, sf_dir, "orders")
        .join(shipped, "o_orderkey", "left")
        .join(segments, "o_custkey", "left")
        .select(
            key.alias("ticket_id"),
            F.when(key % 401 != 0, F.col("o_orderdate")).alias("issue_created"),
            F.col("resolved").alias("issue_resolution_date"),
            status.alias("issue_status"),
            F.when(key % 307 == 0, "").otherwise(F.col("o_orderpriority")).alias("issue_priority"),
            "queue_name",
            F.concat(F.lit("cat_"), (key % 5).cast("string")).alias("category"),
            F.concat(F.lit("sub_"), (key % 15).cast("string")).alias("subcategory"),
            F.when(
                key % 101 != 0, F.concat(F.lit("agent_"), (F.col("o_custkey") % 20).cast("string"))
            ).alias("assigned_agent"),
            F.element_at(F.array(*map(F.lit, ("Email", "Chat", "Phone", "Web"))), (key % 4 + 1).cast("int")).alias(
                "channel"
            ),
            F.when(key % 13 != 0, (key % 97).cast("double")).alias("first_response_time_minutes"),
            F.when(resolved, (key % 4001).cast("double")).alias("resolution_time_minutes"),
            F.when(key % 17 != 0, key % 97 > 30).alias("first_response_breached"),
            F.when(key % 19 != 0, key % 4001 > 1440).alias("resolution_sla_breached"),
            F.when(key % 5 != 0, key % 3).alias("reopen_count"),
            F.when(key % 8 != 7, key % 8).alias("csat_score"),
            (key % 11 == 0).alias("escalated_flag"),
            F.when(key % 50 == 0, True).when(key % 3 == 0, False).alias("deleted_flag"),
        )
    )
