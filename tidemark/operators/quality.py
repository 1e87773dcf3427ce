"""Validation queries over the clickstream model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.support import total


def qa_event_types(fact: DataFrame) -> DataFrame:
    """Events per type, most frequent first."""
    return (
        fact.groupBy("event_type")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), F.col("event_type").asc_nulls_last())
    )


def qa_null_keys(fact: DataFrame) -> DataFrame:
    """NULL counts of the key columns."""
    keys = ("user_id", "event_ts", "event_type", "product_id", "category_id")
    return fact.agg(*[F.count_if(F.col(key).isNull()).alias(f"null_{key}") for key in keys])


def qa_revenue(category_funnel: DataFrame) -> DataFrame:
    """Deduplicated and gross revenue; the former must not exceed the latter."""
    return category_funnel.agg(
        F.sum("revenue_dedup").alias("revenue_dedup"), F.sum("revenue_gross").alias("revenue_gross")
    ).withColumn("dedup_within_gross", F.col("revenue_dedup") <= F.col("revenue_gross"))


def qa_cvr_bounds(category_cvr: DataFrame) -> DataFrame:
    """Smallest and largest conversion rates over the categories."""
    return category_cvr.agg(
        F.min("view_to_cart_cvr").alias("min_v2c"),
        F.max("view_to_cart_cvr").alias("max_v2c"),
        F.min("cart_to_purchase_cvr").alias("min_c2p"),
        F.max("cart_to_purchase_cvr").alias("max_c2p"),
    )


def qa_day0(curve: DataFrame) -> DataFrame:
    """Day-0 retention per cohort; it must be 1."""
    return curve.where(F.col("days_since") == 0).select("cohort_date", "retention_rate").orderBy("cohort_date")


def qa_monotonic(summary: DataFrame) -> DataFrame:
    """Whether later funnel steps have no more sessions than earlier ones."""
    cart_ok = F.col("cart_sessions") <= F.col("view_sessions")
    purchase_ok = F.col("purchase_sessions") <= F.col("cart_sessions")
    return summary.select(
        "view_sessions",
        "cart_sessions",
        "purchase_sessions",
        cart_ok.alias("cart_within_view"),
        purchase_ok.alias("purchase_within_cart"),
        (cart_ok & purchase_ok).alias("is_monotonic"),
    )


def qa_row_integrity(raw: DataFrame, fact: DataFrame, dim_session: DataFrame | None = None) -> DataFrame:
    """Raw against fact rows, and session rows against distinct sessions in the raw events.

    Raw events and fact are read once each: rows are added up over their sessions, which are counted on the way. With
    ``dim_session``, a stored dimension, its own rows are counted; without it those that the fact gives.
    """
    rows = F.count(F.lit(1))
    of_raw = raw.groupBy("user_session").agg(rows.alias("n"))
    of_fact = fact.groupBy("session_id", "user_id").agg(rows.alias("n"))
    counted = F.struct(total("n").alias("rows"), F.count("session_id").alias("sessions"))
    found = of_fact.agg(counted.alias("fact")).scalar()
    sessions = dim_session.agg(rows).scalar() if dim_session is not None else F.col("fact.sessions")
    return of_raw.agg(total("n").alias("raw_rows"), F.count("user_session").alias("sessions_distinct_raw")).withColumn("fact", found).select(
        "raw_rows", F.col("fact.rows").alias("fact_rows"), sessions.alias("sessions_dim"), "sessions_distinct_raw"
    )


def qa_duplicate_events(
    fact: DataFrame, keys: Sequence[str] = ("user_id", "product_id", "event_ts", "event_type")
) -> DataFrame:
    """Number of key combinations that occur more than once."""
    groups = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return groups.agg(F.count(F.lit(1)).alias("dup_groups"))
