"""Revenue drivers: category funnel, conversion quadrants, brand revenue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import FUNNEL_STEPS, first_by_time, is_paid, ratio
from tidemark.operators import funnel
from tidemark.operators.funnel import with_conversion_rates


def session_category(fact: DataFrame) -> DataFrame:
    """One category per session: that of its earliest event that has one."""
    return (
        fact.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(first_by_time(fact, "category_id", F.col("category_id").isNotNull()).alias("category_id"))
    )


def _measures() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("sessions"),
        *[F.sum(f"has_{step}").alias(f"{step}_sessions") for step in FUNNEL_STEPS],
        F.sum("session_revenue_dedup_product").alias("revenue_dedup"),
        F.sum("session_revenue_gross").alias("revenue_gross"),
    ]


def _by_category(per_session: DataFrame) -> DataFrame:
    measures = [name for name in per_session.columns if name not in ("session_id", "category_id")]
    return per_session.groupBy("category_id").agg(*[F.sum(name).alias(name) for name in measures])


def category_funnel(sessions: DataFrame, categories: DataFrame) -> DataFrame:
    """Sessions per step and revenue per category, from stored session rows and session categories.

    Session rows are added up per session id before the join. Both sides then have one row per id and are already
    partitioned on it, so the join needs no further shuffle and meets no hot key.
    """
    return _by_category(sessions.groupBy("session_id").agg(*_measures()).join(categories, "session_id"))


def category_funnel_of_sessions(sessions: DataFrame, with_item_price: bool = False) -> DataFrame:
    """The same from session rows that carry their first category (``session_funnel(..., with_category=True)``).

    ``with_item_price=True`` adds avg_item_price, the mean price of the items that make up the gross revenue; NULL without any.
    """
    category = F.min_by("first_category_id", "first_category_key").alias("category_id")
    items = [F.sum("paid_items").alias("paid_items")] if with_item_price else []
    found = _by_category(sessions.groupBy("session_id").agg(*_measures(), *items, category))
    return found.withColumn("avg_item_price", ratio("revenue_gross", "paid_items")).drop("paid_items") if with_item_price else found


def category_funnel_of_events(fact: DataFrame, with_item_price: bool = False) -> DataFrame:
    """The same straight from events in one scan: the first category rides along with the session rows."""
    return category_funnel_of_sessions(funnel.session_funnel(fact, with_category=True), with_item_price)


def brand_revenue(fact: DataFrame, limit: int | None = None) -> DataFrame:
    """Purchase revenue, purchase sessions and mean price per brand; with ``limit`` only the brands with the highest revenue."""
    brands = (
        fact.where(is_paid() & F.col("brand").isNotNull())
        .groupBy("brand")
        .agg(
            F.count_distinct("session_id").alias("purchase_sessions"),
            F.sum("price").alias("revenue_gross"),
            F.avg("price").alias("avg_item_price"),
        )
    )
    return _top_brands(brands, limit)


def brand_revenue_of_sessions(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """The same from purchases and revenue per brand, session and any further keys (days, say)."""
    sessions = rows.groupBy("brand", "session_id").agg(F.sum("purchases").alias("purchases"), F.sum("revenue").alias("revenue"))
    brands = sessions.groupBy("brand").agg(
        F.count("session_id").alias("purchase_sessions"),
        F.sum("revenue").alias("revenue_gross"),
        ratio(F.sum("revenue"), F.sum("purchases")).alias("avg_item_price"),
    )
    return _top_brands(brands, limit)


def _top_brands(brands: DataFrame, limit: int | None) -> DataFrame:
    return brands if limit is None else brands.orderBy(F.col("revenue_gross").desc_nulls_last(), "brand").limit(limit)


def category_cvr(category_funnel: DataFrame) -> DataFrame:
    """Category funnel with conversion rates, NULL where there is nothing to convert from."""
    return with_conversion_rates(category_funnel)


def category_quadrants(category_cvr: DataFrame) -> DataFrame:
    """Place every category against mean traffic and mean view-to-purchase conversion.

    High traffic and low conversion is ``optimize``, low traffic and high conversion ``grow``, both high ``star``,
    both low ``monitor``; categories without a rate have no quadrant.
    """
    averages = category_cvr.agg(
        F.struct(
            F.avg("view_sessions").alias("views"), F.avg("view_to_purchase_cvr").alias("cvr")
        ).alias("means")
    ).scalar()
    busy = F.col("view_sessions") >= F.col("avg_view_sessions")
    converts = F.col("view_to_purchase_cvr") >= F.col("avg_view_to_purchase_cvr")
    return (
        category_cvr.select(
            "category_id", "view_sessions", "view_to_purchase_cvr", "revenue_dedup", averages.alias("means")
        )
        .withColumns(
            {
                "avg_view_sessions": F.col("means.views"),
                "avg_view_to_purchase_cvr": F.col("means.cvr"),
            }
        )
        .drop("means")
        .withColumn(
            "quadrant",
            F.when(busy & ~converts, "optimize")
            .when(~busy & converts, "grow")
            .when(busy & converts, "star")
            .when(~busy & ~converts, "monitor"),
        )
    )
