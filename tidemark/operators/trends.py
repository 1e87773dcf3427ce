"""Daily event counts, moving averages, daily conversion and the view peak.

Everything after ``daily_event_counts`` works on one row per day and type, so its windows and scalar subqueries are
bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import FUNNEL_STEPS, ratio


def daily_event_counts(fact: DataFrame) -> DataFrame:
    """Events per day and type."""
    return fact.groupBy(F.to_date("event_ts").alias("event_date"), "event_type").agg(
        F.count(F.lit(1)).alias("events")
    )


def daily_events_by_type(daily: DataFrame) -> DataFrame:
    """Total, view, cart and purchase events per day; NULL where a day has none of a type."""
    events = F.col("events")
    return daily.groupBy("event_date").agg(
        F.sum(events).alias("total_events"),
        *[F.sum(F.when(F.col("event_type") == step, events)).alias(f"{step}_events") for step in FUNNEL_STEPS],
    )


def events_moving_avg(daily: DataFrame, days: int = 7, by_type: bool = True) -> DataFrame:
    """Mean daily events over the last ``days`` calendar days, of the days that have events."""
    keys = ["event_type"] if by_type else []
    per_day = daily.groupBy("event_date", *keys).agg(F.sum("events").alias("events"))
    last = Window.partitionBy(*keys).orderBy(F.unix_date("event_date")).rangeBetween(1 - days, 0)
    return per_day.withColumn(f"events_{days}d_ma", F.avg("events").over(last))


def daily_cvr(daily: DataFrame) -> DataFrame:
    """Daily conversion rates between event counts."""
    counts = daily_events_by_type(daily)
    return counts.select(
        "event_date",
        *[f"{step}_events" for step in FUNNEL_STEPS],
        ratio("cart_events", "view_events").alias("view_to_cart_cvr"),
        ratio("purchase_events", "cart_events").alias("cart_to_purchase_cvr"),
        ratio("purchase_events", "view_events").alias("view_to_purchase_cvr"),
    )


def _daily_views(daily: DataFrame) -> DataFrame:
    return (
        daily.where(F.col("event_type") == "view").groupBy("event_date").agg(F.sum("events").alias("views"))
    )


def peak_view_day(daily: DataFrame) -> DataFrame:
    """The day with most views, the latest one on a tie."""
    return _daily_views(daily).agg(
        F.max_by("event_date", F.struct("views", "event_date")).alias("peak_view_date"),
        F.max("views").alias("peak_view_events"),
    )


def peak_view_spike(daily: DataFrame, days: int = 7) -> DataFrame:
    """The view peak against the mean of the days before it, in percent over that mean.

    The percentage is NULL if the days before have no views.
    """
    views = _daily_views(daily)
    peak = views.agg(F.max_by("event_date", F.struct("views", "event_date"))).scalar()
    before = (F.col("event_date") < F.col("peak_view_date")) & (
        F.col("event_date") >= F.date_sub("peak_view_date", days)
    )
    over_base = ratio("peak_view_events", "baseline_views") - 1
    return (
        views.withColumn("peak_view_date", peak)
        .agg(
            F.max("peak_view_date").alias("peak_view_date"),
            F.max("views").alias("peak_view_events"),
            F.avg(F.when(before, F.col("views"))).alias("baseline_views"),
        )
        .withColumn("peak_view_spike_pct", over_base * 100)
    )
