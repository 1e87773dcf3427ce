"""The clickstream model kept up to date load by load.

Events are stored by load and day. Every table that derives from single days is stored by day and overwritten for the days that a load
brings events of; sessions, cohorts and retention are recomputed for the sessions and users it touches. A load may bring late
events of any day. Loading again under the same name replaces what that load brought before, so a failed load is simply repeated.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.columns import is_paid
from tidemark.operators import cohorts, drivers, funnel, star, trends
from tidemark.plans.storage import exists, overwrite_partitions, remove, scratch_dir, store
from tidemark.sources.events import events_clean

SESSION = funnel.SESSION


def _any() -> Column:
    return F.lit(True)


def _is_branded() -> Column:
    return is_paid() & F.col("brand").isNotNull()


def _brand_sessions(fact: DataFrame) -> DataFrame:
    return fact.where(_is_branded()).groupBy("event_date", "brand", "session_id").agg(F.count(F.lit(1)).alias("purchases"), F.sum("price").alias("revenue"))


def _user_days(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date", "user_id").agg(F.min("event_ts").alias("first_ts"), F.max("event_ts").alias("last_ts"))


def _steps_by_day(events: DataFrame) -> DataFrame:
    """Rows of ``product_steps`` day by day: the day takes part in the grouping, not in the result's meaning."""
    named = events.withColumn("product_id", F.struct("event_date", "product_id"))
    steps = funnel.product_steps(named, with_category=True)
    return steps.withColumns({"event_date": F.col("product_id.event_date"), "product_id": F.col("product_id.product_id")})


# Tables whose rows derive from the events of one day: how they are built, the column with the day, and which events make rows.
_BY_DAY = {
    "step_days": (_steps_by_day, "event_date", lambda: F.col("session_id").isNotNull()),
    "daily_event_counts": (lambda events: trends.daily_event_counts(star.fact_events(events)), "event_date", _any),
    "user_days": (_user_days, "event_date", _any),
    "category_days": (lambda events: star.category_counts(events, "event_date"), "event_date", _any),
    "product_days": (lambda events: star.product_counts(events, "event_date"), "event_date", _any),
    "brand_days": (_brand_sessions, "event_date", _is_branded),
    "fct_user_daily_purchases": (cohorts.user_daily_purchases, "purchase_date", is_paid),
}


def _placed(purchases: DataFrame, starts: DataFrame) -> DataFrame:
    return purchases.join(starts, "user_id").withColumn("days_since", F.date_diff("purchase_date", "cohort_date"))


def _retained(activity: DataFrame) -> DataFrame:
    return activity.groupBy("cohort_date", "days_since", "purchase_date").agg(F.count(F.lit(1)).alias("users"))


def _session_rows(steps: DataFrame) -> DataFrame:
    sessions = funnel.sessions_of_steps(funnel.merged_steps(steps.drop("event_date")))
    return sessions.withColumn("session_day", F.to_date("session_start_ts"))


def _derived(events: DataFrame) -> dict[str, DataFrame]:
    """Every derived table as it follows from these events."""
    tables = {name: build(events) for name, (build, *_) in _BY_DAY.items()}
    purchases = tables["fct_user_daily_purchases"]
    starts = cohorts.user_purchase_cohort(purchases)
    activity = _placed(purchases, starts)
    return tables | {
        "sessions": _session_rows(tables["step_days"]),
        "cohorts": starts,
        "fct_cohort_activity": activity,
        "retained": _retained(activity),
    }


class _Store:
    """The stored tables of one model."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark, self.directory, self.scratch = spark, directory.rstrip("/"), scratch_dir(spark)

    def path(self, name: str) -> str:
        return f"{self.directory}/{name}"

    def has(self, name: str) -> bool:
        return exists(self.spark, self.path(name))

    def events(self, folder: str = "events") -> DataFrame:
        return self.spark.read.option("basePath", self.path("events")).parquet(self.path(folder)).drop("load_id")

    @cached_property
    def schemas(self) -> dict[str, StructType]:
        """Those of the derived tables, as they follow from the events', so that a table without rows can be read as well."""
        return {name: table.schema for name, table in _derived(self.events()).items()}

    def read(self, name: str) -> DataFrame:
        """A derived table."""
        return self.spark.read.schema(self.schemas[name]).parquet(self.path(name))

    def keep(self, name: str, table: DataFrame) -> DataFrame:
        return store(table, self.scratch, name)

    def put(self, name: str, table: DataFrame, column: str, days: Iterable[date], filled: Iterable[date] | None = None) -> None:
        """Overwrite these days of a table; days without rows lose their partition. ``filled``: the days with rows, where they are known,
        so that the table is not read for them."""
        overwrite_partitions(table, self.path(name), column)
        for day in set(days) - (_days(table, column) if filled is None else set(filled)):
            remove(self.spark, f"{self.path(name)}/{column}={day}")


def _days(table: DataFrame, column: str) -> set[date]:
    """The days of a table: a list as long as the calendar, not as the table."""
    return {row[0] for row in table.select(F.col(column).cast("date")).distinct().collect()}


def _of_days(table: DataFrame, column: str, days: Iterable[date]) -> DataFrame:
    return table.where(F.col(column).isin(*days)) if days else table.where(F.lit(False))


def load(raw: DataFrame, directory: str, load_id: str, lookback: int | None = None) -> None:
    """Bring the cleaned raw events of one load into the model at ``directory``.

    ``lookback`` says by how many days at most a late event may follow the start of its session; then only so many days of sessions are
    searched for those that the load touches. By default all are.
    """
    if not re.fullmatch(r"[A-Za-z0-9_-]+", load_id):
        raise ValueError("a load's name consists of letters, digits, _ and -")
    model = _Store(raw.sparkSession, directory)
    folder = f"events/load_id={load_id}"
    before = model.keep("before", model.events(folder).select("event_date", *SESSION).distinct()) if model.has(folder) else None
    cleaned = events_clean(raw)
    cleaned.write.mode("overwrite").partitionBy("event_date").parquet(model.path(folder))
    batch = model.spark.read.schema(cleaned.schema).parquet(model.path(folder)).select("event_date", *SESSION).distinct()
    touched = model.keep("touched", batch.unionByName(before) if before is not None else batch)
    days = _days(touched, "event_date")
    if not days:
        return
    bought_before = None
    if model.has("fct_user_daily_purchases"):
        bought_before = model.keep("bought_before", _of_days(model.read("fct_user_daily_purchases"), "purchase_date", days).select("user_id").distinct())
    events = _of_days(model.events(), "event_date", days)
    _load_days(model, events, days)
    _load_sessions(model, touched.where("session_id is not null").select(*SESSION).distinct(), days, lookback)
    _load_cohorts(model, bought_before, days)
    remove(model.spark, model.scratch)


def _load_days(model: _Store, events: DataFrame, days: set[date], at_once: int = 4) -> None:
    """Rebuild these days of the tables that derive from single days: each is written once, in its place, a few tables at a time."""
    makes = [F.bool_or(rows()).alias(name) for name, (*_, rows) in _BY_DAY.items()]
    found = events.groupBy("event_date").agg(*makes).collect()  # as long as the calendar

    def put(item: tuple) -> None:
        name, (build, column, _) = item
        model.put(name, build(events), column, days, [row["event_date"] for row in found if row[name]])

    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(put, _BY_DAY.items()))


def _load_sessions(model: _Store, touched: DataFrame, days: set[date], lookback: int | None) -> None:
    """Recompute the touched sessions from the steps of their days, and rewrite the start days that they leave or enter."""
    steps = model.read("step_days")
    if not model.has("sessions"):  # all steps are this load's
        model.put("sessions", _session_rows(steps), "session_day", set(), set())
        return
    fresh = model.keep("fresh", _session_rows(steps.join(touched, SESSION, "left_semi")))
    stored = model.read("sessions")
    recent = stored if lookback is None else stored.where(F.col("session_day") >= F.date_sub(F.lit(min(days)), lookback))
    starts = _days(fresh, "session_day") | _days(recent.join(touched, SESSION, "left_semi"), "session_day")
    kept = _of_days(stored, "session_day", starts).join(touched, SESSION, "left_anti")
    model.put("sessions", model.keep("rewritten", fresh.unionByName(kept)), "session_day", starts)


def _load_cohorts(model: _Store, bought_before: DataFrame | None, days: set[date]) -> None:
    """Find the cohorts of the users who bought on these days, and rewrite the purchase days whose rows change."""
    purchases = model.read("fct_user_daily_purchases")
    buyers = _of_days(purchases, "purchase_date", days).select("user_id").distinct()
    buyers = buyers.unionByName(bought_before).distinct() if bought_before is not None else buyers
    now = cohorts.user_purchase_cohort(purchases.join(buyers, "user_id", "left_semi"))
    if model.has("cohorts"):
        stored = model.read("cohorts").withColumnRenamed("cohort_date", "was")
        both = now.join(stored.join(buyers, "user_id", "left_semi"), "user_id", "full")
        changed = model.keep("changed", both.where(~F.col("cohort_date").eqNullSafe(F.col("was"))))
        dates = _days(changed.where("cohort_date is not null"), "cohort_date") | _days(changed.where("was is not null"), "was")
        rest = _of_days(model.read("cohorts"), "cohort_date", dates).join(changed, "user_id", "left_anti")
        moved = changed.where("was is not null").select("user_id")
        days = days | _days(purchases.join(moved, "user_id", "left_semi"), "purchase_date")
        rows = changed.where("cohort_date is not null").select("user_id", "cohort_date").unionByName(rest.select("user_id", "cohort_date"))
    else:
        rows, dates = now, set()
    if rows is now or dates:
        model.put("cohorts", model.keep("cohort_rows", rows), "cohort_date", dates)
    activity = model.keep("activity", _placed(_of_days(purchases, "purchase_date", days), model.read("cohorts")))
    model.put("fct_cohort_activity", activity, "purchase_date", days)
    model.put("retained", model.keep("retained", _retained(activity)), "purchase_date", days)


def read_loaded(spark: SparkSession, directory: str, max_day: int = 30, brand_limit: int | None = None) -> dict[str, DataFrame]:
    """The tables of ``build_model`` from a model that is kept by ``load``; events are read for the fact table alone."""
    model = _Store(spark, directory)
    events = model.events()
    sessions = model.read("sessions").drop("session_day")
    purchases = model.read("fct_user_daily_purchases")
    daily, retained = model.read("daily_event_counts"), model.read("retained")
    users = model.read("user_days").groupBy("user_id").agg(F.min("first_ts").alias("first_seen_ts"), F.max("last_ts").alias("last_seen_ts"))
    plain = sessions.drop(*funnel.CATEGORY_COLUMNS)
    return {
        "fact_events": star.fact_events(events),
        "dim_date": star.dim_date(daily),
        "dim_user": users,
        "dim_category": star.dim_category_of_counts(model.read("category_days")),
        "dim_product": star.dim_product_of_counts(model.read("product_days").groupBy("product_id", "category_id", "brand", "price").agg(F.sum("n").alias("n"))),
        "dim_session": star.dim_session_of_rows(plain),
        "fct_session_funnel": plain,
        "fct_user_daily_purchases": purchases,
        "fct_cohort_activity": model.read("fct_cohort_activity"),
        "dim_user_purchase_cohort": model.read("cohorts"),
        "cohort_retention_summary": cohorts.cohort_retention_summary(retained, users="users"),
        "cohort_retention_curve": cohorts.cohort_retention_curve(retained, max_day, users="users"),
        "agg_category_funnel": drivers.category_funnel_of_sessions(sessions),
        "agg_brand_revenue": drivers.brand_revenue_of_sessions(model.read("brand_days"), brand_limit),
        "daily_event_counts": daily,
    }
