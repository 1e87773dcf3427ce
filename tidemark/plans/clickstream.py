"""The clickstream model in dependency order."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.operators import cohorts, drivers, funnel, quality, star, trends
from tidemark.plans.storage import store_all
from tidemark.sources.events import events_clean
from tidemark.sources.model import export_parquet

# The modelled tables that leave the build for dashboards.
EXPORTED = (
    "fct_session_funnel",
    "cohort_retention_summary",
    "cohort_retention_curve",
    "agg_category_funnel",
    "agg_brand_revenue",
    "daily_event_counts",
    "fact_events",
    "dim_date",
    "dim_user",
    "dim_category",
    "dim_product",
    "dim_session",
)


class BuildChecks:
    """Quality checks counted on the passes that a stored build makes anyway (``build_model(..., checks=...)``).

    Rows are counted where they are written, so a repeated task does not count twice.
    """

    # The key columns whose NULLs are counted.
    KEYS = ("user_id", "event_ts", "event_type", "product_id", "category_id")

    def __init__(self) -> None:
        self.raw, self.events, self.sessions, self.categories = (Observation() for _ in range(4))
        self.session_rows: DataFrame | None = None

    def on_raw(self, raw: DataFrame) -> DataFrame:
        return raw.observe(self.raw, F.count(F.lit(1)).alias("raw_rows"))

    def on_events(self, events: DataFrame) -> DataFrame:
        nulls = [F.count_if(F.col(key).isNull()).alias(f"null_{key}") for key in self.KEYS]
        return events.observe(self.events, F.count(F.lit(1)).alias("fact_rows"), *nulls)

    def on_sessions(self, sessions: DataFrame) -> DataFrame:
        return sessions.observe(self.sessions, F.count(F.lit(1)).alias("sessions_dim"))

    def on_categories(self, categories: DataFrame) -> DataFrame:
        sums = [F.sum(name).alias(name) for name in ("revenue_dedup", "revenue_gross")]
        return categories.observe(self.categories, *sums)

    def tables(self) -> dict[str, DataFrame]:
        """qa_null_keys, qa_row_integrity and qa_revenue of the build, without a scan of events.

        ``sessions_distinct_raw`` is counted over the stored session rows: sessions that have a clean event.
        """
        spark = self.session_rows.sparkSession

        def one_row(**values: int) -> DataFrame:
            return spark.range(1).select(*[F.lit(value).cast("bigint").alias(name) for name, value in values.items()])

        events = dict(self.events.get)
        rows = one_row(raw_rows=self.raw.get["raw_rows"], fact_rows=events.pop("fact_rows"), sessions_dim=self.sessions.get["sessions_dim"])
        distinct = self.session_rows.select("session_id").distinct().agg(F.count(F.lit(1))).scalar()
        sums = [F.lit(value).cast("double").alias(name) for name, value in self.categories.get.items()]
        return {
            "qa_null_keys": one_row(**events),
            "qa_row_integrity": rows.withColumn("sessions_distinct_raw", distinct),
            "qa_revenue": quality.qa_revenue(spark.range(1).select(*sums)),
        }


def build_model(
    raw: DataFrame,
    work_dir: str | None = None,
    max_day: int = 30,
    brand_limit: int | None = None,
    checks: BuildChecks | None = None,
) -> dict[str, DataFrame]:
    """All model tables by name, from cleaned raw events.

    The retention curve ends at day offset ``max_day``; ``brand_limit`` keeps only so many brands, by default all.

    Events are read seven times: for daily counts, users, categories, products, session rows, purchases and brands; dates,
    sessions and category measures derive from tables already built. With ``work_dir`` every table is written there and read back before others
    use it, a few at a time where none needs the other. Each is then computed once, lost executors cost no more than their tasks, and later
    joins know the real table sizes; use it for real volumes.
    Without it the tables stay lazy. ``checks`` watches the passes of a stored build.
    """
    if checks and not work_dir:
        raise ValueError("checks watch a stored build: give work_dir")
    watched = checks.on_raw(raw) if checks else raw

    def keep(**tables: DataFrame) -> dict[str, DataFrame]:
        return store_all(tables, work_dir) if work_dir else tables

    cleaned = events_clean(watched)
    events = keep(events_clean=checks.on_events(cleaned) if checks else cleaned)["events_clean"]
    fact = star.fact_events(events)
    rows = funnel.session_funnel(fact, with_category=True)
    model = keep(
        session_rows=checks.on_sessions(rows) if checks else rows,
        dim_product=star.dim_product(events),
        dim_user=star.dim_user(events),
        dim_category=star.dim_category(events),
        fct_user_daily_purchases=cohorts.user_daily_purchases(fact),
        agg_brand_revenue=drivers.brand_revenue(fact, brand_limit),
        daily_event_counts=trends.daily_event_counts(fact),
    )
    with_category = model.pop("session_rows")
    categories = drivers.category_funnel_of_sessions(with_category)
    if checks:
        checks.session_rows = with_category
        categories = checks.on_categories(categories)
    purchases = model["fct_user_daily_purchases"]
    model |= keep(
        agg_category_funnel=categories,
        fct_cohort_activity=cohorts.cohort_activity(purchases),
        dim_user_purchase_cohort=cohorts.user_purchase_cohort(purchases),
        dim_date=star.dim_date(model["daily_event_counts"]),
    )
    activity = model["fct_cohort_activity"]
    model |= keep(
        cohort_retention_summary=cohorts.cohort_retention_summary(activity),
        cohort_retention_curve=cohorts.cohort_retention_curve(activity, max_day),
    )
    sessions = with_category.drop(*funnel.CATEGORY_COLUMNS)
    return model | {"fact_events": fact, "fct_session_funnel": sessions, "dim_session": star.dim_session_of_rows(sessions)}


def export_model(model: Mapping[str, DataFrame], directory: str) -> None:
    """Write the dashboard tables of a built model."""
    export_parquet({name: model[name] for name in EXPORTED}, directory)
