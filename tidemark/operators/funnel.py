"""Session funnel and the metrics read off it.

The session table is built by two group-bys in a row over one scan: first per (session, user, product), then per
(session, user). The product step turns distinct-product counts and purchase deduplication into plain sums, so there
is no distinct-aggregate expansion, no second scan and no join, and a session with very many events is spread over its
products before it meets in one group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import FUNNEL_STEPS, first_by_time, is_paid, is_step, ratio, seconds_between, time_key

SESSION = ["session_id", "user_id"]
#: What session rows have beside the session table's columns if they carry their category.
CATEGORY_COLUMNS = ("first_category_id", "first_category_key", "paid_items")
# How the distinct-product counters of the three steps are called.
_DISTINCT_NAMES = {
    "view": "distinct_products_viewed",
    "cart": "distinct_products_carted",
    "purchase": "distinct_products_purchased",
}


def _paid_key(fact: DataFrame) -> Column:
    return F.when(is_paid(), time_key(fact, "price"))


def product_steps(fact: DataFrame, with_category: bool = False) -> DataFrame:
    """Per (session, user, product): bounds, first times and counts of the steps, revenue, and the earliest revenue purchase.

    Such rows can be added up further (``merged_steps``): those of several days give those of all days.
    """
    steps = []
    if with_category:
        steps.append(F.count_if(is_paid()).alias("paid_items"))
        known = F.col("category_id").isNotNull()
        steps.append(first_by_time(fact, "category_id", known).alias("first_category_id"))
        steps.append(F.min(F.when(known, time_key(fact, "category_id"))).alias("first_category_key"))
    for step in FUNNEL_STEPS:
        steps.append(F.min(F.when(is_step(step), F.col("event_ts"))).alias(f"first_{step}_ts"))
        steps.append(F.count_if(is_step(step)).alias(f"{step}_events"))
    return (
        fact.where(F.col("session_id").isNotNull())
        .groupBy(*SESSION, "product_id")
        .agg(
            F.min("event_ts").alias("first_ts"),
            F.max("event_ts").alias("last_ts"),
            *steps,
            F.sum(F.when(is_paid(), F.col("price"))).alias("gross"),
            first_by_time(fact, "price", is_paid()).alias("first_paid_price"),
            F.min(_paid_key(fact)).alias("first_paid_key"),
        )
    )


def merged_steps(steps: DataFrame) -> DataFrame:
    """Rows of ``product_steps`` of several parts of the events (days, say) as those of all parts together."""
    firsts = [name for name in ("first_category", "first_paid") if f"{name}_key" in steps.columns]
    values = {"first_category": "first_category_id", "first_paid": "first_paid_price"}
    return steps.groupBy(*SESSION, "product_id").agg(
        F.min("first_ts").alias("first_ts"),
        F.max("last_ts").alias("last_ts"),
        *[F.min(f"first_{step}_ts").alias(f"first_{step}_ts") for step in FUNNEL_STEPS],
        *[F.sum(f"{step}_events").alias(f"{step}_events") for step in FUNNEL_STEPS],
        F.sum("gross").alias("gross"),
        *([F.sum("paid_items").alias("paid_items")] if "paid_items" in steps.columns else []),
        *[F.min_by(values[name], f"{name}_key").alias(values[name]) for name in firsts],
        *[F.min(f"{name}_key").alias(f"{name}_key") for name in firsts],
    )


def _per_session(steps: DataFrame) -> DataFrame:
    """Session rows with all step columns, plus ``dedup``: the sum of first paid prices, NULL if none."""
    with_category = "first_category_key" in steps.columns
    has_product = F.col("product_id").isNotNull()
    category = []
    if with_category:
        category.append(F.min_by("first_category_id", "first_category_key").alias("first_category_id"))
        category.append(F.min("first_category_key").alias("first_category_key"))
        category.append(F.sum("paid_items").alias("paid_items"))
    rolled = (
        steps.groupBy(*SESSION)
        .agg(
            F.min("first_ts").alias("session_start_ts"),
            F.max("last_ts").alias("session_end_ts"),
            *[F.min(f"first_{step}_ts").alias(f"first_{step}_ts") for step in FUNNEL_STEPS],
            *[F.sum(f"{step}_events").alias(f"{step}_events") for step in FUNNEL_STEPS],
            *[
                F.count_if(has_product & (F.col(f"{step}_events") > 0)).alias(_DISTINCT_NAMES[step])
                for step in FUNNEL_STEPS
            ],
            F.sum("gross").alias("session_revenue_gross"),
            F.sum("first_paid_price").alias("dedup"),
            *category,
        )
    )
    return rolled.select(
        *SESSION,
        "session_start_ts",
        "session_end_ts",
        seconds_between("session_start_ts", "session_end_ts").alias("session_duration_sec"),
        *[f"first_{step}_ts" for step in FUNNEL_STEPS],
        *[f"{step}_events" for step in FUNNEL_STEPS],
        *_DISTINCT_NAMES.values(),
        *[(F.col(f"{step}_events") > 0).cast("int").alias(f"has_{step}") for step in FUNNEL_STEPS],
        "session_revenue_gross",
        "dedup",
        *(CATEGORY_COLUMNS if with_category else []),
    )


def session_step_agg(fact: DataFrame) -> DataFrame:
    """Per (session, user): bounds, first time / count / distinct products per step, flags, gross revenue."""
    return _per_session(product_steps(fact)).drop("dedup")


def purchase_dedup(fact: DataFrame) -> DataFrame:
    """Per (session, user, product): the earliest revenue purchase and its price."""
    return (
        fact.where(F.col("session_id").isNotNull() & is_paid())
        .groupBy(*SESSION, "product_id")
        .agg(
            F.min("event_ts").alias("first_purchase_ts"),
            first_by_time(fact, "price", is_paid()).alias("first_purchase_price"),
        )
    )


def session_dedup_revenue(dedup: DataFrame) -> DataFrame:
    """Deduplicated revenue per (session, user)."""
    return dedup.groupBy(*SESSION).agg(F.sum("first_purchase_price").alias("session_revenue_dedup_product"))


def session_funnel(fact: DataFrame, ordered_only: bool = False, with_category: bool = False) -> DataFrame:
    """The session table with deduplicated revenue, order-value proxy and step-to-step times.

    ``ordered_only=True`` sets step times to NULL where the later step came first. ``with_category=True`` adds the
    category of the earliest event that has one, that event's order key, and the number of items that count as revenue.
    """
    return sessions_of_steps(product_steps(fact, with_category), ordered_only)


def sessions_of_steps(steps: DataFrame, ordered_only: bool = False) -> DataFrame:
    """The session table from the rows of ``product_steps``, with the first category if they have it."""

    def step_time(start: str, end: str) -> Column:
        delta = seconds_between(f"first_{start}_ts", f"first_{end}_ts")
        return F.when(delta >= 0, delta) if ordered_only else delta

    revenue = F.col("session_revenue_dedup_product")
    products = F.col("distinct_products_purchased")
    return (
        _per_session(steps)
        .withColumn("session_revenue_dedup_product", F.coalesce("dedup", F.lit(0.0)))
        .drop("dedup")
        .withColumns(
            {
                "aov_session_proxy": F.when(products > 0, revenue / products),
                "time_view_to_cart_sec": step_time("view", "cart"),
                "time_view_to_purchase_sec": step_time("view", "purchase"),
                "time_cart_to_purchase_sec": step_time("cart", "purchase"),
            }
        )
    )


def with_conversion_rates(counts: DataFrame) -> DataFrame:
    """Add the three step conversion rates to rows with view / cart / purchase session counts."""
    return counts.withColumns(
        {
            "view_to_cart_cvr": ratio("cart_sessions", "view_sessions"),
            "cart_to_purchase_cvr": ratio("purchase_sessions", "cart_sessions"),
            "view_to_purchase_cvr": ratio("purchase_sessions", "view_sessions"),
        }
    )


def funnel_summary(sessions: DataFrame, *by: Column | str) -> DataFrame:
    """Session counts per step and conversion rates, overall or per group."""
    return with_conversion_rates(
        sessions.groupBy(*by).agg(
            F.count(F.lit(1)).alias("sessions"),
            *[F.sum(f"has_{step}").alias(f"{step}_sessions") for step in FUNNEL_STEPS],
        )
    )


def daily_session_cvr(sessions: DataFrame) -> DataFrame:
    """The same per day on which sessions start: the session-based form of daily conversion."""
    return funnel_summary(sessions, F.to_date("session_start_ts").alias("event_date"))


def funnel_skip_steps(sessions: DataFrame) -> DataFrame:
    """Purchase sessions that skipped the view or the cart, with their share of purchase sessions."""
    bought = F.col("has_purchase") == 1
    return sessions.agg(
        F.count_if(bought).alias("purchase_sessions"),
        F.count_if(bought & (F.col("has_view") == 0)).alias("purchase_no_view"),
        F.count_if(bought & (F.col("has_cart") == 0)).alias("purchase_no_cart"),
    ).withColumns(
        {
            "purchase_no_view_share": ratio("purchase_no_view", "purchase_sessions"),
            "purchase_no_cart_share": ratio("purchase_no_cart", "purchase_sessions"),
        }
    )


def funnel_timing_anomalies(sessions: DataFrame) -> DataFrame:
    """How many sessions have a later step before an earlier one."""
    pairs = ("view_to_cart", "cart_to_purchase", "view_to_purchase")
    return sessions.agg(*[F.count_if(F.col(f"time_{pair}_sec") < 0).alias(f"neg_{pair}") for pair in pairs])


def session_event_density(fact: DataFrame) -> DataFrame:
    """Mean and percentiles of events per session, taken over the histogram of session sizes."""
    histogram = (
        fact.where(F.col("session_id").isNotNull())
        .groupBy(*SESSION)
        .agg(F.count(F.lit(1)).alias("events"))
        .groupBy("events")
        .agg(F.count(F.lit(1)).alias("sessions"))
    )
    points = F.percentile("events", F.array(F.lit(0.5), F.lit(0.9), F.lit(0.99)), F.col("sessions"))
    return histogram.agg(
        ratio(F.sum(F.col("events") * F.col("sessions")), F.sum("sessions")).alias("avg_events_per_session"),
        points.alias("points"),
    ).select(
        "avg_events_per_session",
        F.col("points")[0].alias("p50"),
        F.col("points")[1].alias("p90"),
        F.col("points")[2].alias("p99"),
    )


def funnel_revenue_totals(sessions: DataFrame, *by: Column | str) -> DataFrame:
    """Gross and deduplicated revenue, and by how much duplicates inflate the former (percent), overall or per group."""
    return sessions.groupBy(*by).agg(
        F.sum("session_revenue_gross").alias("gross_total"),
        F.sum("session_revenue_dedup_product").alias("dedup_total"),
    ).withColumn("inflation_pct", (ratio("gross_total", "dedup_total") - 1) * 100)
