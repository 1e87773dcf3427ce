"""Executive KPIs and the data profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import FUNNEL_STEPS, is_paid, is_step, ratio
from tidemark.functions.quantiles import exact_quantiles, quantile_sketches, quantiles_of_sketches

# The published price percentiles.
PRICE_POINTS = {"p50_price": 0.5, "p90_price": 0.9, "p99_price": 0.99}


def _with_rates(totals: DataFrame, *by: str) -> DataFrame:
    """Totals of sessions, users, purchases and revenue, with the rates between them."""
    return totals.select(
        *by,
        "sessions",
        "users",
        "purchases",
        "revenue",
        ratio("purchase_sessions", "sessions").alias("session_to_purchase"),
        ratio("cart_sessions", "view_sessions").alias("add_to_cart_rate"),
        ratio("purchase_sessions", "cart_sessions").alias("cart_to_purchase"),
        ratio("revenue", "purchases").alias("aov"),
        ratio("revenue", "users").alias("arpu"),
    )


def executive_kpis(fact: DataFrame, *by: str) -> DataFrame:
    """Sessions, users, purchases, revenue and the rates between them, in one row, or one for each group of the columns ``by``.

    Events are scanned once and reduced to (session, user) rows. Each such row then goes into two groups, its session and
    its user, so that both are counted as rows of one grouping and no distinct aggregate runs over events.
    """
    visits = fact.groupBy(*by, "session_id", "user_id").agg(
        *[F.max(is_step(step).cast("int")).alias(f"has_{step}") for step in FUNNEL_STEPS],
        F.count_if(is_step("purchase")).alias("purchases"),
        F.sum(F.when(is_paid(), F.col("price"))).alias("revenue"),
    )
    keys = F.array(
        F.struct(F.lit(True).alias("of_session"), F.col("session_id").alias("session"), F.lit(None).cast("bigint").alias("user")),
        F.struct(F.lit(False).alias("of_session"), F.lit(None).cast("string").alias("session"), F.col("user_id").cast("bigint").alias("user")),
    )
    groups = (
        visits.withColumn("key", F.explode(keys))
        .groupBy(*by, "key.of_session", "key.session", "key.user")
        .agg(
            *[F.max(f"has_{step}").alias(f"has_{step}") for step in FUNNEL_STEPS],
            F.sum("purchases").alias("purchases"),
            F.sum("revenue").alias("revenue"),
        )
    )
    of_session = F.col("of_session")
    real = of_session & F.col("session").isNotNull()
    totals = groups.groupBy(*by).agg(
        F.count_if(real).alias("sessions"),
        F.count_if(~of_session & F.col("user").isNotNull()).alias("users"),
        *[F.count_if(real & (F.col(f"has_{step}") == 1)).alias(f"{step}_sessions") for step in FUNNEL_STEPS],
        F.coalesce(F.sum(F.when(of_session, F.col("purchases"))), F.lit(0)).alias("purchases"),
        F.sum(F.when(of_session, F.col("revenue"))).alias("revenue"),
    )
    return _with_rates(totals, *by)


# --- KPIs under any slice, from a rollup per day ------------------------------------------------------------------

#: Who is counted once however often they come: users, sessions, and the sessions with each step.
_KINDS = ("users", "sessions", *(f"{step}_sessions" for step in FUNNEL_STEPS))


def _counted(kind: str, session: Column, user: Column) -> Column:
    """What the kind counts of an event; NULL where the event does not take part."""
    if kind == "users":
        return user
    return session if kind == "sessions" else F.when(is_step(kind.removesuffix("_sessions")), session)


def _sums() -> list[Column]:
    return [F.count_if(is_step("purchase")).alias("purchases"), F.sum(F.when(is_paid(), F.col("price"))).alias("revenue")]


def kpi_sketches(fact: DataFrame, *dims: str, lg_k: int = 14) -> DataFrame:
    """Per day and ``dims``: purchases, revenue, and a HyperLogLog sketch of users and of each kind of sessions.

    One scan and one shuffle of sketches. Rows of any days and values can be united later (``kpis_of_sketches``); the standard error of a
    count is 1.04 / sqrt(2^lg_k).
    """
    session, user = F.col("session_id"), F.col("user_id").cast("bigint")
    sketches = [F.hll_sketch_agg(_counted(kind, session, user), lg_k).alias(kind) for kind in _KINDS]
    return fact.groupBy(F.to_date("event_ts").alias("event_date"), *dims).agg(*_sums(), *sketches)


def kpis_of_sketches(rollup: DataFrame, *by: str) -> DataFrame:
    """The executive KPIs per group of the rollup's columns ``by``; counts of users and sessions are estimates."""
    united = rollup.groupBy(*by).agg(
        F.sum("purchases").alias("purchases"),
        F.sum("revenue").alias("revenue"),
        *[F.hll_sketch_estimate(F.hll_union_agg(kind)).alias(kind) for kind in _KINDS],
    )
    return _with_rates(united, *by)


def session_numbers(fact: DataFrame) -> DataFrame:
    """session_id and a whole number for each session. Numbers follow the sessions' starts, so that those of a day lie close
    together. They differ from run to run: store the result before using it twice."""
    starts = fact.where(F.col("session_id").isNotNull()).groupBy("session_id").agg(F.min("event_ts").alias("start"))
    placed = starts.repartitionByRange("start", "session_id").sortWithinPartitions("start", "session_id")
    return placed.select("session_id", F.monotonically_increasing_id().alias("session_number"))


def kpi_bitmaps(fact: DataFrame, numbers: DataFrame, *dims: str) -> DataFrame:
    """The same rollup with exact members: per day and ``dims`` rows of sums, and rows of bitmaps of users and sessions.

    ``numbers`` has a whole number for each session (``session_numbers``, stored); users are whole numbers already. A row's ``kind`` says
    what it has; a bitmap covers 32,768 numbers.
    """
    day = F.to_date("event_ts").alias("event_date")
    sums = fact.groupBy(day, *dims).agg(*_sums()).withColumn("kind", F.lit("sums"))
    numbered = fact.join(numbers, "session_id", "left")
    session, user = F.col("session_number"), F.col("user_id").cast("bigint")
    members = F.array(*[F.struct(F.lit(kind).alias("kind"), _counted(kind, session, user).alias("number")) for kind in _KINDS])
    rows = numbered.select(day, *dims, F.inline(members)).where("number is not null")
    bitmap = F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bitmap")
    bitmaps = rows.groupBy("event_date", *dims, "kind", F.bitmap_bucket_number("number").alias("bucket")).agg(bitmap)
    return sums.unionByName(bitmaps, allowMissingColumns=True)


def kpis_of_bitmaps(rollup: DataFrame, *by: str) -> DataFrame:
    """The executive KPIs per group of the rollup's columns ``by``, exactly."""
    united = rollup.groupBy(*by, "kind", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("members"),
        F.sum("purchases").alias("purchases"),
        F.sum("revenue").alias("revenue"),
    )
    counts = [F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("members"))), F.lit(0)).cast("bigint").alias(kind) for kind in _KINDS]
    totals = united.groupBy(*by).agg(*counts, F.coalesce(F.sum("purchases"), F.lit(0)).alias("purchases"), F.sum("revenue").alias("revenue"))
    return _with_rates(totals, *by)


def data_profile(raw: DataFrame) -> DataFrame:
    """Row count, time span, step counts, missing keys and non-positive prices of the raw events."""
    return raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("event_ts").alias("min_event_ts"),
        F.max("event_ts").alias("max_event_ts"),
        *[F.count_if(is_step(step)).alias(f"{step}_events") for step in FUNNEL_STEPS],
        F.count_if(F.col("user_id").isNull()).alias("null_user_id_rows"),
        F.count_if(F.col("user_session").isNull()).alias("null_user_session_rows"),
        F.count_if(F.col("price") <= 0).alias("nonpositive_price_rows"),
    )


def price_percentiles(raw: DataFrame, approx: bool = False) -> DataFrame:
    """Median, 90th and 99th percentile of price; ``approx=True`` reads them from a sketch."""
    if approx:
        return quantiles_of_sketches(quantile_sketches(raw, [], "price"), [], PRICE_POINTS).select(*PRICE_POINTS)
    return exact_quantiles(raw, [], "price", PRICE_POINTS)
