"""Star schema over cleaned events: dimensions, fact table, and the star join."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import mode_by_weight, null_safe_join, seconds_between
from tidemark.functions.quantiles import exact_quantiles, quantile_sketches, quantiles_of_sketches
from tidemark.plans.storage import store


def dim_date(events: DataFrame) -> DataFrame:
    """One row per day that has events. Weekdays count from 0 = Sunday."""
    day_of_week = F.dayofweek("date_key") - 1
    return (
        events.select(F.col("event_date").alias("date_key"))
        .distinct()
        .select(
            "date_key",
            F.year("date_key").alias("year"),
            F.month("date_key").alias("month"),
            F.day("date_key").alias("day"),
            day_of_week.alias("day_of_week"),
            day_of_week.isin(0, 6).alias("is_weekend"),
            F.date_format("date_key", "MMMM").alias("month_name"),
            F.weekofyear("date_key").alias("week"),
            F.quarter("date_key").alias("quarter"),
        )
    )


def dim_user(events: DataFrame) -> DataFrame:
    """First and last event time per user."""
    return events.groupBy("user_id").agg(
        F.min("event_ts").alias("first_seen_ts"), F.max("event_ts").alias("last_seen_ts")
    )


def dim_category(events: DataFrame) -> DataFrame:
    """Most frequent category code per category; NULL if no event of it has a code."""
    return dim_category_of_counts(category_counts(events))


def category_counts(events: DataFrame, *by: str) -> DataFrame:
    """Events per category and code, and per further columns; such rows of several parts can be put together."""
    return events.groupBy(*by, "category_id", "category_code").agg(F.count(F.lit(1)).alias("n"))


def dim_category_of_counts(counts: DataFrame) -> DataFrame:
    codes = counts.groupBy("category_id", "category_code").agg(F.sum("n").alias("n"))
    return codes.groupBy("category_id").agg(mode_by_weight("category_code", "n").alias("category_code"))


def with_category_label(categories: DataFrame) -> DataFrame:
    """Add a readable label: the code, or ``cat_<id>`` where there is none."""
    fallback = F.concat(F.lit("cat_"), F.col("category_id").cast("string"))
    return categories.withColumn("category_label", F.coalesce("category_code", fallback))


def dim_product(events: DataFrame, approx: bool = False) -> DataFrame:
    """Most frequent category and brand, and median price, per product.

    Events are scanned and shuffled once, as counts of distinct attribute combinations; modes and median derive from
    those. ``approx=True`` takes the median from a quantile sketch instead (``price_sketches``).
    """
    if approx:
        medians = quantiles_of_sketches(price_sketches(events), ["product_id"], {"median_price": 0.5}).drop("n")
        return null_safe_join(_product_modes(product_counts(events)), medians, ["product_id"], "left")
    return dim_product_of_counts(product_counts(events))


def price_sketches(events: DataFrame) -> DataFrame:
    """A quantile sketch of prices per product and day: small rows to be stored by day and united for any days or products."""
    return quantile_sketches(events, ["event_date", "product_id"], "price")


def product_counts(events: DataFrame, *by: str) -> DataFrame:
    """Events per product, category, brand and price, and per further columns; such rows of several parts can be put together."""
    return events.groupBy(*by, "product_id", "category_id", "brand", "price").agg(F.count(F.lit(1)).alias("n"))


def _product_modes(combos: DataFrame) -> DataFrame:
    by_category = combos.groupBy("product_id", "category_id").agg(F.sum("n").alias("n"))
    by_brand = combos.groupBy("product_id", "brand").agg(F.sum("n").alias("n"))
    return (
        by_category.unionByName(by_brand, allowMissingColumns=True)
        .groupBy("product_id")
        .agg(
            mode_by_weight("category_id", "n").alias("category_id"),
            mode_by_weight("brand", "n").alias("brand"),
        )
    )


def dim_product_of_counts(combos: DataFrame) -> DataFrame:
    medians = exact_quantiles(combos, ["product_id"], "price", {"median_price": 0.5}, weight="n")
    return null_safe_join(_product_modes(combos), medians, ["product_id"], "left")


def dim_session(events: DataFrame) -> DataFrame:
    """Start, end and length per session and user; events without a session are left out."""
    return (
        events.where(F.col("session_id").isNotNull())
        .groupBy("session_id", "user_id")
        .agg(F.min("event_ts").alias("session_start_ts"), F.max("event_ts").alias("session_end_ts"))
        .withColumn("session_duration_seconds", seconds_between("session_start_ts", "session_end_ts"))
    )


def dim_session_of_rows(sessions: DataFrame) -> DataFrame:
    """The same from the session rows of the funnel, without another pass over events."""
    duration = F.col("session_duration_sec").alias("session_duration_seconds")
    return sessions.select("session_id", "user_id", "session_start_ts", "session_end_ts", duration)


def fact_events(events: DataFrame) -> DataFrame:
    """One row per event: keys and price. ``event_id`` stays as tie-break if there is one."""
    tie_break = ["event_id"] if "event_id" in events.columns else []
    return events.select(
        *tie_break,
        "event_ts",
        F.col("event_date").alias("date_key"),
        "user_id",
        "session_id",
        "event_type",
        "product_id",
        "category_id",
        "brand",
        "price",
    )


def star_join(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Fact rows with the attributes of whichever dimensions are given.

    ``dims`` may hold dim_date, dim_category, dim_product, dim_user and dim_session. All joins are many-to-one left
    joins, so no fact row is lost or doubled. Pass dimensions as read back from storage: then Spark knows their size and
    broadcasts the small ones, and it splits hot keys of the others at run time, which it cannot do where a join
    sits right on the aggregation that built the dimension. Users are attached to sessions first, so that the fact is shuffled once for both.
    """
    out = fact
    if "dim_date" in dims:
        out = out.join(dims["dim_date"], "date_key", "left")
    if "dim_category" in dims:
        categories = with_category_label(dims["dim_category"])
        out = out.join(categories, "category_id", "left")
    if "dim_product" in dims:
        products = dims["dim_product"].withColumnsRenamed(
            {"category_id": "product_category_id", "brand": "product_brand"}
        )
        out = out.join(products, "product_id", "left")
    if "dim_user" in dims and "dim_session" in dims:
        users = dims["dim_user"]
        sessions = dims["dim_session"].join(users, "user_id", "left")
        sessionless = users.withColumn("session_id", F.lit(None).cast("string"))
        who = sessions.unionByName(sessionless, allowMissingColumns=True)
        return null_safe_join(out, who, ["session_id", "user_id"], "left")
    if "dim_user" in dims:
        out = out.join(dims["dim_user"], "user_id", "left")
    if "dim_session" in dims:
        out = out.join(dims["dim_session"], ["session_id", "user_id"], "left")
    return out


def with_category_labels(table: DataFrame, categories: DataFrame) -> DataFrame:
    """Any table by category with the codes and labels of the category dimension."""
    return table.join(with_category_label(categories), "category_id", "left")


def on_calendar(daily: DataFrame, dates: DataFrame) -> DataFrame:
    """Any table by ``event_date`` with the attributes of the date dimension."""
    return daily.join(dates.withColumnRenamed("date_key", "event_date"), "event_date", "left")


def dim_days(spark: SparkSession, max_day: int = 30) -> DataFrame:
    """Axis of day offsets 0..max_day."""
    return spark.range(0, max_day + 1).select(F.col("id").cast("int").alias("day"))


def on_day_axis(curve: DataFrame, days: DataFrame) -> DataFrame:
    """A per-day curve on a gap-free axis; days the curve lacks have NULL values."""
    return days.join(curve.withColumnRenamed("days_since", "day"), "day", "left")


def _who_key(session: str = "session_id", user: str = "user_id") -> Column:
    """What fact rows and sessions are stored by; rows without a session are spread over their users."""
    key = F.concat(F.lit("session "), F.col(session))
    return F.coalesce(key, F.concat(F.lit("user "), F.col(user).cast("string")), F.lit("nobody"))


#: A session or a user without one, the part of a large session, and the user.
_STORED_BY = ["who", "part", "user_id"]


def _write_buckets(table: DataFrame, path: str, buckets: int) -> DataFrame:
    """The table written once in buckets by the keys that it is joined on, one file each, and sorted inside; the catalog keeps no entry."""
    keys, spark = _STORED_BY, table.sparkSession
    name = f"star_{uuid.uuid4().hex}"
    writer = table.repartition(buckets, *keys).write.option("path", path).bucketBy(buckets, *keys).sortBy(*keys)
    writer.saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name alone; the files stay
    return stored


def stored_star(fact: DataFrame, dims: Mapping[str, DataFrame], directory: str, buckets: int, most: int = 1_000_000) -> dict[str, DataFrame]:
    """The star written for repeated joins: ``fact`` with its products, and ``dim_who``, sessions with their users.

    Products are attached once, here, where adaptive execution splits hot ones; the fact is then stored in buckets by session, so a hot product is
    spread over all of them. ``dim_who`` lies in the same buckets, so joining it moves no row of the fact (``star_join_stored``). A
    session of more than ``most`` events is dealt to so many parts, and its row of ``dim_who`` is repeated for each. Pass stored dimensions.
    """
    products = dims["dim_product"].withColumnsRenamed({"category_id": "product_category_id", "brand": "product_brand"})
    rows = fact.withColumn("who", _who_key())
    large = rows.groupBy("who").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    large = store(large.select("who", F.ceil(F.col("n") / most).cast("int").alias("parts")), directory, "large_sessions")
    parts = F.coalesce(F.col("parts"), F.lit(1))
    dealt = F.pmod(F.xxhash64("event_ts", "product_id", "event_type", "price"), parts).cast("int")
    rows = rows.join(large, "who", "left").withColumn("part", dealt).drop("parts")
    rows = rows.join(products, "product_id", "left")
    sessions = dims["dim_session"].join(dims["dim_user"], "user_id", "left")
    sessionless = dims["dim_user"].withColumn("session_id", F.lit(None).cast("string"))
    who = sessions.unionByName(sessionless, allowMissingColumns=True).withColumn("who", _who_key())
    who = who.join(large, "who", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return {
        "fact": _write_buckets(rows, f"{directory}/fact", buckets),
        "dim_who": _write_buckets(who, f"{directory}/dim_who", buckets),
        "dim_date": dims["dim_date"],
        "dim_category": dims["dim_category"],
    }


def star_join_stored(star: Mapping[str, DataFrame]) -> DataFrame:
    """``star_join`` from the tables of ``stored_star``: the fact is read bucket by bucket and not shuffled."""
    who = star["dim_who"].drop("session_id")
    # A hash table of a bucket's sessions; the fact streams by and need not be sorted.
    out = star["fact"].join(who.hint("shuffle_hash"), _STORED_BY, "left")
    out = out.join(star["dim_date"], "date_key", "left")
    return out.join(with_category_label(star["dim_category"]), "category_id", "left").drop("who", "part")
