"""Purchase cohorts, retention tables and curves.

Purchases are reduced to one row per user and day right after the filter. From there on a user has one row per day, so
counting distinct users of a (cohort, day offset) is counting rows, and a per-user window holds at most one
row per calendar day.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import is_paid, ratio


def user_daily_purchases(fact: DataFrame) -> DataFrame:
    """Revenue purchases and their sum per user and day."""
    return (
        fact.where(is_paid())
        .groupBy("user_id", F.to_date("event_ts").alias("purchase_date"))
        .agg(F.count(F.lit(1)).alias("purchase_events"), F.sum("price").alias("revenue_gross"))
    )


def user_purchase_cohort(udp: DataFrame) -> DataFrame:
    """First purchase day per user."""
    return udp.groupBy("user_id").agg(F.min("purchase_date").alias("cohort_date"))


def cohort_activity(udp: DataFrame) -> DataFrame:
    """Purchase days with the user's cohort and the days since then."""
    cohort = F.min("purchase_date").over(Window.partitionBy("user_id"))
    return udp.select(
        "user_id",
        cohort.alias("cohort_date"),
        "purchase_date",
        F.date_diff("purchase_date", cohort).alias("days_since"),
        "purchase_events",
        "revenue_gross",
    )


def _with_observed_rates(cohorts: DataFrame, days: Iterable[int]) -> DataFrame:
    """Retention per day offset, NULL where the day lies past the last day of the data (``last_day``)."""
    data_end = cohorts.agg(F.max("last_day")).scalar()
    return cohorts.withColumns(
        {
            f"retention_d{n}": F.when(
                F.date_add("cohort_date", n) <= data_end, ratio(f"retained_d{n}_users", "cohort_size")
            )
            for n in days
        }
    ).drop("last_day")


def _users_where(condition: Column, users: str | None) -> Column:
    """Aggregate: users of the rows that meet the condition; ``users`` names a column with a row's users, else each row is one."""
    return F.count_if(condition) if users is None else F.coalesce(F.sum(F.when(condition, F.col(users))), F.lit(0)).cast("bigint")


def cohort_retention_summary(activity: DataFrame, days: Iterable[int] = (1, 7, 30), users: str | None = None) -> DataFrame:
    """Cohort size, users back on day N and their share; the share is NULL for days past the data.

    ``activity`` has a row per user and purchase day, or, with ``users``, rows that stand for as many users as that column says.
    """
    days = tuple(days)
    cohorts = activity.groupBy("cohort_date").agg(
        _users_where(F.col("days_since") == 0, users).alias("cohort_size"),
        *[_users_where(F.col("days_since") == n, users).alias(f"retained_d{n}_users") for n in days],
        F.max("purchase_date").alias("last_day"),
    )
    return _with_observed_rates(cohorts, days).orderBy("cohort_date")


def cohort_retention_curve(activity: DataFrame, max_day: int = 30, users: str | None = None) -> DataFrame:
    """Active users and their share of the cohort for day offsets 0..max_day; ``users`` as in the summary."""
    per_day = (
        activity.where(F.col("days_since").between(0, max_day))
        .groupBy("cohort_date", "days_since")
        .agg(_users_where(F.lit(True), users).alias("active_users"))
    )
    size = F.max("active_users").over(Window.partitionBy("cohort_date"))
    return per_day.withColumn("retention_rate", ratio(F.col("active_users"), size)).orderBy(
        "cohort_date", "days_since"
    )


def weighted_retention_cards(summary: DataFrame, *by: str | Column) -> DataFrame:
    """All purchasers, and day-1 / day-7 retention weighted by cohort size, over all cohorts or per group of them."""
    return summary.groupBy(*by).agg(
        F.sum("cohort_size").alias("total_purchasers"),
        F.sum("retained_d1_users").alias("d1_retained_users"),
        F.sum("retained_d7_users").alias("d7_retained_users"),
    ).withColumns(
        {
            "d1_retention_weighted": ratio("d1_retained_users", "total_purchasers"),
            "d7_retention_weighted": ratio("d7_retained_users", "total_purchasers"),
        }
    )


def weighted_retention_curve(
    curve: DataFrame, summary: DataFrame, denominator: str = "present", drop_day0: bool = False
) -> DataFrame:
    """Retention per day offset over all cohorts, weighted by cohort size.

    ``denominator="present"`` divides by the cohorts that have users on that day, ``"all"`` by every cohort.
    """
    if denominator not in ("present", "all"):
        raise ValueError("denominator must be 'present' or 'all'")
    sizes = summary.select("cohort_date", "cohort_size")
    rows = curve.where(F.col("days_since") != 0) if drop_day0 else curve
    if denominator == "all":
        per_day = rows.groupBy("days_since").agg(F.sum("active_users").alias("active_users"))
        per_day = per_day.withColumn("cohort_users", sizes.agg(F.sum("cohort_size")).scalar())
    else:
        per_day = (
            rows.join(sizes, "cohort_date")
            .groupBy("days_since")
            .agg(F.sum("active_users").alias("active_users"), F.sum("cohort_size").alias("cohort_users"))
        )
    return per_day.withColumn("retention_weighted", ratio("active_users", "cohort_users")).orderBy("days_since")


def selected_retention_curve(curve: DataFrame, summary: DataFrame, chosen: DataFrame, denominator: str = "present") -> DataFrame:
    """The weighted curve of the cohorts in ``chosen`` (column cohort_date) beside that of all cohorts, per day offset.

    The choice restricts both the active users and the cohorts they are divided by. Offsets that no chosen cohort has are NULL on
    the chosen side. Repeated or unknown dates in ``chosen`` change nothing.
    """
    dates = chosen.select("cohort_date").distinct()
    own = weighted_retention_curve(curve.join(dates, "cohort_date", "left_semi"), summary.join(dates, "cohort_date", "left_semi"), denominator)
    every = weighted_retention_curve(curve, summary, denominator)
    names = ("active_users", "cohort_users", "retention_weighted")
    every = every.withColumnsRenamed({name: f"all_{name}" for name in names})
    return every.join(own.withColumnsRenamed({name: f"chosen_{name}" for name in names}), "days_since", "left").orderBy("days_since")


def activity_retention(
    fact: DataFrame, cohort: str = "purchase", days: Iterable[int] = (1, 7, 30)
) -> DataFrame:
    """Day-N retention that counts any event; cohort day by first purchase or by first activity."""
    if cohort not in ("purchase", "activity"):
        raise ValueError("cohort must be 'purchase' or 'activity'")
    days = tuple(days)
    starts = is_paid() if cohort == "purchase" else F.lit(True)
    user_days = fact.groupBy("user_id", F.to_date("event_ts").alias("day")).agg(
        F.max(starts).alias("starts_cohort")
    )
    first = F.min(F.when(F.col("starts_cohort"), F.col("day"))).over(Window.partitionBy("user_id"))
    placed = (
        user_days.withColumn("cohort_date", first)
        .where(F.col("cohort_date").isNotNull())
        .withColumn("days_since", F.date_diff("day", "cohort_date"))
    )
    cohorts = placed.groupBy("cohort_date").agg(
        F.count_if(F.col("days_since") == 0).alias("cohort_size"),
        *[F.count_if(F.col("days_since") == n).alias(f"retained_d{n}_users") for n in days],
        F.max("day").alias("last_day"),
    )
    return _with_observed_rates(cohorts, days).orderBy("cohort_date")


def repurchase_within(activity: DataFrame, days: Iterable[int] = (7, 30)) -> DataFrame:
    """Users of a cohort with a later purchase within N days, and their share."""
    days = tuple(days)
    first_return = F.min(F.when(F.col("days_since") > 0, F.col("days_since")))
    users = activity.groupBy("user_id", "cohort_date").agg(first_return.alias("first_return"))
    return (
        users.groupBy("cohort_date")
        .agg(
            F.count(F.lit(1)).alias("cohort_size"),
            *[F.count_if(F.col("first_return") <= n).alias(f"repurchased_{n}d_users") for n in days],
        )
        .withColumns({f"repurchase_{n}d": ratio(f"repurchased_{n}d_users", "cohort_size") for n in days})
        .orderBy("cohort_date")
    )


def cohort_bitmaps(activity: DataFrame) -> DataFrame:
    """Who of a cohort bought on which day, as bitmaps: per cohort, day and range of 32,768 user ids, with the number of users.

    User ids are whole numbers. Such rows are small, and sets of users are united bit by bit instead of joined: any period of return is
    a union of days.
    """
    bitmap = F.bitmap_construct_agg(F.bitmap_bit_position("user_id")).alias("bitmap")
    rows = activity.groupBy("cohort_date", "days_since", "purchase_date", F.bitmap_bucket_number("user_id").alias("bucket")).agg(bitmap)
    return rows.withColumn("users", F.bitmap_count("bitmap"))


def repurchase_within_of_bitmaps(bitmaps: DataFrame, days: Iterable[int] = (7, 30)) -> DataFrame:
    """``repurchase_within`` from ``cohort_bitmaps``: users on any of the days 1..N are the union of those days' bitmaps."""
    days = tuple(days)
    periods = {"cohort_size": F.col("days_since") == 0} | {f"repurchased_{n}d_users": F.col("days_since").between(1, n) for n in days}
    tagged = F.array_compact(F.array(*[F.when(inside, F.lit(name)) for name, inside in periods.items()]))
    united = (
        bitmaps.withColumn("period", F.explode(tagged))
        .groupBy("cohort_date", "period", "bucket")
        .agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("users"))
    )
    return (
        united.groupBy("cohort_date")
        .agg(*[_users_where(F.col("period") == name, "users").alias(name) for name in periods])
        .withColumns({f"repurchase_{n}d": ratio(f"repurchased_{n}d_users", "cohort_size") for n in days})
        .orderBy("cohort_date")
    )


def cohort_heatmap(curve: DataFrame, max_day: int = 30) -> DataFrame:
    """Cohorts as rows, day offsets as columns ``day_0`` .. ``day_<max>``, retention rate as value."""
    offsets = list(range(max_day + 1))
    return (
        curve.groupBy("cohort_date")
        .pivot("days_since", offsets)
        .agg(F.max("retention_rate"))
        .withColumnsRenamed({str(n): f"day_{n}" for n in offsets})
        .orderBy("cohort_date")
    )
