"""Column expressions shared by the support-ticket KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ticket states counted as open and as closed.
OPEN_STATES = ("Open", "Pending", "In Progress", "Reopened")
CLOSED_STATES = ("Resolved", "Closed")

# Age buckets of open tickets, as (upper bound in days, label); the last one has no bound.
AGE_BUCKETS = ((1, "0-1 days"), (3, "2-3 days"), (7, "4-7 days"), (14, "8-14 days"), (30, "15-30 days"))
OLDEST_BUCKET = "30+ days"


def is_open() -> Column:
    return F.coalesce(F.col("issue_status").isin(*OPEN_STATES), F.lit(False))


def is_closed() -> Column:
    return F.coalesce(F.col("issue_status").isin(*CLOSED_STATES), F.lit(False))


def flag(name: str) -> Column:
    """1 where the boolean column is true, 0 where it is false or NULL."""
    return F.when(F.col(name), 1).otherwise(0)


def safe_first_response_breach() -> Column:
    return flag("first_response_breached")


def safe_resolution_breach() -> Column:
    return flag("resolution_sla_breached")


def safe_escalated() -> Column:
    return flag("escalated_flag")


def safe_reopens() -> Column:
    return F.coalesce(F.col("reopen_count"), F.lit(0))


def safe_csat() -> Column:
    """The score when it lies in 1..5, else NULL."""
    return F.when(F.col("csat_score").between(1, 5), F.col("csat_score"))


def rate_pct(num: str, den: str) -> Column:
    """Percentage with two decimals, halves rounded to even; 0 when there is nothing to divide by."""
    share = F.when(F.col(den) > 0, F.col(num).cast("double") / F.col(den)).otherwise(F.lit(0.0))
    return F.bround(share * 100, 2)


def total(value: Column | str) -> Column:
    """Aggregate: sum that is 0, not NULL, when there is nothing to add."""
    return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")


def age_bucket_order(age: Column) -> Column:
    """Position 1..6 of the age bucket; tickets without an age sort into the youngest bucket."""
    first, *rest = AGE_BUCKETS
    order = F.when(age.isNull() | (age <= first[0]), 1)
    for pos, (bound, _) in enumerate(rest, start=2):
        order = order.when(age <= bound, pos)
    return order.otherwise(len(AGE_BUCKETS) + 1)


def age_bucket_label(order: Column) -> Column:
    labels = [label for _, label in AGE_BUCKETS] + [OLDEST_BUCKET]
    return F.element_at(F.array(*[F.lit(label) for label in labels]), order)


def with_ticket_dates(tickets: DataFrame) -> DataFrame:
    """Add created_day, created_month and resolved_day as text; NULL where the time is NULL."""
    return tickets.withColumns(
        {
            "created_day": F.date_format("issue_created", "yyyy-MM-dd"),
            "created_month": F.date_format("issue_created", "yyyy-MM"),
            "resolved_day": F.date_format("issue_resolution_date", "yyyy-MM-dd"),
        }
    )
