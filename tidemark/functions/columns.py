"""Column expressions shared by the clickstream operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FUNNEL_STEPS = ("view", "cart", "purchase")


def is_step(step: str) -> Column:
    return F.col("event_type") == step


def is_paid() -> Column:
    """A purchase that counts as revenue; zero and negative prices do not."""
    return is_step("purchase") & (F.col("price") > 0)


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as double, NULL when the denominator is 0 or NULL."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.try_divide(num.cast("double"), den.cast("double"))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole-second boundaries crossed from start to end (negative if end is earlier)."""
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def mode_by_weight(value: str, weight: str) -> Column:
    """Aggregate: the non-NULL value with the largest weight, ties to the largest value."""
    col = F.col(value)
    return F.max_by(col, F.when(col.isNotNull(), F.struct(F.col(weight), col)))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` in which NULL matches NULL; keeps the left key columns."""
    right = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    cond = F.lit(True)
    for key in keys:
        cond = cond & F.col(key).eqNullSafe(F.col(f"__{key}"))
    return left.join(right, cond, how).drop(*[f"__{k}" for k in keys])


def wall_micros(moment: str) -> Column:
    """Microseconds from 1970 to a zone-free time, the same in every session zone: days and time of day, never a local instant."""
    seconds = F.hour(moment) * 3600 + F.minute(moment) * 60
    exact = F.extract(F.lit("SECOND"), F.col(moment)) * 1_000_000
    return F.unix_date(F.to_date(moment)).cast("bigint") * 86_400_000_000 + seconds.cast("bigint") * 1_000_000 + exact.cast("bigint")


def time_key(fact: DataFrame, value: str) -> Column:
    """What orders events by time and among equal times by ``event_id``, or by the value where there is none.

    With ``event_id`` it is one number, which fits the fixed-width buffers of hash aggregation, so that no event has to be
    sorted; a struct does not. An event without an id comes after those of the same time that have one.
    """
    if "event_id" not in fact.columns:
        return F.struct("event_ts", value)
    wide = wall_micros("event_ts").cast("decimal(18,0)") * F.lit("10000000000000000000").cast("decimal(20,0)")
    number = F.coalesce(F.col("event_id").cast("decimal(19,0)"), F.lit("9999999999999999999").cast("decimal(19,0)"))
    return (wide + number).cast("decimal(38,0)")


def first_by_time(fact: DataFrame, value: str, where: Column) -> Column:
    """Aggregate: the value of the earliest event that meets the condition."""
    return F.min_by(F.when(where, F.col(value)), F.when(where, time_key(fact, value)))
