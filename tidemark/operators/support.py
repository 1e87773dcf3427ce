"""Support-ticket KPIs.

All of them derive from the same sums and counts per group (``sums``), so a task ships one small row per group and a hot queue
or agent costs no more than any other. Each table can be had by itself; ``kpi_rollup`` has the groups of all tables from
one scan and one shuffle, and ``tables_of_rollup`` reads the tables off it.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import UTC, date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import ratio
from tidemark.functions.support import (
    age_bucket_label,
    age_bucket_order,
    is_closed,
    is_open,
    rate_pct,
    safe_csat,
    safe_escalated,
    safe_first_response_breach,
    safe_reopens,
    safe_resolution_breach,
    total,
    with_ticket_dates,
)

Moment = str | date | datetime


def utc_moment(moment: Moment) -> Column:
    """A bound as UTC wall-clock time: text and datetimes with an offset are converted, others are taken as UTC."""
    value = datetime.fromisoformat(moment) if isinstance(moment, str) else moment
    if isinstance(value, datetime) and value.tzinfo is not None:
        value = value.astimezone(UTC).replace(tzinfo=None)
    return F.lit(value.isoformat()).cast("timestamp_ntz")


def ticket_base(tickets: DataFrame, start: Moment | None = None, end: Moment | None = None) -> DataFrame:
    """Tickets that are not deleted, created from ``start`` (inclusive) to ``end`` (exclusive) where given."""
    base = tickets.where(~F.coalesce(F.col("deleted_flag"), F.lit(False)))
    if start is not None:
        base = base.where(F.col("issue_created") >= utc_moment(start))
    if end is not None:
        base = base.where(F.col("issue_created") < utc_moment(end))
    return base


def ticket_is_live() -> Column:
    return ~F.coalesce(F.col("deleted_flag"), F.lit(False))


def sums(among: Column | None = None) -> list[Column]:
    """Aggregates: the sums and counts that all per-group tables are made of, over the rows that meet ``among``."""

    def of(value: Column) -> Column:
        return value if among is None else F.when(among, value)

    first, resolution, csat = F.col("first_response_time_minutes"), F.col("resolution_time_minutes"), F.col("csat_score")
    return [
        F.count(of(F.lit(1))).alias("tickets"),
        total(of(is_open().cast("int"))).alias("open"),
        total(of(is_closed().cast("int"))).alias("closed"),
        F.sum(of(first)).alias("first_response_minutes"),
        F.count(of(first)).alias("first_responses"),
        F.sum(of(resolution)).alias("resolution_minutes"),
        F.count(of(resolution)).alias("resolutions"),
        total(of(safe_first_response_breach())).alias("first_response_breaches"),
        total(of(safe_resolution_breach())).alias("resolution_breaches"),
        total(of(safe_escalated())).alias("escalations"),
        total(of(safe_reopens())).alias("reopens"),
        F.sum(of(csat)).alias("csat"),
        F.count(of(csat)).alias("csats"),
        F.sum(of(safe_csat())).alias("valid_csat"),
        F.count(of(safe_csat())).alias("valid_csats"),
    ]


def _grouped(base: DataFrame, *by: str) -> DataFrame:
    """The sums per group; those a table does not use are pruned."""
    return base.groupBy(*by).agg(*sums())


#: Means as quotients of sums.
_MEANS = {
    "avg_first_response_minutes": ("first_response_minutes", "first_responses"),
    "avg_resolution_minutes": ("resolution_minutes", "resolutions"),
    "avg_csat": ("csat", "csats"),
    "avg_reopens": ("reopens", "tickets"),
}


def _mean(name: str) -> Column:
    return ratio(*_MEANS[name]).alias(name)


def _named(**names: str) -> list[Column]:
    return [F.col(old).alias(new) for new, old in names.items()]


def _quality_of_created() -> list[Column]:
    return [
        _mean("avg_first_response_minutes"),
        ratio("resolution_minutes", "resolutions").alias("avg_resolution_minutes_for_created_tickets"),
        *_named(
            first_response_sla_breaches="first_response_breaches",
            resolution_sla_breaches_on_created_tickets="resolution_breaches",
            total_reopens="reopens",
        ),
        ratio("valid_csat", "valid_csats").alias("avg_csat"),
    ]


def _created_table(groups: DataFrame) -> DataFrame:
    return groups.select("created_day", *_named(tickets_created="tickets"), *_quality_of_created()).orderBy("created_day")


def daily_created(base: DataFrame) -> DataFrame:
    """Per created day: tickets, mean times, breaches, reopens and mean valid CSAT."""
    return _created_table(_grouped(with_ticket_dates(base), "created_day"))


def _resolved_table(groups: DataFrame) -> DataFrame:
    return groups.where("resolved_day is not null").select("resolved_day", *_named(tickets_resolved="tickets")).orderBy("resolved_day")


def daily_resolved(base: DataFrame) -> DataFrame:
    """Tickets resolved per day."""
    return _resolved_table(_grouped(with_ticket_dates(base).where(F.col("resolved_day").isNotNull()), "resolved_day"))


def _backlog_table(groups: DataFrame) -> DataFrame:
    return groups.agg(total(F.col("open")).alias("current_open_backlog"))


def backlog_snapshot(base: DataFrame) -> DataFrame:
    """Tickets still open in the filtered set."""
    return _backlog_table(_grouped(base))


def _flow_table(days: DataFrame) -> DataFrame:
    """Sums per created day and counts per resolved day, one below the other, as one row per day."""
    added = [F.sum(name).alias(name) for name in ("first_response_minutes", "resolution_minutes", "valid_csat")]
    counts = "tickets resolved first_responses resolutions first_response_breaches resolution_breaches reopens valid_csats".split()
    whole = days.groupBy("day").agg(*added, *[total(F.col(name)).alias(name) for name in counts])
    net = (F.col("tickets") - F.col("resolved")).alias("net_flow")
    names = _named(tickets_created="tickets", tickets_resolved="resolved")
    return whole.select("day", *names, *_quality_of_created(), net).orderBy("day")


def daily_kpis(base: DataFrame) -> DataFrame:
    """Inflow, outflow, net flow and quality per day, from one scan and one shuffle.

    Every ticket counts once on its created day and once on its resolved day. Quality columns describe the tickets
    created on the day.
    """
    came = F.col("role") == "created"
    both = (
        with_ticket_dates(base)
        .withColumn("role", F.explode(F.array(F.lit("created"), F.lit("resolved"))))
        .withColumn("day", F.when(came, F.col("created_day")).otherwise(F.col("resolved_day")))
        .where(came | F.col("day").isNotNull())
    )
    return _flow_table(both.groupBy("day").agg(*sums(came), F.count_if(~came).alias("resolved")))


def _queue_table(groups: DataFrame) -> DataFrame:
    return (
        groups.select(
            "queue_name",
            *_named(
                tickets_total="tickets",
                tickets_open="open",
                tickets_closed="closed",
                first_response_sla_breaches="first_response_breaches",
                resolution_sla_breaches="resolution_breaches",
            ),
            _mean("avg_first_response_minutes"),
            _mean("avg_resolution_minutes"),
            _mean("avg_reopens"),
            _mean("avg_csat"),
        )
        .withColumns(
            {
                "first_response_breach_rate_pct": rate_pct("first_response_sla_breaches", "tickets_total"),
                "resolution_breach_rate_pct": rate_pct("resolution_sla_breaches", "tickets_total"),
                "closure_rate_pct": rate_pct("tickets_closed", "tickets_total"),
            }
        )
        .orderBy(F.desc("tickets_total"), F.desc("resolution_breach_rate_pct"), "queue_name")
    )


def queue_performance(base: DataFrame) -> DataFrame:
    """Load, breaches, times, reopens, CSAT and rates per queue; the largest queue first."""
    return _queue_table(_grouped(base, "queue_name"))


def _agent_table(groups: DataFrame) -> DataFrame:
    return (
        groups.select(
            "assigned_agent",
            *_named(tickets_handled="tickets", tickets_closed="closed"),
            _mean("avg_first_response_minutes"),
            _mean("avg_resolution_minutes"),
            *_named(
                first_response_sla_breaches="first_response_breaches",
                resolution_sla_breaches="resolution_breaches",
                escalations="escalations",
                total_reopens="reopens",
            ),
            _mean("avg_csat"),
        )
        .withColumns(
            {
                "closure_rate_pct": rate_pct("tickets_closed", "tickets_handled"),
                "first_response_breach_rate_pct": rate_pct("first_response_sla_breaches", "tickets_handled"),
                "resolution_breach_rate_pct": rate_pct("resolution_sla_breaches", "tickets_handled"),
                "escalation_rate_pct": rate_pct("escalations", "tickets_handled"),
            }
        )
        .orderBy(F.desc("tickets_handled"), F.desc("avg_csat"), "assigned_agent")
    )


def agent_performance(base: DataFrame) -> DataFrame:
    """Throughput, quality and outcome per agent; the busiest agent first."""
    return _agent_table(_grouped(base, "assigned_agent"))


def _breach_rates(den: str) -> dict:
    return {
        "first_response_breach_rate_pct": rate_pct("first_response_breaches", den),
        "resolution_breach_rate_pct": rate_pct("resolution_breaches", den),
    }


def _priority_table(groups: DataFrame) -> DataFrame:
    rows = groups.select("issue_priority", *_named(tickets_total="tickets"), _mean("avg_first_response_minutes"), _mean("avg_resolution_minutes"), "first_response_breaches", "resolution_breaches")
    return rows.withColumns(_breach_rates("tickets_total")).orderBy(F.desc("tickets_total"), "issue_priority")


def priority_sla(base: DataFrame) -> DataFrame:
    """Times and breaches per priority; the most frequent first."""
    return _priority_table(_grouped(base, "issue_priority"))


def _age_order(as_of: Moment) -> Column:
    return age_bucket_order(F.date_diff(F.lit(as_of).cast("date"), F.to_date("issue_created")))


def _aging_table(groups: DataFrame) -> DataFrame:
    return groups.orderBy("bucket_order").select(age_bucket_label(F.col("bucket_order")).alias("aging_bucket"), "open_tickets")


def backlog_aging(tickets: DataFrame, as_of: Moment) -> DataFrame:
    """Open tickets per age bucket on the day ``as_of``, youngest bucket first; no date range applies."""
    waiting = ticket_base(tickets).where(is_open())
    return _aging_table(waiting.groupBy(_age_order(as_of).alias("bucket_order")).agg(F.count(F.lit(1)).alias("open_tickets")))


def _category_table(groups: DataFrame) -> DataFrame:
    return (
        groups.select(
            "category",
            "subcategory",
            *_named(tickets_total="tickets", resolution_sla_breaches="resolution_breaches"),
            _mean("avg_resolution_minutes"),
            _mean("avg_reopens"),
            _mean("avg_csat"),
        )
        .withColumn("resolution_breach_rate_pct", rate_pct("resolution_sla_breaches", "tickets_total"))
        .orderBy(F.desc("tickets_total"), F.desc("resolution_breach_rate_pct"), "category", "subcategory")
    )


def category_pain_points(base: DataFrame) -> DataFrame:
    """Volume, breaches, times, reopens and CSAT per category and subcategory; the largest first."""
    return _category_table(_grouped(base, "category", "subcategory"))


def _channel_table(groups: DataFrame) -> DataFrame:
    rows = groups.select("channel", *_named(tickets_total="tickets"), _mean("avg_first_response_minutes"), _mean("avg_resolution_minutes"), "first_response_breaches", "resolution_breaches", _mean("avg_csat"))
    return rows.withColumns(_breach_rates("tickets_total")).orderBy(F.desc("tickets_total"), "channel")


def channel_analysis(base: DataFrame) -> DataFrame:
    """Times, breaches and CSAT per channel; the most used first."""
    return _channel_table(_grouped(base, "channel"))


def _summary_table(groups: DataFrame) -> DataFrame:
    return (
        groups.where("tickets > 0")
        .select(
            *_named(tickets_created="tickets", tickets_resolved="closed", current_open_backlog_within_filtered_set="open"),
            _mean("avg_first_response_minutes"),
            _mean("avg_resolution_minutes"),
            "first_response_breaches",
            "resolution_breaches",
            _mean("avg_csat"),
            *_named(total_reopens="reopens"),
        )
        .withColumns(_breach_rates("tickets_created"))
        .withColumn("reopen_rate_pct", rate_pct("total_reopens", "tickets_created"))
    )


def executive_summary(base: DataFrame) -> DataFrame:
    """One row of totals, means and rates; no row when there are no tickets."""
    return _summary_table(_grouped(base))


def _issues() -> dict[str, Column]:
    def blank(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) == ""

    csat = F.col("csat_score")
    return {
        "missing_created_date": F.col("issue_created").isNull(),
        "resolved_before_created": F.col("issue_resolution_date") < F.col("issue_created"),
        "missing_status": blank("issue_status"),
        "missing_priority": blank("issue_priority"),
        "missing_agent": blank("assigned_agent"),
        "invalid_csat": (csat < 1) | (csat > 5),
    }


def _issue_counts() -> list[Column]:
    return [F.count_if(condition).alias(name) for name, condition in _issues().items()]


def _issue_table(groups: DataFrame) -> DataFrame:
    names = list(_issues())
    return groups.agg(*[total(F.col(name)).alias(name) for name in names]).unpivot([], names, "issue", "cnt")


def data_quality(tickets: DataFrame) -> DataFrame:
    """Number of tickets per data-quality issue, deleted tickets included, counted in one pass."""
    return tickets.agg(*_issue_counts()).unpivot([], list(_issues()), "issue", "cnt")


# The groupings that the ticket tables need, and the columns each groups by.
_GROUPINGS: dict[str, tuple[str, ...]] = {
    "everything": (),
    "created": ("created_day",),
    "resolved": ("resolved_day",),
    "queue": ("queue_name",),
    "agent": ("assigned_agent",),
    "priority": ("issue_priority",),
    "channel": ("channel",),
    "category": ("category", "subcategory"),
    "age": ("bucket_order",),
}
_DIMENSIONS = [name for columns in _GROUPINGS.values() for name in columns]


def grouping_number(columns: Iterable[str]) -> int:
    """What ``grouping_id`` says of rows grouped by these columns: one bit for each dimension, set where it is left out."""
    kept = set(columns)
    return sum(1 << k for k, name in enumerate(reversed(_DIMENSIONS)) if name not in kept)


def kpi_rollup(tickets: DataFrame, start: Moment | None = None, end: Moment | None = None, *, as_of: Moment) -> DataFrame:
    """The groups of all ticket tables in one table: one scan, one shuffle.

    Every ticket goes into each grouping set once, and what meets in a task is added up before it is shuffled. Tables differ in
    which tickets they count: those of the date range, all open ones (age) or all (data quality). So conditions stand inside the
    aggregates, and what is out of range joins the group without a name, where it adds nothing.
    """
    inside = ticket_is_live()
    if start is not None:
        inside = inside & F.coalesce(F.col("issue_created") >= utc_moment(start), F.lit(False))
    if end is not None:
        inside = inside & F.coalesce(F.col("issue_created") < utc_moment(end), F.lit(False))
    waiting = ticket_is_live() & is_open()
    # Issues are judged before dimensions lose their names outside the range.
    rows = with_ticket_dates(tickets).withColumns({"inside": inside, "waiting": waiting, **_issues()})
    named = {name: F.when(F.col("inside"), F.col(name)) for name in _DIMENSIONS if name != "bucket_order"}
    rows = rows.withColumns({**named, "bucket_order": F.when(F.col("waiting"), _age_order(as_of))})
    counted = [F.count_if(name).alias(issue) for issue, name in [("open_tickets", "waiting"), *zip(_issues(), _issues())]]
    sets = [[F.col(name) for name in columns] for columns in _GROUPINGS.values()]
    grouped = rows.groupingSets(sets, *_DIMENSIONS)
    return grouped.agg(F.grouping_id().alias("grouping"), *sums(F.col("inside")), *counted)


def tables_of_rollup(rollup: DataFrame) -> dict[str, DataFrame]:
    """The ticket tables by name, from the stored rows of ``kpi_rollup``."""

    def groups(name: str) -> DataFrame:
        return rollup.where(F.col("grouping") == grouping_number(_GROUPINGS[name]))

    def inside(name: str) -> DataFrame:
        return groups(name).where("tickets > 0")

    came = inside("created").withColumns({"day": F.col("created_day"), "resolved": F.lit(0).cast("bigint")})
    went = inside("resolved").where("resolved_day is not null").select(F.col("resolved_day").alias("day"), F.col("tickets").alias("resolved"))
    return {
        "executive_summary": _summary_table(groups("everything")),
        "daily_created": _created_table(inside("created")),
        "daily_resolved": _resolved_table(inside("resolved")),
        "backlog_snapshot": _backlog_table(groups("everything")),
        "daily_kpis": _flow_table(came.unionByName(went, allowMissingColumns=True)),
        "queue_performance": _queue_table(inside("queue")),
        "agent_performance": _agent_table(inside("agent")),
        "priority_sla": _priority_table(inside("priority")),
        "channel_analysis": _channel_table(inside("channel")),
        "category_pain_points": _category_table(inside("category")),
        "backlog_aging": _aging_table(groups("age").where("open_tickets > 0")),
        "data_quality": _issue_table(groups("everything")),
    }
