"""Registered queries: every operator of the library over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DatetimeType

from harness import adapters
from tidemark.functions import support as tk
from tidemark.functions.quantiles import quantiles_of_sketches
from tidemark.operators import cohorts, drivers, funnel, kpis, quality, star, support, trends
from tidemark.plans import daily
from tidemark.plans.clickstream import EXPORTED, BuildChecks, build_model, export_model
from tidemark.plans.storage import scratch_dir, store, store_all
from tidemark.plans.support import run_ticket_kpis
from tidemark.sources.events import clean_raw_events, events_clean, read_events_csv
from tidemark.sources.model import export_parquet, read_model
from tidemark.sources.tickets import read_ticket_documents, read_tickets

Query = Callable[[SparkSession, str], DataFrame]

# Parameters used on both sides of the check.
AS_OF = "2001-08-02"
RANGE = ("1998-01-01", "1999-01-01")
PLACES = 6
CUT_DAY = 7
SHORT_DAYS = (1, 7, 20)
BRANDS = 5


def _rounded(df: DataFrame) -> DataFrame:
    """Sums of doubles depend on row order in the last bits; compare six decimals."""
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: F.round(name, PLACES) for name in doubles}) if doubles else df


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    return adapters.raw_events(spark, sf)


def _events(spark: SparkSession, sf: str) -> DataFrame:
    return events_clean(_raw(spark, sf))


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return star.fact_events(_events(spark, sf))


def _over_fact(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: op(_fact(spark, sf))


def _over_events(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: op(_events(spark, sf))


def _over_raw(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: op(_raw(spark, sf))


def _over_sessions(op: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_fact(lambda fact: op(funnel.session_funnel(fact)))


def _over_purchases(op: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_fact(lambda fact: op(cohorts.user_daily_purchases(fact)))


def _over_activity(op: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_purchases(lambda udp: op(cohorts.cohort_activity(udp)))


def _over_summary(op: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_activity(lambda activity: op(cohorts.cohort_retention_summary(activity)))


def _over_curve(op: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_activity(lambda activity: op(cohorts.cohort_retention_curve(activity)))


def _over_daily(op: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_fact(lambda fact: op(trends.daily_event_counts(fact)))


def _category_funnel(fact: DataFrame) -> DataFrame:
    return drivers.category_funnel_of_events(fact)


def _over_categories(op: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_fact(lambda fact: op(_category_funnel(fact)))


def _over_tickets(op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: op(adapters.tickets(spark, sf))


def _over_base(op: Callable[[DataFrame], DataFrame]) -> Query:
    return _over_tickets(lambda tickets: op(support.ticket_base(tickets)))


def _weighted(**options) -> Query:
    def run(activity: DataFrame) -> DataFrame:
        summary = cohorts.cohort_retention_summary(activity)
        curve = cohorts.cohort_retention_curve(activity)
        return cohorts.weighted_retention_curve(curve, summary, **options)

    return _over_activity(run)


def _content(tables: dict[str, DataFrame]) -> DataFrame:
    """For every column of every table: how many values it has and the sum of those that are numbers.

    Numbers are added as decimals: the sum does not depend on the order of rows, and ids of 19 digits keep them all. Columns of times
    and truth values hold none, so their text is not made.
    """

    def measured(name: str, df: DataFrame) -> DataFrame:
        def row(c: str) -> Column:
            numberless = isinstance(df.schema[c].dataType, (DatetimeType, BooleanType))
            number = (F.lit(None) if numberless else F.col(c).cast("string")).try_cast("decimal(38,6)")
            filled, total = F.count(c).alias("filled"), F.sum(number).cast("string").alias("total")
            return F.struct(F.lit(c).alias("column_name"), filled, total)

        return df.agg(F.array(*map(row, df.columns)).alias("rows")).select(F.lit(name).alias("table_name"), F.inline("rows"))

    return reduce(DataFrame.unionByName, [measured(name, df) for name, df in tables.items()])


def _csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Files whose columns stand in another order, with quotes, commas and backslashes in the brands."""
    path = f"{scratch_dir(spark)}/events_csv"
    text = adapters.raw_event_strings(spark, sf, odd_brands=True)
    writer = text.select(*reversed(text.columns)).write.option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_events_csv(spark, path)


def _stored_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _content(build_model(_raw(spark, sf), f"{scratch_dir(spark)}/build"))


def _daily_counts(spark: SparkSession, sf: str) -> DataFrame:
    """All days but the last in one load, then the last day with late events of sessions that were loaded before."""
    directory, raw = f"{scratch_dir(spark)}/daily", _raw(spark, sf)
    last = raw.agg(F.max(F.to_date("event_ts"))).scalar()
    late = (F.to_date("event_ts") == last) | (F.col("event_id") % 10 == 7)
    daily.load(raw.where(~late), directory, "first")
    daily.load(raw.where(late), directory, "last")
    return _content(daily.read_loaded(spark, directory))


def _exported_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = f"{scratch_dir(spark)}/export"
    export_model(build_model(_raw(spark, sf)), out)
    return _content(read_model(spark, out, EXPORTED))


def _read_model(spark: SparkSession, sf: str) -> DataFrame:
    out = f"{scratch_dir(spark)}/export"
    export_parquet({"agg_category_funnel": _category_funnel(_fact(spark, sf))}, out)
    return read_model(spark, out, ["agg_category_funnel"])["agg_category_funnel"]


# The foreign field names of the stored ticket documents.
TICKET_FIELDS = {"issue_created": "createdAt", "assigned_agent": "agent", "csat_score": "feedback.csat"}


def _read_tickets(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with an inner document, extended dates and fractional numbers."""
    path = f"{scratch_dir(spark)}/tickets"
    written = adapters.tickets(spark, sf)
    date = F.struct(F.date_format("issue_created", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("$date"))
    documents = written.select(
        *[c for c in written.columns if c not in ("issue_created", "assigned_agent", "csat_score", "reopen_count")],
        F.when(F.col("issue_created").isNotNull(), date).alias("createdAt"),
        F.col("assigned_agent").alias("agent"),
        F.struct((F.col("csat_score") + 0.5).alias("csat")).alias("feedback"),
        F.col("reopen_count").cast("double").alias("reopen_count"),
    )
    documents.write.json(path)
    return read_tickets(spark, path, "json", TICKET_FIELDS).select(*written.columns)


def _read_changing_tickets(spark: SparkSession, sf: str) -> DataFrame:
    """One file in which a field is a number, text or an inner document, by ticket."""
    path = f"{scratch_dir(spark)}/tickets"
    written = adapters.tickets(spark, sf)
    key, stamp = F.col("ticket_id"), F.date_format("issue_created", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")

    def quoted(value: Column) -> Column:
        return F.concat(F.lit('"'), value, F.lit('"'))

    def in_form(name: str, value: Column, number: Column, inner: str) -> Column:
        """A field of JSON text: as it is, as text, or as a document with the field ``inner``."""
        document = F.concat(F.lit(f'{{"{inner}":'), quoted(value), F.lit("}"))
        shown = F.when(key % 3 == 0, number).when(key % 3 == 1, quoted(value)).otherwise(document)
        return F.when(value.isNotNull(), F.concat(F.lit(f',"{name}":'), shown)).otherwise("")

    changing = {"csat_score": "$numberInt", "reopen_count": "$numberLong"}
    rest = [c for c in written.columns if c not in (*changing, "issue_created", "escalated_flag")]
    fields = [in_form(name, F.col(name).cast("string"), F.col(name).cast("string"), inner) for name, inner in changing.items()]
    fields.append(in_form("createdAt", stamp, quoted(stamp), "$date"))
    flag = F.col("escalated_flag").cast("string")
    fields.append(F.concat(F.lit(',"escalated_flag":'), F.when(key % 2 == 0, flag).otherwise(quoted(flag))))
    whole = F.to_json(F.struct(*rest))
    written.select(F.concat(F.substring(whole, F.lit(1), F.length(whole) - 1), *fields, F.lit("}"))).write.text(path)
    return read_ticket_documents(spark, path, {"issue_created": "createdAt"}).select(*written.columns)


def _checks_of_build(spark: SparkSession, sf: str) -> DataFrame:
    """The checks counted during a build, one row each check and number."""
    checks = BuildChecks()
    build_model(_raw(spark, sf), f"{scratch_dir(spark)}/build", checks=checks)
    return _content(checks.tables())


def _star_join(spark: SparkSession, sf: str) -> DataFrame:
    events = _events(spark, sf)
    work = scratch_dir(spark)
    builders = (star.dim_date, star.dim_category, star.dim_product, star.dim_user, star.dim_session)
    dims = store_all({build.__name__: build(events) for build in builders}, work)
    return star.star_join(star.fact_events(events), dims)


def _star_join_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Dimensions of the stored build, a fact in seven buckets, and sessions of more than five events dealt to parts."""
    work, raw = scratch_dir(spark), _raw(spark, sf)
    model = build_model(raw, f"{work}/build")
    return star.star_join_stored(star.stored_star(model["fact_events"], model, f"{work}/star", buckets=7, most=5))


def _day_axis(spark: SparkSession, sf: str) -> DataFrame:
    return star.on_day_axis(_weighted()(spark, sf), star.dim_days(spark))


def _category_labels(spark: SparkSession, sf: str) -> DataFrame:
    categories = store(star.dim_category(_events(spark, sf)), scratch_dir(spark), "dim_category")
    return star.with_category_labels(_category_funnel(_fact(spark, sf)), categories)


def _daily_calendar(spark: SparkSession, sf: str) -> DataFrame:
    counts = trends.daily_event_counts(_fact(spark, sf))
    return star.on_calendar(counts, star.dim_date(_events(spark, sf)))


def _row_integrity(spark: SparkSession, sf: str) -> DataFrame:
    raw = _raw(spark, sf)
    events = events_clean(raw)
    return quality.qa_row_integrity(raw, star.fact_events(events))


def _with_week(rollup: DataFrame) -> DataFrame:
    return rollup.withColumn("week", F.to_date(F.date_trunc("week", "event_date")))


def _bitmap_rollup(spark: SparkSession, sf: str) -> DataFrame:
    work, fact = scratch_dir(spark), _fact(spark, sf)
    numbers = store(kpis.session_numbers(fact), work, "session_numbers")
    return _with_week(store(kpis.kpi_bitmaps(fact, numbers, "brand"), work, "kpi_bitmaps"))


def _sketch_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Per week: whether each estimate of the sketches is within three standard errors of the count that the bitmaps give."""
    sketches = _with_week(store(kpis.kpi_sketches(_fact(spark, sf), "brand"), scratch_dir(spark), "kpi_sketches"))
    found = kpis.kpis_of_sketches(sketches, "week").withColumnsRenamed({"users": "about_users", "sessions": "about_sessions"})
    both = kpis.kpis_of_bitmaps(_bitmap_rollup(spark, sf), "week").join(found.select("week", "about_users", "about_sessions"), "week")
    near = [(F.abs(F.col(f"about_{n}") - F.col(n)) <= 3 * 1.04 / 2**7 * F.col(n) + 1).alias(f"{n}_near") for n in ("users", "sessions")]
    return both.select("week", "users", "sessions", *near)


def _rank_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Per product: how many prices it has, and whether the sketches' median is within 2 % of the ranks around the middle."""
    events = _events(spark, sf)
    stored = store(star.price_sketches(events), scratch_dir(spark), "price_sketches")
    found = quantiles_of_sketches(stored, ["product_id"], {"median": 0.5})
    ranked = events.join(found, "product_id").groupBy("product_id").agg(
        F.max("n").alias("n"), F.count_if(F.col("price") < F.col("median")).alias("below"), F.count_if(F.col("price") <= F.col("median")).alias("upto")
    )
    near = (F.col("below") <= 0.52 * F.col("n") + 1) & (F.col("upto") >= 0.48 * F.col("n") - 1)
    return ranked.select("product_id", "n", near.alias("median_near"))


def _approximate_percentiles(raw: DataFrame) -> DataFrame:
    """Whether the share of prices up to each sketched percentile is within 1 % of what it should be."""
    found = kpis.price_percentiles(raw, approx=True)
    one = found.agg(F.struct(*[F.max(name).alias(name) for name in kpis.PRICE_POINTS]).alias("p")).scalar()
    shares = raw.select("price", one.alias("p")).agg(
        F.count("price").alias("prices"),
        *[F.avg((F.col("price") <= F.col(f"p.{name}")).cast("int")).alias(name) for name in kpis.PRICE_POINTS],
    )
    return shares.select("prices", *[F.abs(F.col(name) - p).between(0, 0.01).alias(f"{name}_near") for name, p in kpis.PRICE_POINTS.items()])


def _chosen_cohorts(activity: DataFrame) -> DataFrame:
    """Cohorts that start on an even day of the month, beside all."""
    summary = cohorts.cohort_retention_summary(activity)
    chosen = summary.where(F.day("cohort_date") % 2 == 0)
    return cohorts.selected_retention_curve(cohorts.cohort_retention_curve(activity), summary, chosen)


def _curve_of_bitmaps(activity: DataFrame) -> DataFrame:
    return cohorts.cohort_retention_curve(cohorts.cohort_bitmaps(activity), users="users")


def _repurchase_of_bitmaps(activity: DataFrame) -> DataFrame:
    return cohorts.repurchase_within_of_bitmaps(cohorts.cohort_bitmaps(activity))


def _ticket_flags(tickets: DataFrame) -> DataFrame:
    return tickets.select("ticket_id", tk.is_open().alias("is_open"), tk.is_closed().alias("is_closed"))


def _ticket_safe_fields(tickets: DataFrame) -> DataFrame:
    return tickets.select(
        "ticket_id",
        tk.safe_first_response_breach().alias("first_response_breached_safe"),
        tk.safe_resolution_breach().alias("resolution_breached_safe"),
        tk.safe_escalated().alias("escalated_safe"),
        tk.safe_reopens().alias("reopen_count_safe"),
        tk.safe_csat().alias("csat_score_safe"),
    )


def _rate_pct(base: DataFrame) -> DataFrame:
    counts = base.groupBy("assigned_agent", "channel").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(tk.is_closed()).alias("closed")
    )
    return counts.select(
        "assigned_agent",
        "channel",
        tk.rate_pct("closed", "n").alias("closure_rate_pct"),
        tk.rate_pct("n", "closed").alias("inverse_rate_pct"),
    )


def _ticket_dates(tickets: DataFrame) -> DataFrame:
    return tk.with_ticket_dates(tickets).select("ticket_id", "created_day", "created_month", "resolved_day")


def _all_ticket_kpis(tickets: DataFrame) -> DataFrame:
    return _content(run_ticket_kpis(tickets, *RANGE, as_of=AS_OF))


def _clean_strings(spark: SparkSession, sf: str) -> DataFrame:
    return clean_raw_events(adapters.raw_event_strings(spark, sf))


QUERIES: dict[str, Query] = {
    # sources, sinks, whole builds
    "read_events_csv": _csv_round_trip,
    "clean_raw_events": _clean_strings,
    "events_clean": _over_raw(events_clean),
    "read_model_parquet": _read_model,
    "read_tickets": _read_tickets,
    "read_ticket_documents": _read_changing_tickets,
    "export_parquet": _exported_counts,
    "build_clickstream_model": _stored_counts,
    "load_clickstream_daily": _daily_counts,
    "run_all_ticket_kpis": _over_tickets(_all_ticket_kpis),
    # star schema
    "dim_date": _over_events(star.dim_date),
    "dim_user": _over_events(star.dim_user),
    "dim_category": _over_events(star.dim_category),
    "category_label": _over_events(lambda e: star.with_category_label(star.dim_category(e))),
    "dim_product": _over_events(star.dim_product),
    "dim_session": _over_events(star.dim_session),
    "fact_events": _over_events(star.fact_events),
    "star_join": _star_join,
    "star_join_stored": _star_join_stored,
    "dim_days": _day_axis,
    # session funnel
    "session_step_agg": _over_fact(funnel.session_step_agg),
    "purchase_dedup": _over_fact(funnel.purchase_dedup),
    "session_dedup_revenue": _over_fact(lambda f: funnel.session_dedup_revenue(funnel.purchase_dedup(f))),
    "session_funnel": _over_fact(funnel.session_funnel),
    "session_funnel_ordered": _over_fact(lambda f: funnel.session_funnel(f, ordered_only=True)),
    "funnel_summary": _over_sessions(funnel.funnel_summary),
    "funnel_summary_by_cart": _over_sessions(lambda s: funnel.funnel_summary(s, "has_cart")),
    "funnel_skip_steps": _over_sessions(funnel.funnel_skip_steps),
    "funnel_timing_anomalies": _over_sessions(funnel.funnel_timing_anomalies),
    "session_event_density": _over_fact(funnel.session_event_density),
    "funnel_revenue_totals_daily": _over_sessions(
        lambda s: funnel.funnel_revenue_totals(s, F.to_date("session_start_ts").alias("event_date"))
    ),
    "funnel_revenue_totals": _over_sessions(funnel.funnel_revenue_totals),
    # cohorts and retention
    "user_daily_purchases": _over_fact(cohorts.user_daily_purchases),
    "user_purchase_cohort": _over_purchases(cohorts.user_purchase_cohort),
    "cohort_activity": _over_purchases(cohorts.cohort_activity),
    "cohort_retention_summary": _over_summary(lambda s: s),
    "cohort_retention_summary_short": _over_activity(lambda a: cohorts.cohort_retention_summary(a, SHORT_DAYS)),
    "cohort_retention_curve": _over_curve(lambda c: c),
    "cohort_retention_curve_cut": _over_activity(lambda a: cohorts.cohort_retention_curve(a, CUT_DAY)),
    "weighted_retention_cards": _over_summary(cohorts.weighted_retention_cards),
    "weighted_retention_curve": _weighted(),
    "weighted_retention_curve_all": _weighted(denominator="all"),
    "weighted_retention_curve_no_day0": _weighted(drop_day0=True),
    "activity_retention": _over_fact(cohorts.activity_retention),
    "activity_retention_first_seen": _over_fact(lambda f: cohorts.activity_retention(f, cohort="activity")),
    "repurchase_within": _over_activity(cohorts.repurchase_within),
    "cohort_retention_curve_bitmaps": _over_activity(_curve_of_bitmaps),
    "repurchase_within_bitmaps": _over_activity(_repurchase_of_bitmaps),
    "weighted_retention_curve_chosen": _over_activity(_chosen_cohorts),
    "weighted_retention_cards_by_week": _over_summary(
        lambda s: cohorts.weighted_retention_cards(s, F.to_date(F.date_trunc("week", "cohort_date")).alias("week"))
    ),
    "cohort_heatmap": _over_curve(cohorts.cohort_heatmap),
    # revenue drivers
    "session_category": _over_fact(drivers.session_category),
    "category_funnel": _over_categories(lambda c: c),
    "brand_revenue": _over_fact(drivers.brand_revenue),
    "brand_revenue_top": _over_fact(lambda f: drivers.brand_revenue(f, BRANDS)),
    "category_funnel_labelled": _category_labels,
    "category_funnel_item_price": _over_fact(lambda f: drivers.category_funnel_of_events(f, with_item_price=True)),
    "category_cvr": _over_categories(drivers.category_cvr),
    "category_quadrants": _over_categories(lambda c: drivers.category_quadrants(drivers.category_cvr(c))),
    # trends
    "daily_event_counts": _over_daily(lambda d: d),
    "daily_events_by_type": _over_daily(trends.daily_events_by_type),
    "events_moving_avg": _over_daily(trends.events_moving_avg),
    "events_moving_avg_total": _over_daily(lambda d: trends.events_moving_avg(d, by_type=False)),
    "daily_cvr": _over_daily(trends.daily_cvr),
    "daily_session_cvr": _over_sessions(funnel.daily_session_cvr),
    "daily_events_on_calendar": _daily_calendar,
    "peak_view_day": _over_daily(trends.peak_view_day),
    "peak_view_spike": _over_daily(trends.peak_view_spike),
    # executive and profile
    "executive_kpis": _over_fact(kpis.executive_kpis),
    "executive_kpis_by_brand": _over_fact(lambda f: kpis.executive_kpis(f, "brand")),
    "executive_kpis_weekly_rollup": lambda spark, sf: kpis.kpis_of_bitmaps(_bitmap_rollup(spark, sf), "week"),
    "executive_kpis_brand_rollup": lambda spark, sf: kpis.kpis_of_bitmaps(_bitmap_rollup(spark, sf), "brand"),
    "executive_kpis_sketch_error": _sketch_errors,
    "median_price_sketch_error": _rank_errors,
    "price_percentiles_approx": _over_raw(_approximate_percentiles),
    "data_profile": _over_raw(kpis.data_profile),
    "price_percentiles": _over_raw(kpis.price_percentiles),
    # validation
    "qa_event_type_coverage": _over_fact(quality.qa_event_types),
    "qa_null_keys": _over_fact(quality.qa_null_keys),
    "qa_revenue": _over_categories(quality.qa_revenue),
    "qa_cvr_bounds": _over_categories(lambda c: quality.qa_cvr_bounds(drivers.category_cvr(c))),
    "qa_day0_retention": _over_curve(quality.qa_day0),
    "qa_funnel_monotonic": _over_sessions(lambda s: quality.qa_monotonic(funnel.funnel_summary(s))),
    "qa_row_integrity": _row_integrity,
    "qa_during_build": _checks_of_build,
    "qa_duplicate_events": _over_fact(quality.qa_duplicate_events),
    # ticket expressions
    "ticket_base": _over_tickets(lambda t: support.ticket_base(t, *RANGE)),
    "ticket_date_fields": _over_tickets(_ticket_dates),
    "ticket_status_flags": _over_tickets(_ticket_flags),
    "ticket_safe_fields": _over_tickets(_ticket_safe_fields),
    "rate_pct": _over_base(_rate_pct),
    # ticket KPIs
    "ticket_daily_created": _over_base(support.daily_created),
    "ticket_daily_resolved": _over_base(support.daily_resolved),
    "ticket_backlog_snapshot": _over_base(support.backlog_snapshot),
    "ticket_daily_kpis": _over_base(support.daily_kpis),
    "ticket_queue_performance": _over_base(support.queue_performance),
    "ticket_agent_performance": _over_base(support.agent_performance),
    "ticket_priority_sla": _over_base(support.priority_sla),
    "ticket_backlog_aging": _over_tickets(lambda t: support.backlog_aging(t, AS_OF)),
    "ticket_category_pain_points": _over_base(support.category_pain_points),
    "ticket_channel_analysis": _over_base(support.channel_analysis),
    "ticket_executive_summary": _over_base(support.executive_summary),
    "ticket_data_quality": _over_tickets(support.data_quality),
}


def rounded_queries() -> dict[str, Query]:
    """The registered queries, with doubles rounded for comparison."""
    return {
        name: (lambda spark, sf, query=query: _rounded(query(spark, sf))) for name, query in QUERIES.items()
    }
