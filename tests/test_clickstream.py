"""Engine-difference traps and edge cases of the clickstream operators, on hand-written rows."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import at, make_events, only, rows_of

from tidemark.functions.columns import ratio
from tidemark.operators import cohorts, drivers, funnel, kpis, quality, star, trends
from tidemark.sources.events import RAW_SCHEMA, clean_raw_events, events_clean


def raw_row(**fields):
    base = {
        "event_time": "2019-11-01 00:00:00 UTC",
        "event_type": "view",
        "product_id": "1",
        "category_id": "2",
        "category_code": "a.b",
        "brand": "x",
        "price": "1.5",
        "user_id": "3",
        "user_session": "s",
    }
    return tuple({**base, **fields}[name] for name in RAW_SCHEMA.fieldNames())


def cleaned(spark, **fields):
    return only(clean_raw_events(spark.createDataFrame([raw_row(**fields)], RAW_SCHEMA)))


@pytest.mark.parametrize(
    ("field", "text", "column", "value"),
    [
        ("event_time", "2019-11-01 12:34:56 UTC", "event_ts", datetime(2019, 11, 1, 12, 34, 56)),
        ("event_time", "2019-11-01 12:34:56", "event_ts", datetime(2019, 11, 1, 12, 34, 56)),
        ("event_time", "2019-11-01 12:34:56.25", "event_ts", datetime(2019, 11, 1, 12, 34, 56, 250000)),
        ("event_time", "2019-11-01", "event_ts", datetime(2019, 11, 1)),
        ("event_time", "2019-11-01T12:34:56Z", "event_ts", datetime(2019, 11, 1, 12, 34, 56)),
        ("event_time", "2019", "event_ts", None),
        ("event_time", "yesterday", "event_ts", None),
        ("event_time", None, "event_ts", None),
        ("event_type", "  PurchasE ", "event_type", "purchase"),
        ("category_id", "2053013555631882655", "category_id", 2053013555631882655),
        ("category_id", "1.5e18", "category_id", 1500000000000000000),
        ("product_id", "1.7", "product_id", 2),
        ("product_id", "abc", "product_id", None),
        ("user_id", "", "user_id", None),
        ("price", "12,5", "price", None),
        ("price", "-3", "price", -3.0),
        ("brand", "   ", "brand", None),
        ("brand", " acme ", "brand", "acme"),
        ("category_code", "", "category_code", None),
        ("user_session", None, "user_session", None),
    ],
)
def test_cleaning(spark, field, text, column, value):
    assert cleaned(spark, **{field: text})[column] == value


def test_times_do_not_depend_on_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 02:30 does not exist on that day in that zone.
        row = cleaned(spark, event_time="2024-03-10 02:30:00 UTC")
        assert row["event_ts"] == datetime(2024, 3, 10, 2, 30)
        events = make_events(spark, {"ts": "01 00:00:00"}, {"ts": "01 03:00:00"})
        assert only(star.dim_session(events))["session_duration_seconds"] == 10_800
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_events_need_time_and_user(spark):
    raw = clean_raw_events(
        spark.createDataFrame(
            [raw_row(), raw_row(event_time="?"), raw_row(user_id=""), raw_row(user_session="")], RAW_SCHEMA
        )
    )
    kept = rows_of(events_clean(raw))
    assert [row["session_id"] for row in kept] == ["s", None]
    assert kept[0]["event_date"] == date(2019, 11, 1)
    assert "user_session" not in kept[0] and "event_id" not in kept[0]


def test_ratio_is_null_without_denominator(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (1, 4)], "a bigint, b bigint")
    assert [r[0] for r in df.select(ratio("a", "b")).collect()] == [None, None, 0.25]


def test_weekdays_count_from_sunday(spark):
    events = make_events(spark, {"ts": "06"}, {"ts": "07"}, {"ts": "08"}, {"ts": "08 09:00:00"})
    days = {row["day"]: row for row in rows_of(star.dim_date(events))}
    assert {d: (r["day_of_week"], r["is_weekend"]) for d, r in days.items()} == {
        6: (6, True),
        7: (0, True),
        8: (1, False),
    }
    assert (days[8]["month_name"], days[8]["week"], days[8]["quarter"]) == ("January", 2, 1)


def test_modes_skip_null_and_break_ties_upwards(spark):
    events = make_events(
        spark,
        *[{"ts": "01", "category_code": None, "brand": None}] * 5,
        *[{"ts": "01", "category_code": "a", "brand": "x"}] * 2,
        *[{"ts": "01", "category_code": "b", "brand": "y", "category_id": 101}] * 2,
        {"ts": "01", "category_code": "b", "category_id": 100, "brand": None},
        {"ts": "01", "category_id": 7, "category_code": None, "product_id": None, "brand": None, "price": None},
    )
    codes = {row["category_id"]: row["category_code"] for row in rows_of(star.dim_category(events))}
    assert codes == {100: "a", 101: "b", 7: None}
    labels = {r["category_id"]: r["category_label"] for r in rows_of(star.with_category_label(star.dim_category(events)))}
    assert labels == {100: "a", 101: "b", 7: "cat_7"}
    products = {row["product_id"]: row for row in rows_of(star.dim_product(events))}
    assert products[10] == {"product_id": 10, "category_id": 100, "brand": "y", "median_price": 5.0}
    assert products[None] == {"product_id": None, "category_id": 7, "brand": None, "median_price": None}


def test_median_interpolates_exactly_or_picks_an_element(spark):
    events = make_events(spark, *[{"ts": "01", "price": p} for p in (1.0, 2.0, 10.0, 11.0)])
    assert only(star.dim_product(events))["median_price"] == 6.0
    assert only(star.dim_product(events, approx=True))["median_price"] == 2.0


def test_durations_count_second_boundaries(spark):
    events = make_events(spark, {"ts": "01 10:00:00.9"}, {"ts": "01 10:00:01.1"}, {"ts": "02", "session_id": None})
    assert only(star.dim_session(events))["session_duration_seconds"] == 1


def test_two_users_in_one_session_are_two_rows(spark):
    events = make_events(
        spark,
        {"ts": "01 10:00:00", "user_id": 1},
        {"ts": "01 11:00:00", "user_id": 2, "event_type": "purchase", "category_id": 200},
    )
    sessions = funnel.session_funnel(events)
    assert sessions.count() == 2
    assert star.dim_session(events).count() == 2
    by_category = rows_of(drivers.category_funnel(sessions, drivers.session_category(events)))
    assert [(r["category_id"], r["sessions"], r["purchase_sessions"]) for r in by_category] == [(100, 2, 1)]
    kpi = only(kpis.executive_kpis(events))
    assert (kpi["sessions"], kpi["users"]) == (1, 2)


def test_session_steps(spark):
    events = make_events(
        spark,
        {"ts": "01 10:00:00", "event_type": "cart", "product_id": 1},
        {"ts": "01 10:00:30", "event_type": "view", "product_id": 1},
        {"ts": "01 10:00:40", "event_type": "view", "product_id": None},
        {"ts": "01 10:01:00", "event_type": "purchase", "product_id": 1, "price": 8.0},
        {"ts": "01 10:01:00", "event_type": "purchase", "product_id": 1, "price": 6.0},
        {"ts": "01 10:02:00", "event_type": "purchase", "product_id": 1, "price": 1.0},
        {"ts": "01 10:03:00", "event_type": "purchase", "product_id": 2, "price": -4.0},
        {"ts": "01 10:04:00", "event_type": "purchase", "product_id": None, "price": 2.0},
        {"ts": "01 10:05:00", "event_type": "purchase", "product_id": None, "price": 3.0},
    )
    row = only(funnel.session_funnel(events))
    assert (row["view_events"], row["cart_events"], row["purchase_events"]) == (2, 1, 6)
    assert row["distinct_products_viewed"] == 1
    assert row["distinct_products_purchased"] == 2
    assert row["session_revenue_gross"] == 20.0
    # Product 1 counts with the earlier of two events at its first time, the missing product once.
    assert row["session_revenue_dedup_product"] == 10.0
    # Without event ids the lower price counts.
    assert only(funnel.session_funnel(events.drop("event_id")))["session_revenue_dedup_product"] == 8.0
    assert row["aov_session_proxy"] == 5.0
    assert row["time_view_to_cart_sec"] == -30
    assert row["time_view_to_purchase_sec"] == 30
    assert row["time_cart_to_purchase_sec"] == 60
    ordered = only(funnel.session_funnel(events, ordered_only=True))
    assert ordered["time_view_to_cart_sec"] is None
    assert ordered["time_view_to_purchase_sec"] == 30
    firsts = {r["product_id"]: r for r in rows_of(funnel.purchase_dedup(events))}
    assert {p: r["first_purchase_price"] for p, r in firsts.items()} == {1: 8.0, None: 2.0}
    assert firsts[1]["first_purchase_ts"] == at("01 10:01:00")


def test_unpaid_purchases_give_zero_not_null(spark):
    events = make_events(spark, {"ts": "01", "event_type": "purchase", "price": 0.0}, {"ts": "01", "session_id": "t"})
    rows = {r["session_id"]: r for r in rows_of(funnel.session_funnel(events))}
    assert rows["s"]["session_revenue_gross"] is None
    assert rows["s"]["session_revenue_dedup_product"] == 0.0
    assert rows["s"]["aov_session_proxy"] == 0.0
    assert rows["t"]["aov_session_proxy"] is None


def test_session_density(spark):
    events = make_events(
        spark, *[{"ts": "01", "session_id": s} for s in ("a", "a", "a", "b")], {"ts": "01", "session_id": None}
    )
    row = only(funnel.session_event_density(events))
    assert (row["avg_events_per_session"], row["p50"], row["p99"]) == (2.0, 2.0, pytest.approx(2.98))


def test_session_category_is_that_of_the_earliest_event(spark):
    events = make_events(
        spark,
        {"ts": "01 10:00:00", "category_id": None},
        {"ts": "01 10:00:02", "category_id": 1},
        {"ts": "01 10:00:01", "category_id": 9, "event_id": 6},
        {"ts": "01 10:00:01", "category_id": 5, "event_id": 7},
        {"ts": "01", "session_id": "none", "category_id": None},
    )
    assert {r["session_id"]: r["category_id"] for r in rows_of(drivers.session_category(events))} == {
        "s": 9,
        "none": None,
    }
    anonymous = drivers.session_category(events.drop("event_id"))
    assert {r["session_id"]: r["category_id"] for r in rows_of(anonymous)}["s"] == 5


def test_brand_limit_and_filters(spark):
    buy = {"ts": "01", "event_type": "purchase"}
    events = make_events(
        spark,
        {**buy, "brand": "a", "price": 3.0},
        {**buy, "brand": "a", "price": 5.0},
        {**buy, "brand": "b", "price": 8.0, "session_id": None},
        {**buy, "brand": "c", "price": -9.0},
        {**buy, "brand": None, "price": 99.0},
        {**buy, "brand": "d", "price": 1.0, "session_id": "t"},
    )
    assert [tuple(r.values()) for r in rows_of(drivers.brand_revenue(events, limit=2))] == [
        ("a", 1, 8.0, 4.0),
        ("b", 0, 8.0, 8.0),
    ]


def test_quadrants(spark):
    rows = [(1, 100, 50), (2, 100, 1), (3, 10, 5), (4, 10, 0), (5, 0, 0)]
    counts = spark.createDataFrame(
        [(c, v, v, v, p, 1.0, 1.0) for c, v, p in rows],
        "category_id bigint, sessions bigint, view_sessions bigint, cart_sessions bigint, purchase_sessions bigint, "
        "revenue_dedup double, revenue_gross double",
    )
    placed = rows_of(drivers.category_quadrants(drivers.category_cvr(counts)))
    assert {r["category_id"]: r["quadrant"] for r in placed} == {
        1: "star",
        2: "optimize",
        3: "grow",
        4: "monitor",
        5: None,
    }


def purchases(spark, *user_days):
    return make_events(
        spark, *[{"ts": f"{day:02d} 08:00:00", "user_id": u, "event_type": "purchase"} for u, day in user_days]
    )


def test_retention_guard_and_rates(spark):
    # Users 1-3 start on day 1, user 4 on day 2; the data ends on day 8.
    fact = purchases(spark, (1, 1), (1, 2), (1, 8), (2, 1), (2, 2), (2, 2), (3, 1), (4, 2), (4, 8))
    activity = cohorts.cohort_activity(cohorts.user_daily_purchases(fact))
    first, second = rows_of(cohorts.cohort_retention_summary(activity))
    assert (first["cohort_size"], first["retained_d1_users"], first["retained_d7_users"]) == (3, 2, 1)
    assert first["retention_d1"] == pytest.approx(2 / 3)
    assert first["retention_d30"] is None
    assert second["retention_d1"] == 0.0
    assert second["retention_d7"] is None

    curve = cohorts.cohort_retention_curve(activity)
    summary = cohorts.cohort_retention_summary(activity)
    assert [r["retention_rate"] for r in rows_of(quality.qa_day0(curve))] == [1.0, 1.0]
    cards = only(cohorts.weighted_retention_cards(summary))
    assert (cards["total_purchasers"], cards["d1_retention_weighted"]) == (4, 0.5)
    present = {r["days_since"]: r for r in rows_of(cohorts.weighted_retention_curve(curve, summary))}
    everyone = {r["days_since"]: r for r in rows_of(cohorts.weighted_retention_curve(curve, summary, "all"))}
    assert present[1]["retention_weighted"] == pytest.approx(2 / 3)
    assert everyone[1]["retention_weighted"] == 0.5
    tail = cohorts.weighted_retention_curve(curve, summary, drop_day0=True)
    assert [r["days_since"] for r in rows_of(tail)] == [1, 6, 7]
    axis = rows_of(star.on_day_axis(tail, star.dim_days(spark, 7)).orderBy("day"))
    assert [r["active_users"] for r in axis] == [None, 2, None, None, None, None, 1, 1]

    back = {r["cohort_date"].day: r for r in rows_of(cohorts.repurchase_within(activity, (1, 7)))}
    assert (back[1]["repurchased_1d_users"], back[1]["repurchased_7d_users"]) == (2, 2)
    assert (back[2]["repurchased_1d_users"], back[2]["repurchase_7d"]) == (0, 1.0)

    heat = rows_of(cohorts.cohort_heatmap(curve, 7))
    assert (heat[0]["day_0"], heat[0]["day_3"]) == (1.0, None)
    assert heat[1]["day_6"] == 1.0
    with pytest.raises(ValueError):
        cohorts.weighted_retention_curve(curve, summary, "some")


def test_activity_retention_counts_any_event(spark):
    events = purchases(spark, (1, 2)).unionByName(
        make_events(spark, {"ts": "01", "user_id": 1}, {"ts": "03", "user_id": 1}, {"ts": "03", "user_id": 2})
    )
    bought = only(cohorts.activity_retention(events, days=(1,)))
    assert (bought["cohort_date"], bought["cohort_size"], bought["retention_d1"]) == (date(2024, 1, 2), 1, 1.0)
    seen = rows_of(cohorts.activity_retention(events, "activity", (1,)))
    assert [(r["cohort_date"].day, r["cohort_size"], r["retention_d1"]) for r in seen] == [(1, 1, 1.0), (3, 1, None)]
    with pytest.raises(ValueError):
        cohorts.activity_retention(events, "signup")


def daily(spark, *rows):
    return spark.createDataFrame(
        [(date(2024, 1, day), kind, n) for day, kind, n in rows], "event_date date, event_type string, events bigint"
    )


def test_moving_average_is_over_calendar_days_with_events(spark):
    days = daily(spark, (1, "view", 10), (2, "view", 20), (8, "view", 40), (20, "view", 7), (8, "cart", 2))
    by_type = {(r["event_date"].day, r["event_type"]): r["events_7d_ma"] for r in rows_of(trends.events_moving_avg(days))}
    assert by_type == {(1, "view"): 10, (2, "view"): 15, (8, "view"): 30, (20, "view"): 7, (8, "cart"): 2}
    both = {r["event_date"].day: r["events_7d_ma"] for r in rows_of(trends.events_moving_avg(days, by_type=False))}
    assert both[8] == 31


def test_peak_takes_latest_tie_and_compares_with_days_before(spark):
    days = daily(
        spark, (1, "view", 50), (5, "view", 10), (9, "cart", 99), (10, "view", 30), (12, "view", 50), (12, "cart", 1)
    )
    peak = only(trends.peak_view_day(days))
    assert (peak["peak_view_date"], peak["peak_view_events"]) == (date(2024, 1, 12), 50)
    spike = only(trends.peak_view_spike(days))
    assert (spike["baseline_views"], spike["peak_view_spike_pct"]) == (20.0, pytest.approx(150.0))
    alone = only(trends.peak_view_spike(daily(spark, (1, "view", 5))))
    assert (alone["baseline_views"], alone["peak_view_spike_pct"]) == (None, None)


def test_daily_conversion_is_null_without_views(spark):
    days = daily(spark, (1, "view", 4), (1, "cart", 2), (2, "purchase", 1), (1, "error", 5))
    rows = {r["event_date"].day: r for r in rows_of(trends.daily_cvr(days))}
    assert rows[1]["view_to_cart_cvr"] == 0.5
    assert rows[1]["cart_to_purchase_cvr"] is None
    assert rows[2]["view_to_purchase_cvr"] is None
    totals = {r["event_date"].day: r["total_events"] for r in rows_of(trends.daily_events_by_type(days))}
    assert totals == {1: 11, 2: 1}


def test_checks(spark):
    events = make_events(
        spark, {"ts": "01"}, {"ts": "01"}, {"ts": "01", "event_type": "cart"}, {"ts": "02", "category_id": None}
    )
    assert only(quality.qa_duplicate_events(events))["dup_groups"] == 1
    assert only(quality.qa_null_keys(events))["null_category_id"] == 1
    assert rows_of(quality.qa_event_types(events))[0] == {"event_type": "view", "n": 3}
    summary = funnel.funnel_summary(funnel.session_funnel(events))
    assert only(quality.qa_monotonic(summary))["is_monotonic"] is True
    raw = events.withColumnRenamed("session_id", "user_session")
    assert only(quality.qa_row_integrity(raw, events, star.dim_session(events))) == {
        "raw_rows": 4,
        "fact_rows": 4,
        "sessions_dim": 1,
        "sessions_distinct_raw": 1,
    }


def test_star_join_keeps_every_fact_row_once(spark):
    events = make_events(
        spark,
        {"ts": "01", "user_id": 1},
        {"ts": "02", "user_id": 1, "session_id": None},
        {"ts": "03", "user_id": 2, "product_id": None, "category_id": None},
    )
    builders = (star.dim_date, star.dim_category, star.dim_product, star.dim_user, star.dim_session)
    dims = {build.__name__: build(events) for build in builders}
    rows = {r["event_id"]: r for r in rows_of(star.star_join(star.fact_events(events), dims))}
    assert set(rows) == {0, 1, 2}
    assert rows[1]["session_start_ts"] is None
    assert rows[1]["last_seen_ts"] == at("02")
    assert rows[2]["session_start_ts"] == at("03")
    assert rows[2]["median_price"] is None and rows[2]["category_label"] is None
    for left_out in ("dim_user", "dim_session"):
        some = {name: dim for name, dim in dims.items() if name != left_out}
        assert star.star_join(star.fact_events(events), some).count() == 3


def test_profile_percentiles(spark):
    raw = make_events(spark, *[{"ts": "01", "price": float(p)} for p in range(-1, 10)]).withColumnRenamed(
        "session_id", "user_session"
    )
    profile = only(kpis.data_profile(raw))
    assert (profile["total_rows"], profile["nonpositive_price_rows"], profile["view_events"]) == (11, 2, 11)
    assert only(kpis.price_percentiles(raw))["p50_price"] == 4.0
    assert only(kpis.price_percentiles(raw, approx=True))["p50_price"] == 4.0
