"""Measures under any slice: mergeable sketches and bitmaps, chosen cohorts, order keys in any session zone."""

from __future__ import annotations

import json
import random
from datetime import datetime

import pytest
from conftest import make_events, only, rows_of
from pyspark.sql import functions as F

from tidemark.functions.columns import wall_micros
from tidemark.functions.quantiles import quantile_sketches, quantiles_of_sketches
from tidemark.operators import cohorts, drivers, funnel, kpis, star
from tidemark.plans.storage import scratch_dir, store
from tidemark.sources.tickets import document_schema, read_ticket_documents


@pytest.fixture(scope="module")
def fact(spark):
    rng = random.Random(3)
    rows = []
    for k in range(600):
        user = rng.choice([1, 2, 3, 40_000, 70_001, -5, 10**12])
        rows.append(
            {
                "ts": f"{rng.randint(1, 28):02} {rng.randint(0, 23):02}:00:00",
                "user_id": user,
                "session_id": rng.choice([None, f"s{k % 50}", f"t{user}"]),
                "event_type": rng.choice(["view", "cart", "purchase"]),
                "brand": rng.choice([None, "a", "b"]),
                "price": rng.choice([None, -1.0, 0.0, 2.5, 9.75]),
            }
        )
    return make_events(spark, *rows)


def same(found, wanted):
    columns = sorted(wanted.columns)
    assert sorted(found.columns) == columns
    show = lambda df: sorted(repr(tuple(round(v, 9) if isinstance(v, float) else v for v in row)) for row in df.select(*columns).collect())
    assert show(found) == show(wanted)


@pytest.mark.parametrize("by", [(), ("brand",), ("week",), ("brand", "week")])
def test_bitmap_rollup_equals_the_kpis_of_events(spark, fact, by):
    work = scratch_dir(spark)
    numbers = store(kpis.session_numbers(fact), work, "numbers")
    week = F.to_date(F.date_trunc("week", "event_date")).alias("week")
    rollup = store(kpis.kpi_bitmaps(fact, numbers, "brand"), work, "rollup").select("*", week)
    same(kpis.kpis_of_bitmaps(rollup, *by), kpis.executive_kpis(fact.select("*", week), *by))


def test_rollup_of_nothing(spark, fact):
    none = fact.limit(0)
    rollup = kpis.kpi_bitmaps(none, kpis.session_numbers(none), "brand")
    same(kpis.kpis_of_bitmaps(rollup), kpis.executive_kpis(none))
    assert kpis.kpis_of_bitmaps(rollup, "brand").count() == 0
    assert only(kpis.kpis_of_sketches(kpis.kpi_sketches(none)))["sessions"] in (0, None)


def test_sketches_unite_to_what_one_sketch_says(spark, fact):
    daily = kpis.kpi_sketches(fact, "brand")
    exact = only(kpis.executive_kpis(fact))
    found = only(kpis.kpis_of_sketches(daily))
    for name in ("sessions", "users"):
        assert abs(found[name] - exact[name]) <= 0.03 * exact[name] + 1
    assert found["purchases"] == exact["purchases"] and found["revenue"] == pytest.approx(exact["revenue"])
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Expand" not in plan


def test_quantile_sketches_stay_within_their_rank_error(spark):
    df = spark.range(30_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 7).alias("day"), F.sqrt("id").alias("v"))
    df = df.unionByName(spark.createDataFrame([(9, 0, None), (8, 0, 4.0)], "k long, day long, v double"))
    found = quantiles_of_sketches(quantile_sketches(df, ["k", "day"], "v"), ["k"], {"p10": 0.1, "p50": 0.5, "p99": 0.99})
    rows = {r["k"]: r for r in rows_of(found)}
    assert set(rows) == {0, 1, 2, 8} and rows[8] == {"k": 8, "p10": 4.0, "p50": 4.0, "p99": 4.0, "n": 1}
    for k in (0, 1, 2):
        assert rows[k]["n"] == 10_000
        for name, p in (("p10", 0.1), ("p50", 0.5), ("p99", 0.99)):
            assert abs(rows[k][name] ** 2 / 30_000 - p) < 0.01
    approx = rows_of(star.dim_product(make_events(spark, {"ts": "01", "price": 3.0}, {"ts": "02", "price": 5.0}), approx=True))
    assert approx[0]["median_price"] in (3.0, 5.0) and approx[0]["category_id"] == 100


def test_cohorts_as_sets_of_users(spark, fact):
    activity = cohorts.cohort_activity(cohorts.user_daily_purchases(fact))
    bitmaps = cohorts.cohort_bitmaps(activity)
    same(cohorts.cohort_retention_curve(bitmaps, users="users"), cohorts.cohort_retention_curve(activity))
    same(cohorts.cohort_retention_summary(bitmaps, users="users"), cohorts.cohort_retention_summary(activity))
    same(cohorts.repurchase_within_of_bitmaps(bitmaps, (1, 5, 30)), cohorts.repurchase_within(activity, (1, 5, 30)))
    assert cohorts.cohort_bitmaps(activity.limit(0)).count() == 0


def test_chosen_cohorts_restrict_both_sides(spark, fact):
    activity = cohorts.cohort_activity(cohorts.user_daily_purchases(fact))
    summary, curve = cohorts.cohort_retention_summary(activity), cohorts.cohort_retention_curve(activity)
    dates = sorted(r["cohort_date"] for r in rows_of(summary))
    chosen = spark.createDataFrame([(d,) for d in [dates[0], dates[0], dates[-1]]] + [(datetime(1999, 1, 1).date(),)], "cohort_date date")
    found = rows_of(cohorts.selected_retention_curve(curve, summary, chosen, "all"))
    size = sum(r["cohort_size"] for r in rows_of(summary) if r["cohort_date"] in (dates[0], dates[-1]))
    for r in found:
        active = sum(c["active_users"] for c in rows_of(curve) if c["days_since"] == r["days_since"] and c["cohort_date"] in (dates[0], dates[-1]))
        assert (r["chosen_active_users"] or 0) == active and r["chosen_cohort_users"] in (size, None)
        assert r["all_cohort_users"] == sum(s["cohort_size"] for s in rows_of(summary))
    assert {r["chosen_active_users"] for r in rows_of(cohorts.selected_retention_curve(curve, summary, chosen.limit(0)))} == {None}


DST = [
    {"ts": "01", "event_type": "purchase", "price": 10.0, "event_id": 1},
    {"ts": "01", "event_type": "purchase", "price": 99.0, "event_id": 2},
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_first_purchase_is_the_same_in_every_zone(spark, zone):
    """Two wall-clock times of which one does not exist in New York; the earlier one counts, and what is shown beside it is its time."""
    events = make_events(spark, *DST).withColumn("event_ts", F.when(F.col("event_id") == 1, F.lit("2025-03-09 02:30:00")).otherwise("2025-03-09 03:10:00").cast("timestamp_ntz"))
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        row = only(funnel.purchase_dedup(events))
        assert (row["first_purchase_price"], row["first_purchase_ts"]) == (10.0, datetime(2025, 3, 9, 2, 30))
        session = only(funnel.session_funnel(events))
        assert session["session_revenue_dedup_product"] == 10.0 and session["session_duration_sec"] == 2400
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_events_without_an_id_come_last_and_still_count(spark):
    bought = {"event_type": "purchase", "ts": "01 10:00:00"}
    rows = [{**bought, "event_id": None, "price": 4.0}, {**bought, "event_id": 7, "price": 5.0}, {**bought, "event_id": None, "price": 6.0, "product_id": 2}]
    found = make_events(spark, *rows)
    session = only(funnel.session_funnel(found, with_category=True))
    assert session["session_revenue_dedup_product"] == 11.0 and session["session_revenue_gross"] == 15.0
    assert only(drivers.session_category(found))["category_id"] == 100


def test_wall_clock_is_exact_also_before_1970(spark):
    times = ["1969-12-31 23:59:59.999999", "1970-01-01 00:00:00", "2024-02-29 23:59:59.000001", "0900-01-01 00:00:00.5", "9999-12-31 23:59:59.999999"]
    table = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    want = [(datetime.fromisoformat(t) - datetime(1970, 1, 1)) for t in times]
    got = [r[0] for r in table.select(wall_micros("t")).collect()]
    assert got == [d.days * 86_400_000_000 + d.seconds * 1_000_000 + d.microseconds for d in want]


def test_documents_whose_fields_change_type(spark, tmp_path):
    documents = [
        {"ticket_id": 7, "csat_score": 4, "reopen_count": "2", "issue_created": "2024-01-01T10:00:00Z", "escalated_flag": True},
        {"ticket_id": {"$oid": "abc"}, "csat_score": "4.5", "reopen_count": {"$numberLong": "9007199254740993"}, "issue_created": {"$date": "2024-01-01T12:00:00+02:00"}, "escalated_flag": "true"},
        {"ticket_id": "x", "csat_score": {"$numberDouble": "3"}, "reopen_count": 1.0, "issue_created": {"$date": {"$numberLong": "1704103200000"}}, "escalated_flag": "no idea"},
        {"ticket_id": None, "csat_score": [1], "reopen_count": {"a": 1}, "issue_created": "soon", "queue_name": {"b": 1}},
        {},
    ]
    (tmp_path / "t.json").write_text("\n".join(map(json.dumps, documents)) + "\n")
    found = rows_of(read_ticket_documents(spark, str(tmp_path / "t.json"), {"customer_id": "who.id"}))
    assert [r["ticket_id"] for r in found] == ["7", "abc", "x", None, None]
    assert [r["csat_score"] for r in found] == [4.0, 4.5, 3.0, None, None]
    assert [r["reopen_count"] for r in found] == [2, 9007199254740993, 1, None, None]
    assert [r["issue_created"] for r in found] == [datetime(2024, 1, 1, 10)] * 3 + [None, None]
    assert [r["escalated_flag"] for r in found] == [True, True, None, None, None]
    assert found[3]["queue_name"] == '{"b":1}'
    schema = only(document_schema(spark, str(tmp_path / "t.json")))
    assert schema["documents"] == 5 and "csat_score: VARIANT" in schema["covering_schema"]
    with pytest.raises(ValueError, match="not ticket columns"):
        read_ticket_documents(spark, str(tmp_path / "t.json"), {"nothing": "x"})
