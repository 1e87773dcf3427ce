"""Ticket KPIs: missing values, zero denominators, odd scores and dates."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from conftest import only, rows_of
from pyspark.sql import functions as F

from tidemark.functions.support import rate_pct
from tidemark.operators import support
from tidemark.plans.support import run_ticket_kpis
from tidemark.sources.tickets import TICKET_SCHEMA, read_tickets

DEFAULTS = {
    "ticket_id": "T",
    "issue_created": datetime(2024, 1, 1, 9),
    "issue_status": "Open",
    "issue_priority": "High",
    "queue_name": "q",
    "category": "c",
    "subcategory": "d",
    "assigned_agent": "a",
    "channel": "Email",
}


def tickets(spark, *rows):
    names = TICKET_SCHEMA.fieldNames()
    csat = lambda row: {"csat_score": None if row.get("csat_score") is None else float(row["csat_score"])}
    full = [{**DEFAULTS, **row} for row in rows]
    return spark.createDataFrame([tuple({**row, **csat(row)}.get(n) for n in names) for row in full], TICKET_SCHEMA)


def test_base_drops_deleted_and_uses_half_open_range(spark):
    rows = [
        {"ticket_id": "gone", "deleted_flag": True},
        {"ticket_id": "kept", "deleted_flag": False},
        {"ticket_id": "unset"},
        {"ticket_id": "edge", "issue_created": datetime(2024, 2, 1)},
        {"ticket_id": "undated", "issue_created": None},
    ]
    t = tickets(spark, *rows)
    assert {r["ticket_id"] for r in rows_of(support.ticket_base(t))} == {"kept", "unset", "edge", "undated"}
    january = support.ticket_base(t, "2024-01-01", date(2024, 2, 1))
    assert {r["ticket_id"] for r in rows_of(january)} == {"kept", "unset"}
    assert {r["ticket_id"] for r in rows_of(support.ticket_base(t, datetime(2024, 2, 1)))} == {"edge"}


def test_rates_round_half_to_even_and_survive_zero(spark):
    df = spark.createDataFrame([(1, 800), (3, 800), (1, 0), (1, 3)], "a bigint, b bigint")
    assert [r[0] for r in df.select(rate_pct("a", "b")).collect()] == [0.12, 0.38, 0.0, 33.33]


def test_daily_flow(spark):
    t = tickets(
        spark,
        {"reopen_count": None, "csat_score": 6, "first_response_breached": True, "first_response_time_minutes": 4.0},
        {"reopen_count": 2, "csat_score": 0, "issue_resolution_date": datetime(2024, 1, 3), "issue_status": "Closed"},
        {"csat_score": 5, "issue_resolution_date": datetime(2024, 1, 1, 23), "issue_status": None},
        {"issue_created": None, "issue_resolution_date": datetime(2024, 1, 3)},
    )
    created = {r["created_day"]: r for r in rows_of(support.daily_created(t))}
    assert created["2024-01-01"]["tickets_created"] == 3
    assert created["2024-01-01"]["total_reopens"] == 2
    assert created["2024-01-01"]["avg_csat"] == 5.0
    assert created[None]["total_reopens"] == 0
    resolved = {r["resolved_day"]: r["tickets_resolved"] for r in rows_of(support.daily_resolved(t))}
    assert resolved == {"2024-01-01": 1, "2024-01-03": 2}
    days = {r["day"]: r for r in rows_of(support.daily_kpis(t))}
    assert {d: (r["tickets_created"], r["tickets_resolved"], r["net_flow"]) for d, r in days.items()} == {
        None: (1, 0, 1),
        "2024-01-01": (3, 1, 2),
        "2024-01-03": (0, 2, -2),
    }
    assert days["2024-01-03"]["avg_csat"] is None
    assert days["2024-01-01"]["first_response_sla_breaches"] == 1
    assert only(support.backlog_snapshot(t)) == {"current_open_backlog": 2}


def test_groups_average_raw_scores_and_keep_missing_keys(spark):
    t = tickets(
        spark,
        {"csat_score": 6, "resolution_sla_breached": True, "escalated_flag": True},
        {"csat_score": 2, "issue_status": "Resolved", "reopen_count": 3},
        {"csat_score": None, "assigned_agent": None, "queue_name": "r"},
    )
    queues = rows_of(support.queue_performance(t))
    assert [q["queue_name"] for q in queues] == ["q", "r"]
    assert (queues[0]["avg_csat"], queues[0]["avg_reopens"], queues[0]["closure_rate_pct"]) == (4.0, 1.5, 50.0)
    assert (queues[1]["avg_csat"], queues[1]["resolution_breach_rate_pct"]) == (None, 0.0)
    agents = {r["assigned_agent"]: r for r in rows_of(support.agent_performance(t))}
    assert set(agents) == {"a", None}
    assert (agents["a"]["escalation_rate_pct"], agents["a"]["total_reopens"]) == (50.0, 3)
    summary = only(support.executive_summary(t))
    assert (summary["tickets_created"], summary["tickets_resolved"], summary["reopen_rate_pct"]) == (3, 1, 100.0)


def test_empty_input(spark):
    nothing = support.ticket_base(tickets(spark, {}), "1990-01-01", "1991-01-01")
    assert rows_of(support.executive_summary(nothing)) == []
    assert only(support.backlog_snapshot(nothing)) == {"current_open_backlog": 0}
    assert rows_of(support.daily_kpis(nothing)) == []


def test_aging_buckets(spark):
    ages = {0: 1, 1: 1, 2: 1, 3: 1, 4: 1, 7: 1, 8: 1, 14: 1, 15: 1, 30: 1, 31: 2}
    as_of = date(2024, 3, 1)
    rows = [
        {"issue_created": datetime.combine(date.fromordinal(as_of.toordinal() - age), datetime.max.time())}
        for age, count in ages.items()
        for _ in range(count)
    ]
    t = tickets(spark, *rows, {"issue_created": None}, {"issue_status": "Closed"}, {"deleted_flag": True})
    assert [tuple(r.values()) for r in rows_of(support.backlog_aging(t, as_of))] == [
        ("0-1 days", 3),
        ("2-3 days", 2),
        ("4-7 days", 2),
        ("8-14 days", 2),
        ("15-30 days", 2),
        ("30+ days", 2),
    ]


def test_data_quality_counts_deleted_tickets_too(spark):
    t = tickets(
        spark,
        {"issue_created": None, "deleted_flag": True},
        {"issue_resolution_date": datetime(2023, 1, 1)},
        {"issue_status": "", "issue_priority": None, "assigned_agent": ""},
        {"csat_score": 0},
        {"csat_score": 5},
    )
    assert {r["issue"]: r["cnt"] for r in rows_of(support.data_quality(t))} == {
        "missing_created_date": 1,
        "resolved_before_created": 1,
        "missing_status": 1,
        "missing_priority": 1,
        "missing_agent": 1,
        "invalid_csat": 1,
    }


def test_read_json_with_other_field_names(spark, tmp_path):
    path = tmp_path / "docs.json"
    path.write_text(
        '{"ticket_id":"TCK-1","opened":"2025-01-02T09:10:00Z","issue_status":"Resolved","csat":4,'
        '"escalated_flag":true,"resolution_time_minutes":1760,"tags":["x"]}\n'
        '{"ticket_id":"TCK-2"}\n'
    )
    t = read_tickets(spark, str(path), mapping={"issue_created": "opened", "csat_score": "csat"})
    assert t.columns == TICKET_SCHEMA.fieldNames()
    rows = {r["ticket_id"]: r for r in rows_of(t)}
    assert rows["TCK-1"]["issue_created"] == datetime(2025, 1, 2, 9, 10)
    assert (rows["TCK-1"]["csat_score"], rows["TCK-1"]["resolution_time_minutes"]) == (4, 1760.0)
    assert rows["TCK-2"]["issue_status"] is None
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        opened = read_tickets(spark, str(path), mapping={"issue_created": "opened"}).select("issue_created")
        assert opened.first()[0] == datetime(2025, 1, 2, 9, 10)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    with pytest.raises(ValueError):
        read_tickets(spark, str(path), mapping={"no_such_column": "x"})


def test_read_parquet_without_some_fields(spark, tmp_path):
    path = str(tmp_path / "tickets")
    tickets(spark, {"csat_score": 3}).select("ticket_id", F.col("csat_score").alias("score")).write.parquet(path)
    row = only(read_tickets(spark, path, "parquet", {"csat_score": "score"}))
    assert (row["csat_score"], row["queue_name"]) == (3, None)


def test_all_kpis_run(spark):
    tables = run_ticket_kpis(tickets(spark, {}), "2024-01-01", "2024-02-01", as_of="2024-01-05")
    assert len(tables) == 12
    assert rows_of(tables["backlog_aging"]) == [{"aging_bucket": "4-7 days", "open_tickets": 1}]


def test_tickets_from_extended_documents(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text(
        '{"ticket_id":"1","opened":{"$date":"2024-11-03T05:30:00Z"},"csat":4.5,"reopen_count":2.0,"sla":{"breached":true}}\n'
        '{"ticket_id":"2","opened":{"$date":"2024-11-03T06:30:00Z"},"csat":5,"reopen_count":1}\n'
        '{"ticket_id":"3","opened":"2024-11-03T12:00:00+05:30"}\n'
        '{"ticket_id":"4","opened":{"$date":{"$numberLong":"1730615400000"}}}\n'
        '{"ticket_id":"5","opened":"2024-11-03 06:30:00"}\n'
    )
    mapping = {"issue_created": "opened", "csat_score": "csat", "first_response_breached": "sla.breached"}
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        rows = {r["ticket_id"]: r for r in rows_of(read_tickets(spark, str(path), mapping=mapping))}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    hours = [str(rows[k]["issue_created"])[11:16] for k in "12345"]
    assert hours == ["05:30", "06:30", "06:30", "06:30", "06:30"]
    assert (rows["1"]["csat_score"], rows["1"]["reopen_count"], rows["1"]["first_response_breached"]) == (4.5, 2, True)
    assert rows["2"]["csat_score"] == 5.0
    with pytest.raises(ValueError, match="lacks"):
        read_tickets(spark, str(path), mapping=mapping | {"queue_name": "quue"})


def test_tickets_from_csv(spark, tmp_path):
    (tmp_path / "t.csv").write_text('ticket_id,issue_created,csat_score,queue_name\n7,2024-01-02T03:04:05Z,4.5,"a ""b"""\n')
    row = only(read_tickets(spark, str(tmp_path / "t.csv"), "csv"))
    assert (row["ticket_id"], str(row["issue_created"]), row["csat_score"], row["queue_name"]) == ("7", "2024-01-02 03:04:05", 4.5, 'a "b"')


def test_bounds_with_an_offset_are_instants(spark):
    t = tickets(spark, {"ticket_id": "a", "issue_created": datetime(2024, 1, 1, 18, 30)}, {"ticket_id": "b", "issue_created": datetime(2024, 1, 1, 18, 29)})
    assert [r["ticket_id"] for r in rows_of(support.ticket_base(t, "2024-01-02T00:00:00+05:30"))] == ["a"]
    assert [r["ticket_id"] for r in rows_of(support.ticket_base(t, None, datetime.fromisoformat("2024-01-01T18:30:00+00:00")))] == ["b"]


def test_stored_kpis_equal_lazy_ones(spark, tmp_path):
    t = tickets(spark, {}, {"issue_priority": "low"})
    lazy, stored = run_ticket_kpis(t, as_of="2024-01-05"), run_ticket_kpis(t, as_of="2024-01-05", work_dir=str(tmp_path))
    assert rows_of(lazy["priority_sla"]) == rows_of(stored["priority_sla"])


def test_all_tables_come_from_one_scan_and_one_shuffle(spark, tmp_path):
    tickets(spark, {}).write.parquet(str(tmp_path / "t"))
    rollup = support.kpi_rollup(spark.read.parquet(str(tmp_path / "t")), "2024-01-01", "2025-01-01", as_of="2024-02-01")
    plan = rollup._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_rollup_equals_the_single_tables(spark):
    rows = [
        {"ticket_id": "1", "assigned_agent": None, "csat_score": 6, "issue_priority": ""},
        {"ticket_id": "2", "assigned_agent": "", "queue_name": None, "issue_status": "Closed", "issue_resolution_date": datetime(2024, 1, 5)},
        {"ticket_id": "3", "deleted_flag": True, "queue_name": "gone", "csat_score": 9},
        {"ticket_id": "4", "issue_created": datetime(2023, 5, 1), "queue_name": "old", "issue_resolution_date": datetime(2023, 1, 1)},
        {"ticket_id": "5", "issue_created": None, "category": None},
        {"ticket_id": "6", "reopen_count": 3, "csat_score": 4, "escalated_flag": True, "first_response_time_minutes": 2.5},
    ]
    for found in (tickets(spark, *rows), tickets(spark, *rows).limit(0)):
        for bounds in ((), ("2024-01-01", "2024-02-01"), ("2030-01-01", None)):
            made = run_ticket_kpis(found, *bounds, as_of="2024-01-20")
            base = support.ticket_base(found, *bounds)
            for name, table in made.items():
                single = support.backlog_aging(found, "2024-01-20") if name == "backlog_aging" else getattr(support, name)(found if name == "data_quality" else base)
                assert rows_of(table) == rows_of(single), (name, bounds)
                assert table.columns == single.columns
