"""Whole builds, stored tables, invariants on the test tables, and plan shapes that matter at scale."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from conftest import make_events, only, rows_of
from pyspark.sql import functions as F

from harness import adapters
from harness.queries import QUERIES
from tidemark.operators import drivers, funnel, quality, star
from tidemark.plans import daily, storage
from tidemark.plans.clickstream import EXPORTED, BuildChecks, build_model, export_model
from tidemark.sources.events import clean_raw_events, malformed_rows, read_events_csv
from tidemark.sources.model import export_parquet, read_model


@pytest.fixture(scope="module")
def model(spark, sf_dir, tmp_path_factory):
    return build_model(adapters.raw_events(spark, sf_dir), str(tmp_path_factory.mktemp("build")))


def test_stored_and_lazy_builds_agree(spark, sf_dir, model):
    lazy = build_model(adapters.raw_events(spark, sf_dir))
    assert set(lazy) == set(model)
    for name in ("fct_session_funnel", "cohort_retention_curve", "dim_product", "daily_event_counts"):
        assert lazy[name].exceptAll(model[name]).count() == 0
        assert model[name].exceptAll(lazy[name]).count() == 0


def test_export_and_read_back(spark, model, tmp_path):
    export_model(model, str(tmp_path))
    back = read_model(spark, str(tmp_path), EXPORTED)
    for name in EXPORTED:
        assert back[name].schema.simpleString() == model[name].schema.simpleString()
        assert back[name].count() == model[name].count()


def test_partitioned_export(spark, model, tmp_path):
    export_parquet({"fact_events": model["fact_events"]}, str(tmp_path), {"fact_events": ["date_key"]})
    back = read_model(spark, str(tmp_path), ["fact_events"])["fact_events"]
    days = model["fact_events"].select("date_key").distinct().count()
    assert len(list((tmp_path / "fact_events").glob("date_key=*"))) == days
    assert back.count() == model["fact_events"].count()


def test_csv_keeps_text_as_is(spark, tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(
        "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n"
        '2019-11-01 00:00:00 UTC,view,1003461,2053013555631882655,electronics.smartphone,"a, b",489.07,520088904,4d3b\n'
        "2019-11-01 00:00:01 UTC,cart,1,2,,,,3,\n"
    )
    rows = rows_of(read_events_csv(spark, str(path)))
    assert rows[0]["category_id"] == "2053013555631882655"
    assert rows[0]["brand"] == "a, b"
    assert rows[1]["category_code"] is None and rows[1]["user_session"] is None


def test_scratch_follows_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = storage.scratch_dir(spark), storage.scratch_dir(spark)
    assert first.startswith(shared) and second.startswith(shared) and first != second


def test_scratch_without_a_shared_folder_lies_in_the_warehouse():
    settings = {"spark.sql.warehouse.dir": "hdfs://w"}
    unset = SimpleNamespace(get=lambda key, *default: settings.get(key, *default))
    assert storage.scratch_dir(SimpleNamespace(conf=unset)).startswith("hdfs://w/scratch/")


def test_csv_goes_by_header_and_doubled_quotes(spark, tmp_path):
    header = "user_id,event_type,event_time,product_id,category_id,category_code,brand,price,user_session"
    (tmp_path / "a.csv").write_text(header + '\n5,view,2019-11-01 00:00:00 UTC,1,2,c,"acme ""pro"", inc",7.0d,s\n6,cart\n')
    (row, short) = rows_of(read_events_csv(spark, str(tmp_path)).orderBy("user_id"))
    assert (row["brand"], row["user_id"], row["event_type"], row["user_session"]) == ('acme "pro", inc', "5", "view", "s")
    assert short["event_type"] == "cart" and [r["row"] for r in rows_of(malformed_rows(spark, str(tmp_path)))] == ["6,cart"]
    assert rows_of(clean_raw_events(read_events_csv(spark, str(tmp_path))).where("user_id = 5"))[0]["price"] is None
    (tmp_path / "b.csv").write_text(header.replace("user_id,event_type", "event_type,user_id") + "\nview,5,t,1,2,c,b,1,s\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_events_csv(spark, str(tmp_path)).collect()


def test_csv_lines_and_missing_columns(spark, tmp_path):
    header = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"
    (tmp_path / "a.csv").write_text(header + '\nt,view,1,2,c,"two\nlines",1,5,s\n')
    assert only(read_events_csv(spark, str(tmp_path), multi_line=True))["brand"] == "two\nlines"
    other = tmp_path / "other"
    other.mkdir()
    (other / "a.csv").write_text("event_time,event_type\nt,view\n")
    with pytest.raises(ValueError, match="lacks"):
        read_events_csv(spark, str(other))


def test_invariants(model):
    sessions = model["fct_session_funnel"]
    categories = model["agg_category_funnel"]
    assert only(quality.qa_revenue(categories))["dedup_within_gross"] is True
    assert {r["retention_rate"] for r in rows_of(quality.qa_day0(model["cohort_retention_curve"]))} == {1.0}
    rates = model["cohort_retention_curve"].where(~F.col("retention_rate").between(0, 1))
    assert rates.count() == 0
    bounds = only(quality.qa_cvr_bounds(drivers.category_cvr(categories)))
    assert bounds["min_v2c"] >= 0
    assert categories.agg(F.sum("sessions")).first()[0] == sessions.count()
    assert sessions.count() == model["dim_session"].count()
    totals = only(funnel.funnel_revenue_totals(sessions))
    assert totals["dedup_total"] <= totals["gross_total"]
    flags = sessions.where((F.col("has_purchase") == 1) != F.col("first_purchase_ts").isNotNull())
    assert flags.count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(plan):
    return plan.count("Exchange hashpartitioning")


def test_session_table_takes_one_scan_and_two_shuffles(spark, sf_dir):
    plan = plan_of(QUERIES["session_funnel"](spark, sf_dir))
    assert plan.count("FileScan") == 1
    assert exchanges(plan) == 2
    assert "Expand" not in plan and "Join" not in plan


def test_category_funnel_takes_one_scan(spark, sf_dir):
    plan = plan_of(QUERIES["category_funnel"](spark, sf_dir))
    # Per product, per (session, user), per session, per category.
    assert plan.count("FileScan") == 1 and exchanges(plan) == 4 and "Join" not in plan


def test_session_tables_need_no_sorting(spark, sf_dir):
    for name in ("session_funnel", "category_funnel", "session_category", "purchase_dedup"):
        assert "SortAggregate" not in plan_of(QUERIES[name](spark, sf_dir)), name


def test_row_integrity_takes_two_scans(spark, sf_dir):
    plan = QUERIES["qa_row_integrity"](spark, sf_dir)._jdf.queryExecution().sparkPlan().toString()
    outer = QUERIES["qa_row_integrity"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert outer.count("Relation [") == 2, plan


def test_executive_kpis_take_one_scan(spark, sf_dir):
    assert plan_of(QUERIES["executive_kpis"](spark, sf_dir)).count("FileScan") == 1


def test_purchase_filter_reaches_the_scan(spark, tmp_path):
    make_events(spark, {"ts": "01"}).write.parquet(str(tmp_path / "e"))
    fact = star.fact_events(spark.read.parquet(str(tmp_path / "e")))
    plan = plan_of(drivers.brand_revenue(fact))
    assert "EqualTo(event_type,purchase)" in plan and "GreaterThan(price,0.0)" in plan
    read = plan.split("ReadSchema:")[1].splitlines()[0]
    assert "product_id" not in read and "event_ts" not in read
    assert "TakeOrderedAndProject" not in plan
    assert "TakeOrderedAndProject" in plan_of(drivers.brand_revenue(fact, 5))


STORED_FIRST = {"read_events_csv", "read_tickets", "read_model_parquet", "export_parquet", "build_clickstream_model"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORED_FIRST))
def test_no_cross_joins_and_no_python_in_plans(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert operator not in plan


def test_hot_session_and_product_give_whole_results(spark):
    n = 30_000
    events = spark.range(n).select(
        F.col("id").alias("event_id"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))).alias("event_ts"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 700).cast("bigint").alias("user_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 700)).alias("session_id"),
        F.element_at(F.array(*map(F.lit, ("view", "cart", "purchase"))), (F.col("id") % 7 % 3 + 1).cast("int")).alias(
            "event_type"
        ),
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(F.col("id") % 11).alias("product_id"),
        F.lit(1).cast("bigint").alias("category_id"),
        F.lit("b").alias("brand"),
        (F.col("id") % 97 + 0.5).alias("price"),
    )
    row = only(funnel.session_funnel(events).where("session_id = 'hot'"))
    local = [(i, i % 7 % 3, i % 50, i % 97 + 0.5) for i in range(0, n, 3)]
    firsts = {}
    for i, kind, product, price in local:
        if kind == 2:
            firsts.setdefault(product, price)
    assert row["view_events"] == sum(1 for r in local if r[1] == 0)
    assert row["distinct_products_purchased"] == len(firsts)
    assert row["session_revenue_dedup_product"] == pytest.approx(sum(firsts.values()))
    assert row["session_revenue_gross"] == pytest.approx(sum(r[3] for r in local if r[1] == 2))


def test_hot_keys_are_split_when_joining_stored_dimensions(spark, tmp_path):
    events = spark.range(400_000).select(
        F.col("id").alias("event_id"),
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("event_ts"),
        F.lit("2024-01-01").cast("date").alias("event_date"),
        F.col("id").alias("user_id"),
        F.lit("s").alias("session_id"),
        F.lit("view").alias("event_type"),
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 2000).cast("bigint").alias("product_id"),
        F.lit(1).cast("bigint").alias("category_id"),
        F.uuid(F.lit(1)).alias("brand"),
        F.rand(1).alias("price"),
    )
    events.repartition(8).write.parquet(str(tmp_path / "events"))
    events = spark.read.parquet(str(tmp_path / "events"))
    products = events.groupBy("product_id").agg(
        F.max("category_id").alias("category_id"), F.max("brand").alias("brand"), F.max("price").alias("median_price")
    )
    products = storage.store(products, str(tmp_path), "products")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = star.star_join(star.fact_events(events), {"dim_product": products})
        sums = joined.agg(F.count(F.lit(1)), F.count("median_price"), F.max("brand"), F.max("price"))
        assert tuple(sums.collect()[0])[:2] == (400_000, 400_000)
        assert "skew=true" in plan_of(sums)
    finally:
        for key in settings:
            spark.conf.unset(key)


# --- the model kept up to date load by load

BOUGHT = {"event_type": "purchase", "session_id": "s1", "user_id": 1}
FIRST = [
    {"ts": "05 10:00:00", **BOUGHT},
    {"ts": "05 10:00:00", "session_id": "s2", "user_id": 2},
    {"ts": "06 09:00:00", **BOUGHT, "session_id": "s3", "price": 7.0},
    {"ts": "06 09:00:00", "event_type": "cart", "session_id": None, "user_id": 3},
]
LATE = [
    {"ts": "07 08:00:00", **BOUGHT, "session_id": "s4"},
    {"ts": "05 09:59:00", "session_id": "s1", "user_id": 1, "category_id": 7},
    {"ts": "04 23:59:00", "session_id": "s2", "user_id": 2},
    {"ts": "03 12:00:00", **BOUGHT, "session_id": "s3", "price": 9.0},
    {"ts": "06 12:00:00", **BOUGHT, "session_id": "s2", "user_id": 2},
]


def numbered(spark, rows):
    events = make_events(spark, *[{**row, "event_id": k} for k, row in rows])
    return events.withColumnRenamed("session_id", "user_session").drop("event_date")


def same_model(spark, directory, raw):
    found, wanted = daily.read_loaded(spark, directory), build_model(raw)
    assert set(found) == set(wanted)
    for name, table in wanted.items():
        columns = table.columns
        assert sorted(map(repr, found[name].select(*columns).collect())) == sorted(map(repr, table.collect())), name


def test_late_events_move_sessions_users_and_cohorts(spark, tmp_path):
    first, late = list(enumerate(FIRST)), list(enumerate(LATE, start=100))
    daily.load(numbered(spark, first), str(tmp_path), "2024-01-06")
    same_model(spark, str(tmp_path), numbered(spark, first))
    daily.load(numbered(spark, late), str(tmp_path), "2024-01-07")
    same_model(spark, str(tmp_path), numbered(spark, first + late))
    moved = {r["user_id"]: str(r["cohort_date"]) for r in rows_of(daily.read_loaded(spark, str(tmp_path))["dim_user_purchase_cohort"])}
    assert moved == {1: "2024-01-03", 2: "2024-01-06"}
    # The same load with other content: days, sessions and cohorts that it brought before are gone again.
    daily.load(numbered(spark, late[:1]), str(tmp_path), "2024-01-07")
    same_model(spark, str(tmp_path), numbered(spark, first + late[:1]))


def test_a_load_writes_what_derives_from_days_once(spark, tmp_path, monkeypatch):
    """In its place, without a copy in the scratch folder before; days that lose their rows still lose their partition."""
    copies, whole = [], storage.store
    for place in (storage, daily):
        monkeypatch.setattr(place, "store", lambda table, directory, name: copies.append(name) or whole(table, directory, name))
    first = list(enumerate([{"ts": "05 10:00:00", "event_type": "purchase"}, {"ts": "06 10:00:00", "session_id": None, "event_type": "purchase"}]))
    daily.load(numbered(spark, first), str(tmp_path), "a")
    same_model(spark, str(tmp_path), numbered(spark, first))
    assert not {*copies} & {"cleaned", *daily._BY_DAY}
    again = [(0, {"ts": "05 10:00:00"}), first[1]]
    daily.load(numbered(spark, again), str(tmp_path), "a")
    same_model(spark, str(tmp_path), numbered(spark, again))
    assert not {*copies} & {"cleaned", *daily._BY_DAY}
    assert not (tmp_path / "step_days" / "event_date=2024-01-06").exists() and not (tmp_path / "brand_days" / "event_date=2024-01-05").exists()


def test_load_without_purchases_and_untouched_days(spark, tmp_path):
    first = list(enumerate([{"ts": "05 10:00:00"}, {"ts": "06 10:00:00", "session_id": "t", "user_id": 2}]))
    daily.load(numbered(spark, first), str(tmp_path), "a")
    assert daily.read_loaded(spark, str(tmp_path))["fct_cohort_activity"].count() == 0
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "step_days" / "event_date=2024-01-05").glob("*.parquet")}
    later = list(enumerate([{"ts": "06 11:00:00", "session_id": "t", "user_id": 2, "event_type": "purchase"}], start=9))
    daily.load(numbered(spark, later), str(tmp_path), "b", lookback=1)
    same_model(spark, str(tmp_path), numbered(spark, first + later))
    assert files == {p: p.stat().st_mtime_ns for p in (tmp_path / "step_days" / "event_date=2024-01-05").glob("*.parquet")}
    with pytest.raises(ValueError, match="name"):
        daily.load(numbered(spark, later), str(tmp_path), "a/b")


def test_whole_build_checks_do_not_depend_on_partitions(spark, sf_dir):
    found = []
    for partitions in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        found.append(sorted(QUERIES["build_clickstream_model"](spark, sf_dir).collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert found[0] == found[1]


def test_scratch_refuses_a_folder_of_the_driver_on_a_cluster():
    settings = {"spark.sql.warehouse.dir": "file:/w", "spark.master": "spark://far:7077"}
    far = SimpleNamespace(conf=SimpleNamespace(get=lambda key, *default: settings.get(key, *default)))
    with pytest.raises(ValueError, match="checkpoint"):
        storage.scratch_dir(far)


def test_checks_during_the_build_cost_no_scan_and_show_faults(spark, tmp_path):
    rows = [{"ts": "05 10:00:00"}, {"ts": "05 11:00:00", "product_id": None, "category_id": None, "event_type": None}, {"ts": "06 11:00:00", "user_id": None}]
    raw = numbered(spark, list(enumerate(rows))).select("*")
    checks = BuildChecks()
    build_model(raw, str(tmp_path / "b"), checks=checks)
    tables = checks.tables()
    assert only(tables["qa_null_keys"]) == {"null_user_id": 0, "null_event_ts": 0, "null_event_type": 1, "null_product_id": 1, "null_category_id": 1}
    assert only(tables["qa_row_integrity"]) == {"raw_rows": 3, "fact_rows": 2, "sessions_dim": 1, "sessions_distinct_raw": 1}
    assert only(tables["qa_revenue"])["dedup_within_gross"] is None
    scans = [line for table in tables.values() for line in plan_of(table).splitlines() if "FileScan" in line]
    assert scans and all("session_rows" in line or "session_id" in line for line in scans)
    assert not any("event_ts" in line or "price" in line for line in scans)
    with pytest.raises(ValueError, match="work_dir"):
        build_model(raw, checks=BuildChecks())


def test_stored_star_is_joined_without_moving_the_fact(spark, tmp_path):
    many = [{"ts": f"05 10:{k % 60:02}:00", "product_id": 1 if k % 3 else k, "session_id": "hot" if k % 2 else f"s{k % 9}", "user_id": k % 2} for k in range(600)]
    odd = [{"ts": "05 11:00:00", "session_id": None}, {"ts": "05 11:00:00", "product_id": None, "category_id": None, "price": None}]
    raw = numbered(spark, list(enumerate(many + odd)))
    model = build_model(raw, str(tmp_path / "m"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    stored = star.stored_star(model["fact_events"], model, str(tmp_path / "s"), buckets=5, most=50)
    hot = stored["fact"].where("session_id = 'hot'")
    assert hot.select("part").distinct().count() == 6 and not spark.catalog.listTables()
    plain = star.star_join(model["fact_events"], model)
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = star.star_join_stored({**stored, "dim_date": F.broadcast(stored["dim_date"]), "dim_category": F.broadcast(stored["dim_category"])})
        assert "Exchange hashpartitioning" not in plan_of(joined) and "Bucketed: true" in plan_of(joined)
    finally:
        for key in settings:
            spark.conf.unset(key)
    columns = sorted(plain.columns)
    assert sorted(joined.columns) == columns
    assert sorted(map(repr, joined.select(columns).collect())) == sorted(map(repr, plain.select(columns).collect()))
