"""Check SQL for DuckDB: plain formulations over the whole given tables, one per registered query."""

from __future__ import annotations

from harness.queries import AS_OF, BRANDS, CUT_DAY, PLACES, RANGE, SHORT_DAYS
from tidemark.plans.clickstream import EXPORTED

STEPS = ("view", "cart", "purchase")

# --- common table expressions -------------------------------------------------------------------------------------

CLICKS = """
keyed AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
),
filed AS (
  SELECT *, CASE WHEN event_id % 5 = 0 THEN (k + 1) % 10 ELSE k % 10 END AS category_id FROM keyed
),
clicks AS (
  SELECT event_id,
         ts AS event_ts,
         CAST(ts AS DATE) AS event_date,
         CASE event_type WHEN 'click' THEN 'cart' ELSE event_type END AS event_type,
         k AS product_id,
         category_id,
         CASE WHEN category_id = 3 OR event_id % 2 = 1 THEN NULL
              WHEN event_id % 3 = 0 THEN 'cat.' || category_id || '.alt'
              ELSE 'cat.' || category_id END AS category_code,
         CASE WHEN event_id % 7 <> 0 THEN 'brand_' || ((k + event_id % 3) % 13) END AS brand,
         CASE WHEN event_id % 50 = 0 THEN -value ELSE value END AS price,
         user_id,
         CASE WHEN event_id % 500 <> 0 THEN user_id || '-' || CAST(ts AS DATE) END AS session_id
  FROM filed
)"""

PAID = "event_type = 'purchase' AND price > 0"

DEDUP = f"""
ranked AS (
  SELECT session_id, user_id, product_id, event_ts, price,
         row_number() OVER (PARTITION BY session_id, user_id, product_id ORDER BY event_ts, event_id) AS nth
  FROM clicks WHERE session_id IS NOT NULL AND {PAID}
),
firsts AS (
  SELECT session_id, user_id, product_id, event_ts AS first_purchase_ts, price AS first_purchase_price
  FROM ranked WHERE nth = 1
),
earned AS (
  SELECT session_id, user_id, sum(first_purchase_price) AS revenue FROM firsts GROUP BY ALL
)"""

STEP_AGG = f"""
visits AS (
  SELECT session_id, user_id,
         min(event_ts) AS session_start_ts,
         max(event_ts) AS session_end_ts,
         date_diff('second', min(event_ts), max(event_ts)) AS session_duration_sec,
         {", ".join(f"min(CASE WHEN event_type = '{s}' THEN event_ts END) AS first_{s}_ts" for s in STEPS)},
         {", ".join(f"count(CASE WHEN event_type = '{s}' THEN 1 END) AS {s}_events" for s in STEPS)},
         {", ".join(
             f"count(DISTINCT CASE WHEN event_type = '{s}' THEN product_id END) AS distinct_products_{name}"
             for s, name in zip(STEPS, ("viewed", "carted", "purchased")))},
         {", ".join(f"CAST(bool_or(event_type = '{s}') AS INTEGER) AS has_{s}" for s in STEPS)},
         sum(CASE WHEN {PAID} THEN price END) AS session_revenue_gross
  FROM clicks WHERE session_id IS NOT NULL GROUP BY session_id, user_id
)"""


def _funnel_cte(ordered_only: bool = False) -> str:
    def gap(a: str, b: str) -> str:
        delta = f"date_diff('second', first_{a}_ts, first_{b}_ts)"
        shown = f"CASE WHEN {delta} >= 0 THEN {delta} END" if ordered_only else delta
        return f"{shown} AS time_{a}_to_{b}_sec"

    return f"""
funnel AS (
  SELECT v.*,
         coalesce(e.revenue, 0) AS session_revenue_dedup_product,
         coalesce(e.revenue, 0) / nullif(distinct_products_purchased, 0) AS aov_session_proxy,
         {gap("view", "cart")}, {gap("view", "purchase")}, {gap("cart", "purchase")}
  FROM visits v LEFT JOIN earned e USING (session_id, user_id)
)"""


FUNNEL = f"{CLICKS}, {DEDUP}, {STEP_AGG}, {_funnel_cte()}"

RATES = """
  cart_sessions / nullif(CAST(view_sessions AS DOUBLE), 0) AS view_to_cart_cvr,
  purchase_sessions / nullif(CAST(cart_sessions AS DOUBLE), 0) AS cart_to_purchase_cvr,
  purchase_sessions / nullif(CAST(view_sessions AS DOUBLE), 0) AS view_to_purchase_cvr"""
CVRS = ("view_to_cart_cvr", "cart_to_purchase_cvr", "view_to_purchase_cvr")

FUNNEL_SUMS = ", ".join(f"CAST(sum(has_{s}) AS BIGINT) AS {s}_sessions" for s in STEPS)

CATEGORIES = f"""{FUNNEL},
placed AS (
  SELECT session_id, category_id FROM clicks WHERE session_id IS NOT NULL AND category_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY event_ts, event_id) = 1
),
per_category AS (
  SELECT category_id, count(*) AS sessions, {FUNNEL_SUMS},
         sum(session_revenue_dedup_product) AS revenue_dedup,
         sum(session_revenue_gross) AS revenue_gross
  FROM funnel JOIN placed USING (session_id) GROUP BY category_id
),
rated AS (SELECT *, {RATES} FROM per_category)"""

ACTIVITY = f"""{CLICKS},
buys AS (
  SELECT user_id, event_date AS purchase_date, count(*) AS purchase_events, sum(price) AS revenue_gross
  FROM clicks WHERE {PAID} GROUP BY ALL
),
starts AS (SELECT user_id, min(purchase_date) AS cohort_date FROM buys GROUP BY user_id),
activity AS (
  SELECT user_id, cohort_date, purchase_date, CAST(purchase_date - cohort_date AS INTEGER) AS days_since,
         purchase_events, revenue_gross
  FROM buys JOIN starts USING (user_id)
)"""


def _retention(source: str, day: str, days: tuple[int, ...] = (1, 7, 30)) -> str:
    kept = ", ".join(
        f"count(DISTINCT CASE WHEN days_since = {n} THEN user_id END) AS retained_d{n}_users" for n in days
    )
    rates = ", ".join(
        f"CASE WHEN cohort_date + {n} <= (SELECT max({day}) FROM {source})"
        f" THEN retained_d{n}_users / CAST(cohort_size AS DOUBLE) END AS retention_d{n}"
        for n in days
    )
    return f"""
sized AS (
  SELECT cohort_date, count(DISTINCT user_id) AS cohort_size, {kept} FROM {source} GROUP BY cohort_date
),
summary AS (SELECT *, {rates} FROM sized)"""


SUMMARY = f"{ACTIVITY}, {_retention('activity', 'purchase_date')}"

CURVE = f"""{SUMMARY},
curve AS (
  SELECT a.cohort_date, a.days_since, count(DISTINCT a.user_id) AS active_users,
         count(DISTINCT a.user_id) / CAST(any_value(s.cohort_size) AS DOUBLE) AS retention_rate
  FROM activity a JOIN summary s USING (cohort_date)
  WHERE a.days_since BETWEEN 0 AND 30
  GROUP BY a.cohort_date, a.days_since
),
weighted AS (
  SELECT days_since, CAST(sum(active_users) AS BIGINT) AS active_users,
         CAST(sum(cohort_size) AS BIGINT) AS cohort_users,
         sum(active_users) / CAST(sum(cohort_size) AS DOUBLE) AS retention_weighted
  FROM curve JOIN summary USING (cohort_date) GROUP BY days_since
)"""


def _user_days(first: str) -> str:
    return f"""{CLICKS},
begun AS (SELECT user_id, min(event_date) AS cohort_date FROM clicks WHERE {first} GROUP BY user_id),
seen AS (
  SELECT DISTINCT user_id, cohort_date, event_date, event_date - cohort_date AS days_since
  FROM clicks JOIN begun USING (user_id)
), {_retention("seen", "event_date")}"""


DAILY = f"""{CLICKS},
daily AS (SELECT event_date, event_type, count(*) AS events FROM clicks GROUP BY ALL),
wide AS (
  SELECT event_date, CAST(sum(events) AS BIGINT) AS total_events,
         {", ".join(f"CAST(sum(CASE WHEN event_type = '{s}' THEN events END) AS BIGINT) AS {s}_events"
                    for s in STEPS)}
  FROM daily GROUP BY event_date
),
peak AS (
  SELECT event_date AS peak_view_date, view_events AS peak_view_events FROM wide
  WHERE view_events IS NOT NULL ORDER BY view_events DESC, event_date DESC LIMIT 1
)"""

CATEGORY_DIM = f"""{CLICKS},
codes AS (
  SELECT category_id, category_code, count(*) AS n FROM clicks WHERE category_code IS NOT NULL
  GROUP BY category_id, category_code
  QUALIFY row_number() OVER (PARTITION BY category_id ORDER BY n DESC, category_code DESC) = 1
),
dim_category AS (
  SELECT category_id, category_code FROM (SELECT DISTINCT category_id FROM clicks) LEFT JOIN codes USING (category_id)
)"""

PRODUCT_DIM = """
top_category AS (
  SELECT product_id, category_id, count(*) AS n FROM clicks WHERE category_id IS NOT NULL GROUP BY product_id, category_id
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY n DESC, category_id DESC) = 1
),
top_brand AS (
  SELECT product_id, brand, count(*) AS n FROM clicks WHERE brand IS NOT NULL GROUP BY product_id, brand
  QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY n DESC, brand DESC) = 1
),
dim_product AS (
  SELECT p.product_id, c.category_id, b.brand, p.median_price
  FROM (SELECT product_id, quantile_cont(price, 0.5) AS median_price FROM clicks GROUP BY product_id) p
  LEFT JOIN top_category c USING (product_id) LEFT JOIN top_brand b USING (product_id)
)"""

DATE_DIM = """
dim_date AS (
  SELECT DISTINCT event_date AS date_key,
         CAST(year(event_date) AS INTEGER) AS year,
         CAST(month(event_date) AS INTEGER) AS month,
         CAST(day(event_date) AS INTEGER) AS day,
         CAST(dayofweek(event_date) AS INTEGER) AS day_of_week,
         dayofweek(event_date) IN (0, 6) AS is_weekend,
         monthname(event_date) AS month_name,
         CAST(week(event_date) AS INTEGER) AS week,
         CAST(quarter(event_date) AS INTEGER) AS quarter
  FROM clicks
)"""

USER_DIM = """
dim_user AS (
  SELECT user_id, min(event_ts) AS first_seen_ts, max(event_ts) AS last_seen_ts FROM clicks GROUP BY user_id
)"""

SESSION_DIM = """
dim_session AS (
  SELECT session_id, user_id, min(event_ts) AS session_start_ts, max(event_ts) AS session_end_ts,
         date_diff('second', min(event_ts), max(event_ts)) AS session_duration_seconds
  FROM clicks WHERE session_id IS NOT NULL GROUP BY session_id, user_id
)"""

RAW_TEXT = f"""{CLICKS},
raw_text AS (
  SELECT event_id,
         CASE WHEN event_id % 11 = 0 THEN strftime(event_ts, '%Y-%m-%d %H:%M:%S.%f')
              ELSE strftime(event_ts, '%Y-%m-%d %H:%M:%S') || ' UTC' END AS event_time,
         upper(event_type) AS event_type,
         CASE WHEN event_id % 97 = 0 THEN '1.5e18' ELSE CAST(product_id AS VARCHAR) END AS product_id,
         CAST(category_id AS VARCHAR) AS category_id,
         category_code, brand,
         CASE WHEN event_id % 101 = 0 THEN 'n/a' ELSE CAST(price AS VARCHAR) END AS price,
         CASE WHEN event_id % 103 = 0 THEN '?' ELSE CAST(user_id AS VARCHAR) END AS user_id,
         session_id AS user_session
  FROM clicks
)"""

TICKETS = """
shipped AS (SELECT l_orderkey AS o_orderkey, max(l_shipdate) AS resolved FROM lineitem GROUP BY l_orderkey),
tickets AS (
  SELECT o_orderkey AS ticket_id,
         CASE WHEN o_orderkey % 401 <> 0 THEN o_orderdate END AS issue_created,
         resolved AS issue_resolution_date,
         CASE WHEN o_orderkey % 211 = 0 THEN NULL
              WHEN o_orderstatus = 'F' THEN if(o_orderkey % 2 = 0, 'Resolved', 'Closed')
              WHEN o_orderstatus = 'O' THEN if(o_orderkey % 2 = 0, 'Open', 'In Progress')
              ELSE if(o_orderkey % 2 = 0, 'Pending', 'Reopened') END AS issue_status,
         if(o_orderkey % 307 = 0, '', o_orderpriority) AS issue_priority,
         c_mktsegment AS queue_name,
         'cat_' || (o_orderkey % 5) AS category,
         'sub_' || (o_orderkey % 15) AS subcategory,
         CASE WHEN o_orderkey % 101 <> 0 THEN 'agent_' || (o_custkey % 20) END AS assigned_agent,
         CASE o_orderkey % 4 WHEN 0 THEN 'Email' WHEN 1 THEN 'Chat' WHEN 2 THEN 'Phone' ELSE 'Web' END AS channel,
         CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderkey % 97 AS DOUBLE) END AS first_response_time_minutes,
         CASE WHEN resolved IS NOT NULL THEN CAST(o_orderkey % 4001 AS DOUBLE) END AS resolution_time_minutes,
         CASE WHEN o_orderkey % 17 <> 0 THEN o_orderkey % 97 > 30 END AS first_response_breached,
         CASE WHEN o_orderkey % 19 <> 0 THEN o_orderkey % 4001 > 1440 END AS resolution_sla_breached,
         CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 3 END AS reopen_count,
         CASE WHEN o_orderkey % 8 <> 7 THEN o_orderkey % 8 END AS csat_score,
         o_orderkey % 11 = 0 AS escalated_flag,
         CASE WHEN o_orderkey % 50 = 0 THEN TRUE WHEN o_orderkey % 3 = 0 THEN FALSE END AS deleted_flag
  FROM orders LEFT JOIN shipped USING (o_orderkey) LEFT JOIN customer ON c_custkey = o_custkey
),
live AS (SELECT * FROM tickets WHERE deleted_flag IS NOT TRUE),
marked AS (
  SELECT *,
         coalesce(issue_status IN ('Open', 'Pending', 'In Progress', 'Reopened'), FALSE) AS is_open,
         coalesce(issue_status IN ('Resolved', 'Closed'), FALSE) AS is_closed,
         strftime(issue_created, '%Y-%m-%d') AS created_day,
         strftime(issue_resolution_date, '%Y-%m-%d') AS resolved_day,
         CASE WHEN csat_score >= 1 AND csat_score <= 5 THEN csat_score END AS good_csat
  FROM live
)"""

IN_RANGE = f"issue_created >= TIMESTAMP '{RANGE[0]}' AND issue_created < TIMESTAMP '{RANGE[1]}'"

MEAN_TIMES = """avg(first_response_time_minutes) AS avg_first_response_minutes,
         avg(resolution_time_minutes) AS avg_resolution_minutes"""
TIMES = ("avg_first_response_minutes", "avg_resolution_minutes")


def _pct(num: str, den: str, name: str) -> str:
    return f"round_even(CASE WHEN {den} > 0 THEN {num} / CAST({den} AS DOUBLE) ELSE 0 END * 100, 2) AS {name}"


def _breaches(first: str, resolution: str) -> str:
    return (
        f"count(CASE WHEN first_response_breached THEN 1 END) AS {first},"
        f" count(CASE WHEN resolution_sla_breached THEN 1 END) AS {resolution}"
    )


def _breach_rates(first: str, resolution: str, den: str) -> str:
    return (
        f"{_pct(first, den, 'first_response_breach_rate_pct')},"
        f" {_pct(resolution, den, 'resolution_breach_rate_pct')}"
    )


REOPENS = "CAST(coalesce(sum(reopen_count), 0) AS BIGINT) AS total_reopens"
SLA = ("first_response_breaches", "resolution_breaches")
SLA_LONG = ("first_response_sla_breaches", "resolution_sla_breaches")
SLA_DAILY = ("first_response_sla_breaches", "resolution_sla_breaches_on_created_tickets")

DAY_FLOW = f"""{TICKETS},
came AS (
  SELECT created_day AS day, count(*) AS tickets_created,
         avg(first_response_time_minutes) AS avg_first_response_minutes,
         avg(resolution_time_minutes) AS avg_resolution_minutes_for_created_tickets,
         {_breaches(*SLA_DAILY)}, {REOPENS}, avg(good_csat) AS avg_csat
  FROM marked GROUP BY created_day
),
went AS (
  SELECT resolved_day AS day, count(*) AS tickets_resolved FROM marked WHERE resolved_day IS NOT NULL GROUP BY ALL
)"""
DAY_DOUBLES = ("avg_first_response_minutes", "avg_resolution_minutes_for_created_tickets", "avg_csat")


def _query(ctes: str, select: str, doubles: tuple[str, ...] = ()) -> str:
    """``select`` over ``ctes`` with the named double columns rounded for comparison."""
    rounded = ", ".join(f"round({name}, {PLACES}) AS {name}" for name in doubles)
    shown = f"* REPLACE ({rounded})" if rounded else "*"
    return f"WITH {ctes.strip()}\nSELECT {shown} FROM (\n{select}\n) AS result"


def _content(tables: dict[str, str]) -> str:
    """For every column of every table: how many values it has and the sum of those that are numbers, added as decimals."""
    parts = [
        f"""SELECT '{name}' AS table_name, column_name, filled, CAST(total AS VARCHAR) AS total
FROM (SELECT count(COLUMNS('(.*)')) AS "\\1" FROM ({rows})) UNPIVOT (filled FOR column_name IN (*))
JOIN (SELECT * FROM (SELECT sum(TRY_CAST(CAST(COLUMNS('(.*)') AS VARCHAR) AS DECIMAL(38,6))) AS "\\1" FROM ({rows}))
  UNPIVOT INCLUDE NULLS (total FOR column_name IN (*))) USING (column_name)"""
        for name, rows in tables.items()
    ]
    return "\nUNION ALL\n".join(parts)


# Which registered query gives a table of the whole builds.
_MODEL_TABLES = {
    "fct_session_funnel": "session_funnel",
    "cohort_retention_summary": "cohort_retention_summary",
    "cohort_retention_curve": "cohort_retention_curve",
    "agg_category_funnel": "category_funnel",
    "agg_brand_revenue": "brand_revenue",
    "daily_event_counts": "daily_event_counts",
    "fact_events": "fact_events",
    "dim_date": "dim_date",
    "dim_user": "dim_user",
    "dim_category": "dim_category",
    "dim_product": "dim_product",
    "dim_session": "dim_session",
    "fct_user_daily_purchases": "user_daily_purchases",
    "dim_user_purchase_cohort": "user_purchase_cohort",
    "fct_cohort_activity": "cohort_activity",
}
_KPI_TABLES = (
    "executive_summary daily_created daily_resolved backlog_snapshot daily_kpis queue_performance agent_performance "
    "priority_sla channel_analysis category_pain_points backlog_aging data_quality"
).split()
_AGE = f"date_diff('day', CAST(issue_created AS DATE), DATE '{AS_OF}')"
_AGED = f"""{TICKETS},
aged AS (
  SELECT CASE WHEN issue_created IS NULL OR {_AGE} <= 1 THEN '0-1 days'
              WHEN {_AGE} <= 3 THEN '2-3 days'
              WHEN {_AGE} <= 7 THEN '4-7 days'
              WHEN {_AGE} <= 14 THEN '8-14 days'
              WHEN {_AGE} <= 30 THEN '15-30 days'
              ELSE '30+ days' END AS aging_bucket
  FROM marked WHERE is_open
)"""

# The ticket KPIs of a date range read the live tickets of that range.
_LIVE = "WHERE deleted_flag IS NOT TRUE"
_RETURNS = """
returned AS (
  SELECT cohort_date, user_id, min(CASE WHEN days_since > 0 THEN days_since END) AS back
  FROM activity GROUP BY ALL
)"""

# The text columns as written: blanks and all, and some brands with quotes, commas and backslashes; empty fields are NULL.
_WRITTEN = """SELECT event_time, '  ' || event_type || ' ' AS event_type, product_id, category_id,
       coalesce(category_code, ' ') AS category_code,
       CASE WHEN event_id % 10 = 0 THEN 'a "' || coalesce(brand, '') || '", \\ inc' ELSE brand END AS brand,
       price, user_id, user_session
FROM raw_text"""
_BRANDS = f"""SELECT brand, count(DISTINCT session_id) AS purchase_sessions, sum(price) AS revenue_gross,
       avg(price) AS avg_item_price
FROM clicks WHERE {PAID} AND brand IS NOT NULL GROUP BY brand"""
_SUMMARY_RATES = ("retention_d1", "retention_d7", "retention_d30")
_FUNNEL_DOUBLES = ("session_revenue_gross", "session_revenue_dedup_product", "aov_session_proxy")


def _star_joined() -> str:
    ctes = f"{CATEGORY_DIM}, {PRODUCT_DIM}, {DATE_DIM}, {USER_DIM}, {SESSION_DIM}"
    return _query(
        ctes,
        """
SELECT e.event_id, e.event_ts, e.event_date AS date_key, e.user_id, e.session_id, e.event_type, e.product_id,
       e.category_id, e.brand, e.price,
       d.year, d.month, d.day, d.day_of_week, d.is_weekend, d.month_name, d.week, d.quarter,
       c.category_code, coalesce(c.category_code, 'cat_' || c.category_id) AS category_label,
       p.category_id AS product_category_id, p.brand AS product_brand, p.median_price,
       u.first_seen_ts, u.last_seen_ts, s.session_start_ts, s.session_end_ts, s.session_duration_seconds
FROM clicks e
LEFT JOIN dim_date d ON d.date_key = e.event_date
LEFT JOIN dim_category c ON c.category_id = e.category_id
LEFT JOIN dim_product p ON p.product_id = e.product_id
LEFT JOIN dim_user u ON u.user_id = e.user_id
LEFT JOIN dim_session s ON s.session_id = e.session_id AND s.user_id = e.user_id""",
        ("price", "median_price"),
    )


def _kpis(by: str = "") -> str:
    """Executive KPIs, overall or per brand or week."""
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return _query(
        f"""{CLICKS}, dated AS (SELECT *, CAST(date_trunc('week', event_date) AS DATE) AS week FROM clicks), n AS (
  SELECT {key}count(DISTINCT session_id) AS sessions, count(DISTINCT user_id) AS users,
         count(CASE WHEN event_type = 'purchase' THEN 1 END) AS purchases,
         sum(CASE WHEN {PAID} THEN price END) AS revenue,
         {", ".join(f"count(DISTINCT CASE WHEN event_type = '{s}' THEN session_id END) AS {s}_visits" for s in STEPS)}
  FROM dated {group})""",
        f"""SELECT {key}n.sessions, n.users, n.purchases, n.revenue,
       purchase_visits / CAST(nullif(sessions, 0) AS DOUBLE) AS session_to_purchase,
       cart_visits / CAST(nullif(view_visits, 0) AS DOUBLE) AS add_to_cart_rate,
       purchase_visits / CAST(nullif(cart_visits, 0) AS DOUBLE) AS cart_to_purchase,
       revenue / nullif(purchases, 0) AS aov, revenue / nullif(users, 0) AS arpu FROM n""",
        ("revenue", "session_to_purchase", "add_to_cart_rate", "cart_to_purchase", "aov", "arpu"),
    )


def _cards(by: str = "", name: str = "") -> str:
    key, group = (f"{by} AS {name}, ", "GROUP BY ALL") if by else ("", "")
    return _query(
        f"""{SUMMARY}, cards AS (
  SELECT {key}CAST(sum(cohort_size) AS BIGINT) AS total_purchasers,
         CAST(sum(retained_d1_users) AS BIGINT) AS d1_retained_users,
         CAST(sum(retained_d7_users) AS BIGINT) AS d7_retained_users FROM summary {group})""",
        """SELECT *, d1_retained_users / nullif(CAST(total_purchasers AS DOUBLE), 0) AS d1_retention_weighted,
       d7_retained_users / nullif(CAST(total_purchasers AS DOUBLE), 0) AS d7_retention_weighted FROM cards""",
        ("d1_retention_weighted", "d7_retention_weighted"),
    )


def _revenue_totals(by: str = "", name: str = "") -> str:
    key, group = (f"{by} AS {name}, ", "GROUP BY ALL") if by else ("", "")
    return _query(
        f"""{FUNNEL}, sums AS (
  SELECT {key}sum(session_revenue_gross) AS gross_total, sum(session_revenue_dedup_product) AS dedup_total FROM funnel {group})""",
        "SELECT *, (gross_total / nullif(dedup_total, 0) - 1) * 100 AS inflation_pct FROM sums",
        ("gross_total", "dedup_total", "inflation_pct"),
    )


def _moving_average(keys: str) -> str:
    by = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys} " if keys else ""
    return _query(
        f"{DAILY}, per_day AS (SELECT {by}event_date, CAST(sum(events) AS BIGINT) AS events FROM daily GROUP BY ALL)",
        f"""SELECT {by}event_date, events,
       avg(events) OVER ({part}ORDER BY event_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)
         AS events_7d_ma
FROM per_day""",
        ("events_7d_ma",),
    )


def sql() -> dict[str, str]:
    """Check SQL of every registered query; that of whole builds reads the SQL of their tables."""
    found = _tables()
    return found | {
        "qa_during_build": _content({name: found[name] for name in ("qa_null_keys", "qa_row_integrity", "qa_revenue")}),
        "star_join_stored": found["star_join"],
        "repurchase_within_bitmaps": found["repurchase_within"],
        "export_parquet": _content({name: found[_MODEL_TABLES[name]] for name in EXPORTED}),
        "build_clickstream_model": _content({name: found[key] for name, key in _MODEL_TABLES.items()}),
        "load_clickstream_daily": _content({name: found[key] for name, key in _MODEL_TABLES.items()}),
        "run_all_ticket_kpis": _content(
            {
                name: found[f"ticket_{name}"]
                if name in ("backlog_aging", "data_quality")
                else found[f"ticket_{name}"].replace(_LIVE, f"{_LIVE} AND {IN_RANGE}")
                for name in _KPI_TABLES
            }
        ),
    }


def _tables() -> dict[str, str]:
    clicks = f"{CLICKS}"
    heat = ", ".join(f"max(CASE WHEN days_since = {n} THEN retention_rate END) AS day_{n}" for n in range(31))
    curve_columns = "days_since, active_users, cohort_users, retention_weighted"
    return {
        # sources, sinks, whole builds
        "read_events_csv": _query(RAW_TEXT, _WRITTEN),
        "clean_raw_events": _query(
            clicks,
            """
SELECT CASE WHEN event_id % 11 = 0 THEN event_ts ELSE date_trunc('second', event_ts) END AS event_ts,
       event_type,
       CASE WHEN event_id % 97 = 0 THEN 1500000000000000000 ELSE product_id END AS product_id,
       category_id, category_code, brand,
       CASE WHEN event_id % 101 <> 0 THEN price END AS price,
       CASE WHEN event_id % 103 <> 0 THEN user_id END AS user_id,
       session_id AS user_session
FROM clicks""",
            ("price",),
        ),
        "events_clean": _query(clicks, "SELECT * FROM clicks", ("price",)),
        "read_model_parquet": _query(CATEGORIES, "SELECT * FROM per_category", ("revenue_dedup", "revenue_gross")),
        "read_tickets": _query(TICKETS, "SELECT * REPLACE (CAST(ticket_id AS VARCHAR) AS ticket_id, CAST(csat_score + 0.5 AS DOUBLE) AS csat_score) FROM tickets"),
        "read_ticket_documents": _query(
            TICKETS, "SELECT * REPLACE (CAST(ticket_id AS VARCHAR) AS ticket_id, CAST(csat_score AS DOUBLE) AS csat_score) FROM tickets"
        ),
        # star schema
        "dim_date": _query(f"{clicks}, {DATE_DIM}", "SELECT * FROM dim_date"),
        "dim_user": _query(f"{clicks}, {USER_DIM}", "SELECT * FROM dim_user"),
        "dim_category": _query(CATEGORY_DIM, "SELECT * FROM dim_category"),
        "category_label": _query(
            CATEGORY_DIM,
            "SELECT *, coalesce(category_code, 'cat_' || category_id) AS category_label FROM dim_category",
        ),
        "dim_product": _query(f"{clicks}, {PRODUCT_DIM}", "SELECT * FROM dim_product", ("median_price",)),
        "dim_session": _query(f"{clicks}, {SESSION_DIM}", "SELECT * FROM dim_session"),
        "fact_events": _query(
            clicks,
            """SELECT event_id, event_ts, event_date AS date_key, user_id, session_id, event_type, product_id,
       category_id, brand, price FROM clicks""",
            ("price",),
        ),
        "star_join": _star_joined(),
        "dim_days": _query(
            CURVE,
            """SELECT CAST(d AS INTEGER) AS day, active_users, cohort_users, retention_weighted
FROM generate_series(0, 30) AS axis(d) LEFT JOIN weighted ON days_since = d""",
            ("retention_weighted",),
        ),
        # session funnel
        "session_step_agg": _query(f"{clicks}, {STEP_AGG}", "SELECT * FROM visits", ("session_revenue_gross",)),
        "purchase_dedup": _query(f"{clicks}, {DEDUP}", "SELECT * FROM firsts", ("first_purchase_price",)),
        "session_dedup_revenue": _query(
            f"{clicks}, {DEDUP}",
            "SELECT session_id, user_id, revenue AS session_revenue_dedup_product FROM earned",
            ("session_revenue_dedup_product",),
        ),
        "session_funnel": _query(FUNNEL, "SELECT * FROM funnel", _FUNNEL_DOUBLES),
        "session_funnel_ordered": _query(
            f"{clicks}, {DEDUP}, {STEP_AGG}, {_funnel_cte(ordered_only=True)}",
            "SELECT * FROM funnel",
            _FUNNEL_DOUBLES,
        ),
        "funnel_summary": _query(
            f"{FUNNEL}, counted AS (SELECT count(*) AS sessions, {FUNNEL_SUMS} FROM funnel)",
            f"SELECT *, {RATES} FROM counted",
            CVRS,
        ),
        "funnel_summary_by_cart": _query(
            f"{FUNNEL}, counted AS (SELECT has_cart, count(*) AS sessions, {FUNNEL_SUMS} FROM funnel GROUP BY has_cart)",
            f"SELECT *, {RATES} FROM counted",
            CVRS,
        ),
        "daily_session_cvr": _query(
            f"""{FUNNEL}, counted AS (
  SELECT CAST(session_start_ts AS DATE) AS event_date, count(*) AS sessions, {FUNNEL_SUMS} FROM funnel GROUP BY ALL
)""",
            f"SELECT *, {RATES} FROM counted",
            CVRS,
        ),
        "category_funnel_labelled": _query(
            f"{CATEGORIES}, {CATEGORY_DIM.removeprefix(CLICKS).lstrip(',')}",
            """SELECT *, coalesce(category_code, 'cat_' || category_id) AS category_label
FROM per_category LEFT JOIN dim_category USING (category_id)""",
            ("revenue_dedup", "revenue_gross"),
        ),
        "daily_events_on_calendar": _query(
            f"{DAILY}, {DATE_DIM}",
            "SELECT daily.*, dim_date.* EXCLUDE (date_key) FROM daily LEFT JOIN dim_date ON event_date = date_key",
        ),
        "funnel_skip_steps": _query(
            f"""{FUNNEL}, skips AS (
  SELECT count(*) AS purchase_sessions,
         count(CASE WHEN has_view = 0 THEN 1 END) AS purchase_no_view,
         count(CASE WHEN has_cart = 0 THEN 1 END) AS purchase_no_cart
  FROM funnel WHERE has_purchase = 1)""",
            """SELECT *, purchase_no_view / nullif(CAST(purchase_sessions AS DOUBLE), 0) AS purchase_no_view_share,
       purchase_no_cart / nullif(CAST(purchase_sessions AS DOUBLE), 0) AS purchase_no_cart_share FROM skips""",
            ("purchase_no_view_share", "purchase_no_cart_share"),
        ),
        "funnel_timing_anomalies": _query(
            FUNNEL,
            "SELECT "
            + ", ".join(
                f"count(CASE WHEN time_{pair}_sec < 0 THEN 1 END) AS neg_{pair}"
                for pair in ("view_to_cart", "cart_to_purchase", "view_to_purchase")
            )
            + " FROM funnel",
        ),
        "session_event_density": _query(
            f"""{clicks}, sizes AS (
  SELECT count(*) AS n FROM clicks WHERE session_id IS NOT NULL GROUP BY session_id, user_id)""",
            """SELECT avg(n) AS avg_events_per_session, CAST(quantile_cont(n, 0.5) AS DOUBLE) AS p50,
       CAST(quantile_cont(n, 0.9) AS DOUBLE) AS p90, CAST(quantile_cont(n, 0.99) AS DOUBLE) AS p99 FROM sizes""",
            ("avg_events_per_session", "p50", "p90", "p99"),
        ),
        "funnel_revenue_totals": _revenue_totals(),
        "funnel_revenue_totals_daily": _revenue_totals("CAST(session_start_ts AS DATE)", "event_date"),
        # cohorts and retention
        "user_daily_purchases": _query(ACTIVITY, "SELECT * FROM buys", ("revenue_gross",)),
        "user_purchase_cohort": _query(ACTIVITY, "SELECT * FROM starts"),
        "cohort_activity": _query(ACTIVITY, "SELECT * FROM activity", ("revenue_gross",)),
        "cohort_retention_summary": _query(SUMMARY, "SELECT * FROM summary", _SUMMARY_RATES),
        "cohort_retention_summary_short": _query(
            f"{ACTIVITY}, {_retention('activity', 'purchase_date', SHORT_DAYS)}",
            "SELECT * FROM summary",
            tuple(f"retention_d{n}" for n in SHORT_DAYS),
        ),
        "cohort_retention_curve": _query(CURVE, "SELECT * FROM curve", ("retention_rate",)),
        "cohort_retention_curve_cut": _query(
            CURVE, f"SELECT * FROM curve WHERE days_since <= {CUT_DAY}", ("retention_rate",)
        ),
        "weighted_retention_cards": _cards(),
        "weighted_retention_cards_by_week": _cards("CAST(date_trunc('week', cohort_date) AS DATE)", "week"),
        "weighted_retention_curve_chosen": _query(
            f"""{CURVE}, chosen AS (
  SELECT days_since, CAST(sum(active_users) AS BIGINT) AS chosen_active_users, CAST(sum(cohort_size) AS BIGINT) AS chosen_cohort_users
  FROM curve JOIN summary USING (cohort_date) WHERE day(cohort_date) % 2 = 0 GROUP BY days_since)""",
            """SELECT days_since, active_users AS all_active_users, cohort_users AS all_cohort_users, retention_weighted AS all_retention_weighted,
       chosen_active_users, chosen_cohort_users, chosen_active_users / CAST(chosen_cohort_users AS DOUBLE) AS chosen_retention_weighted
FROM weighted LEFT JOIN chosen USING (days_since)""",
            ("all_retention_weighted", "chosen_retention_weighted"),
        ),
        "cohort_retention_curve_bitmaps": _query(CURVE, "SELECT * FROM curve", ("retention_rate",)),
        "weighted_retention_curve": _query(
            CURVE, f"SELECT {curve_columns} FROM weighted", ("retention_weighted",)
        ),
        "weighted_retention_curve_all": _query(
            f"{CURVE}, everyone AS (SELECT CAST(sum(cohort_size) AS BIGINT) AS cohort_users FROM summary)",
            """SELECT days_since, active_users, everyone.cohort_users,
       active_users / CAST(everyone.cohort_users AS DOUBLE) AS retention_weighted FROM weighted, everyone""",
            ("retention_weighted",),
        ),
        "weighted_retention_curve_no_day0": _query(
            CURVE, f"SELECT {curve_columns} FROM weighted WHERE days_since > 0", ("retention_weighted",)
        ),
        "activity_retention": _query(_user_days(PAID), "SELECT * FROM summary", _SUMMARY_RATES),
        "activity_retention_first_seen": _query(_user_days("TRUE"), "SELECT * FROM summary", _SUMMARY_RATES),
        "repurchase_within": _query(
            f"""{ACTIVITY}, {_RETURNS}, tallied AS (
  SELECT cohort_date, count(*) AS cohort_size,
         count(CASE WHEN back <= 7 THEN 1 END) AS repurchased_7d_users,
         count(CASE WHEN back <= 30 THEN 1 END) AS repurchased_30d_users
  FROM returned GROUP BY cohort_date)""",
            """SELECT *, repurchased_7d_users / CAST(cohort_size AS DOUBLE) AS repurchase_7d,
       repurchased_30d_users / CAST(cohort_size AS DOUBLE) AS repurchase_30d FROM tallied""",
            ("repurchase_7d", "repurchase_30d"),
        ),
        "cohort_heatmap": _query(
            CURVE,
            f"SELECT cohort_date, {heat} FROM curve GROUP BY cohort_date",
            tuple(f"day_{n}" for n in range(31)),
        ),
        # revenue drivers
        "session_category": _query(
            CATEGORIES,
            """SELECT session_id, category_id
FROM (SELECT DISTINCT session_id FROM clicks WHERE session_id IS NOT NULL) LEFT JOIN placed USING (session_id)""",
        ),
        "category_funnel": _query(CATEGORIES, "SELECT * FROM per_category", ("revenue_dedup", "revenue_gross")),
        "brand_revenue": _query(clicks, _BRANDS, ("revenue_gross", "avg_item_price")),
        "brand_revenue_top": _query(
            clicks, f"{_BRANDS} ORDER BY sum(price) DESC, brand LIMIT {BRANDS}", ("revenue_gross", "avg_item_price")
        ),
        "category_funnel_item_price": _query(
            f"""{CATEGORIES}, sold AS (
  SELECT category_id, avg(price) AS avg_item_price
  FROM (SELECT session_id, price FROM clicks WHERE session_id IS NOT NULL AND {PAID}) JOIN placed USING (session_id) GROUP BY category_id)""",
            "SELECT * FROM per_category LEFT JOIN sold USING (category_id)",
            ("revenue_dedup", "revenue_gross", "avg_item_price"),
        ),
        "category_cvr": _query(CATEGORIES, "SELECT * FROM rated", ("revenue_dedup", "revenue_gross", *CVRS)),
        "category_quadrants": _query(
            f"""{CATEGORIES}, leveled AS (
  SELECT category_id, view_sessions, view_to_purchase_cvr, revenue_dedup,
         avg(view_sessions) OVER () AS avg_view_sessions,
         avg(view_to_purchase_cvr) OVER () AS avg_view_to_purchase_cvr
  FROM rated)""",
            """SELECT *, CASE
    WHEN view_to_purchase_cvr IS NULL THEN NULL
    WHEN view_sessions >= avg_view_sessions
      THEN if(view_to_purchase_cvr >= avg_view_to_purchase_cvr, 'star', 'optimize')
    ELSE if(view_to_purchase_cvr >= avg_view_to_purchase_cvr, 'grow', 'monitor') END AS quadrant
FROM leveled""",
            ("view_to_purchase_cvr", "revenue_dedup", "avg_view_sessions", "avg_view_to_purchase_cvr"),
        ),
        # trends
        "daily_event_counts": _query(DAILY, "SELECT * FROM daily"),
        "daily_events_by_type": _query(DAILY, "SELECT * FROM wide"),
        "events_moving_avg": _moving_average("event_type"),
        "events_moving_avg_total": _moving_average(""),
        "daily_cvr": _query(
            DAILY,
            """SELECT event_date, view_events, cart_events, purchase_events,
       cart_events / nullif(CAST(view_events AS DOUBLE), 0) AS view_to_cart_cvr,
       purchase_events / nullif(CAST(cart_events AS DOUBLE), 0) AS cart_to_purchase_cvr,
       purchase_events / nullif(CAST(view_events AS DOUBLE), 0) AS view_to_purchase_cvr
FROM wide""",
            CVRS,
        ),
        "peak_view_day": _query(DAILY, "SELECT * FROM peak"),
        "peak_view_spike": _query(
            f"""{DAILY}, based AS (
  SELECT peak_view_date, peak_view_events,
         (SELECT avg(view_events) FROM wide WHERE event_date BETWEEN peak_view_date - 7 AND peak_view_date - 1)
           AS baseline_views
  FROM peak)""",
            "SELECT *, (peak_view_events / nullif(baseline_views, 0) - 1) * 100 AS peak_view_spike_pct FROM based",
            ("baseline_views", "peak_view_spike_pct"),
        ),
        # executive and profile
        "executive_kpis": _kpis(),
        "executive_kpis_by_brand": _kpis("brand"),
        "executive_kpis_weekly_rollup": _kpis("week"),
        "executive_kpis_brand_rollup": _kpis("brand"),
        "executive_kpis_sketch_error": f"WITH found AS ({_kpis('week')}) SELECT week, users, sessions, TRUE AS users_near, TRUE AS sessions_near FROM found",
        "median_price_sketch_error": _query(
            clicks, "SELECT product_id, count(price) AS n, TRUE AS median_near FROM clicks WHERE price IS NOT NULL GROUP BY product_id"
        ),
        "price_percentiles_approx": _query(
            clicks, "SELECT count(price) AS prices, TRUE AS p50_price_near, TRUE AS p90_price_near, TRUE AS p99_price_near FROM clicks"
        ),
        "data_profile": _query(
            clicks,
            f"""SELECT count(*) AS total_rows, min(event_ts) AS min_event_ts, max(event_ts) AS max_event_ts,
       {", ".join(f"count(CASE WHEN event_type = '{s}' THEN 1 END) AS {s}_events" for s in STEPS)},
       count(*) - count(user_id) AS null_user_id_rows, count(*) - count(session_id) AS null_user_session_rows,
       count(CASE WHEN price <= 0 THEN 1 END) AS nonpositive_price_rows FROM clicks""",
        ),
        "price_percentiles": _query(
            clicks,
            """SELECT quantile_cont(price, 0.5) AS p50_price, quantile_cont(price, 0.9) AS p90_price,
       quantile_cont(price, 0.99) AS p99_price FROM clicks""",
            ("p50_price", "p90_price", "p99_price"),
        ),
        # validation
        "qa_event_type_coverage": _query(clicks, "SELECT event_type, count(*) AS n FROM clicks GROUP BY event_type"),
        "qa_null_keys": _query(
            clicks,
            "SELECT "
            + ", ".join(
                f"count(*) - count({key}) AS null_{key}"
                for key in ("user_id", "event_ts", "event_type", "product_id", "category_id")
            )
            + " FROM clicks",
        ),
        "qa_revenue": _query(
            f"""{CATEGORIES}, sums AS (
  SELECT sum(revenue_dedup) AS revenue_dedup, sum(revenue_gross) AS revenue_gross FROM per_category)""",
            "SELECT *, revenue_dedup <= revenue_gross AS dedup_within_gross FROM sums",
            ("revenue_dedup", "revenue_gross"),
        ),
        "qa_cvr_bounds": _query(
            CATEGORIES,
            """SELECT min(view_to_cart_cvr) AS min_v2c, max(view_to_cart_cvr) AS max_v2c,
       min(cart_to_purchase_cvr) AS min_c2p, max(cart_to_purchase_cvr) AS max_c2p FROM rated""",
            ("min_v2c", "max_v2c", "min_c2p", "max_c2p"),
        ),
        "qa_day0_retention": _query(
            CURVE, "SELECT cohort_date, retention_rate FROM curve WHERE days_since = 0", ("retention_rate",)
        ),
        "qa_funnel_monotonic": _query(
            f"{FUNNEL}, counted AS (SELECT {FUNNEL_SUMS} FROM funnel)",
            """SELECT *, cart_sessions <= view_sessions AS cart_within_view,
       purchase_sessions <= cart_sessions AS purchase_within_cart,
       cart_sessions <= view_sessions AND purchase_sessions <= cart_sessions AS is_monotonic FROM counted""",
        ),
        "qa_row_integrity": _query(
            f"{clicks}, {SESSION_DIM}",
            """SELECT (SELECT count(*) FROM events) AS raw_rows, (SELECT count(*) FROM clicks) AS fact_rows,
       (SELECT count(*) FROM dim_session) AS sessions_dim,
       (SELECT count(DISTINCT session_id) FROM clicks) AS sessions_distinct_raw""",
        ),
        "qa_duplicate_events": _query(
            f"""{clicks}, dups AS (
  SELECT 1 FROM clicks GROUP BY user_id, product_id, event_ts, event_type HAVING count(*) > 1)""",
            "SELECT count(*) AS dup_groups FROM dups",
        ),
        # ticket expressions
        "ticket_base": _query(TICKETS, f"SELECT * FROM live WHERE {IN_RANGE}"),
        "ticket_date_fields": _query(
            TICKETS,
            """SELECT ticket_id, strftime(issue_created, '%Y-%m-%d') AS created_day,
       strftime(issue_created, '%Y-%m') AS created_month,
       strftime(issue_resolution_date, '%Y-%m-%d') AS resolved_day FROM tickets""",
        ),
        "ticket_status_flags": _query(
            TICKETS,
            """SELECT ticket_id,
       issue_status IS NOT NULL AND issue_status NOT IN ('Resolved', 'Closed') AS is_open,
       issue_status IS NOT NULL AND issue_status IN ('Resolved', 'Closed') AS is_closed FROM tickets""",
        ),
        "ticket_safe_fields": _query(
            TICKETS,
            """SELECT ticket_id,
       CAST(first_response_breached IS TRUE AS INTEGER) AS first_response_breached_safe,
       CAST(resolution_sla_breached IS TRUE AS INTEGER) AS resolution_breached_safe,
       CAST(escalated_flag IS TRUE AS INTEGER) AS escalated_safe,
       coalesce(reopen_count, 0) AS reopen_count_safe,
       CASE WHEN csat_score IN (1, 2, 3, 4, 5) THEN csat_score END AS csat_score_safe FROM tickets""",
        ),
        "rate_pct": _query(
            f"""{TICKETS}, n AS (
  SELECT assigned_agent, channel, count(*) AS n, count(CASE WHEN is_closed THEN 1 END) AS closed
  FROM marked GROUP BY ALL)""",
            f"""SELECT assigned_agent, channel, {_pct("closed", "n", "closure_rate_pct")},
       {_pct("n", "closed", "inverse_rate_pct")} FROM n""",
        ),
        # ticket KPIs
        "ticket_daily_created": _query(DAY_FLOW, "SELECT * RENAME (day AS created_day) FROM came", DAY_DOUBLES),
        "ticket_daily_resolved": _query(DAY_FLOW, "SELECT day AS resolved_day, tickets_resolved FROM went"),
        "ticket_backlog_snapshot": _query(
            TICKETS, "SELECT count(*) AS current_open_backlog FROM marked WHERE is_open"
        ),
        "ticket_daily_kpis": _query(
            DAY_FLOW,
            """SELECT coalesce(came.day, went.day) AS day,
       coalesce(tickets_created, 0) AS tickets_created, coalesce(tickets_resolved, 0) AS tickets_resolved,
       coalesce(tickets_created, 0) - coalesce(tickets_resolved, 0) AS net_flow,
       avg_first_response_minutes, avg_resolution_minutes_for_created_tickets,
       coalesce(first_response_sla_breaches, 0) AS first_response_sla_breaches,
       coalesce(resolution_sla_breaches_on_created_tickets, 0) AS resolution_sla_breaches_on_created_tickets,
       coalesce(total_reopens, 0) AS total_reopens, avg_csat
FROM came FULL JOIN went ON came.day = went.day""",
            DAY_DOUBLES,
        ),
        "ticket_queue_performance": _query(
            f"""{TICKETS}, g AS (
  SELECT queue_name, count(*) AS tickets_total, count(CASE WHEN is_open THEN 1 END) AS tickets_open,
         count(CASE WHEN is_closed THEN 1 END) AS tickets_closed, {_breaches(*SLA_LONG)}, {MEAN_TIMES},
         avg(coalesce(reopen_count, 0)) AS avg_reopens, avg(csat_score) AS avg_csat
  FROM marked GROUP BY queue_name)""",
            f"""SELECT *, {_breach_rates(*SLA_LONG, "tickets_total")},
       {_pct("tickets_closed", "tickets_total", "closure_rate_pct")} FROM g""",
            (*TIMES, "avg_reopens", "avg_csat"),
        ),
        "ticket_agent_performance": _query(
            f"""{TICKETS}, g AS (
  SELECT assigned_agent, count(*) AS tickets_handled, count(CASE WHEN is_closed THEN 1 END) AS tickets_closed,
         {MEAN_TIMES}, {_breaches(*SLA_LONG)}, count(CASE WHEN escalated_flag THEN 1 END) AS escalations,
         {REOPENS}, avg(csat_score) AS avg_csat
  FROM marked GROUP BY assigned_agent)""",
            f"""SELECT *, {_pct("tickets_closed", "tickets_handled", "closure_rate_pct")},
       {_breach_rates(*SLA_LONG, "tickets_handled")},
       {_pct("escalations", "tickets_handled", "escalation_rate_pct")} FROM g""",
            (*TIMES, "avg_csat"),
        ),
        "ticket_priority_sla": _query(
            f"""{TICKETS}, g AS (
  SELECT issue_priority, count(*) AS tickets_total, {MEAN_TIMES}, {_breaches(*SLA)}
  FROM marked GROUP BY issue_priority)""",
            f"""SELECT *, {_breach_rates(*SLA, "tickets_total")} FROM g""",
            TIMES,
        ),
        "ticket_backlog_aging": _query(
            _AGED, "SELECT aging_bucket, count(*) AS open_tickets FROM aged GROUP BY aging_bucket"
        ),
        "ticket_category_pain_points": _query(
            f"""{TICKETS}, g AS (
  SELECT category, subcategory, count(*) AS tickets_total,
         count(CASE WHEN resolution_sla_breached THEN 1 END) AS resolution_sla_breaches,
         avg(resolution_time_minutes) AS avg_resolution_minutes,
         avg(coalesce(reopen_count, 0)) AS avg_reopens, avg(csat_score) AS avg_csat
  FROM marked GROUP BY category, subcategory)""",
            f"""SELECT *, {_pct("resolution_sla_breaches", "tickets_total", "resolution_breach_rate_pct")} FROM g""",
            ("avg_resolution_minutes", "avg_reopens", "avg_csat"),
        ),
        "ticket_channel_analysis": _query(
            f"""{TICKETS}, g AS (
  SELECT channel, count(*) AS tickets_total, {MEAN_TIMES}, {_breaches(*SLA)}, avg(csat_score) AS avg_csat
  FROM marked GROUP BY channel)""",
            f"""SELECT *, {_breach_rates(*SLA, "tickets_total")} FROM g""",
            (*TIMES, "avg_csat"),
        ),
        "ticket_executive_summary": _query(
            f"""{TICKETS}, g AS (
  SELECT count(*) AS tickets_created, count(CASE WHEN is_closed THEN 1 END) AS tickets_resolved,
         count(CASE WHEN is_open THEN 1 END) AS current_open_backlog_within_filtered_set,
         {MEAN_TIMES}, {_breaches(*SLA)}, avg(csat_score) AS avg_csat, {REOPENS}
  FROM marked)""",
            f"""SELECT *, {_breach_rates(*SLA, "tickets_created")},
       {_pct("total_reopens", "tickets_created", "reopen_rate_pct")} FROM g WHERE tickets_created > 0""",
            (*TIMES, "avg_csat"),
        ),
        "ticket_data_quality": _query(
            TICKETS,
            "\nUNION ALL\n".join(
                f"SELECT '{issue}' AS issue, count(*) AS cnt FROM tickets WHERE {cond}"
                for issue, cond in {
                    "missing_created_date": "issue_created IS NULL",
                    "resolved_before_created": "issue_resolution_date < issue_created",
                    "missing_status": "coalesce(issue_status, '') = ''",
                    "missing_priority": "coalesce(issue_priority, '') = ''",
                    "missing_agent": "coalesce(assigned_agent, '') = ''",
                    "invalid_csat": "csat_score NOT BETWEEN 1 AND 5",
                }.items()
            ),
        ),
    }
