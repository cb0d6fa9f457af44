"""Registered queries against independent SQL, and the shape of their plans."""

from __future__ import annotations

import os
import re
from dataclasses import replace
from datetime import date

import pytest

import __spark_entry__ as registered
from checks import oracles
from checks.compare import differences, duck
from kpiloom.functions import between
from kpiloom.operators.activation import LIVE_VIDEO_LABEL, activation_report
from kpiloom.operators.cleaning import paid_purchases
from kpiloom.operators.outcomes import purchase_outcomes, within
from kpiloom.operators.periods import report_windows
from kpiloom.plans import reports
from kpiloom.sources import standins

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
EXTRA = {name for module in registered.EXTRA for name in module.queries()}
QUERIES = {name: query for name, query in registered.queries().items() if name not in EXTRA}
SQL = {name: sql for name, sql in registered.oracle_sql().items() if name not in EXTRA}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    assert differences(spark, con, QUERIES[name], SQL[name], FOLDER, oracles.ORDERED.get(name)) == []


@pytest.mark.parametrize("name", sorted(oracles.ORDERED))
def test_shuffled_rows_are_found(spark, con, name):
    """A report that promises an order and has its rows in another one doesn't agree."""
    by = oracles.ORDERED[name]
    backwards = lambda spark, folder: QUERIES[name](spark, folder).orderBy(*by, ascending=False)
    assert differences(spark, con, backwards, SQL[name], FOLDER) == []
    assert differences(spark, con, backwards, SQL[name], FOLDER, by)


def test_entry(spark):
    rows = registered.entry(spark).collect()
    assert rows and [r.date for r in rows] == sorted(r.date for r in rows)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_copies_products_or_python(spark, name):
    """No input copied per distinct count, no product but with the one-row total, no Python rows."""
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for node in ("Expand", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert node not in plan
    assert plan.count("BroadcastNestedLoopJoin") == (1 if name == "revenue_daily" else 0)


@pytest.mark.parametrize("threshold, by_user", [("-1", 2), ("10MB", 1)], ids=["shuffled users", "broadcast users"])
@pytest.mark.parametrize("name, last", [("activation_windows_lv", "SinglePartition"), ("retention_cohorts", "cohort")])
def test_activity_is_shuffled_once(spark, name, last, threshold, by_user):
    """Activity and purchases by user and day, the days after purchases by user, and the result."""
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, threshold)
    try:
        plan = re.sub(r"#\d+L?", "", plan_of(QUERIES[name](spark, FOLDER)))
    finally:
        spark.conf.set(conf, before)
    assert plan.count(" Exchange hashpartitioning(user_id, day,") == 1
    assert plan.count(" Exchange hashpartitioning(user_id, 4)") == by_user
    assert plan.count(" Exchange ") == 2 + by_user and last in plan


def test_summary_reads_activity_once(spark):
    """Activation and retention use the same shuffled rows of purchases and activity."""
    df = QUERIES["kpi_summary"](spark, FOLDER)
    df.collect()
    final = re.sub(r"#\d+L?", "", plan_of(df)).split("== Initial Plan ==")[0]
    by_user_day = [line for line in final.splitlines() if "Exchange hashpartitioning(user_id, day," in line]
    assert ["ReusedExchange" in line for line in by_user_day if "ReusedExchange" in line] == [True]
    assert len([line for line in by_user_day if "ReusedExchange" not in line]) == 1


def test_floor_reaches_the_scan(spark):
    conf = "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "2000")
    try:
        plan = plan_of(QUERIES["activation_daily"](spark, FOLDER))
    finally:
        spark.conf.set(conf, before)
    assert plan.count("GreaterThanOrEqual(ts,2024-01-05T00:00)") == 4
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


@pytest.mark.parametrize("name", ["signup_funnel", "signup_funnel_local"])
def test_funnel_never_shrinks(spark, name):
    bad = "cat_selected_d0 > cat_selected_d1 OR cat_selected_d1 > cat_selected_d3 OR cat_selected_d3 > cat_selected_d7"
    assert QUERIES[name](spark, FOLDER).where(f"{bad} OR cat_selected_d7 > total_signups").count() == 0


def test_activated_are_buyers_and_cohorts_add_up(spark):
    daily = QUERIES["activation_daily"](spark, FOLDER)
    assert daily.where("lv_activated_24hr > total_purchases OR total_purchases > total_transactions").count() == 0
    waterfall = QUERIES["retention_waterfall_long"](spark, FOLDER)
    assert waterfall.where("d7_retained_users + d7_not_retained != total_purchased_users").count() == 0
    assert waterfall.where("d7_not_retained < 0 OR d30_not_retained < 0").count() == 0


MEASURED = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(MEASURED), reason="test tables not present")
def test_known_counts(spark):
    """Counts worked out beforehand for the stand-ins as they are, without floors or varied values."""
    start = date(2024, 1, 1)
    rules = replace(standins.EVENTS_RULES, floor_date=start, free_pattern="%7%", quiz_pattern="%9%")
    tables = standins.events_tables(spark, MEASURED, standins.PLAIN)
    daily = reports.activation_daily(tables, rules, transactions=True)
    sums = "sum(total_transactions), sum(total_purchases), sum(lv_activated_24hr), sum(test_activated_24hr)"
    assert tuple(daily.selectExpr(*sums.split(", ")).collect()[0]) == (1594, 1284, 1004, 504)
    (pairs,) = reports.retention_cohorts(tables, rules).collect()
    (users,) = reports.retention_cohorts(tables, rules, "users").collect()
    assert (pairs.d7_retained_users, pairs.d30_retained_users, pairs.total_purchase_users) == (975, 31, 122)
    assert (users.d7_retained_users, users.d30_retained_users) == (122, 29)
    signups = standins.signup_tables(spark, MEASURED)
    first = reports.signup_funnel(signups, rules, standins.EVENTS_REF).orderBy("signup_date").first()
    got = [first[c] for c in ("total_signups", *(f"cat_selected_d{n}" for n in (0, 1, 3, 7)))]
    assert got == [51, 13, 28, 44, 48]
    # The known counts of the long profile are of purchase days; a window counts each user once.
    paid = paid_purchases(standins.orders_purchases(spark, MEASURED), replace(standins.ORDERS_RULES, floor_date=None))
    shipped = {"ship": standins.orders_activity(spark, MEASURED, date(1990, 1, 1))}
    facts = purchase_outcomes(paid, shipped, {"lv": within(standins.ORDERS_HORIZON, "ship")})
    activated = facts.where("lv")
    windows = report_windows(standins.ORDERS_REF)
    counted = [activated.where(between("purchase_date", *windows[w])) for w in ("W", "MTD", "LY_MTD", "LY_full")]
    assert [df.count() for df in counted] == [2, 7, 14, 284]
    (row,) = activation_report(facts, standins.ORDERS_REF, {"lv": LIVE_VIDEO_LABEL}).collect()
    users = [df.select("user_id").distinct().count() for df in counted]
    assert [row.users_W_daily_avg, row.users_MTD, row.users_LY_MTD, row.users_LY_full] == [
        round(users[0] / 7, 1),
        *users[1:],
    ]


# A filter, a query that covers it, and how to take it out of that query's SQL.
AMOUNT, SCREEN, TITLE, FLOOR = oracles.AMOUNT, oracles.SCREEN, oracles.TITLE, oracles.FLOOR
FILTERS = {
    "P2 partition floor": ("activation_daily", f"CAST(e.ts AS DATE) >= {FLOOR}", "true"),
    "P3 local floor": ("content_dau_west", f"CAST(ts - INTERVAL 300 MINUTE AS DATE) >= {FLOOR}", "true"),
    "P4 paid": ("revenue_daily", f"AND {AMOUNT} > 0", ""),
    "P4 paid, activation": ("activation_daily", f"AND {AMOUNT} > 0", ""),
    "P5 categories": ("revenue_daily", f"c.c_mktsegment IN {oracles.IN_SCOPE}", "true"),
    "P6 free screens": ("activity_days", f"lower({SCREEN}) NOT LIKE '%free%'", "true"),
    "P6 any case": ("activity_days", f"lower({SCREEN})", f"({SCREEN})"),
    "P6 unknown screens": ("activity_days", f"lower({SCREEN})", f"coalesce(lower({SCREEN}), '')"),
    "P7 finished": ("activity_days", "event_id % 3 <> 0", "true"),
    "P8 quizzes": ("activity_days", f"lower({TITLE}) NOT LIKE '%quiz%'", "true"),
    "P8 any case, F10 lower": ("activity_days", f"lower({TITLE})", f"({TITLE})"),
    "P8 unknown titles": ("activity_days", f"lower({TITLE})", f"coalesce(lower({TITLE}), '')"),
    "P9 first signup date": ("signup_funnel", f"signup_date BETWEEN {FLOOR}", "signup_date BETWEEN DATE '2000-01-01'"),
    "P9 last signup date": ("signup_funnel", f"AND {oracles.REF}", "AND DATE '2030-01-01'"),
    "P13 empty category": ("signup_funnel", "AND category <> ''", ""),
    "P13 main categories": ("signup_funnel", "category NOT IN ('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD') AND", ""),
    "A4 nobody": ("activation_windows_nobody", "HAVING", "HAVING true OR"),
    "F5 clamped month": ("activation_windows_clamped", "- INTERVAL 1 MONTH AS DATE)", "- INTERVAL 30 DAY AS DATE)"),
    "F19 week label": ("date_dim_orders", "%Y-W%W", "%G-W%V"),
    "K9 complete cohorts": ("kpi_summary_cohorts", "HAVING last_day", "HAVING true OR last_day"),
    "K16 scope": ("journey_funnel", f"WHERE c_mktsegment IN {oracles.IN_SCOPE} AND CAST(ts AS DATE)", "WHERE CAST(ts AS DATE)"),
    "K16 floor": ("journey_funnel", f"AND CAST(ts AS DATE) >= {FLOOR}\n)", ")"),
}


@pytest.mark.skipif(not os.path.isdir(MEASURED), reason="test tables not present")
@pytest.mark.parametrize("name", FILTERS)
def test_filter_has_something_to_remove(name):
    """Without the filter the SQL gives other rows, so a query that lacks it would not agree."""
    query, old, new = FILTERS[name]
    assert old in SQL[query]
    con = duck(MEASURED)
    whole, without = (sorted(map(repr, con.execute(sql).fetchall())) for sql in (SQL[query], SQL[query].replace(old, new)))
    assert whole != without


def test_no_frame_that_starts_at_the_row_and_has_no_end(spark):
    """Such a frame is gone through again for every row."""
    for name, query in QUERIES.items():
        assert not re.search(r"following\$?\(?\)?, unboundedfollowing", plan_of(query(spark, FOLDER)).lower()), name


def test_shipments_before_the_floor_are_not_read(spark):
    plan = plan_of(QUERIES["activation_windows_long"](spark, FOLDER))
    assert "GreaterThanOrEqual(l_shipdate,1996-01-01T00:00)" in plan


def test_dimensions_are_not_copied(spark):
    for name in ("content_daily", "users_with_funnel", "purchases_with_daily", "signup_funnel", "kpi_summary"):
        assert "Generate explode" not in plan_of(QUERIES[name](spark, FOLDER))
