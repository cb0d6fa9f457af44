"""Column contracts of the reports, and links of the star model."""

from __future__ import annotations

from datetime import date

import pytest

from kpiloom.operators import calendar, model
from kpiloom.operators.cleaning import Rules
from kpiloom.plans import reports, summary

RULES = Rules(date(2025, 1, 1))
REF = date(2025, 4, 14)
DATE = ["date", "day_of_week", "week", "month"]
CATEGORIES = (
    "banking ssc railways defence ctet upsc engineering gate iit_jee neet uttar_pradesh bihar rajasthan maharashtra "
    "madhya_pradesh haryana gujarat"
).split()


@pytest.fixture
def empty(make):
    roles = ("users", "purchases", "live_sessions", "video_events", "test_attempts", "content_events")
    return {role: make(role) for role in roles}


def test_windowed_activation(empty):
    windows = "today lw_same_day MTD LM_MTD full_LM LY_WTD LY_MTD LY_LW LY_LM LY_full".split()
    columns = reports.live_video_activation(empty, RULES, REF).columns
    assert len(columns) == 27 and columns[0] == "kpi"
    assert columns[1:5] == ["users_W_daily_avg", "pct_W", "users_W1_daily_avg", "pct_W1"]
    assert set(columns[5:]) == {
        *(f"users_{w}" for w in windows),
        *(f"pct_{w}" for w in windows),
        "wow_delta_pct_pts",
        "mom_mtd_delta_pct_pts",
    }
    assert reports.test_activation(empty, RULES, REF).columns == columns


def test_daily_activation(empty):
    assert reports.activation_daily(empty, RULES).columns == [
        *DATE,
        "total_purchases",
        "lv_activated_24hr",
        "lv_activation_pct",
        "test_activated_24hr",
        "test_activation_pct",
    ]


def test_retention(empty):
    assert reports.retention_cohorts(empty, RULES).columns == [
        "kpi",
        "d7_retained_users",
        "total_purchase_users",
        "d7_retention_pct",
        "d30_retained_users",
        "d30_retention_pct",
        "purchase_cohort_month",
    ]
    assert reports.retention_waterfall(empty, RULES).columns == [
        "cohort_month",
        "total_purchased_users",
        "d7_retained_users",
        "d7_retention_pct",
        "d30_retained_users",
        "d30_retention_pct",
        "d7_not_retained",
        "d30_not_retained",
    ]


def test_signups(empty):
    stages = [c for n in (0, 1, 3, 7) for c in (f"cat_selected_d{n}", f"pct_cat_selected_d{n}")]
    assert reports.signup_funnel(empty, RULES, REF).columns == [
        "kpi",
        "signup_date",
        "total_signups",
        *stages,
        *"banking ssc railways defence upsc others".split(),
    ]
    wide = reports.signup_funnel_wide(empty, RULES, REF).columns
    assert wide == [*DATE, "total_signups", *stages, *(f"cat_{c}" for c in CATEGORIES)] and len(wide) == 30
    assert reports.signup_funnel_long(empty, RULES, REF).columns == ["date", "stage", "users", "pct"]


def test_content(empty):
    volume = "dau total_consumption_events avg_items_per_user total_watch_hours avg_watch_min_per_user".split()
    narrow = reports.content_daily(empty, RULES).columns
    types = [f"{t}_{c}" for t in "live_class video test notes quiz".split() for c in ("users", "events")]
    mains = [f"{c}_users" for c in "banking ssc railways defence upsc".split()]
    assert narrow == ["kpi", "activity_date", *volume, *types, *mains] and len(narrow) == 22
    wide = reports.content_daily_wide(empty, RULES).columns
    types = [
        f"{t}_{c}" for t in "live_class recorded_video test notes practice_quiz".split() for c in ("users", "events")
    ]
    assert wide == [*DATE, *volume, *types, *(f"cat_{c}_users" for c in CATEGORIES)] and len(wide) == 36


def test_summary(empty):
    got = summary.kpi_summary(empty, RULES, REF)
    assert got.columns == ["kpi", "window", "users", "pct", "denom_label"]
    assert got.count() == 16  # all but the cohorts


def test_missing_table_is_named(empty):
    without = {k: v for k, v in empty.items() if k != "video_events"}
    with pytest.raises(KeyError, match="video_events"):
        reports.activation_daily(without, RULES)


def test_calendar_fills_gaps(spark, empty):
    daily = reports.activation_daily(empty, RULES)
    laid_out = calendar.on_calendar(daily, calendar.date_dim(spark, date(2025, 1, 1), date(2025, 1, 10)))
    assert laid_out.count() == 10 and laid_out.where("total_purchases IS NULL").count() == 10


@pytest.mark.parametrize("threshold", ["-1", "10MB"], ids=["shuffled", "broadcast"])
def test_attach_keeps_every_fact_once(spark, threshold):
    """A key that holds a third of the facts, with a dimension that is shuffled or broadcast."""
    conf = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(conf)
    spark.conf.set(conf, threshold)
    try:
        check_attach(spark)
    finally:
        spark.conf.set(conf, before)


def check_attach(spark):
    facts = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 7, id % 50) AS k")
    dimension = spark.range(40).selectExpr("id AS k", "concat('n', id) AS name")
    got = model.attach(facts, dimension, ["k"])
    assert got.count() == 3000 and got.select("id").distinct().count() == 3000
    assert got.where("name IS NULL").count() == facts.where("k >= 40").count()
    assert got.where("name != concat('n', k)").count() == 0
    inner = model.attach(facts, dimension, ["k"], how="inner")
    assert inner.count() == facts.where("k < 40").count()


def test_repeated_keys_of_a_dimension_are_an_error(spark, make):
    """A user, day or signup date with two rows would double facts: reading the result fails and says which."""
    bought = make("purchases", {"user_id": 1, "at": "2025-01-05 10:00"}, {"user_id": 2, "at": "2025-01-05 10:00"})
    users = make("users", {"user_id": 1, "category": "SSC"}, {"user_id": 1, "category": "SSC"}, {"user_id": 2, "category": "A"})
    with pytest.raises(Exception, match="users: several rows for user_id 1"):
        model.purchases_with_users(bought, users, ["category"]).collect()
    once = users.where("user_id = 2").union(make("users", {"category": "B"}, {"category": "C"}))
    got = model.purchases_with_users(bought, once, ["category"]).collect()
    assert sorted((r.user_id, r.category) for r in got) == [(1, None), (2, "A")]
    daily = spark.createDataFrame([(date(2025, 1, 5), 1), (date(2025, 1, 5), 1)], "date date, n int")
    with pytest.raises(Exception, match="daily KPI: several rows for purchase_date 2025-01-05"):
        model.purchases_with_daily(bought, daily, ["n"], 330).collect()
    funnel = daily.withColumnRenamed("date", "signup_date")
    signed = make("users", {"user_id": 1, "signup_date": "2025-01-05"})
    with pytest.raises(Exception, match="signup funnel: several rows"):
        model.users_with_funnel(signed, funnel, ["n"]).collect()


def test_the_check_of_keys_reads_nothing_twice(spark, make, tmp_path):
    users = make("users", *({"user_id": u, "category": "SSC"} for u in range(10)))
    users.write.parquet(str(tmp_path / "users"))
    users = spark.read.schema(users.schema).parquet(str(tmp_path / "users"))
    bought = make("purchases", {"user_id": 1, "at": "2025-01-05 10:00"})
    plan = model.purchases_with_users(bought, users, ["category"])._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("FileScan parquet") == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = model.purchases_with_users(bought, users, ["category"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One shuffle of the purchases, one of the users that the count and the join share.
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 2
