"""All KPI tables in one go, on data in which one user and one day hold a third of the rows."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest

from kpiloom.operators.cleaning import Rules
from kpiloom.plans import refresh, reports, summary
from kpiloom.session import use_checkpoint_dir
from kpiloom.sources import EXAM_CATEGORIES

RULES = Rules(date(2025, 1, 1))
REF = date(2025, 3, 10)
START = datetime(2024, 12, 30)


@pytest.fixture(scope="module")
def rng():
    return random.Random(7)


@pytest.fixture
def tables(make, rng):
    def when():
        return START + (timedelta(days=20, minutes=rng.randrange(1440)) if rng.random() < 0.33 else timedelta(minutes=rng.randrange(75 * 1440)))

    def who():
        return 0 if rng.random() < 0.33 else rng.randrange(60)

    def facts(n, **columns):
        return [{"user_id": who(), "at": when().isoformat(), **{k: v() for k, v in columns.items()}} for _ in range(n)]

    categories = (*EXAM_CATEGORIES, "CUET", "", None)
    users = []
    for n in range(60):
        signed = when()
        picked = None if n % 5 == 0 else (signed + timedelta(days=rng.randrange(-1, 9))).date().isoformat()
        users.append(
            {
                "user_id": n,
                "category": categories[n % len(categories)],
                "signup_ts": signed.isoformat(),
                "signup_date": signed.date().isoformat(),
                "category_selected_date": picked,
            }
        )
    return {
        "users": make("users", *users),
        "purchases": make("purchases", *facts(300, amount=lambda: rng.randrange(0, 900))),
        "live_sessions": make("live_sessions", *facts(400, screen=lambda: rng.choice(("home", "FREE tab", None)))),
        "video_events": make("video_events", *facts(300)),
        "test_attempts": make(
            "test_attempts",
            *facts(200, action=lambda: rng.choice(("finished", "started")), title=lambda: rng.choice(("Mock", "A Quiz"))),
        ),
        "content_events": make(
            "content_events",
            *facts(
                600,
                category=lambda: rng.choice(categories),
                content_type=lambda: rng.choice(("live_class", "test", "notes", "podcast")),
                duration_seconds=lambda: rng.choice((None, 5, 90, 3000)),
            ),
        ),
    }


def rows(df):
    return sorted(map(repr, df.collect()))


def test_refresh_equals_the_single_reports(spark, tables, tmp_path):
    kpis = refresh.kpi_tables(spark, tables, RULES, REF)
    single = {
        "kpi_date": None,
        "kpi_activation_windows": reports.activation_windows(tables, RULES, REF),
        "kpi_activation_daily": reports.activation_daily(tables, RULES),
        "kpi_activation_by_category": reports.activation_by_category(tables, RULES),
        "kpi_retention": reports.retention_cohorts(tables, RULES),
        "kpi_retention_cohort": reports.retention_waterfall(tables, RULES),
        "kpi_signup_to_category": reports.signup_funnel(tables, RULES, REF),
        "kpi_signup_to_category_daily": reports.signup_funnel_wide(tables, RULES, REF),
        "kpi_signup_to_category_long": reports.signup_funnel_long(tables, RULES, REF),
        "kpi_signup_by_weekday": reports.signup_by_weekday(tables, RULES, REF),
        "kpi_content_consumed": reports.content_daily(tables, RULES),
        "kpi_content_consumed_daily": reports.content_daily_wide(tables, RULES),
        "kpi_content_by_type": reports.content_by_type(tables, RULES),
        "kpi_revenue_daily": reports.revenue_daily(tables, RULES),
        "kpi_journey_funnel": reports.journey_funnel(tables, RULES),
        "kpi_summary_snapshot": summary.kpi_summary(tables, RULES, REF),
    }
    assert set(kpis) == set(single)
    days = kpis["kpi_date"].collect()
    assert [(b.date - a.date).days for a, b in zip(days, days[1:], strict=False)] == [1] * (len(days) - 1)
    for name, column in (("kpi_activation_daily", "date"), ("kpi_content_consumed", "activity_date")):
        assert {r[column] for r in kpis[name].collect()} <= {r.date for r in days}
    del single["kpi_date"]
    for name, df in single.items():
        assert kpis[name].columns == df.columns
        assert rows(kpis[name]) == rows(df), name
    refresh.write_kpi_tables(kpis, str(tmp_path))
    daily = spark.read.option("header", True).csv(str(tmp_path / "kpi_activation_daily"))
    assert daily.columns == kpis["kpi_activation_daily"].columns
    assert daily.count() == kpis["kpi_activation_daily"].count()


def test_refresh_equals_the_single_reports_when_users_repeat(spark, tables):
    """Users with rows of several categories, or the same row twice, buy and come back once."""
    users = tables["users"]
    other = users.where("user_id % 3 = 0").drop("category").selectExpr("*", "'SSC' AS category").select(users.columns)
    repeated = {**tables, "users": users.union(other).union(users.where("user_id % 4 = 0"))}
    kpis = refresh.kpi_tables(spark, repeated, RULES, REF)
    single = {
        "kpi_activation_windows": reports.activation_windows(repeated, RULES, REF),
        "kpi_activation_daily": reports.activation_daily(repeated, RULES),
        "kpi_activation_by_category": reports.activation_by_category(repeated, RULES),
        "kpi_retention": reports.retention_cohorts(repeated, RULES),
        "kpi_retention_cohort": reports.retention_waterfall(repeated, RULES),
        "kpi_journey_funnel": reports.journey_funnel(repeated, RULES),
        "kpi_summary_snapshot": summary.kpi_summary(repeated, RULES, REF),
    }
    for name, df in single.items():
        assert rows(kpis[name]) == rows(df), name


def test_one_and_two_row_reports_agree(tables):
    both = reports.activation_windows(tables, RULES, REF)
    lv, test = reports.live_video_activation(tables, RULES, REF), reports.test_activation(tables, RULES, REF)
    assert rows(both) == sorted(rows(lv) + rows(test))


def test_checkpoint_folder_of_the_session_is_used(spark):
    assert use_checkpoint_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_command_line(spark, tables, tmp_path):
    from kpiloom.__main__ import main
    from kpiloom.sources import write_base_table

    arguments = ["--floor", "2025-01-01", "--ref-date", "2025-03-10", "--out", str(tmp_path / "out"), "--sink", "parquet"]
    for role, df in tables.items():
        write_base_table(df, role, str(tmp_path / role))
        arguments += ["--table", f"{role}={tmp_path / role}"]
    with pytest.raises(SystemExit):
        main([*arguments, "--database", "d", "--format", "csv"])
    main([*arguments, "--category", "SSC", "--main-category", "SSC", "--out", str(tmp_path / "ssc")])
    scope = Rules(RULES.floor_date, categories=("SSC",))
    got = spark.read.parquet(str(tmp_path / "ssc" / "kpi_retention_cohort"))
    assert rows(got) == rows(reports.retention_waterfall(tables, scope))
    main(arguments)
    got = spark.read.parquet(str(tmp_path / "out" / "kpi_retention_cohort"))
    assert rows(got) == rows(reports.retention_waterfall(tables, RULES))
