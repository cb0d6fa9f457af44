"""The long KPI summary (K9): (kpi, window, users, pct, denom_label).

Users are whole numbers and percents have one decimal, both rounded once from the counts. An average
per day divides by the days of its window, also by those on which nothing happened.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame

from kpiloom.functions import between, date_literal, literal, pct, round_ratio, rows
from kpiloom.operators.activation import window_counts
from kpiloom.operators.cleaning import Rules
from kpiloom.operators.content import daily_active_users
from kpiloom.operators.outcomes import Outcome
from kpiloom.operators.periods import report_windows
from kpiloom.operators.retention import cohort_counts
from kpiloom.operators.signups import signup_counts
from kpiloom.plans.reports import activation_outcomes, buyer_facts, retention_outcomes
from kpiloom.sources.tables import Tables, require

# Labels of the summary.
ACTIVATION_KPIS = {"lv": "Live+Video Activation (24hr)", "test": "Test Activation (24hr)"}
ACTIVATION_WINDOWS = {
    "W": ("W (7-day avg)", "Purchasers W", 7),
    "W1": ("W-1 (7-day avg)", "Purchasers W-1", 7),
    "today": ("Today", "Purchasers Today", 1),
    "MTD": ("MTD", "Purchasers MTD", 1),
    "full_LM": ("Full LM", "Purchasers Full LM", 1),
}
SIGNUP_KPI = "Signup to Category (D1)"
CONTENT_KPI = "Content Consumed / DAU"


def _row(kpi: str, window: str, users: str, share: str, label: str) -> str:
    return (
        f"struct({literal(kpi)} AS kpi, {literal(window)} AS window, cast({users} as bigint) AS users, "
        f"cast({share} as double) AS pct, {literal(label)} AS denom_label)"
    )


def _per_day(total: str, days: int) -> str:
    return round_ratio(total, str(days), 0)


def activation_summary(facts: DataFrame, ref_date: date, digits: int = 1) -> DataFrame:
    """Activation in five windows; an outcome nobody reached still has its rows."""
    bounds = report_windows(ref_date)
    counts = window_counts(facts, {w: bounds[w] for w in ACTIVATION_WINDOWS}, list(ACTIVATION_KPIS))
    return rows(
        counts,
        [
            _row(kpi, name, _per_day(f"{o}_{w}", days), pct(f"{o}_{w}", f"buyers_{w}", digits), label)
            for o, kpi in ACTIVATION_KPIS.items()
            for w, (name, label, days) in ACTIVATION_WINDOWS.items()
        ],
    )


def retention_summary(
    facts: DataFrame,
    outcomes: Mapping[str, Outcome],
    ref_date: date,
    unit: str = "pairs",
    complete_only: bool = True,
    digits: int = 1,
) -> DataFrame:
    """Retention per cohort; by default only of cohorts whose last buyer can have come back by ``ref_date``."""
    structs = [
        f"struct(date_add(last_day(cohort), {outcome.last_day}) AS due, '{name.upper()} Retention' AS kpi, "
        f"concat(date_format(cohort, 'MMM yyyy'), ' cohort') AS window, {name}_{unit} AS users, "
        f"{pct(f'{name}_{unit}', 'buyers', digits)} AS pct, "
        f"concat(date_format(cohort, 'MMM'), ' Purchasers') AS denom_label)"
        for name, outcome in outcomes.items()
    ]
    cohorts = rows(cohort_counts(facts, list(outcomes)), structs)
    return (cohorts.where(f"due <= {date_literal(ref_date)}") if complete_only else cohorts).drop("due")


def _windows_of_days(ref_date: date) -> dict[str, tuple[date, int]]:
    """First day and number of days of: the reference day, the seven days and the month up to it."""
    return {
        "Yesterday": (ref_date, 1),
        "W": (ref_date - timedelta(days=6), 7),
        "MTD": (ref_date.replace(day=1), ref_date.day),
    }


def _window_sums(daily: DataFrame, day: str, columns: list[str], ref_date: date) -> DataFrame:
    return daily.selectExpr(
        *(
            f"coalesce(sum(if({between(day, first, ref_date)}, {c}, 0L)), 0L) AS {c}_{window}"
            for window, (first, _) in _windows_of_days(ref_date).items()
            for c in columns
        )
    )


def signup_summary(counts: DataFrame, ref_date: date, digits: int = 1) -> DataFrame:
    """Category selected within a day of signup: yesterday, per day of the week, and month to date."""
    sums = _window_sums(counts, "signed_up", ["d1", "total_signups"], ref_date)
    names = {"Yesterday": ("Yesterday", 1), "W": ("W avg", 7), "MTD": ("MTD", 1)}
    return rows(
        sums,
        [
            _row(SIGNUP_KPI, name, _per_day(f"d1_{w}", days), pct(f"d1_{w}", f"total_signups_{w}", digits), f"Signups {w}")
            for w, (name, days) in names.items()
        ],
    )


def content_summary(daily: DataFrame, ref_date: date) -> DataFrame:
    """Daily active users: yesterday, and on average per day of the week and of the month to date."""
    sums = _window_sums(daily, "activity_date", ["dau"], ref_date)
    structs = []
    for w, (_, days) in _windows_of_days(ref_date).items():
        name = w if w == "Yesterday" else f"{w} avg"
        structs.append(_row(CONTENT_KPI, name, _per_day(f"dau_{w}", days), "NULL", f"DAU {name}"))
    return rows(sums, structs)


def kpi_summary(
    tables: Tables,
    rules: Rules,
    ref_date: date,
    unit: str = "pairs",
    complete_cohorts_only: bool = True,
    signup_offset_minutes: int = 330,
    signups: DataFrame | None = None,
) -> DataFrame:
    """All parts of the summary. Activation and retention share one pass over purchases and activity.

    ``signups``: the table to take signups from, if it is not the users table.
    """
    cohorts = retention_outcomes()
    facts = buyer_facts(tables, rules, activation_outcomes() | cohorts)
    users, events = require(tables, ["users", "content_events"])
    funnel = signup_counts(
        users if signups is None else signups, ref_date, rules.floor_date, (1,), (), (), signup_offset_minutes
    )
    parts = [
        activation_summary(facts, ref_date),
        retention_summary(facts, cohorts, ref_date, unit, complete_cohorts_only),
        signup_summary(funnel, ref_date),
        content_summary(daily_active_users(events, rules), ref_date),
    ]
    return reduce(DataFrame.unionByName, parts)
