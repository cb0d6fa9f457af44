"""Activation: the share of buyers who did something soon after buying (K1, K2, K6, K11).

All functions take the rows of ``purchase_outcomes``. "24 hours" means the purchase day and the day
after it, in local dates.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame

from kpiloom.functions import (
    FlagSet,
    aggregate,
    between,
    date_attributes,
    literal,
    pct,
    pct_delta,
    round_ratio,
    rows,
)
from kpiloom.operators.periods import report_windows

# Report labels.
LIVE_VIDEO_LABEL = "Live + Video Activation (24hr)"
TEST_LABEL = "Test Activation (24hr)"


def window_counts(facts: DataFrame, windows: Mapping[str, tuple[date, date]], outcomes: list[str]) -> DataFrame:
    """One row: distinct buyers per window, and per outcome how many of them reached it.

    Columns ``buyers_<window>``, ``<outcome>_<window>``, and ``any_<outcome>`` telling whether any
    purchase of any date reached it.
    """
    flags = FlagSet("buyers", {w: between("purchase_date", first, last) for w, (first, last) in windows.items()})
    per_user = aggregate(
        facts,
        ["user_id"],
        [
            *flags.seen(),
            *(column for o in outcomes for column in flags.seen(where=o, prefix=o)),
            *(f"bool_or({o}) AS any_{o}" for o in outcomes),
        ],
    )
    return per_user.selectExpr(
        *flags.counts(name="buyers_{}"),
        *(column for o in outcomes for column in flags.counts(prefix=o, name=o + "_{}")),
        *(f"coalesce(bool_or(any_{o}), false) AS any_{o}" for o in outcomes),
    )


def activation_report(facts: DataFrame, ref_date: date, labels: Mapping[str, str], empty: str = "drop") -> DataFrame:
    """One wide row per outcome: users and percent of buyers in twelve windows, and two deltas.

    ``labels``: outcome -> name of the KPI. ``empty``: an outcome that no buyer ever reached gives no
    row (``drop``) or a row of zeros (``zeros``).
    """
    if empty not in ("drop", "zeros"):
        raise ValueError("empty must be 'drop' or 'zeros'")
    counts = window_counts(facts, report_windows(ref_date), list(labels))
    structs = [
        f"struct(any_{o} AS reached, {literal(label)} AS kpi, {', '.join(_report_columns(o))})"
        for o, label in labels.items()
    ]
    report = rows(counts, structs)
    return (report.where("reached") if empty == "drop" else report).drop("reached")


def _report_columns(outcome: str) -> list[str]:
    def users(window: str) -> str:
        return f"{outcome}_{window}"

    def buyers(window: str) -> str:
        return f"buyers_{window}"

    def share(window: str) -> str:
        return f"{pct(users(window), buyers(window))} AS pct_{window}"

    def delta(window: str, prior: str, name: str) -> str:
        return f"{pct_delta(users(window), buyers(window), users(prior), buyers(prior))} AS {name}"

    def plain(*windows: str) -> list[str]:
        return [column for w in windows for column in (f"{users(w)} AS users_{w}", share(w))]

    def rolling(window: str) -> list[str]:
        return [f"{round_ratio(users(window), '7', 1)} AS users_{window}_daily_avg", share(window)]

    return [
        *rolling("W"),
        *rolling("W1"),
        *plain("today", "lw_same_day"),
        delta("W", "W1", "wow_delta_pct_pts"),
        *plain("MTD", "LM_MTD"),
        delta("MTD", "LM_MTD", "mom_mtd_delta_pct_pts"),
        *plain("full_LM", "LY_WTD", "LY_MTD", "LY_LW", "LY_LM", "LY_full"),
    ]


def _activated(outcomes: list[str]) -> list[str]:
    return ["count(1) AS total_purchases", *(f"count_if({o}) AS {o}_activated_24hr" for o in outcomes)]


def _shares(outcomes: list[str]) -> list[str]:
    return [
        column
        for o in outcomes
        for column in (
            f"{o}_activated_24hr",
            f"{pct(f'{o}_activated_24hr', 'total_purchases')} AS {o}_activation_pct",
        )
    ]


def activation_daily(facts: DataFrame, outcomes: list[str], transactions: bool = False) -> DataFrame:
    """Per purchase date: buyers, and per outcome how many were activated and their percent.

    ``total_purchases`` counts each buyer once a day; ``transactions`` adds the number of payments.
    """
    extra = ["sum(transactions) AS total_transactions"] if transactions else []
    daily = aggregate(facts, ["purchase_date"], [*_activated(outcomes), *extra])
    return daily.selectExpr(
        *date_attributes("purchase_date"),
        "total_purchases",
        *_shares(outcomes),
        *(["total_transactions"] if transactions else []),
    )


def activation_by_category(facts: DataFrame, outcomes: list[str]) -> DataFrame:
    """Per exam category of the buyer: buyer days, and per outcome how many were activated and their percent."""
    by_category = aggregate(facts, ["category"], _activated(outcomes))
    return by_category.selectExpr("category", "total_purchases", *_shares(outcomes))
