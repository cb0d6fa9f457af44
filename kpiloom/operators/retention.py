"""Retention of buyers by month of purchase (K3, K7), from the rows of ``purchase_outcomes``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from kpiloom.functions import aggregate, literal, month_label, pct

RETENTION_LABEL = "Retention"
UNITS = ("pairs", "users")


def cohort_counts(facts: DataFrame, outcomes: list[str]) -> DataFrame:
    """Per purchase month: distinct buyers, and per outcome the retained purchase days and retained buyers."""
    per_user = aggregate(
        facts, ["user_id", "trunc(purchase_date, 'month') AS cohort"], [f"count_if({o}) AS {o}" for o in outcomes]
    )
    return aggregate(
        per_user,
        ["cohort"],
        [
            "count(1) AS buyers",
            *(f"sum({o}) AS {o}_pairs" for o in outcomes),
            *(f"count_if({o} > 0) AS {o}_users" for o in outcomes),
        ],
    )


def _retained(outcome: str, unit: str) -> str:
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    return f"{outcome}_{unit}"


def retention_cohorts(facts: DataFrame, names: Mapping[str, str], unit: str = "pairs") -> DataFrame:
    """Per purchase month, users retained and their percent of the month's buyers.

    ``names``: outcome -> column stem. With ``unit="pairs"`` a buyer counts once per purchase day
    retained, over distinct buyers, so that the percent can pass 100; with ``unit="users"`` once a month.
    """
    columns = []
    for outcome, stem in names.items():
        retained = _retained(outcome, unit)
        columns += [f"{retained} AS {stem}_retained_users", f"{pct(retained, 'buyers')} AS {stem}_retention_pct"]
    columns.insert(1, "buyers AS total_purchase_users")
    return cohort_counts(facts, list(names)).selectExpr(
        f"{literal(RETENTION_LABEL)} AS kpi", *columns, "cohort AS purchase_cohort_month"
    )


def retention_waterfall(facts: DataFrame, names: Mapping[str, str], unit: str = "users") -> DataFrame:
    """Per purchase month, users retained and not retained.

    Those not retained are the buyers less those retained, which adds up only for ``unit="users"``.
    """
    columns = []
    for outcome, stem in names.items():
        retained = _retained(outcome, unit)
        columns += [f"{retained} AS {stem}_retained_users", f"{pct(retained, 'buyers')} AS {stem}_retention_pct"]
    columns += [f"buyers - {_retained(outcome, unit)} AS {stem}_not_retained" for outcome, stem in names.items()]
    return cohort_counts(facts, list(names)).selectExpr(
        f"{month_label('cohort')} AS cohort_month", "buyers AS total_purchased_users", *columns
    )
