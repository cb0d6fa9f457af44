"""From signup to category selection, and the journey from signup to activation (K4, K8, K12, K13, K16).

The funnel reports are layouts of one ``signup_counts`` result.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from kpiloom.functions import (
    FlagSet,
    aggregate,
    column_names,
    date_attributes,
    date_literal,
    is_weekend,
    literal,
    local_date,
    one_of,
    pct,
    rows,
    weekday_name,
)
from kpiloom.sources.schemas import MAIN_CATEGORIES, WIDE_CATEGORIES

SIGNUP_LABEL = "Signup to Category Selected"
THRESHOLDS = (0, 1, 3, 7)


def signup_counts(
    users: DataFrame,
    ref_date: date,
    floor_date: date | None,
    thresholds: Sequence[int] = THRESHOLDS,
    categories: Sequence[str] = WIDE_CATEGORIES,
    main_categories: Sequence[str] = MAIN_CATEGORIES,
    signup_offset_minutes: int = 330,
) -> DataFrame:
    """Per signup date: signups, category selections within each threshold, signups per category and in others.

    ``others`` are the known categories that are not among ``main_categories``.

    Users are chosen by the stored signup date and grouped by the date of the shifted signup time, so a
    day after ``ref_date`` may appear. The published metric shifts a time that is local already;
    ``signup_offset_minutes=0`` gives the plain local date. Threshold 0 asks for a selection on the
    signup date itself, the others for one up to that many days later, earlier ones included.
    """
    chosen = users.where(f"signup_date <= {date_literal(ref_date)}")
    if floor_date is not None:
        chosen = chosen.where(f"signup_date >= {date_literal(floor_date)}")
    selected_at = "cast(category_selected_date as timestamp_ntz)"
    signups = chosen.selectExpr(
        "user_id",
        "category",
        f"{local_date('signup_ts', signup_offset_minutes)} AS signed_up",
        f"{local_date(selected_at, signup_offset_minutes)} AS selected",
    )
    conditions = {f"d{n}": _selected_within(n) for n in thresholds}
    conditions |= {f"category {c}": f"category = {literal(c)}" for c in (*categories, *main_categories)}
    conditions["others"] = f"NOT {one_of('category', main_categories)} AND category != ''"
    flags = FlagSet("flags", {name: f"user_id IS NOT NULL AND {c}" for name, c in conditions.items()})
    per_user = aggregate(signups, ["signed_up", "user_id"], flags.seen())
    return aggregate(per_user, ["signed_up"], ["count(user_id) AS total_signups", *flags.counts()])


def _selected_within(days: int) -> str:
    return "selected = signed_up" if days == 0 else f"selected <= date_add(signed_up, {days})"


def _thresholds(thresholds: Sequence[int]) -> list[str]:
    return [
        column
        for n in thresholds
        for column in (
            f"d{n} AS cat_selected_d{n}",
            f"{pct(f'd{n}', 'total_signups')} AS pct_cat_selected_d{n}",
        )
    ]


def signup_funnel(
    counts: DataFrame, thresholds: Sequence[int] = THRESHOLDS, categories: Sequence[str] = MAIN_CATEGORIES
) -> DataFrame:
    """Daily funnel with a few categories and the rest in ``others``."""
    return counts.selectExpr(
        f"{literal(SIGNUP_LABEL)} AS kpi",
        "signed_up AS signup_date",
        "total_signups",
        *_thresholds(thresholds),
        *(f"`category {c}` AS {name}" for c, name in column_names(categories).items()),
        "others",
    )


def signup_funnel_wide(
    counts: DataFrame, thresholds: Sequence[int] = THRESHOLDS, categories: Sequence[str] = WIDE_CATEGORIES
) -> DataFrame:
    """Daily funnel with date attributes and a column per category."""
    return counts.selectExpr(
        *date_attributes("signed_up"),
        "total_signups",
        *_thresholds(thresholds),
        *(f"`category {c}` AS cat_{name}" for c, name in column_names(categories).items()),
    )


def signup_funnel_long(counts: DataFrame, thresholds: Sequence[int] = THRESHOLDS) -> DataFrame:
    """Daily funnel with a row per date and stage: (date, stage, users, pct)."""
    stages = [
        f"struct(signed_up AS date, 'D{n}' AS stage, d{n} AS users, {pct(f'd{n}', 'total_signups')} AS pct)"
        for n in thresholds
    ]
    return rows(counts, stages)


def signup_by_weekday(counts: DataFrame) -> DataFrame:
    """Same-day selection rate per weekday, summed over the days before it is divided."""
    by_weekday = aggregate(
        counts,
        [f"{weekday_name('signed_up')} AS day_of_week", f"{is_weekend('signed_up')} AS is_weekend"],
        ["sum(total_signups) AS total_signups", "sum(d0) AS cat_selected_d0"],
    )
    return by_weekday.selectExpr("*", f"{pct('cat_selected_d0', 'total_signups')} AS pct_cat_selected_d0")


# Stages of the journey, in order.
JOURNEY_STAGES = ("Signup", "Category selected", "Purchase", "Activated 24hr")


def journey_funnel(users: DataFrame, facts: DataFrame, outcomes: Sequence[str]) -> DataFrame:
    """Distinct users per stage and how many were lost since the stage before: (step, stage, users, drop_off).

    A user is in a stage who reached it and all stages before it: signed up, selected a category, made a
    qualified purchase, and reached any of ``outcomes`` after a purchase. ``users`` and ``facts`` should have the
    same scope, or those outside it are counted as lost.
    """

    signed_up = users.selectExpr(
        "user_id", "if(signup_ts IS NOT NULL, 1, 0) | if(category_selected_date IS NOT NULL, 2, 0) AS stages"
    )
    bought = facts.selectExpr("user_id", f"4 | if({' OR '.join(outcomes)}, 8, 0) AS stages")
    per_user = aggregate(
        signed_up.unionAll(bought).where("user_id IS NOT NULL"), ["user_id"], ["bit_or(stages) AS stages"]
    )
    complete = [(2 << stage) - 1 for stage in range(len(JOURNEY_STAGES))]
    totals = per_user.selectExpr(
        *(f"count_if((stages & {mask}) = {mask}) AS stage_{stage}" for stage, mask in enumerate(complete))
    )
    drop_offs = ["cast(NULL as bigint)", *(f"stage_{s - 1} - stage_{s}" for s in range(1, len(complete)))]
    return rows(
        totals,
        [
            f"struct({stage + 1} AS step, {literal(label)} AS stage, stage_{stage} AS users, {lost} AS drop_off)"
            for stage, (label, lost) in enumerate(zip(JOURNEY_STAGES, drop_offs, strict=True))
        ],
    )
