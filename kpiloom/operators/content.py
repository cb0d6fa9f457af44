"""Content consumed per day (K5, K8, K14). The reports are layouts of one ``content_counts`` result.

Counts of distinct users come from one row per day and user that is combined before the shuffle, so
a day or a user with a large part of all events costs no more than the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from kpiloom.functions import (
    FlagSet,
    aggregate,
    column_names,
    date_attributes,
    literal,
    local_date,
    round_ratio,
    rows,
    whole_div,
)
from kpiloom.operators.cleaning import Rules, in_scope, since_floor
from kpiloom.sources.schemas import CONTENT_TYPES, MAIN_CATEGORIES, WIDE_CATEGORIES, WIDE_CONTENT_TYPES

CONTENT_LABEL = "Content Consumed Per Day"


def content_rows(content_events: DataFrame, rules: Rules) -> DataFrame:
    """Events in scope, by the category of the event, with their local date."""
    consumed_on = local_date("server_time", rules.utc_offset_minutes)
    return (
        since_floor(content_events, rules)
        .where(in_scope(rules))
        .selectExpr(f"{consumed_on} AS activity_date", "user_id", "content_type", "category", "duration_seconds")
    )


def daily_active_users(content_events: DataFrame, rules: Rules) -> DataFrame:
    """Distinct users per day: (activity_date, dau)."""
    per_user = content_rows(content_events, rules).select("activity_date", "user_id").distinct()
    return aggregate(per_user, ["activity_date"], ["count(user_id) AS dau"])


def content_counts(
    content_events: DataFrame, rules: Rules, content_types: Sequence[str], categories: Sequence[str]
) -> DataFrame:
    """Per day: users, events and seconds, users and events per type, users per category."""
    known = "user_id IS NOT NULL"
    flags = FlagSet("flags", {f"category {c}": f"{known} AND category = {literal(c)}" for c in categories})
    per_user = aggregate(
        content_rows(content_events, rules),
        ["activity_date", "user_id"],
        [
            "count(1) AS events",
            "sum(duration_seconds) AS seconds",
            *(f"count_if(content_type = {literal(t)}) AS `type {t}`" for t in content_types),
            *flags.seen(),
        ],
    )
    return aggregate(
        per_user,
        ["activity_date"],
        [
            "count(user_id) AS dau",
            "sum(events) AS events",
            "sum(seconds) AS seconds",
            *(f"count_if(`type {t}` > 0 AND {known}) AS `users {t}`" for t in content_types),
            *(f"sum(`type {t}`) AS `events {t}`" for t in content_types),
            *flags.counts(),
        ],
    )


# Whole seconds per user come first, then minutes.
VOLUME = (
    "dau",
    "events AS total_consumption_events",
    f"{round_ratio('events', 'dau', 2)} AS avg_items_per_user",
    f"{round_ratio('seconds', '3600', 1)} AS total_watch_hours",
    f"{round_ratio(whole_div('seconds', 'dau'), '60', 1)} AS avg_watch_min_per_user",
)


def _by_type(content_types: Mapping[str, str]) -> list[str]:
    stems = column_names(content_types.values())
    return [
        column
        for t, stem in content_types.items()
        for column in (
            f"`users {t}` AS {stems[stem]}_users",
            f"`events {t}` AS {stems[stem]}_events",
        )
    ]


def content_daily(
    counts: DataFrame,
    content_types: Mapping[str, str] = CONTENT_TYPES,
    categories: Sequence[str] = MAIN_CATEGORIES,
) -> DataFrame:
    """Daily content report with a few categories. ``content_types``: type -> column stem."""
    return counts.selectExpr(
        f"{literal(CONTENT_LABEL)} AS kpi",
        "activity_date",
        *VOLUME,
        *_by_type(content_types),
        *(f"`category {c}` AS {name}_users" for c, name in column_names(categories).items()),
    )


def content_daily_wide(
    counts: DataFrame,
    content_types: Mapping[str, str] = WIDE_CONTENT_TYPES,
    categories: Sequence[str] = WIDE_CATEGORIES,
) -> DataFrame:
    """Daily content report with date attributes and a column per category."""
    return counts.selectExpr(
        *date_attributes("activity_date"),
        *VOLUME,
        *_by_type(content_types),
        *(f"`category {c}` AS cat_{name}_users" for c, name in column_names(categories).items()),
    )


def content_by_type(counts: DataFrame, content_types: Sequence[str] = tuple(CONTENT_TYPES)) -> DataFrame:
    """A row per day and content type, for stacked charts: (date, content_type, users, events)."""
    return rows(
        counts,
        [
            f"struct(activity_date AS date, {literal(t)} AS content_type, `users {t}` AS users, `events {t}` AS events)"
            for t in content_types
        ],
    )
