"""From raw facts to (user, local date) rows: which rows count, and on which day."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame

from kpiloom.functions import date_literal, literal, local_date, local_date_from, one_of
from kpiloom.sources.schemas import EXAM_CATEGORIES
from kpiloom.sources.tables import require


@dataclass(frozen=True)
class Rules:
    """What counts. The defaults are the published definitions; only the floor date has to be chosen.

    ``floor_date``: first day in the reports. It is applied to the UTC partition date and to the local
    date, so the local hours before UTC midnight of that day are left out. None means no floor.
    ``categories``: the user categories in scope. None means all users, known or not.
    """

    floor_date: date | None
    utc_offset_minutes: int = 330
    categories: tuple[str, ...] | None = EXAM_CATEGORIES
    free_pattern: str = "%free%"
    quiz_pattern: str = "%quiz%"
    finished_action: str = "finished"


def since_floor(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows on or after the floor date, by partition date and by local date.

    Both conditions are on stored columns: the first prunes partitions, the second reaches the files.
    """
    if rules.floor_date is None:
        return df
    by_partition = f"day >= {date_literal(rules.floor_date)}"
    return df.where(f"{by_partition} AND {local_date_from('server_time', rules.floor_date, rules.utc_offset_minutes)}")


def in_scope(rules: Rules) -> str:
    """Condition that a category is one of those reported."""
    return "true" if rules.categories is None else one_of("category", rules.categories)


def unlike(column: str, pattern: str) -> str:
    """Condition that a text is known and not of the pattern, in any case. Unknown text does not pass."""
    return f"lower({column}) NOT LIKE {literal(pattern)}"


def paid_purchases(purchases: DataFrame, rules: Rules) -> DataFrame:
    """Purchases with money paid: (user_id, purchase_date, amount), one row per transaction."""
    bought_on = local_date("server_time", rules.utc_offset_minutes)
    return since_floor(purchases, rules).where("amount > 0").selectExpr(
        "user_id", f"{bought_on} AS purchase_date", "amount"
    )


def members(users: DataFrame, rules: Rules) -> DataFrame:
    """Users whose category is in scope: (user_id, category)."""
    return users.where(in_scope(rules)).select("user_id", "category")


def activity_rows(facts: DataFrame, rules: Rules) -> DataFrame:
    """(user_id, activity_date) of every row from the floor date on.

    The floor on the local date removes nothing that a report counts: that always follows a purchase,
    and purchases have the same floor.
    """
    active_on = local_date("server_time", rules.utc_offset_minutes)
    return since_floor(facts, rules).selectExpr("user_id", f"{active_on} AS activity_date")


def live_activity(live_sessions: DataFrame, rules: Rules) -> DataFrame:
    """Live classes, without those started from a free screen or from an unknown one."""
    return activity_rows(live_sessions.where(unlike("screen", rules.free_pattern)), rules)


def video_activity(video_events: DataFrame, rules: Rules) -> DataFrame:
    """Recorded videos watched."""
    return activity_rows(video_events, rules)


def test_activity(test_attempts: DataFrame, rules: Rules) -> DataFrame:
    """Tests finished, without quizzes and tests of unknown title."""
    finished = f"action = {literal(rules.finished_action)} AND {unlike('title', rules.quiz_pattern)}"
    return activity_rows(test_attempts.where(finished), rules)


# Kinds of activity, the table each comes from and how it is cleaned.
ACTIVITY_KINDS = {
    "live": ("live_sessions", live_activity),
    "video": ("video_events", video_activity),
    "test": ("test_attempts", test_activity),
}


def activity_by_kind(tables: Mapping[str, DataFrame], kinds: tuple[str, ...], rules: Rules) -> dict[str, DataFrame]:
    """Cleaned activity of each kind, from the bound base tables."""
    require(tables, [ACTIVITY_KINDS[kind][0] for kind in kinds])
    return {kind: ACTIVITY_KINDS[kind][1](tables[ACTIVITY_KINDS[kind][0]], rules) for kind in kinds}
