"""The reports, from bound base tables.

Each function takes the tables as ``{role: DataFrame}`` (see ``kpiloom.sources``) and the ``Rules``.
Reports on buyers can also be made from one ``buyer_facts`` result, so that several of them share a
single pass over purchases and activity.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame

from kpiloom.operators import activation, content, outcomes, retention, revenue, signups
from kpiloom.functions import local_date_from
from kpiloom.operators.cleaning import Rules, activity_by_kind, in_scope, members, paid_purchases
from kpiloom.operators.outcomes import Outcome, around, within
from kpiloom.sources.schemas import CONTENT_TYPES, MAIN_CATEGORIES, WIDE_CATEGORIES, WIDE_CONTENT_TYPES
from kpiloom.sources.tables import Tables, require

ALL_KINDS = ("live", "video", "test")
RETENTION_NAMES = {"d7": "d7", "d30": "d30"}


def activation_outcomes(horizon_days: int = 1) -> dict[str, Outcome]:
    """``lv``: a live class or a video, ``test``: a finished test, by the end of the horizon."""
    return {"lv": within(horizon_days, "live", "video"), "test": within(horizon_days, "test")}


def retention_outcomes(days: Sequence[int] = (7, 30), tolerance: int = 1) -> dict[str, Outcome]:
    """``d7``, ``d30``: any activity around the 7th and 30th day after the purchase."""
    return {f"d{day}": around(day, tolerance, *ALL_KINDS) for day in days}


def buyer_facts(
    tables: Tables, rules: Rules, wanted: Mapping[str, Outcome], with_category: bool = False, max_buyers: int = 0
) -> DataFrame:
    """One row per qualified buyer and purchase day, with the wanted outcomes.

    ``with_category`` adds the buyer's category; a buyer with rows of several categories has a row for each.
    ``max_buyers``: see ``purchase_outcomes``.
    """
    purchases, users = require(tables, ["purchases", "users"])
    kinds = tuple(k for k in ALL_KINDS if any(k in outcome.kinds for outcome in wanted.values()))
    buyers = members(users, rules)
    return outcomes.purchase_outcomes(
        paid_purchases(purchases, rules),
        activity_by_kind(tables, kinds, rules),
        wanted,
        buyers if with_category else buyers.select("user_id"),
        max_buyers=max_buyers,
    )


def live_video_activation(tables: Tables, rules: Rules, ref_date: date, horizon_days: int = 1) -> DataFrame:
    """K1: live class or video within the horizon, in all report windows."""
    wanted = {"lv": activation_outcomes(horizon_days)["lv"]}
    facts = buyer_facts(tables, rules, wanted)
    return activation.activation_report(facts, ref_date, {"lv": activation.LIVE_VIDEO_LABEL})


def test_activation(tables: Tables, rules: Rules, ref_date: date, horizon_days: int = 1) -> DataFrame:
    """K2: finished test within the horizon, in all report windows."""
    wanted = {"test": activation_outcomes(horizon_days)["test"]}
    facts = buyer_facts(tables, rules, wanted)
    return activation.activation_report(facts, ref_date, {"test": activation.TEST_LABEL})


def activation_windows(tables: Tables, rules: Rules, ref_date: date, horizon_days: int = 1) -> DataFrame:
    """K1 and K2 as two rows of one report, from one pass."""
    facts = buyer_facts(tables, rules, activation_outcomes(horizon_days))
    labels = {"lv": activation.LIVE_VIDEO_LABEL, "test": activation.TEST_LABEL}
    return activation.activation_report(facts, ref_date, labels)


def activation_daily(tables: Tables, rules: Rules, horizon_days: int = 1, transactions: bool = False) -> DataFrame:
    """K6: both activations per purchase date."""
    facts = buyer_facts(tables, rules, activation_outcomes(horizon_days))
    return activation.activation_daily(facts, ["lv", "test"], transactions)


def activation_by_category(tables: Tables, rules: Rules, horizon_days: int = 1) -> DataFrame:
    """K11: both activations per exam category of the buyer."""
    facts = buyer_facts(tables, rules, activation_outcomes(horizon_days), with_category=True)
    return activation.activation_by_category(facts, ["lv", "test"])


def retention_cohorts(tables: Tables, rules: Rules, unit: str = "pairs") -> DataFrame:
    """K3: buyers back around day 7 and day 30, per month of purchase."""
    return retention.retention_cohorts(buyer_facts(tables, rules, retention_outcomes()), RETENTION_NAMES, unit)


def retention_waterfall(tables: Tables, rules: Rules, unit: str = "users") -> DataFrame:
    """K7: the same with those who did not come back."""
    return retention.retention_waterfall(buyer_facts(tables, rules, retention_outcomes()), RETENTION_NAMES, unit)


def signup_counts(
    tables: Tables,
    rules: Rules,
    ref_date: date,
    signup_offset_minutes: int = 330,
    categories: Sequence[str] = WIDE_CATEGORIES,
    main_categories: Sequence[str] = MAIN_CATEGORIES,
) -> DataFrame:
    """The daily counts that the signup reports lay out."""
    (users,) = require(tables, ["users"])
    return signups.signup_counts(
        users,
        ref_date,
        rules.floor_date,
        categories=categories,
        main_categories=main_categories,
        signup_offset_minutes=signup_offset_minutes,
    )


def signup_funnel(
    tables: Tables,
    rules: Rules,
    ref_date: date,
    signup_offset_minutes: int = 330,
    main_categories: Sequence[str] = MAIN_CATEGORIES,
) -> DataFrame:
    """K4: category selection by days after signup, per signup date."""
    counts = signup_counts(tables, rules, ref_date, signup_offset_minutes, (), main_categories)
    return signups.signup_funnel(counts, categories=main_categories)


def signup_funnel_wide(
    tables: Tables,
    rules: Rules,
    ref_date: date,
    signup_offset_minutes: int = 330,
    categories: Sequence[str] = WIDE_CATEGORIES,
) -> DataFrame:
    """K8: K4 with date attributes and all categories."""
    counts = signup_counts(tables, rules, ref_date, signup_offset_minutes, categories, ())
    return signups.signup_funnel_wide(counts, categories=categories)


def signup_funnel_long(tables: Tables, rules: Rules, ref_date: date, signup_offset_minutes: int = 330) -> DataFrame:
    """K12: K4 with a row per stage."""
    return signups.signup_funnel_long(signup_counts(tables, rules, ref_date, signup_offset_minutes, (), ()))


def signup_by_weekday(tables: Tables, rules: Rules, ref_date: date, signup_offset_minutes: int = 330) -> DataFrame:
    """K13: same-day category selection per weekday."""
    return signups.signup_by_weekday(signup_counts(tables, rules, ref_date, signup_offset_minutes, (), ()))


def content_counts(
    tables: Tables,
    rules: Rules,
    content_types: Sequence[str] = tuple(CONTENT_TYPES),
    categories: Sequence[str] = WIDE_CATEGORIES,
) -> DataFrame:
    """The daily counts that the content reports lay out."""
    (events,) = require(tables, ["content_events"])
    return content.content_counts(events, rules, content_types, categories)


def content_daily(
    tables: Tables,
    rules: Rules,
    content_types: Mapping[str, str] = CONTENT_TYPES,
    categories: Sequence[str] = MAIN_CATEGORIES,
) -> DataFrame:
    """K5: content consumed per day."""
    counts = content_counts(tables, rules, list(content_types), categories)
    return content.content_daily(counts, content_types, categories)


def content_daily_wide(
    tables: Tables,
    rules: Rules,
    content_types: Mapping[str, str] = WIDE_CONTENT_TYPES,
    categories: Sequence[str] = WIDE_CATEGORIES,
) -> DataFrame:
    """K8: K5 with date attributes and all categories."""
    counts = content_counts(tables, rules, list(content_types), categories)
    return content.content_daily_wide(counts, content_types, categories)


def content_by_type(
    tables: Tables, rules: Rules, content_types: Sequence[str] = tuple(CONTENT_TYPES)
) -> DataFrame:
    """K14: K5 with a row per content type."""
    return content.content_by_type(content_counts(tables, rules, content_types, ()), content_types)


def revenue_daily(tables: Tables, rules: Rules) -> DataFrame:
    """K15: revenue, orders, average order value and conversion per day."""
    purchases, users = require(tables, ["purchases", "users"])
    return revenue.revenue_daily(paid_purchases(purchases, rules), members(users, rules))


def journey_funnel(tables: Tables, rules: Rules, horizon_days: int = 1) -> DataFrame:
    """K16: users from signup to activation, with the drop-off at each stage."""
    wanted = {"lv": activation_outcomes(horizon_days)["lv"]}
    return signups.journey_funnel(journey_users(tables, rules), buyer_facts(tables, rules, wanted), ["lv"])


def journey_users(tables: Tables, rules: Rules) -> DataFrame:
    """Users in the scope that buyers have too: of a category in scope, signed up from the floor date on."""
    (users,) = require(tables, ["users"])
    scoped = users.where(in_scope(rules))
    return scoped if rules.floor_date is None else scoped.where(local_date_from("signup_ts", rules.floor_date, 0))
