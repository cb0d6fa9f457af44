"""Refresh of all KPI tables in one go."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from kpiloom.operators import activation, calendar, content, outcomes, retention, signups
from kpiloom.operators.cleaning import Rules, members
from kpiloom.plans import reports, summary
from kpiloom.session import use_checkpoint_dir
from kpiloom.sources.schemas import CONTENT_TYPES, MAIN_CATEGORIES, WIDE_CATEGORIES
from kpiloom.sources.sinks import write_kpi_csv
from kpiloom.sources.tables import Tables

BOTH_LABELS = {"lv": activation.LIVE_VIDEO_LABEL, "test": activation.TEST_LABEL}


def refresh_outcomes() -> dict[str, outcomes.Outcome]:
    """The outcomes that the KPI tables count."""
    return reports.activation_outcomes() | reports.retention_outcomes()


def kpi_tables(
    spark: SparkSession,
    tables: Tables,
    rules: Rules,
    ref_date: date,
    content_types: Mapping[str, str] = CONTENT_TYPES,
    main_categories: Sequence[str] = MAIN_CATEGORIES,
    wide_categories: Sequence[str] = WIDE_CATEGORIES,
    signup_offset_minutes: int = 330,
    facts: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Every KPI table by name; activity and content, the large tables, are read once for all of them.

    ``facts``: the outcomes of ``refresh_outcomes()`` for each buyer and purchase day, if they are there already (see
    ``kpiloom.plans.history``); otherwise they are made from purchases and activity.

    What the reports share, one row per buyer and purchase day and one row per calendar day for signups
    and content, is checkpointed in the shared folder, so losing an executor later does not bring the
    base tables back into play.
    """
    use_checkpoint_dir(spark)
    cohorts = reports.retention_outcomes()
    wanted = refresh_outcomes()
    if facts is None:
        facts = reports.buyer_facts(tables, rules, wanted, max_buyers=outcomes.MAX_BUYERS).checkpoint()
    by_category = facts.join(members(tables["users"], rules).distinct(), "user_id")
    funnel = reports.signup_counts(
        tables, rules, ref_date, signup_offset_minutes, wide_categories, main_categories
    ).checkpoint()
    categories = list(dict.fromkeys([*main_categories, *wide_categories]))
    volume = reports.content_counts(tables, rules, list(content_types), categories).checkpoint()
    wide_types = {t: t for t in content_types}
    dates = facts.selectExpr("purchase_date AS day").unionAll(funnel.select("signed_up")).unionAll(volume.select("activity_date"))
    both = list(BOTH_LABELS)
    return {
        "kpi_date": calendar.date_dim_of(dates, "day").orderBy("date"),
        "kpi_activation_windows": activation.activation_report(facts, ref_date, BOTH_LABELS),
        "kpi_activation_daily": activation.activation_daily(facts, both).orderBy("date"),
        "kpi_activation_by_category": activation.activation_by_category(by_category, both).orderBy("category"),
        "kpi_retention": retention.retention_cohorts(facts, reports.RETENTION_NAMES).orderBy("purchase_cohort_month"),
        "kpi_retention_cohort": retention.retention_waterfall(facts, reports.RETENTION_NAMES).orderBy("cohort_month"),
        "kpi_signup_to_category": signups.signup_funnel(funnel, categories=main_categories).orderBy("signup_date"),
        "kpi_signup_to_category_daily": signups.signup_funnel_wide(funnel, categories=wide_categories).orderBy("date"),
        "kpi_signup_to_category_long": signups.signup_funnel_long(funnel).orderBy("date", "stage"),
        "kpi_signup_by_weekday": signups.signup_by_weekday(funnel),
        "kpi_content_consumed": content.content_daily(volume, content_types, main_categories).orderBy("activity_date"),
        "kpi_content_consumed_daily": content.content_daily_wide(volume, wide_types, wide_categories).orderBy("date"),
        "kpi_content_by_type": content.content_by_type(volume, list(content_types)).orderBy("date", "content_type"),
        "kpi_revenue_daily": reports.revenue_daily(tables, rules).orderBy("date"),
        "kpi_journey_funnel": signups.journey_funnel(reports.journey_users(tables, rules), facts, ["lv"]).orderBy("step"),
        "kpi_summary_snapshot": reduce(
            DataFrame.unionByName,
            [
                summary.activation_summary(facts, ref_date),
                summary.retention_summary(facts, cohorts, ref_date),
                summary.signup_summary(funnel, ref_date),
                summary.content_summary(volume, ref_date),
            ],
        ),
    }


def write_kpi_tables(
    kpis: Mapping[str, DataFrame], folder: str, write: Callable[[DataFrame, str], None] = write_kpi_csv
) -> None:
    """Every KPI table into a folder of its own name."""
    for name, df in kpis.items():
        write(df, f"{folder}/{name}")
