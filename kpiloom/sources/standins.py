"""The base tables, stood in for by general test tables (orders, line items, customers, events).

Three profiles. ``events`` has a month of events, so its cohorts are short; ``orders`` has seven years, so that
last year's windows are not empty; ``signup`` makes every signup event a user. Floors lie inside the data, and
texts, amounts and categories are varied by row, so that each filter has something to remove. Frames are built
under the stored names and types of the data dictionary and go through its renaming.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from kpiloom.functions import aggregate, local_date_from
from kpiloom.operators.cleaning import Rules
from kpiloom.operators.model import attach
from kpiloom.sources.schemas import TABLES
from kpiloom.sources.tables import Tables

EVENTS_FLOOR = date(2024, 1, 5)
EVENTS_REF = date(2024, 1, 28)
ORDERS_FLOOR = date(1996, 1, 1)
ORDERS_REF = date(2000, 6, 15)
ORDERS_HORIZON = 7

SEGMENTS = ("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY")
MAIN_SEGMENTS = SEGMENTS[:3]
EVENT_TYPES = {"click": "click", "error": "error", "purchase": "purchase", "signup": "signup", "view": "view"}

EVENTS_RULES = Rules(EVENTS_FLOOR, categories=SEGMENTS)
ORDERS_RULES = Rules(ORDERS_FLOOR, utc_offset_minutes=0, categories=None)


# Columns read from the test tables.
COLUMNS = {
    "customer": "c_custkey BIGINT, c_mktsegment STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_shipdate TIMESTAMP_NTZ",
}


def _load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


# What rows are given beside their own values, by their number: unknown and empty categories, free purchases, free
# and unknown screens in any case, quizzes and unknown titles.
VARIED = {
    "category": "CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 17 = 1 THEN '' ELSE c_mktsegment END",
    "amount": "CASE WHEN event_id % 11 = 0 THEN 0 ELSE ceil(value) END",
    "screen": "CASE event_id % 7 WHEN 0 THEN 'Free Home' WHEN 1 THEN 'tab FREE' WHEN 2 THEN NULL ELSE 'Home' END",
    "title": "CASE event_id % 5 WHEN 0 THEN 'Daily QUIZ' WHEN 1 THEN NULL WHEN 2 THEN 'A quiz' ELSE 'Mock' END",
}
PLAIN = {"category": "c_mktsegment", "amount": "ceil(value)", "screen": "props", "title": "props"}


def _bound(role: str, df: DataFrame, **values: str) -> DataFrame:
    """A base table from SQL values of its stored columns, by their names here; other columns are NULL."""
    spec = TABLES[role]
    stored = [
        f"cast({values.get(name, 'NULL')} as {kind.simpleString()}) AS {column}" for column, name, kind in spec.columns
    ]
    return spec.rename(df.selectExpr(*stored))


def _customers(spark: SparkSession, folder: str, varied: dict[str, str] = VARIED) -> DataFrame:
    customers = _load(spark, folder, "customer")
    return customers.selectExpr("c_custkey AS user_id", f"{varied['category']} AS category")


def events_tables(spark: SparkSession, folder: str, varied: dict[str, str] = VARIED) -> Tables:
    """Events by type as purchases, live sessions, videos, tests and content; customers as users."""
    events = _load(spark, folder, "events")
    stamp = {"user_id": "user_id", "server_time": "ts", "day": "cast(ts as date)"}

    def of_type(name: str) -> DataFrame:
        return events.where(f"event_type = '{name}'")

    customers = _customers(spark, folder, varied)
    owned = attach(events, customers, ["user_id"])
    return {
        "users": _bound("users", customers, user_id="user_id", category="category"),
        "purchases": _bound(
            "purchases", of_type("purchase"), transaction_id="event_id", amount=varied["amount"], **stamp
        ),
        "live_sessions": _bound("live_sessions", of_type("view"), screen=varied["screen"], **stamp),
        "video_events": _bound("video_events", of_type("click"), **stamp),
        "test_attempts": _bound(
            "test_attempts",
            of_type("error"),
            action="if(event_id % 3 != 0, 'finished', 'abandoned')",
            title=varied["title"],
            **stamp,
        ),
        "content_events": _bound(
            "content_events",
            owned,
            consumption_id="event_id",
            content_type="event_type",
            duration_seconds="floor(value)",
            category="category",
            **stamp,
        ),
    }


def event_times(spark: SparkSession, folder: str) -> DataFrame:
    """The time of every event."""
    return _load(spark, folder, "events").selectExpr("ts AS server_time")


def orders_purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as purchases, at midnight of the order date."""
    return _bound(
        "purchases",
        _load(spark, folder, "orders"),
        transaction_id="o_orderkey",
        user_id="o_custkey",
        server_time="o_orderdate",
        day="cast(o_orderdate as date)",
        amount="ceil(o_totalprice)",
    )


def order_times(spark: SparkSession, folder: str) -> DataFrame:
    """The time of every order."""
    return _load(spark, folder, "orders").selectExpr("o_orderdate AS server_time")


def orders_activity(spark: SparkSession, folder: str, floor: date = ORDERS_FLOOR) -> DataFrame:
    """Shipments from ``floor`` on as activity of the customer who ordered: (user_id, activity_date).

    No counted purchase is earlier, so what was shipped before follows none; the condition reaches the files.
    An order with very many lines is left to the adaptive skew join, which splits its lines over several tasks.
    """
    owners = _load(spark, folder, "orders").selectExpr("o_orderkey AS l_orderkey", "o_custkey AS user_id")
    lines = _load(spark, folder, "lineitem").where(local_date_from("l_shipdate", floor, 0))
    shipped = lines.selectExpr("l_orderkey", "cast(l_shipdate as date) AS activity_date")
    return shipped.join(owners, "l_orderkey").select("user_id", "activity_date")


def _signup_events(spark: SparkSession, folder: str) -> DataFrame:
    """Signup events with the person, their category and the date of their first click from then on.

    The first click is looked up by day: on the signup day itself if the last click of that day is not
    earlier than the signup, else on the next day with a click. That needs a row per person and day
    only, however many events a person has; the days of a person are gone through once, from the last.
    Signups of a person and day that are very many are left to the adaptive skew join.
    """
    events = _load(spark, folder, "events").selectExpr(
        "event_id", "user_id AS person", "ts", "cast(ts as date) AS signup_date", "event_type"
    )
    days = aggregate(
        events.where("event_type IN ('signup', 'click')"),
        ["person", "signup_date"],
        ["max(if(event_type = 'click', ts, NULL)) AS last_click"],
    )
    later = "PARTITION BY person ORDER BY signup_date DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    days = days.selectExpr(
        "*", f"min(if(last_click IS NOT NULL, signup_date, NULL)) OVER ({later}) AS next_click_date"
    )
    people = _customers(spark, folder).withColumnRenamed("user_id", "person")
    signups = events.where("event_type = 'signup'").withColumnRenamed("ts", "signup_ts")
    found = attach(attach(signups, days, ["person", "signup_date"]), people, ["person"])
    return found.selectExpr(
        "event_id",
        "person",
        "category",
        "signup_ts",
        "signup_date",
        "if(last_click >= signup_ts, signup_date, next_click_date) AS category_selected_date",
    )


def signup_users(spark: SparkSession, folder: str) -> DataFrame:
    """Each signup event as a user of its own; the person's first click from then on selects the category."""
    own = {c: c for c in ("signup_ts", "signup_date", "category", "category_selected_date")}
    return _bound("users", _signup_events(spark, folder), user_id="event_id", **own)


def signup_tables(spark: SparkSession, folder: str) -> Tables:
    """Only the users table, of ``signup_users``."""
    return {"users": signup_users(spark, folder)}


def journey_tables(spark: SparkSession, folder: str) -> Tables:
    """The tables of ``events_tables``, with customers who know their first signup and what followed it."""
    first = aggregate(
        _signup_events(spark, folder),
        ["person AS user_id"],
        [
            "min(signup_ts) AS signup_ts",
            "min(signup_date) AS signup_date",
            "min_by(category_selected_date, signup_ts) AS category_selected_date",
        ],
    )
    known = _customers(spark, folder).join(first, "user_id", "left")
    users = _bound("users", known, **{c: c for c in ("user_id", "category", *first.columns[1:])})
    return {**events_tables(spark, folder), "users": users}
