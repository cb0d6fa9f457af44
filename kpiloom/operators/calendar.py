"""Date dimension (K10) and daily tables laid out on it (J7)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from kpiloom.functions import date_attributes, date_literal, is_weekend


def _attributes(days: DataFrame) -> DataFrame:
    label, name, week, month = date_attributes("day")
    return days.selectExpr(label, "year(day) AS year", month, week, name, f"{is_weekend('day')} AS is_weekend")


def date_dim(spark: SparkSession, start: date, end: date) -> DataFrame:
    """A row per day from ``start`` to ``end``, both included."""
    span = f"explode(sequence({date_literal(start)}, {date_literal(end)})) AS day"
    return _attributes(spark.range(1).selectExpr(span))


def date_dim_of(df: DataFrame, column: str) -> DataFrame:
    """A row per day from the first to the last day that occurs in a date column."""
    ends = df.selectExpr(f"min({column}) AS first", f"max({column}) AS last").where("first IS NOT NULL")
    return _attributes(ends.selectExpr("explode(sequence(first, last)) AS day"))


def on_calendar(daily: DataFrame, dates: DataFrame) -> DataFrame:
    """A daily table with a row for every date of a date dimension, NULL where there was nothing."""
    own = [c for c in daily.columns if c not in dates.columns]
    return dates.join(daily.select("date", *own), "date", "left")
