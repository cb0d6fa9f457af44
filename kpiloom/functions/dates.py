"""Local calendar dates, date labels and pushdown-friendly date floors, as Spark SQL expressions."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta


def local_date(ts: str, offset_minutes: int) -> str:
    """Calendar date of a UTC timestamp in a zone ``offset_minutes`` ahead of UTC."""
    if offset_minutes == 0:
        return f"cast({ts} as date)"
    return f"cast({ts} + INTERVAL '{int(offset_minutes)}' MINUTE as date)"


def date_literal(day: date) -> str:
    return f"DATE '{day.isoformat()}'"


def between(column: str, first: date, last: date) -> str:
    """Date within a range, both ends included."""
    return f"{column} BETWEEN {date_literal(first)} AND {date_literal(last)}"


def local_date_from(ts: str, floor: date, offset_minutes: int) -> str:
    """``local_date(ts) >= floor``, written on the bare timestamp so that it reaches the file scan."""
    first = datetime.combine(floor, time()) - timedelta(minutes=offset_minutes)
    return f"{ts} >= TIMESTAMP_NTZ '{first.isoformat(sep=' ')}'"


def weekday_name(day: str) -> str:
    """``Monday`` .. ``Sunday``."""
    return f"date_format({day}, 'EEEE')"


def week_label(day: str) -> str:
    """``2025-W01``: weeks start on Monday, and the days before the first Monday are week 00."""
    week = f"(dayofyear({day}) + 6 - weekday({day})) div 7"
    return f"concat(date_format({day}, 'yyyy'), '-W', lpad(cast({week} as string), 2, '0'))"


def month_label(day: str) -> str:
    """``2025-01``."""
    return f"date_format({day}, 'yyyy-MM')"


def is_weekend(day: str) -> str:
    return f"weekday({day}) >= 5"


def date_attributes(day: str) -> list[str]:
    """The date columns that every daily table carries."""
    return [
        f"{day} AS date",
        f"{weekday_name(day)} AS day_of_week",
        f"{week_label(day)} AS week",
        f"{month_label(day)} AS month",
    ]
