"""Report windows around a reference date, worked out on the driver so that they are plain date literals."""

from __future__ import annotations

import calendar
from datetime import UTC, date, datetime, timedelta

WINDOWS = (
    "W",
    "W1",
    "today",
    "lw_same_day",
    "MTD",
    "LM_MTD",
    "full_LM",
    "LY_WTD",
    "LY_MTD",
    "LY_LW",
    "LY_LM",
    "LY_full",
)


def yesterday(utc_offset_minutes: int = 0, now: datetime | None = None) -> date:
    """The usual reference date: the last full local day. ``now`` is the time with its zone; default: the driver's clock."""
    if now is not None and now.tzinfo is None:
        raise ValueError("the time needs a zone")
    return ((now or datetime.now(UTC)).astimezone(UTC) + timedelta(minutes=utc_offset_minutes)).date() - timedelta(days=1)


def add_months(day: date, months: int) -> date:
    """Same day of another month, or the last day of that month where it is shorter."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    return date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))


def report_windows(ref: date) -> dict[str, tuple[date, date]]:
    """First and last day of every window, both included.

    This year's weeks are rolling seven days; last year's start on Monday, 52 weeks back.
    """
    one = timedelta(days=1)
    month = ref.replace(day=1)
    last_month = add_months(month, -1)
    year_ago = timedelta(weeks=52)
    monday = ref - timedelta(days=ref.weekday()) - year_ago
    month_last_year = add_months(month, -12)
    new_year = ref.replace(month=1, day=1)
    return {
        "W": (ref - 6 * one, ref),
        "W1": (ref - 13 * one, ref - 7 * one),
        "today": (ref, ref),
        "lw_same_day": (ref - 7 * one, ref - 7 * one),
        "MTD": (month, ref),
        "LM_MTD": (last_month, add_months(ref, -1)),
        "full_LM": (last_month, month - one),
        "LY_WTD": (monday, ref - year_ago),
        "LY_MTD": (month_last_year, add_months(ref, -12)),
        "LY_LW": (monday - 7 * one, monday - one),
        "LY_LM": (add_months(month_last_year, -1), month_last_year - one),
        "LY_full": (add_months(new_year, -12), new_year - one),
    }
