"""Rounded ratios that come out the same on every engine, as Spark SQL expressions.

A ratio of two counts is rounded with whole-number arithmetic, half away from zero, so a tie such as
87 of 160 is always 54.38 and never depends on how a double happens to be stored. All functions here
take and give SQL text; the arguments are column names or expressions of whole numbers.
"""

from __future__ import annotations


def whole_div(numerator: str, denominator: str) -> str:
    """Whole-number quotient, truncated toward zero; NULL where the denominator is 0."""
    return f"(({numerator}) div nullif({denominator}, 0))"


def round_ratio(numerator: str, denominator: str, digits: int) -> str:
    """``numerator / denominator`` rounded once to ``digits`` places, NULL where the denominator is 0.

    Neither side is negative.
    """
    scale = 10**digits
    rounded = whole_div(f"({numerator}) * {2 * scale} + ({denominator})", f"({denominator}) * 2")
    return f"({rounded} / {scale}D)"


def pct(part: str, whole: str, digits: int = 2) -> str:
    """Share of ``part`` in ``whole`` in percent."""
    return round_ratio(f"({part}) * 100", whole, digits)


def pct_delta(part: str, whole: str, prior_part: str, prior_whole: str, digits: int = 2) -> str:
    """Difference of two percentages in points, rounded once from the exact fraction."""
    d, d1 = (f"cast({whole_} as decimal(19,0))" for whole_ in (whole, prior_whole))
    gap = f"({part} * {d1} - {prior_part} * {d})"
    return f"(if({gap} < 0, -1, 1) * {pct(f'abs({gap})', f'({d} * {d1})', digits)})"
