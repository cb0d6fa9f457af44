"""SQL expressions shared by the operators."""

from kpiloom.functions.dates import (
    between,
    date_attributes,
    date_literal,
    is_weekend,
    local_date,
    local_date_from,
    month_label,
    week_label,
    weekday_name,
)
from kpiloom.functions.flags import FlagSet
from kpiloom.functions.rounding import pct, pct_delta, round_ratio, whole_div
from kpiloom.functions.text import aggregate, column_name, column_names, literal, one_of, rows

__all__ = [
    "FlagSet",
    "aggregate",
    "between",
    "column_name",
    "column_names",
    "date_attributes",
    "date_literal",
    "is_weekend",
    "literal",
    "local_date",
    "local_date_from",
    "month_label",
    "one_of",
    "pct",
    "pct_delta",
    "round_ratio",
    "rows",
    "week_label",
    "weekday_name",
    "whole_div",
]
