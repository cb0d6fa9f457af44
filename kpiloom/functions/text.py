"""SQL text for names, values and aggregations."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def literal(value: str) -> str:
    """A string value as a SQL literal, kept as it is."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def one_of(column: str, values: Iterable[str]) -> str:
    """``column IN (values)``; never true for no values, and NULL for an unknown column value."""
    listed = ", ".join(literal(v) for v in values)
    return f"({column} IN ({listed}))" if listed else f"(isnull({column}) AND NULL)"


def column_name(value: str) -> str:
    """``IIT JEE`` -> ``iit_jee``: lower case, anything but letters and digits as an underscore."""
    return re.sub(r"\W+", "_", value.lower())


def column_names(values: Iterable[str]) -> dict[str, str]:
    """The column name of each value; an error if two values would share one."""
    names = {value: column_name(value) for value in values}
    shared = {value for value, name in names.items() if list(names.values()).count(name) > 1}
    if shared:
        raise ValueError(f"values with one column name: {', '.join(sorted(shared))}")
    return names


def aggregate(df: DataFrame, keys: Iterable[str], columns: Iterable[str]) -> DataFrame:
    """Group by key expressions and aggregate by SQL expressions."""
    return df.groupBy(*(F.expr(k) for k in keys)).agg(*(F.expr(c) for c in columns))


def rows(df: DataFrame, structs: Iterable[str]) -> DataFrame:
    """One output row per struct expression and input row."""
    return df.selectExpr(f"inline(array({', '.join(structs)}))")
