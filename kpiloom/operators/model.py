"""Joins of the star model: facts to the dimension rows they refer to (J1, J7, J8)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions import local_date


def attach(facts: DataFrame, dimension: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Facts joined to a dimension that has at most one row per key.

    The join is left to Spark: a dimension that it measures as small is broadcast, otherwise both sides are
    shuffled and the adaptive skew join splits the facts of a key that holds a large part of them.
    """
    return facts.join(dimension, list(keys), how)


def one_per_key(dimension: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """The dimension, which fails when it is read if a key has several rows, equal ones as well.

    Rows are counted per key in the plan itself, where a join on the key follows with the same partitioning, so
    nothing is read twice and no job is run beforehand. A key with a NULL joins nothing and may repeat.
    """
    others = [c for c in dimension.columns if c not in keys]
    counted = dimension.groupBy(*keys).agg(F.count("*").alias("_rows"), *(F.first(c).alias(c) for c in others))
    named = F.concat_ws(", ", *(F.concat(F.lit(f"{k} "), F.col(k).cast("string")) for k in keys))
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    repeated = F.raise_error(F.concat(F.lit(f"{what}: several rows for "), named)).cast("boolean")
    return counted.where(F.when(known & (F.col("_rows") > 1), repeated).otherwise(True)).select(dimension.columns)


def purchases_with_users(purchases: DataFrame, users: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every purchase with columns of its buyer. A user with several rows is an error."""
    return attach(purchases, one_per_key(users.select("user_id", *columns), ["user_id"], "users"), ["user_id"])


def purchases_with_daily(
    purchases: DataFrame, daily: DataFrame, columns: Sequence[str], utc_offset_minutes: int
) -> DataFrame:
    """Every purchase with its local date and columns of a daily KPI of that date, which has one row per date."""
    dated = purchases.selectExpr("*", f"{local_date('server_time', utc_offset_minutes)} AS purchase_date")
    by_date = daily.selectExpr("date AS purchase_date", *columns)
    return attach(dated, one_per_key(by_date, ["purchase_date"], "daily KPI"), ["purchase_date"])


def users_with_funnel(users: DataFrame, funnel: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every user with columns of the daily signup funnel of the signup date, which has one row per date."""
    daily = one_per_key(funnel.select("signup_date", *columns), ["signup_date"], "signup funnel")
    return attach(users, daily, ["signup_date"])
