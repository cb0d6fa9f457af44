"""Revenue and orders per day (K15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions import aggregate, pct, round_ratio


def revenue_daily(paid: DataFrame, members: DataFrame) -> DataFrame:
    """Per purchase date: buyers, orders, revenue, average order value and conversion.

    ``paid``: (user_id, purchase_date, amount), a row per transaction. Only purchases of ``members``
    count. ``conversion_pct`` is the share of all members who bought on that day. Money is added up in
    whole hundredths.
    """
    per_user = aggregate(
        paid,
        ["user_id", "purchase_date"],
        ["count(1) AS orders", "sum(cast(cast(amount as decimal(20,2)) * 100 as bigint)) AS hundredths"],
    )
    daily = aggregate(
        per_user.join(members, "user_id", "left_semi"),
        ["purchase_date"],
        ["count(1) AS buyers", "sum(orders) AS orders", "sum(hundredths) AS hundredths"],
    )
    everyone = members.selectExpr("count(DISTINCT user_id) AS everyone")  # always exactly one row
    return daily.crossJoin(F.broadcast(everyone)).selectExpr(
        "purchase_date AS date",
        "buyers",
        "orders",
        "hundredths / 100D AS revenue",
        f"{round_ratio('hundredths', 'orders * 100', 2)} AS avg_order_value",
        f"{pct('buyers', 'everyone')} AS conversion_pct",
    )
