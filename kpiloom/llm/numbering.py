"""Numbers without gaps inside groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(rows: DataFrame, group: str, block: Column, by: list[str], name: str) -> DataFrame:
    """``rows`` with the column ``name``: numbers from 0 in each group, without gaps.

    Each group is cut into blocks, and numbered block by block and inside by the order of the columns ``by``; rows
    equal in all of ``by`` are interchangeable. So no group is ever sorted as a whole: a task sorts blocks.
    ``block`` should spread rows evenly. The counts of the blocks, which are broadcast, are at most as many rows
    as groups times blocks: the caller chooses both so that this is small whatever the input is.
    """
    rows = rows.withColumn("_block", block)
    counts = rows.groupBy(group, "_block").count()
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, "_block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(group, "_block").orderBy(*by)
    return (
        rows.withColumn("_place", F.row_number().over(inside) - 1)
        .join(F.broadcast(starts), [group, "_block"])
        .withColumn(name, (F.col("_start") + F.col("_place")).cast("long"))
        .drop("_block", "_start", "_place")
    )
