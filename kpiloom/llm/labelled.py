"""Bounded samples of labelled texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sampled(
    docs: DataFrame, labels: DataFrame, label: str, per_label: int, most_chars: int, key: str = "doc_id", text: str = "text"
) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """(text, label) of at most ``per_label`` rows of each label 0 and 1, and how many rows of ``labels`` have each.

    Rows are taken in the order of a hash of their key; rows with a null label or key, and those whose texts are all
    null or longer than ``most_chars`` characters, are not taken. Each task keeps its first rows of a label, so that
    no task gets all rows of one.
    """
    rows = labels.select(F.col(key).alias("key"), F.col(label).alias("label")).where("key IS NOT NULL AND label IN (0, 1)")
    counts = {row["label"]: row["count"] for row in rows.groupBy("label").count().collect()}
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(F.length("text") <= most_chars)
    usable = rows.distinct().join(texts.select("key").distinct(), "key", "left_semi")
    each = [usable.where(F.col("label") == v).orderBy(F.xxhash64("key"), "key").limit(per_label) for v in (0, 1)]
    chosen = each[0].union(each[1])
    ids = docs.sparkSession.createDataFrame(chosen.collect(), chosen.schema)
    found = texts.join(F.broadcast(ids), "key").select("key", "label", "text").distinct()
    found = found.orderBy(F.xxhash64("key"), "key", "label", "text").limit(2 * per_label).collect()
    return [(row["text"], row["label"]) for row in found], counts
