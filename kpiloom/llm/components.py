"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.store import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b): root is the same for all nodes that links connect.

    Each round every node takes its smallest neighbour, if that is smaller, for its parent, and links are
    carried over to the parents; a node with a smaller neighbour is gone afterwards. Node names should be
    hashes, whose order is random, so that few rounds are enough. Null ends and loops are no links; no links
    give no rows. Every round is written to the shared folder, and no list of neighbours is ever gathered.
    """
    links = stored(_tidy(links), "links")
    roots = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().withColumn("root", F.col("node"))
    while not links.isEmpty():
        both = links.union(links.select("b", "a"))
        parents = both.groupBy(F.col("a").alias("child")).agg(F.min("b").alias("parent"))
        parents = stored(parents.where("parent < child"), "parents")
        roots = followed(roots, parents)
        left, right = (
            parents.select(F.col("child").alias(end), F.col("parent").alias(f"{end}_parent")) for end in ("a", "b")
        )
        moved = (
            links.join(left, "a", "left")
            .join(right, "b", "left")
            .select(F.coalesce("a_parent", "a").alias("a"), F.coalesce("b_parent", "b").alias("b"))
        )
        links = stored(_tidy(moved), "links")
    return stored(roots, "roots")


def merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after more links between nodes that it has: only the roots that these connect are looked at."""
    ends = [roots.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root")) for end in ("a", "b")]
    between = links.join(ends[0], "a").join(ends[1], "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))
    above = components(between).select(F.col("node").alias("child"), F.col("root").alias("parent"))
    return stored(followed(roots, above), "merged")


def followed(roots: DataFrame, parents: DataFrame) -> DataFrame:
    """``roots`` with every root that has a parent replaced by it."""
    return roots.join(parents, roots["root"] == parents["child"], "left").select(
        "node", F.coalesce("parent", "root").alias("root")
    )


def _tidy(links: DataFrame) -> DataFrame:
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
