"""Documents that contain items of a benchmark, by MinHash containment search, with DataFrame functions only.

Sets are the distinct shingles of five words (lower case, split at space and 0x09-0x0D); an item of fewer
words is one shingle, looked for among the documents' shingles of that many words. A document contains an item
if it has the given share of the item's shingles.

Similarity says little about a short item in a long document, so the items alone are signed. They are parted
by the size of their sets into classes of doubling size; each class has as many minima as its largest set
may have shingles missing from a document that counts, and one more. A document that contains the item must
hold one of these minima, so looking for the minima among the documents' shingles misses nothing. The
documents that hold one are then compared with all shingles of the items, as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm.store import stored

# Bytes of an index of items up to which it is broadcast; a larger one is shuffled. ROW_BYTES is what a row takes beside text.
BROADCAST_BYTES, ROW_BYTES = 32 << 20, 100
# Parts of one in which the share is given, to compare whole numbers.
SCALE = 1000


def word_list(text: str) -> Column:
    """The words of a text; a null text has none."""
    blank = "concat(' ', char(9), char(10), char(11), char(12), char(13))"
    trimmed = f"trim(BOTH {blank} FROM lower(coalesce({text}, '')))"
    return F.expr(f"if({trimmed} = '', cast(array() AS ARRAY<STRING>), split({trimmed}, '[ \\\\x09-\\\\x0D]+'))")


def shingles(words: str, size: int) -> Column:
    """All runs of ``size`` words of an array column, as text."""
    parts = ", ".join(f"get({words}, i + {k})" for k in range(size))
    every = f"transform(sequence(0, size({words}) - {size}), i -> concat_ws(' ', {parts}))"
    return F.expr(f"if(size({words}) < {size}, cast(array() AS ARRAY<STRING>), {every})")


def _small(index: DataFrame) -> DataFrame:
    """The index, to be broadcast if its rows and the shingles in them take few enough bytes."""
    text = F.octet_length("shingle") if "shingle" in index.columns else F.lit(0)
    size = index.agg(F.sum(text + ROW_BYTES)).first()[0] or 0
    return F.broadcast(index) if size <= BROADCAST_BYTES else index


def item_sets(items: DataFrame, item: str, text: str, shingle_words: int) -> DataFrame:
    """(item, words_each, shingle, n_shingles): the distinct shingles of every item that has words.

    Each id and text is an item of its own, named by the struct of the id and the text's hash.
    """
    named = F.struct(F.col(item).alias("id"), F.xxhash64(F.col(text)).alias("text_hash")).alias("item")
    rows = items.select(named, word_list(f"`{text}`").alias("words"))
    cases = shingles("words", shingle_words)
    for size in range(1, shingle_words):
        cases = F.when(F.size("words") == size, shingles("words", size)).otherwise(cases)
    words_each = F.least(F.size("words"), F.lit(shingle_words)).alias("words_each")
    sets = rows.select("item", words_each, F.explode(cases).alias("shingle")).distinct()
    sizes = sets.groupBy(F.col("item").alias("of")).agg(F.count("*").alias("n_shingles"))
    return stored(sets.join(sizes, F.col("item").eqNullSafe(F.col("of"))).drop("of"), "items")


def minima(sets: DataFrame, share: float) -> DataFrame:
    """(item, shingle): each item's least shingles by hash, as many as its size class may miss and one more."""
    largest = F.expr("cast(pow(2, ceil(log2(n_shingles))) AS BIGINT)")
    needed = F.floor(largest * (SCALE - round(share * SCALE)) / SCALE) + 1
    ranked = Window.partitionBy("item").orderBy(F.xxhash64("shingle"), "shingle")
    return sets.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= needed).select("item", "shingle")


def contained(
    docs: DataFrame,
    items: DataFrame,
    share: float = 0.8,
    shingle_words: int = 5,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row for each pair of a document and an item that it contains: key, item, matched, n_shingles, containment
    and text_hash, the xxhash64 of the document's text, which tells rows of a null or repeated key apart.

    Null and empty texts contain nothing, and items without words are contained in nothing. Rows with the same
    key and text are one document, and items with the same id and text one item; different texts of one id, or of a
    null one, are items of their own. A null key or id stays null in the result. Every text is read in whole. Other
    columns are not looked at, whatever they are called.
    """
    sets = item_sets(items, item, item_text, shingle_words)
    sizes = sorted(row[0] for row in sets.select("words_each").distinct().collect())
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    if not sizes:
        sizes = [shingle_words]
    index = _small(minima(sets, share).select("item", F.xxhash64("shingle").alias("hash")))
    rows = docs.select("key", F.xxhash64("text").alias("text_hash"), word_list("text").alias("words"))
    probes = rows.select("key", "text_hash", F.explode(F.transform(_every(sizes), lambda x: F.xxhash64(x))).alias("hash"))
    candidates = stored(probes.join(index, "hash").select("key", "text_hash").distinct(), "candidates")

    near = candidates.select(F.col("key").alias("near"), "text_hash")
    texts = docs.withColumn("text_hash", F.xxhash64("text"))
    texts = texts.join(near, F.col("key").eqNullSafe(F.col("near")) & (texts["text_hash"] == near["text_hash"]), "left_semi")
    held = texts.select("key", "text_hash", word_list("text").alias("words"))
    held = held.select("key", "text_hash", F.explode(F.array_distinct(_every(sizes))).alias("shingle"))
    full = _small(sets.select("item", "shingle", "n_shingles"))
    matched = held.join(full, "shingle").groupBy("key", "text_hash", "item", "n_shingles")
    matched = matched.agg(F.count_distinct("shingle").alias("matched"))
    enough = F.col("matched") * SCALE >= F.col("n_shingles") * round(share * SCALE)
    return matched.where(enough).select(
        F.col("key").alias(key),
        F.col("item.id").alias(item),
        "matched",
        "n_shingles",
        (F.col("matched") / F.col("n_shingles")).alias("containment"),
        "text_hash",
    )


def _every(sizes: list[int]) -> Column:
    """The shingles of the column words, of all sizes."""
    return F.concat(*(shingles("words", size) for size in sizes))
