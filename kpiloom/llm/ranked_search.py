"""Ranked lexical search by sequential reads of impact-sorted lists with score intervals (no random access).

Terms are runs of ASCII letters and digits and of all bytes beyond ASCII, A-Z lower-cased. A term's impact in a
document depends on its weight, its occurrences and the document's length; a document's score for a query is the
sum of the impacts of the query's terms, all in whole numbers (see ``Scoring``).

1. One pass over the texts writes a row for each document: its number of terms, and the ordinals and occurrences of
   those terms that are in any query. Totals and the documents of each term are counted from these rows.
2. The rows are cut into shards of a bounded number of postings. In a shard, each term has a list of its documents
   by falling impact. A query reads its lists from the top, some entries of each at a time. A document's score is at
   least the sum of what was read of it, and at most that sum and, for each term not yet read of it, the last
   impact read from the term's list, or nothing if the document, given its length, could not come that low.
   Reading ends when every document whose upper end reaches the lower end of the k-th has an interval of
   one number: then members, ties and scores are settled.
3. Each task keeps the best k of each query over its shards, whose k-th score is a bound for the next shards. The
   best of all tasks are ranked in two steps, first among equal hashes of the key, so that no task
   gets more than a bounded number of rows of a query from the first step.

Queries come in blocks whose texts have a bounded size; each block takes the steps above. Terms are known by 64-bit
hashes of their bytes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm import words
from kpiloom.llm.store import stored

# Bytes that are in no term, as the complement of the terms' bytes.
BETWEEN = np.ones(256, bool)
BETWEEN[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

# Entries that a query reads from each list at first; twice as many at each further step.
FIRST_READ = 128
# Parts of the keys in the first step of ranking.
PARTS = 64


@dataclass(frozen=True)
class Limits:
    """Results of a query, bytes of the queries' texts in a block, and postings of a shard (one document at least)."""

    results: int = 50
    query_bytes: int = 8 << 20
    postings: int = 1 << 21


@dataclass(frozen=True)
class Scoring:
    """The whole-number weights: of terms from the documents N and those with the term, of lengths from N and all terms L.

    ``weight`` is floor(1000 * ln((2N + 2) / (2df + 1))), a length counts as m = 50 + (50 * n * N) div L, and
    the impact of tf occurrences is weight * ((10**9 * tf) div (1000 * tf + 20 * m)).
    """

    documents: int
    terms: int

    def weight(self, holding: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * holding + 1)))

    def lengths(self, n: np.ndarray) -> np.ndarray:
        return 50 + 50 * n * self.documents // max(self.terms, 1)


def shares(occurrences: np.ndarray, length: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * occurrences // (1000 * occurrences + 20 * length)


def hashed(terms: list[bytes]) -> np.ndarray:
    """The hashes of terms that are in lower case."""
    ends = np.cumsum([len(t) for t in terms], dtype=np.int64)
    return words.hash_spans(np.frombuffer(b"".join(terms), np.uint8), ends - [len(t) for t in terms], ends)


def terms_of(text: str | None) -> set[bytes]:
    """The distinct terms of a text."""
    return set(TERM.findall((text or "").encode().translate(bytes(words.LOWER))))


def indexed(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """For rows of (key, text): key, n_terms, and the ordinals and occurrences of its terms in the sorted vocabulary."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            key, text = batch.columns
            for start, stop in words.blocks(text):
                data, offsets = words.utf8(text.slice(start, stop - start))
                starts, ends, counts = words.word_spans(data, offsets, BETWEEN)
                hashes = words.hash_spans(words.LOWER[data], starts, ends)
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                found = np.flatnonzero(known[at] == hashes)
                doc = np.searchsorted(counts, found, "right") - 1
                pair, times = np.unique(doc * len(known) + at[found], return_counts=True)
                edges = np.searchsorted(pair, np.arange(stop - start + 1) * len(known)).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(edges), pa.array(values.astype(np.int32)))
                    for values in (pair % len(known), times)
                ]
                yield pa.RecordBatch.from_arrays(
                    [key.slice(start, stop - start), pa.array(np.diff(counts)), *lists], names=["key", "n_terms", "terms", "times"]
                )

    return docs.select("key", "text").mapInArrow(index, "key BIGINT, n_terms BIGINT, terms ARRAY<INT>, times ARRAY<INT>")


class Shard:
    """The impact-sorted lists of some documents: for each term a run of documents (by place) and impacts."""

    def __init__(self, lengths: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray, weights: np.ndarray):
        impact = weights[term] * shares(times, lengths[doc])
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[order], impact[order]
        self.starts = np.searchsorted(term[order], np.arange(len(weights) + 1))
        self.weights = weights
        # What one occurrence gives for each unit of weight: no posting of a document is worth less.
        self.least = shares(np.ones(len(lengths), np.int64), lengths)

    def read(self, terms: np.ndarray, most: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The documents (places) whose score is over 0, not under ``floor``, and among the best ``most``, all ties of the
        last one included; their scores; and how many postings were read."""
        terms = terms[(self.weights[terms] > 0) & (self.starts[terms] < self.starts[terms + 1])]
        at, ends = self.starts[terms].copy(), self.starts[terms + 1]
        low = np.zeros(len(self.least), np.int64)
        unread = np.ones((len(terms), len(low)), bool)
        step, taken = FIRST_READ, 0
        while True:
            for i in range(len(terms)):
                stop = min(at[i] + step, ends[i])
                places = self.doc[at[i] : stop]
                low[places] += self.impact[at[i] : stop]
                unread[i, places] = False
                taken += len(places)
                at[i] = stop
            step *= 2
            last = np.where(at < ends, self.impact[np.minimum(at, len(self.impact)) - 1] if len(terms) else 0, 0)
            bar = max(floor, 1)
            if len(low) > most:
                bar = max(bar, int(np.partition(low, len(low) - most)[len(low) - most]))
            # What is still missing is at most the sum of the last impacts, whatever the document.
            near = np.flatnonzero(low + last.sum() >= bar)
            open_ = np.flatnonzero(last)
            room = unread[np.ix_(open_, near)] & (self.least[near] <= (last[open_] // self.weights[terms[open_]])[:, None])
            high = low[near] + (room * last[open_, None]).sum(axis=0)
            in_reach = high >= bar
            if not (in_reach & (high > low[near])).any():
                found = near[in_reach]
                return found, low[found], taken


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, numbers of terms, and (place, term, times) of the postings, of rows with about ``most`` postings."""

    def joined(held: list[pa.RecordBatch]) -> tuple:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        sizes = np.diff(rows["terms"].offsets.to_numpy())
        term, times = (rows[c].flatten().to_numpy().astype(np.int64) for c in ("terms", "times"))
        return rows["key"], rows["n_terms"].to_numpy(), np.repeat(np.arange(len(rows)), sizes), term, times

    held, size = [], 0
    for batch in batches:
        edges = batch["terms"].offsets.to_numpy()
        start = 0
        while start < len(batch):
            stop = int(np.searchsorted(edges, edges[start] + most - size, "right")) - 1
            stop = min(max(stop, start + (not held)), len(batch))
            if stop > start:
                held.append(batch.slice(start, stop - start))
                size += int(edges[stop] - edges[start])
                start = stop
            if start < len(batch):
                yield joined(held)
                held, size = [], 0
    if held:
        yield joined(held)


def _best(index: DataFrame, queries: list[np.ndarray], weights: np.ndarray, scoring: Scoring, limits: Limits) -> DataFrame:
    """(query, key, score): of each task, the best of each query."""
    sent = index.sparkSession.sparkContext.broadcast((queries, weights))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = sent.value
        best = [(np.zeros(0, np.int64),) * 3 for _ in queries]
        for key, n, doc, term, times in _shards(batches, limits.postings):
            shard = Shard(scoring.lengths(n), doc, term, times, weights)
            unnamed = key.is_null().to_numpy(zero_copy_only=False).astype(np.int64)
            names = key.fill_null(0).to_numpy(zero_copy_only=False)
            for number, terms in enumerate(queries):
                held = best[number]
                floor = int(held[0].min()) if len(held[0]) >= limits.results else 0
                places, scores, _ = shard.read(terms, limits.results, floor)
                if len(places):
                    score, blank, name = (
                        np.concatenate(x) for x in zip(held, (scores, unnamed[places], names[places]), strict=True)
                    )
                    order = np.lexsort((name, blank, -score))[: limits.results]
                    best[number] = score[order], blank[order], name[order]
        for number, (score, blank, name) in enumerate(best):
            if len(score):
                keys = pa.array(name, pa.int64(), mask=blank.astype(bool))
                numbers = pa.array(np.full(len(score), number, np.int32))
                yield pa.RecordBatch.from_arrays([numbers, keys, pa.array(score)], names=["query", "key", "score"])

    return index.mapInArrow(search, "query INT, key BIGINT, score BIGINT")


def ranked(
    docs: DataFrame,
    items: DataFrame,
    limits: Limits = Limits(),
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row for each item and each of its best documents with a score over 0: item, rank (from 1), key and score.

    Equal scores go by key; rows with a null key come last, and rows that are equal in score and key are
    interchangeable. Keys are whole numbers. Every row of ``docs`` is a document, repeated ones as well. Each id and text of
    ``items`` is a query of its own, so a repeated or null id with several texts has several rows of each rank.
    Null texts have no terms; items without terms, empty tables and documents without any of an item's terms give
    no rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    items = items.select(F.col(item).alias("item"), F.col(item_text).alias("text")).where("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / limits.query_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    found = []
    for number in range(blocks):
        queries = [(row.item, terms) for row in items.where(block == number).collect() if (terms := terms_of(row.text))]
        if not queries:
            continue
        vocabulary, places = np.unique(hashed([t for _, terms in queries for t in terms]), return_inverse=True)
        ends = np.cumsum([len(terms) for _, terms in queries])
        index = stored(indexed(docs, vocabulary), "index", "zstd")
        documents, total = index.agg(F.count_if(F.col("n_terms") > 0), F.sum("n_terms")).first()
        scoring = Scoring(documents, total or 0)
        holding = dict(index.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        weights = np.array([scoring.weight(holding.get(i, 0)) for i in range(len(vocabulary))], np.int64)
        best = _best(index, np.split(places, ends[:-1]), weights, scoring, limits)
        names = spark.createDataFrame([(i, name) for i, (name, _) in enumerate(queries)], f"query INT, item {items.schema['item'].dataType.simpleString()}")
        found.append(_merged(best, limits.results).join(F.broadcast(names), "query"))
    if not found:
        kind = items.schema["item"].dataType.simpleString()
        return spark.createDataFrame([], f"`{item}` {kind}, rank INT, `{key}` BIGINT, score BIGINT")
    out = reduce(DataFrame.unionAll, found)
    return out.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")


def _merged(best: DataFrame, most: int) -> DataFrame:
    """The best of each query with their ranks, first among keys with equal hashes, then among what is left."""
    by = F.col("score").desc(), F.col("key").asc_nulls_last()
    first = Window.partitionBy("query", "part").orderBy(*by)
    best = best.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(PARTS)))
    best = best.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most).drop("rank", "part")
    ranked_ = best.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*by)))
    return ranked_.where(F.col("rank") <= most)
