"""Scores of texts by a bigram model whose counts are in a log-frequency Bloom filter.

Tokens are a text's words (lower-case A-Z) and one end. Single words keep exact counts. Of a pair with count c,
the keys (pair, 1) to (pair, level of c) are put into a filter, levels being powers of ``BASE``; a lookup asks for
level 1, 2, ... until the filter says no. The filter is cut into segments of the hash, each with a fixed number of
bits for each key that it gets, so its rate of errors (only counts that are too high) is the same at every size.

Texts are stored in runs of some million tokens. A run sends its distinct words and pairs, each with its count in the
texts to learn from, to the parts of the hash that they fall into. The task of a part sums the counts, fills the
part's segments of the filter, and answers every run with the words' counts or the pairs' levels, in the order of
the run's keys. A run's texts meet the answers and are scored. So every text is read as often whatever the size, what
moves is in proportion to the texts, and neither the words' counts nor the filter is in one place as a whole.

The probability of word w after h is (c(hw) + mass * p(w)) / (c(h) + mass), with p(w) the smoothed share of w
alone, (c(w) + 1/2) / (N + (V + 1) / 2), and c(hw) at most c(h) and c(w).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.llm import words
from kpiloom.llm.store import stored

START, END = words.mix(np.array([1, 2], np.uint64) * words.GOLDEN)
BASE = 1.5
# Keys looked up at a time.
PROBES = 1 << 15
# Words of 32 bits in a block of the filter; a key sets one bit in each.
BLOCK_WORDS = 8
# Bytes of text whose words or pairs make a part.
PART_BYTES = 16 << 20
# A part is shared by several tasks if there is more text than this many times the text to learn from.
SPARSE = 8
# Rows of the stored runs are large, so that the writer has to look at their size after each one.
RUN_FILES = {"parquet.page.size.row.check.min": "1", "parquet.block.size": str(32 << 20)}


@dataclass(frozen=True)
class Model:
    """Bits of filter for each key put into it, bytes of text for a segment, least bytes of the filter, most bytes
    of the words' counts (``max_broadcast``) and of the filter (``max_part``) that a task has to hold, one segment at
    least, the weight of the single words' shares, and tokens and bytes of text after which a run ends."""

    key_bits: float = 14.0
    segment_bytes: int = 4 << 20
    least_bytes: int = 1 << 16
    max_broadcast: int = 128 << 20
    max_part: int = 48 << 20
    mass: float = 100.0
    run_tokens: int = 2_500_000
    run_bytes: int = 16 << 20


def levels(counts: np.ndarray) -> np.ndarray:
    """1 for a count of 1, and one more for every factor of ``BASE``."""
    return 1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64)


def of_level(level: np.ndarray) -> np.ndarray:
    """The middle of the whole numbers of each level; 0 for level 0."""
    low, high = np.ceil(BASE ** (level - 1.0) - 1e-9), np.ceil(BASE ** (level + 0.0) - 1e-9) - 1
    return np.where(level > 0, (low + high) / 2, 0.0)


def _bits(keys: np.ndarray, level: int, blocks: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The block of each key at a level, and the bit of each word of the block."""
    mixed = words.mix(keys + words.mix(np.array([level], np.uint64)))
    block = ((mixed >> np.uint64(32)) * np.asarray(blocks, np.uint64)) >> np.uint64(32)
    shifts = words.mix(mixed)[:, None] >> np.arange(0, 5 * BLOCK_WORDS, 5, dtype=np.uint64)[None, :]
    return block.astype(np.int64), np.uint32(1) << (shifts & np.uint64(31)).astype(np.uint32)


def filled(keys: np.ndarray, counts: np.ndarray, blocks: int) -> np.ndarray:
    """The part of the filter for these keys and counts."""
    part = np.zeros((blocks, BLOCK_WORDS), np.uint32)
    level, reached = 1, levels(counts) if len(counts) else np.zeros(0, np.int64)
    while len(keys):
        block, bits = _bits(keys, level, blocks)
        order = np.argsort(block, kind="stable")
        block, bits = block[order], bits[order]
        starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        part[block[starts]] |= np.bitwise_or.reduceat(bits, starts, axis=0)
        level += 1
        more = reached >= level
        keys, reached = keys[more], reached[more]
    return part


def probed(filter_part: np.ndarray, first_block: np.ndarray, keys: np.ndarray, blocks: int | np.ndarray) -> np.ndarray:
    """The level of each key, whose part starts at ``first_block`` and has ``blocks``."""
    found, blocks = np.zeros(len(keys), np.int64), np.broadcast_to(blocks, len(keys))
    for start in range(0, len(keys), PROBES):
        live, level = np.arange(start, min(start + PROBES, len(keys))), 1
        while len(live):
            block, bits = _bits(keys[live], level, blocks[live])
            live = live[((filter_part[first_block[live] + block] & bits) == bits).all(axis=1)]
            found[live] = level
            level += 1
    return found


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each token, the one before it (the start for the first), and the number of tokens before each text."""
    hashes, counts = words.words(column)
    texts = np.arange(len(column))
    ends = counts[1:] + texts
    token = np.empty(len(hashes) + len(column), np.uint64)
    inner = np.ones(len(token), bool)
    inner[ends] = False
    token[inner], token[ends] = hashes, END
    before = np.empty_like(token)
    before[1:] = token[:-1]
    starts = np.concatenate(([0], ends + 1))
    before[starts[:-1]] = START
    return token, before, starts


def pairs(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return words.mix((before * words.GOLDEN) ^ token)


def _segment(keys: np.ndarray, segments: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)).astype(np.int64)


def blocks_for(counts: np.ndarray, key_bits: float, least: int) -> int:
    """Blocks of the part of the filter for pairs with these counts."""
    return max(1, least, math.ceil(int(levels(counts).sum()) * key_bits / (32 * BLOCK_WORDS)))


@dataclass(frozen=True)
class Layout:
    """Segments of the hash, how many make a part (of words, of pairs), tasks that share a part, and the filter's
    bits for a key and least blocks of a segment."""

    segments: int
    steps: tuple[int, int]
    copies: int
    key_bits: float
    least: int

    def starts(self, kind: int) -> np.ndarray:
        """The least key of each part."""
        firsts = range(0, self.segments, self.steps[kind])
        return np.array([-((-first << 32) // self.segments) << 32 for first in firsts], np.uint64)


def laid_out(total: int, size: int, model: Model) -> Layout:
    """For so many bytes of text, and of text to learn from."""
    segments = max(1, math.ceil(size / model.segment_bytes))
    least = max(1, model.least_bytes // segments // (4 * BLOCK_WORDS))
    copies = max(1, math.ceil(total / (SPARSE * max(size, model.segment_bytes))))
    # A token takes two bytes of text at least, and n tokens put n words and n keys of the filter at most.
    tokens_learnt = size / segments / 2 + 1
    most_bytes = 16 * tokens_learnt, max(4 * BLOCK_WORDS * least, tokens_learnt * model.key_bits / 8)
    fitting = PART_BYTES / ((size + total / copies) / segments + 1)
    bounds = model.max_broadcast / most_bytes[0], model.max_part / most_bytes[1]
    words_step, pairs_step = (max(1, int(min(fitting, bound))) for bound in bounds)
    return Layout(segments, (words_step, pairs_step), copies, model.key_bits, least)


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers in as many bytes each as the largest needs, after that number of bytes."""
    width = max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    return bytes([width]) + np.ascontiguousarray(numbers, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(data: pa.Scalar) -> np.ndarray:
    data = np.frombuffer(data.as_buffer(), np.uint8)
    width, data = int(data[0]), data[1:]
    wide = np.zeros((len(data) // width, 8), np.uint8)
    wide[:, :width] = data.reshape(-1, width)
    return wide.view("<u8").ravel()


def _distinct(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Grams in order and their numbers (numpy sorts for these; without them it hashes, which takes ten times as long)."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *grams]), return_counts=True)


def _counts(learnt: list[np.ndarray], others: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All grams in order, and how often each is among those learnt."""
    keys, counts = _distinct(learnt)
    more, _ = _distinct(others)
    place = np.searchsorted(keys, more)
    new = np.ones(len(more), bool)
    inside = np.flatnonzero(place < len(keys))
    new[inside] = keys[place[inside]] != more[inside]
    return np.insert(keys, place[new], more[new]), np.insert(counts, place[new], 0)


def runs(texts: DataFrame, model: Model) -> DataFrame:
    """(run, texts) from (key, text, learnt): the rows of each run as a compressed stream of Arrow batches."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sealed() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            codec = pa.Codec("zstd", compression_level=3)
            with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=codec)) as out:
                for rows in held:
                    out.write_batch(rows)
            held.clear()
            return pa.RecordBatch.from_pydict({"run": [run], "texts": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

        held: list[pa.RecordBatch] = []
        run, size, most_tokens = TaskContext.get().partitionId() << 33, 0, 0
        for batch in batches:
            for start, stop in words.blocks(batch.column(1)):
                held.append(batch.slice(start, stop - start))
                data, _ = words.utf8(held[-1].column(1))
                size += len(data)
                most_tokens += np.count_nonzero(words.SPACE[data]) + 2 * (stop - start)
                if size >= model.run_bytes or most_tokens >= model.run_tokens:
                    yield sealed()
                    run, size, most_tokens = run + 1, 0, 0
        if held:
            yield sealed()

    return texts.mapInArrow(cut, "run BIGINT, texts BINARY")


def answered(runs: DataFrame, layout: Layout) -> DataFrame:
    """(run, part, found, types, tokens): the counts of each run's words and the levels of its pairs, part by part,
    in the order of the distinct ones; and rows without a run, with the distinct words and tokens learnt from."""
    starts = [layout.starts(kind) for kind in (0, 1)]
    segments, steps, copies = layout.segments, layout.steps, layout.copies

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run, texts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held: list[tuple[list, list]] = [([], []), ([], [])]
                for rows in pa.ipc.open_stream(texts.as_buffer()):
                    token, before, ends = tokens(rows.column(1))
                    own = np.repeat(rows.column(2).to_numpy(zero_copy_only=False), np.diff(ends))
                    for kind, grams in enumerate((token, pairs(before, token))):
                        held[kind][0].append(grams[own])
                        held[kind][1].append(grams[~own])
                for kind in (0, 1):
                    keys, counts = _counts(*held[kind])
                    held[kind] = ([], [])
                    messages = messages_of(run, kind, keys, counts)
                    while some := list(islice(messages, 64)):
                        yield pa.RecordBatch.from_pylist(some, ASKED)

    def messages_of(run: int, kind: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[dict]:
        at = np.append(np.searchsorted(keys, starts[kind]), len(keys))
        own = (run ^ run >> 33) % copies
        for part in np.flatnonzero(np.diff(at)).tolist():
            inside = slice(at[part], at[part + 1])
            learnt = np.flatnonzero(counts[inside]) + at[part]
            for copy in range(copies):
                chosen = inside if copy == own else learnt
                if copy == own or len(learnt):
                    yield {
                        "part": (part + kind * len(starts[0])) * copies + copy,
                        "run": run if copy == own else None,
                        "keys": packed(np.diff(keys[chosen], prepend=starts[kind][part])),
                        "counts": packed(counts[chosen]),
                    }

    def answer(asked: pa.Table) -> pa.Table:
        group = asked["part"][0].as_py()
        part, copy = divmod(group, copies)
        kind = int(part >= len(starts[0]))
        part -= kind * len(starts[0])
        keys = np.concatenate([np.cumsum(unpacked(x)) + starts[kind][part] for x in asked["keys"]])
        keys, place = np.unique(keys, return_inverse=True)
        counts = [unpacked(x) for x in asked["counts"]]
        ends = np.cumsum([len(x) for x in counts])
        found = np.bincount(place, np.concatenate(counts), len(keys)).astype(np.int64)
        del counts
        types, learnt = (np.count_nonzero(found), int(found.sum())) if kind == 0 and copy == 0 else (0, 0)
        if kind:
            first = part * steps[kind]
            found = levels_of(keys, found, first, min(first + steps[kind], segments))
        each = np.split(found[place], ends[:-1])
        rows = [(run, group, packed(x), 0, 0) for run, x in zip(asked["run"].to_pylist(), each, strict=True) if run is not None]
        columns = zip(*rows, (None, group, b"", types, learnt), strict=True)
        return pa.Table.from_arrays([pa.array(x, field.type) for x, field in zip(columns, ANSWERS, strict=True)], schema=ANSWERS)

    def levels_of(keys: np.ndarray, counts: np.ndarray, first: int, stop: int) -> np.ndarray:
        """The levels that the filter gives for all keys of some segments, with only those counted in it."""
        segment = _segment(keys, segments) - first
        at = np.searchsorted(segment, np.arange(stop - first + 1))
        made = []
        for start, end in zip(at[:-1], at[1:], strict=True):
            own = start + np.flatnonzero(counts[start:end])
            made.append(filled(keys[own], counts[own], blocks_for(counts[own], layout.key_bits, layout.least)))
        blocks = np.array([len(x) for x in made])
        return probed(np.concatenate(made), (np.cumsum(blocks) - blocks)[segment], keys, blocks[segment])

    asked = runs.mapInArrow(ask, "part BIGINT, run BIGINT, keys BINARY, counts BINARY")
    return asked.groupBy("part").applyInArrow(answer, "run BIGINT, part BIGINT, found BINARY, types BIGINT, tokens BIGINT")


ASKED = pa.schema([("part", pa.int64()), ("run", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
ANSWERS = pa.schema([("run", pa.int64()), ("part", pa.int64()), ("found", pa.binary()), ("types", pa.int64()), ("tokens", pa.int64())])
SCORES = ["key", "n_tokens", "n_known", "base_score", "score"]


def scored(rows: DataFrame, train: str, key: str = "doc_id", text: str = "text", model: Model = Model()) -> DataFrame:
    """key, n_tokens, n_known, train_tokens, base_score and score of every row; ``train``: the rows to learn from, as SQL.

    Both scores are sums of log10 probabilities over the tokens of the whole text. A null text has the end
    alone. Without rows to learn from every probability is one. Keys may be null or repeated: results belong to
    rows. Other columns may be used by ``train`` only.
    """
    texts = rows.select(F.col(key).alias("key"), F.col(text).alias("text"), F.expr(f"coalesce({train}, false)").alias("learnt"))
    length = F.octet_length("text")
    sizes = texts.agg(F.sum(length), F.sum(F.when(F.col("learnt"), length)), F.count_if("learnt")).first()
    total, size, train_texts = (x or 0 for x in sizes)
    layout = laid_out(total, size, model)
    made = stored(runs(texts, model), "runs", "none", **RUN_FILES)
    answers = stored(answered(made, layout), "answers")
    sums = answers.where("run IS NULL").agg(F.sum("types"), F.sum("tokens")).first()
    types, train_tokens = (x or 0 for x in sums)
    shape = Shape(train_texts, train_tokens + 0.5 * (types + 1), model.mass)
    word_groups = len(layout.starts(0)) * layout.copies

    def score(run: pa.Table, found: pa.Table) -> pa.Table:
        found = found.sort_by("part")
        of_words = pc.less(found["part"], word_groups)
        counts, level = (
            np.concatenate([unpacked(x) for x in found["found"].filter(kind)]).astype(np.int64)
            for kind in (of_words, pc.invert(of_words))
        )
        return shape.scores(pa.ipc.open_stream(run["texts"][0].as_buffer()), counts, level)

    kind = texts.schema["key"].dataType.simpleString()
    found = answers.where("run IS NOT NULL").select("run", "part", "found")
    out = made.groupBy("run").cogroup(found.groupBy("run")).applyInArrow(
        score, f"key {kind}, n_tokens BIGINT, n_known BIGINT, base_score DOUBLE, score DOUBLE"
    )
    return out.select(
        F.col("key").alias(key), "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )


@dataclass(frozen=True)
class Shape:
    """Texts learnt from, N + (V + 1) / 2, and the weight."""

    texts: int
    spread: float
    mass: float

    def shares(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / self.spread

    def scores(self, batches: Iterator[pa.RecordBatch], counts: np.ndarray, level: np.ndarray) -> pa.Table:
        """Scores of a run's rows, from the counts of its distinct words and the levels of its distinct pairs in order."""
        blocks = []
        for rows in batches:
            token, before, starts = tokens(rows.column(1))
            each = [np.unique(grams, return_inverse=True) for grams in (token, pairs(before, token))]
            blocks.append((rows.column(0), starts, *((keys, place.astype(np.int32)) for keys, place in each)))
        known, seen = (_distinct([block[i][0] for block in blocks])[0] for i in (2, 3))
        assert len(known) == len(counts) and len(seen) == len(level)
        out = []
        for key, starts, (types, type_at), (both, pair_at) in blocks:
            count = counts[np.searchsorted(known, types)][type_at]
            context = np.concatenate(([0], count[:-1]))
            context[starts[:-1]] = self.texts
            both = np.minimum(of_level(level[np.searchsorted(seen, both)])[pair_at], np.minimum(count, context))
            shares = self.shares(count)
            values = [
                np.diff(starts),
                np.add.reduceat((count > 0).astype(np.int64), starts[:-1]),
                np.add.reduceat(np.log10(shares), starts[:-1]),
                np.add.reduceat(np.log10((both + self.mass * shares) / (context + self.mass)), starts[:-1]),
            ]
            out.append(pa.RecordBatch.from_arrays([key, *(pa.array(x) for x in values)], names=SCORES))
        return pa.Table.from_batches(out)
