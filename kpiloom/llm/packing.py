"""Documents packed into sequences of a fixed number of tokens, by bin completion.

Only the lengths of the pieces matter for packing, and there are at most as many lengths as a sequence has
tokens. So the plan is made on the driver from the number of pieces of each length, a table that doesn't grow
with the input: a list of patterns (lengths that share a sequence) and how often each is used. Pieces are then
numbered within their length, each range of numbers belongs to one place of one pattern, and a join of the
numbers with these ranges places every piece. All work on texts and pieces is done in parallel.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kpiloom.llm import words
from kpiloom.llm.numbering import numbered
from kpiloom.llm.store import stored

# Parts of a text that a byte-level tokenizer never joins. The first three are single words of it: plain letters, plain
# marks, each with a space before, or a line feed, if what follows is of another of these kinds. The rest goes up to
# a space between two other characters.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
# All of ASCII but the apostrophe, which is joined with letters after it.
MARKS = re.escape('!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')
SINGLE = re.compile(f" ?[{LETTERS}]+| ?[{MARKS}]+|\n")
PARTS = re.compile(
    f" ?[{LETTERS}]+(?=[ \n{MARKS}]|\\Z)| ?[{MARKS}]+(?=[ \n{LETTERS}]|\\Z)|\n(?=[{LETTERS}])"
    "|[\\s\\S]+?(?<=\\S)(?= \\S)|[\\s\\S]+"
)
# Ids are remembered for parts of text up to this many characters, and for so many of them (some 200 MB).
SHORT, REMEMBERED = 40, 800_000
# Steps of the search for each sequence that best fit takes more than the lower bound, and at most.
STEPS, MOST_STEPS = 4_000, 40_000

PIECES = "piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it can be seen, else one from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder:
    """Token ids as little-endian unsigned 32-bit numbers, as the tokenizer's plain call gives them.

    Each part of a text is encoded once and remembered; of too many, those that the next texts have are kept. A text
    with one of the tokenizer's added tokens is encoded whole, because such a token is not split into parts.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or "(?!)")
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.known: dict[str, bytes] = {}

    def ids(self, part: str) -> bytes:
        if SINGLE.fullmatch(part):
            tokens = self.model.tokenize(part.encode().decode("latin-1").translate(self.letters))
            return array("I", [token.id for token in tokens]).tobytes()
        return self.whole(part)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def __call__(self, texts: list[str]) -> list[bytes]:
        special = {i for i, text in enumerate(texts) if self.added.search(text)}
        parts = [PARTS.findall(text) if i not in special else [] for i, text in enumerate(texts)]
        met = set().union(*parts)
        if len(self.known) > REMEMBERED:
            self.known = {part: self.known[part] for part in met & self.known.keys()}
        new = met.difference(self.known)
        self.known.update((part, self.ids(part)) for part in new)
        out = [b"".join(map(self.known.__getitem__, split)) for split in parts]
        for i in special:
            out[i] = self.whole(texts[i])
        for part in new:
            if len(part) > SHORT:
                del self.known[part]
        return out


@functools.cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text", keep_ids: bool = False
) -> DataFrame:
    """One row for each piece of each document: key, piece, start, length, ids_crc32, and ids if they are kept.

    A document is its ids and ``end_id``; one longer than ``capacity`` is cut so that the first piece may be
    shorter and all others are full. A null text is empty, so that it is the end alone.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, {PIECES}" + (", ids BINARY" if keep_ids else "")
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            for begin, stop in words.blocks(batch.column(1)):
                rows = []
                texts = [x or "" for x in batch.column(1).slice(begin, stop - begin).to_pylist()]
                for at, ids in zip(range(begin, stop), encode(texts), strict=True):
                    data = memoryview(ids + end)
                    total = len(data) // 4
                    first = total % capacity or capacity
                    edges = [0, *range(first, total + 1, capacity)]
                    for piece, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                        part = data[4 * a : 4 * b]
                        rows.append((at, piece, a, b - a, zlib.crc32(part), *([bytes(part)] if keep_ids else [])))
                at, *columns = zip(*rows, strict=True)
                keys = batch.column(0).take(pa.array(at))
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]
                names = [key, "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([keys, *arrays], names=names[: len(arrays) + 1])

    return docs.select(key, text).mapInArrow(cut, schema)


def packed(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 2,
    key: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
    blocks: int = 64,
) -> DataFrame:
    """``pieces`` with sequence_id and offset. Every piece is in one sequence, and no sequence is too long.

    Sequences are numbered from 0; in each one offsets have no gaps. No rows give no rows. Keys may be null or
    repeated: each row is a document.
    """
    cut = stored(pieces(docs, tokenizer, capacity, end_id, key, text, keep_ids), "pieces")
    counts = {row["length"]: row["count"] for row in cut.groupBy("length").count().collect()}
    places = docs.sparkSession.createDataFrame(
        _places(plan(counts, capacity)), "length BIGINT, first BIGINT, stop BIGINT, base BIGINT, offset BIGINT"
    )
    by = [key, "piece", "ids_crc32"]
    ranked = numbered(cut, "length", F.pmod(F.xxhash64(*by), F.lit(blocks)), by, "_rank")
    at = ranked["_rank"]
    joined = ranked.join(
        F.broadcast(places), (ranked["length"] == places["length"]) & (at >= places["first"]) & (at < places["stop"])
    )
    return joined.select(*(ranked[c] for c in cut.columns), (F.col("base") + at - F.col("first")).alias("sequence_id"), "offset")


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, ...]]:
    """(length, first, stop, base, offset): pieces first to stop - 1 of a length are at offset in sequences from base."""
    used: dict[int, int] = {}
    rows, base = [], 0
    for lengths, times in patterns:
        offset = 0
        for length in lengths:
            first = used.get(length, 0)
            rows.append((length, first, first + times, base, offset))
            used[length] = first + times
            offset += length
        base += times
    return rows


def plan(counts: dict[int, int], capacity: int, steps: int | None = None) -> list[tuple[tuple[int, ...], int]]:
    """Patterns and how often each is used, in as few sequences as the search finds.

    Best fit gives the first solution. Then the largest length left is completed by its undominated fillings,
    least waste first, each used as often as its lengths allow and later fewer times. The first choices are followed
    down to the end; then branches are taken up in the order of how many choices on the way to them were not the first. A branch
    ends when its waste leaves no room for fewer sequences than the best solution has. The search ends when all
    branches have, at the lower bound, or after ``steps`` (``STEPS`` for each sequence that could be saved), whatever
    comes first; only the steps keep it from the optimum, and the best solution so far is whole at any time.
    """
    start = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        start[length] = count
    total = int((start * np.arange(capacity + 1)).sum())
    best = best_fit(start, capacity)
    fewest = sum(times for _, times in best)
    least = lower_bound(start, capacity)
    steps = min(STEPS * (fewest - least), MOST_STEPS) if steps is None else steps
    # Branches still to take up: choices that were not the first, a number, waste, patterns so far, options tried here.
    # They hold no table of their own, which is made again from the patterns.
    ways, waiting = itertools.count(), [(0, 0, 0, None, 0)] if start.any() else []
    while waiting and fewest > least and steps > 0:
        off, _, waste, made, tried = heapq.heappop(waiting)
        left = _left(start, made)
        while steps > 0:
            option = (0, None, 0)
            options = itertools.islice(_options(left, capacity), tried, None)
            while option and option[1] is None and steps > 0:
                option, tried, steps = next(options, None), tried + 1, steps - 1
            if option is None or option[1] is None or waste + option[0] > (fewest - 1) * capacity - total:
                break
            heapq.heappush(waiting, (off + 1, next(ways), waste, made, tried))
            lost, lengths, times = option
            waste, made, tried = waste + lost * times, ((lengths, times), made), 0
            if waste > (fewest - 1) * capacity - total:
                break
            left = _left(left, (made[0], None))
            if not left.any():
                best, fewest = [], (total + waste) // capacity
                while made:
                    best.append(made[0])
                    made = made[1]
                break
    return best


def _left(start: np.ndarray, made: tuple | None) -> np.ndarray:
    """The pieces of each length that are left by patterns."""
    left = start.copy()
    while made:
        (lengths, times), made = made
        each, need = np.unique(lengths, return_counts=True)
        left[each] -= times * need
    return left


def _options(left: np.ndarray, capacity: int) -> Iterator[tuple[int, tuple[int, ...] | None, int]]:
    """(waste, pattern, times) for the largest length left: all patterns as often as they can be used, then fewer times.

    A pattern that is dominated is given as None, so that the search may stop between any two.
    """
    kept: list[tuple[int, tuple[int, ...], int]] = []
    largest = int(np.flatnonzero(left)[-1])
    for lost, filling in fillings(left, capacity):
        if any(_dominates(pattern[1:], filling) for _, pattern, _ in kept):
            yield lost, None, 0
            continue
        pattern = (largest, *filling)
        each, need = np.unique(pattern, return_counts=True)
        kept.append((lost, pattern, int((left[each] // need).min())))
        yield kept[-1]
    for lost, pattern, times in kept:
        yield from ((lost, pattern, fewer) for fewer in range(times - 1, 0, -1))


def lower_bound(left: np.ndarray, capacity: int) -> int:
    """Sequences that any solution needs: by the sum, and with those over some size alone and those near half apart."""
    lengths = np.arange(capacity + 1)
    best = -(-int((left * lengths).sum()) // capacity)
    for small in range(1, capacity // 2 + 1):
        large = int(left[capacity - small + 1 :].sum())
        middle = lengths[(lengths > capacity // 2) & (lengths <= capacity - small)]
        apart = int(left[middle].sum())
        room = apart * capacity - int((left[middle] * middle).sum())
        rest = int((left * lengths)[small : capacity // 2 + 1].sum()) - room
        best = max(best, large + apart + max(0, -(-rest // capacity)))
    return best


def best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit by falling length, for all pieces of a length at once."""
    rooms: dict[int, list[tuple[tuple[int, ...], int]]] = {capacity: [((), int(left.sum()))]}
    for length in range(capacity, 0, -1):
        count = int(left[length])
        while count:
            room = min(r for r in rooms if r >= length)
            lengths, times = rooms[room].pop()
            each = min(room // length, count) if room == capacity else 1
            now = min(count // each, times)
            if times > now:
                rooms[room].append((lengths, times - now))
            elif not rooms[room]:
                del rooms[room]
            rooms.setdefault(room - each * length, []).append(((*lengths, *[length] * each), now))
            count -= now * each
    return [pattern for patterns in rooms.values() for pattern in patterns if pattern[0]]


def fillings(left: np.ndarray, capacity: int) -> Iterator[tuple[int, tuple[int, ...]]]:
    """(waste, lengths): every choice of lengths left for the room beside the largest one, least waste first.

    Of equal waste, those with larger lengths come first. Nothing is tried in vain: ``sums`` has, for each length, the
    sums (as bits) that it and smaller ones can make with as many pieces as there are.
    """
    largest = int(np.flatnonzero(left)[-1])
    room = capacity - largest
    lengths = [int(x) for x in np.flatnonzero(left[: room + 1])]
    counts = [int(left[x]) - (x == largest) for x in lengths]
    mask, made = (1 << (room + 1)) - 1, 1
    sums = [made]
    for length, count in zip(lengths, counts, strict=True):
        more, take = min(count, room // length), 1
        while more > 0:
            made |= (made << (length * min(take, more))) & mask
            more, take = more - take, 2 * take
        sums.append(made)

    def choices(upto: int, target: int) -> Iterator[tuple[int, ...]]:
        if not target:
            yield ()
            return
        while upto and sums[upto] >> target & 1:
            length = lengths[upto - 1]
            for times in range(min(counts[upto - 1], target // length), 0, -1):
                if sums[upto - 1] >> (target - times * length) & 1:
                    yield from ((length,) * times + rest for rest in choices(upto - 1, target - times * length))
            upto -= 1

    for lost in range(room + 1):
        yield from ((lost, filling) for filling in choices(len(lengths), room - lost))


def _dominates(one: tuple[int, ...], other: tuple[int, ...]) -> bool:
    """Whether the lengths of ``other`` go into those of ``one``, found by first fit."""
    rooms = list(one)
    for length in other:
        at = next((i for i, room in enumerate(rooms) if room >= length), None)
        if at is None:
            return False
        rooms[at] -= length
    return True
