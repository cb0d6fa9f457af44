"""Near duplicates by b-bit MinHash.

A text's set is its distinct shingles of some words (lower-case A-Z; the whole sequence as one shingle if the
text is shorter; a text without words has no set and is linked with nothing). Texts whose sets have a Jaccard
similarity of the threshold or more are linked; the classes are the connected components of all links.

1. One pass over the texts makes, for each row, a digest of the set, the keys of all bands of its MinHash
   signature, and the signature itself with only the low bits of each minimum, packed into longs. Rows with
   equal digests are one node from here on, so thousands of copies weigh as much as one text.
2. Nodes that share a band are candidates. Each is compared with the smallest node of each of its bands: the
   packed signatures are compared by bit counts, corrected for minima that agree in the low bits by chance.
   The best such pair of each node is confirmed on the full sets, and the confirmed links give components.
3. What is left are bands whose nodes are in several components. Their nodes are compared by bit counts, block
   against block, without making a row of each pair. In each round every node is paired with the nearest node of
   another component, if it is likely to be similar enough; these pairs are confirmed, and components grow. So
   a group of thousands of near copies, each similar to some of the others, takes a few pairs for each copy.
   These rounds work with the nodes whose sets step 2 has made; texts are read again for step 4 alone.
4. At last all pairs that lie in different components and come near the threshold are confirmed. No pair of a
   band is left out; one that shares several bands is a row in the first of them only.

The only uncertain step is that a pair shares no band, or that bit counts are far off. With the defaults (42
bands of 6 minima; 2 bits of 1024 minima) a pair at a similarity of just 0.8 is missed with a probability of 3e-6
by the bands, and of less than 2e-6 by the bit counts (``SLACK`` is over four and a half standard deviations).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm import words
from kpiloom.llm.components import components, followed, merged
from kpiloom.llm.store import stored

SLACK = 0.07
# Nodes of a band, up to which their pairs are rows of a join, and which otherwise are compared in one piece.
FEW = 16
BLOCK = 512
# Signatures of a block that are compared with all of another at a time.
STEP = 64
# Rounds of nearest pairs before all that are left.
BEST_ROUNDS = 1
# Parts of one in which the threshold is given, to compare whole numbers.
SCALE = 1000


@dataclass(frozen=True)
class MinHash:
    """Words of a shingle, least similarity, bands and minima of a band, and all minima and the bits kept of each.

    Bands take the first minima. Bits: 1, 2, 4 or 8.
    """

    shingle_words: int = 5
    similarity: float = 0.8
    bands: int = 42
    band_size: int = 6
    minima: int = 1024
    bits: int = 2


def signatures(docs: DataFrame, shape: MinHash) -> DataFrame:
    """For rows of (key, text): key, n_shingles, digest, band_keys and packed, the last three null without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, text = batch.columns
            for start, stop in words.blocks(text):
                sets = list(words.shingle_sets(text.slice(start, stop - start), shape.shingle_words))
                made = [_lengths(sets), _digests(sets), *_sign(sets, shape)]
                yield pa.RecordBatch.from_arrays([key.slice(start, stop - start), *made], names=SIGNED)

    kind = docs.schema["key"].dataType.simpleString()
    return docs.select("key", "text").mapInArrow(
        sign, f"key {kind}, n_shingles BIGINT, digest BINARY, band_keys ARRAY<BIGINT>, packed ARRAY<BIGINT>"
    )


SIGNED = ["key", "n_shingles", "digest", "band_keys", "packed"]


def _lengths(sets: list[np.ndarray]) -> pa.Array:
    return pa.array([len(s) for s in sets], pa.int64())


def _digests(sets: list[np.ndarray]) -> pa.Array:
    """16 bytes that are equal for equal sets; null for an empty one."""
    found = [None] * len(sets)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        hashes = np.concatenate(sets)
        starts = np.concatenate(([0], np.cumsum([len(sets[i]) for i in full])[:-1]))
        sums = np.add.reduceat(words.mix(hashes), starts)
        others = np.bitwise_xor.reduceat(words.mix(hashes ^ words.GOLDEN), starts)
        for i, x, y in zip(full, words.mix(sums), words.mix(others), strict=True):
            found[i] = x.tobytes() + y.tobytes()
    return pa.array(found, pa.binary())


def _sign(sets: list[np.ndarray], shape: MinHash) -> list[pa.Array]:
    """The band keys and the packed low bits of each set."""
    sizes = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(sizes)
    keys, packed = ([None] * len(sets) for _ in range(2))
    if len(full):
        hashes = np.concatenate(sets)
        starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
        seeds = words.mix(np.arange(1, shape.minima + 1, dtype=np.uint64) * words.GOLDEN) | np.uint64(1)
        per_long = 64 // shape.bits
        banded = np.zeros((shape.bands, len(full)), np.uint64)
        longs = np.zeros((-(-shape.minima // per_long), len(full)), np.uint64)
        for k, seed in enumerate(seeds):
            least = words.mix(np.minimum.reduceat(hashes * seed, starts) + np.uint64(k))
            if k < shape.bands * shape.band_size:
                banded[k // shape.band_size] = words.mix(banded[k // shape.band_size] ^ least)
            low = least & np.uint64((1 << shape.bits) - 1)
            longs[k // per_long] |= low << np.uint64(k % per_long * shape.bits)
        for at, key, long in zip(full.tolist(), banded.T.astype(np.int64), longs.T.astype(np.int64), strict=True):
            keys[at], packed[at] = key, long
    return [pa.array(keys, pa.list_(pa.int64())), pa.array(packed, pa.list_(pa.int64()))]


def _fold(shape: MinHash) -> tuple[list[int], int]:
    """Shifts that bring all bits of a value onto its lowest, and the mask of the lowest bits."""
    shifts = [1 << i for i in range(shape.bits.bit_length() - 1)]
    mask = sum(1 << i for i in range(0, 64, shape.bits))
    return shifts, mask if mask < 1 << 63 else mask - (1 << 64)


def _similarity(equal: Column | np.ndarray, shape: MinHash) -> Column | np.ndarray:
    """The share of equal minima behind a number of equal low bits: chance equals one in 2**bits of the rest."""
    chance = 1 / (1 << shape.bits)
    return (equal / float(shape.minima) - chance) / (1 - chance)


def estimate(left: str, right: str, shape: MinHash) -> Column:
    """The similarity of two packed signatures."""
    shifts, mask = _fold(shape)
    longs = -(-shape.minima // (64 // shape.bits))
    differ = F.lit(0)
    for i in range(longs):
        x = F.col(left)[i].bitwiseXOR(F.col(right)[i])
        for shift in reversed(shifts):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(mask)))
    return _similarity(shape.minima - differ, shape)


def _estimates(left: np.ndarray, right: np.ndarray, shape: MinHash) -> np.ndarray:
    """The similarities of all rows of one matrix of packed signatures with all rows of another."""
    shifts, mask = _fold(shape)
    differ = np.empty((len(left), len(right)), np.int64)
    for start in range(0, len(left), STEP):
        x = (left[start : start + STEP, None, :] ^ right[None, :, :]).view(np.uint64)
        for shift in reversed(shifts):
            x |= x >> np.uint64(shift)
        x &= np.int64(mask).view(np.uint64)
        differ[start : start + STEP] = np.bitwise_count(x).sum(axis=2, dtype=np.int64)
    return _similarity(shape.minima - differ, shape)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shape: MinHash = MinHash()) -> DataFrame:
    """One row for each row of ``docs``: the key, n_shingles, component_id and kept.

    component_id is the smallest key that links reach, the row's own included; kept says that the row has it.
    Rows with a null key take part; a class of null keys alone has a null component_id and keeps its rows.
    Repeated rows are one class (all rows with its smallest key are kept). No rows give no rows. Other
    columns of ``docs`` are not looked at.
    """
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    signed = stored(signatures(docs, shape), "signatures")
    nodes = stored(
        signed.where("digest IS NOT NULL")
        .groupBy(F.col("digest").alias("node"))
        .agg(F.min("key").alias("least"), F.first("band_keys").alias("band_keys"), F.first("packed").alias("packed")),
        "nodes",
    )
    bands = _shared_bands(nodes)
    packed = nodes.select("node", "packed")
    first = _best_with_least(bands, packed, shape)
    sets = _sets_of(_ends(first), docs, nodes, shape)
    found = components(_confirmed(first, sets, shape))
    alone = bands.select("node", F.col("node").alias("root")).distinct()
    roots = stored(followed(alone, found.toDF("child", "parent")), "roots")
    done = first
    for _ in range(BEST_ROUNDS):
        near = _across(bands, nodes, roots, done, shape, True)
        for end in ("a", "b"):
            near = near.join(sets.select(F.col("node").alias(end)), end, "left_semi")
        roots, done = _joined(near, sets, roots, shape), done.union(near.select("a", "b"))
    near = _across(bands, nodes, roots, done, shape, False)
    others = _ends(near).join(sets, "node", "left_anti")
    if not others.isEmpty():
        sets = sets.union(_sets_of(others, docs, nodes, shape))
    roots = _joined(near, sets, roots, shape)

    classes = (
        nodes.select("node", "least")
        .join(roots, "node", "left")
        .select("node", "least", F.coalesce("root", "node").alias("root"))
    )
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = stored(classes.select("node", "root").join(least, "root"), "classes")
    out = (
        signed.select("key", "n_shingles", "digest")
        .join(classes.select("node", "component_id"), F.col("digest") == F.col("node"), "left")
        .withColumn("component_id", F.when(F.col("digest").isNull(), F.col("key")).otherwise(F.col("component_id")))
    )
    return out.select(
        F.col("key").alias(key), "n_shingles", "component_id", F.expr("key <=> component_id").alias("kept")
    )


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def _joined(pairs: DataFrame, sets: DataFrame, roots: DataFrame, shape: MinHash) -> DataFrame:
    """``roots`` after the links among ``pairs``."""
    found = _confirmed(pairs, sets, shape)
    return roots if found.isEmpty() else merged(roots, found)


def _shared_bands(nodes: DataFrame) -> DataFrame:
    """(band, node, least) for each band that several nodes share; least is the smallest of them."""
    rows = nodes.select(F.explode("band_keys").alias("band"), "node")
    shared = rows.groupBy("band").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most")
    return stored(rows.join(shared.select("band", "least"), "band"), "bands")


def _best_with_least(bands: DataFrame, packed: DataFrame, shape: MinHash) -> DataFrame:
    """(a, b): each node and that smallest node of one of its bands that its bit counts are nearest to."""
    pairs = bands.where("least < node").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    guessed = _guessed(pairs, packed, shape)
    best = guessed.groupBy("b").agg(F.min_by("a", F.struct(-F.col("guess"), F.col("a"))).alias("a"))
    return stored(best.select("a", "b"), "best")


def _guessed(pairs: DataFrame, packed: DataFrame, shape: MinHash) -> DataFrame:
    left = packed.select(F.col("node").alias("a"), F.col("packed").alias("packed_a"))
    right = packed.select(F.col("node").alias("b"), F.col("packed").alias("packed_b"))
    guessed = pairs.join(right, "b").join(left, "a").select("a", "b", estimate("packed_a", "packed_b", shape).alias("guess"))
    return guessed.where(F.col("guess") >= shape.similarity - SLACK)


def _across(
    bands: DataFrame, nodes: DataFrame, roots: DataFrame, done: DataFrame, shape: MinHash, best_only: bool
) -> DataFrame:
    """(a, b): pairs of a band in different components whose bit counts come near the threshold, but ``done``.

    With ``best_only`` of each node only the pair with the nearest smaller node, if bit counts are at the threshold.
    """
    rows = bands.select("band", "node").join(roots, "node")
    mixed = (
        rows.groupBy("band")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size"))
        .where("low < high")
    )
    rows = stored(rows.join(mixed.select("band", "size"), "band"), "mixed")
    few = rows.where(F.col("size") <= FEW)
    other = few.select("band", F.col("node").alias("b"), F.col("root").alias("root_b"))
    pairs = few.join(other, "band").where("node < b AND root <> root_b").select(F.col("node").alias("a"), "b")
    least = shape.similarity - (SLACK / 4 if best_only else SLACK)
    near = _guessed(pairs.distinct(), nodes.select("node", "packed"), shape).where(F.col("guess") >= least)
    many = rows.where(F.col("size") > FEW)
    near = near.union(_across_blocks(many, nodes, shape, best_only, least)).join(done, ["a", "b"], "left_anti")
    if best_only:
        near = near.groupBy("b").agg(F.min_by("a", F.struct(-F.col("guess"), F.col("a"))).alias("a"))
    return stored(near.select("a", "b").distinct(), "across")


def _across_blocks(rows: DataFrame, nodes: DataFrame, shape: MinHash, best_only: bool, least: float) -> DataFrame:
    """(a, b, guess) for bands of many nodes: blocks of about ``BLOCK`` nodes meet each other, two at a time.

    The blocks of a band that has several are shuffled once for each other one; a band of one block stays where it is.
    """
    rows = rows.join(nodes.select("node", "packed", "band_keys"), "node")
    rows = rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    members = F.collect_list(F.struct("node", "root", "packed", "band_keys")).alias("members")
    blocks = stored(rows.groupBy("band", "blocks", "block").agg(members), "blocks")
    several = blocks.where("blocks > 1")
    to_meet = F.explode(F.sequence("block", F.col("blocks") - 1)).alias("other")
    left = several.select("band", "block", "members", to_meet)
    right = several.select("band", F.col("block").alias("other"), F.col("members").alias("others"))

    def columns(members: pa.StructArray) -> list[np.ndarray]:
        plain = [members.field(c).to_numpy(zero_copy_only=False) for c in ("node", "root")]
        lists = [members.field(c).flatten().to_numpy().reshape(len(members), -1) for c in ("packed", "band_keys")]
        return plain + lists

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for band, members, others in zip(*batch.columns, strict=True):
                node_a, root_a, packed_a, keys_a = columns(members.values)
                node_b, root_b, packed_b, keys_b = columns((others if others.is_valid else members).values)
                guess = _estimates(packed_a, packed_b, shape)
                guess[(root_a[:, None] == root_b[None, :]) | (guess < least)] = -1
                i, j = np.nonzero(guess >= 0)
                earlier = (keys_a == band.as_py()).argmax(axis=1)
                shared = (keys_a[i] == keys_b[j]).argmax(axis=1)
                i, j = i[shared == earlier[i]], j[shared == earlier[i]]
                if best_only:
                    only = np.full_like(guess, -1)
                    only[i, j] = guess[i, j]
                    best = {(int(x), y) for y, x in enumerate(only.argmax(axis=0))}
                    best |= {(x, int(y)) for x, y in enumerate(only.argmax(axis=1))}
                    i, j = np.array(sorted(p for p in best if only[p] >= 0), np.int64).reshape(-1, 2).T
                ends = [(x, y) if x < y else (y, x) for x, y in zip(node_a[i], node_b[j], strict=True)]
                sides = [pa.array([p[k] for p in ends], pa.binary()) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*sides, pa.array(guess[i, j])], names=["a", "b", "guess"])

    both = left.join(right, ["band", "other"]).select("band", "members", "others")
    alone = blocks.where("blocks = 1").select("band", "members", F.lit(None).cast(both.schema["others"].dataType))
    return both.unionAll(alone).mapInArrow(compare, "a BINARY, b BINARY, guess DOUBLE")


def _confirmed(pairs: DataFrame, sets: DataFrame, shape: MinHash) -> DataFrame:
    """Those pairs whose full sets are as similar as asked for."""
    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    either = F.size("set_a") + F.size("set_b") - both
    enough = both.cast("long") * SCALE >= either * round(shape.similarity * SCALE)
    return stored(pairs.join(right, "b").join(left, "a").where(enough).select("a", "b"), "confirmed")


def _sets_of(wanted: DataFrame, docs: DataFrame, nodes: DataFrame, shape: MinHash) -> DataFrame:
    """(node, hashes): the full set of each wanted node, made anew from the text of one of its rows."""
    keys = wanted.join(nodes, "node").select("least").distinct()
    texts = docs.join(keys, docs["key"].eqNullSafe(keys["least"]), "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in words.blocks(batch.column(0)):
                found = list(words.shingle_sets(batch.column(0).slice(start, stop - start), shape.shingle_words))
                arrays = pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([_digests(found), arrays], names=["node", "hashes"])

    made = texts.select("text").mapInArrow(sets, "node BINARY, hashes ARRAY<BIGINT>")
    made = made.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("hashes").alias("hashes"))
    return stored(made, "sets")
