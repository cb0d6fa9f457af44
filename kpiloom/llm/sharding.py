"""Shards by jump consistent hashing, with DataFrame functions only.

A row's shard follows from its key and the number of shards alone; no table of ranges or ring positions is
kept. With one more shard each row either stays or moves to the new one. The 64-bit generator that the
method steps through is kept in three limbs of 22, 22 and 20 bits, because whole products of 64 bits would
overflow a long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.llm.numbering import numbered

# Fixed value: the multiplier of the method's generator.
MULTIPLIER = 2862933555777941757

LIMB = (1 << 22) - 1
TOP = (1 << 20) - 1


def key_limbs(key: str) -> list[str]:
    """The first 64 bits of the MD5 digest of a key's string form, lowest limb first; a null key counts as ''."""
    digest = f"md5(coalesce(cast({key} AS STRING), ''))"
    high, low = (f"cast(conv(substr({digest}, {at}, 8), 16, 10) AS BIGINT)" for at in (1, 9))
    return [
        f"{low} & {LIMB}",
        f"(shiftright({low}, 22) | shiftleft({high}, 10)) & {LIMB}",
        f"shiftright({high}, 12)",
    ]


def _step(shards: int) -> str:
    """One step of the generator, and the next jump that it gives."""
    a0, a1, a2 = MULTIPLIER & LIMB, MULTIPLIER >> 22 & LIMB, MULTIPLIER >> 44
    s0 = f"(s.r0 * {a0}L + 1L)"
    s1 = f"(shiftright({s0}, 22) + s.r0 * {a1}L + s.r1 * {a0}L)"
    s2 = f"(shiftright({s1}, 22) + s.r0 * {a2}L + s.r1 * {a1}L + s.r2 * {a0}L)"
    moved = f"named_struct('r0', {s0} & {LIMB}L, 'r1', {s1} & {LIMB}L, 'r2', {s2} & {TOP}L)"
    jump = f"(s.next + 1) * ({1 << 31}D / (shiftleft(m.r2, 11) + shiftright(m.r1, 11) + 1))"
    return (
        f"if(s.next >= {shards}, s, aggregate(array({moved}), s, (s, m) -> named_struct("
        f"'r0', m.r0, 'r1', m.r1, 'r2', m.r2, 'shard', s.next, 'next', cast(floor({jump}) AS BIGINT))))"
    )


def jump(key: str, shards: int) -> Column:
    """struct(shard, next): the shard out of ``shards``, and the number of shards up to which it stays the same.

    ``key`` is the name of a column of any type with a string form.
    """
    r0, r1, r2 = key_limbs(key)
    start = f"named_struct('r0', {r0}, 'r1', {r1}, 'r2', {r2}, 'shard', -1L, 'next', 0L)"
    return F.expr(
        f"aggregate(sequence(1, {shards}), {start}, (s, i) -> {_step(shards)}, "
        f"s -> named_struct('shard', cast(s.shard AS INT), 'next', s.next))"
    )


def sharded(rows: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """``rows`` with shard (0 to shards - 1) and grown_shard, the one it has with one shard more.

    Rows with a null key go where the empty string goes; repeated rows go to one shard. Columns of these names
    that ``rows`` has already are replaced. Nothing moves: this is a projection.
    """
    if shards < 1:
        raise ValueError("there must be a shard")
    jumped = rows.withColumn("_jump", jump(f"`{key}`", shards))
    grown = F.when(F.col("_jump.next") == shards, F.lit(shards)).otherwise(F.col("_jump.shard"))
    return jumped.withColumns({"shard": F.col("_jump.shard"), "grown_shard": grown.cast("int")}).drop("_jump")


def with_slots(rows: DataFrame, by: list[str], key: str = "doc_id") -> DataFrame:
    """``rows``, which have a shard, with slot: numbered from 0 in each shard without gaps (see ``numbered``).

    A shard has 4096 blocks, by a digest of the key and of the columns ``by``, so that the rows of a null or repeated
    key spread over the blocks as far as they differ in these.
    """
    parts = ", ".join(f"cast(`{c}` AS STRING)" for c in dict.fromkeys([key, *by]))
    block = F.expr(f"cast(conv(substr(md5(concat_ws('/', {parts})), 17, 3), 16, 10) AS INT)")
    return numbered(rows, "shard", block, by, "slot")
