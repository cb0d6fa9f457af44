from __future__ import annotations

import hashlib
from collections import Counter

import pytest

from kpiloom.llm import sharding


def jump(key, shards):
    key = int(hashlib.md5(("" if key is None else str(key)).encode()).hexdigest()[:16], 16)
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 8, 100])
def test_against_the_plain_loop(session, shards):
    rows = session.range(2000).selectExpr("id AS doc_id", "'x' AS shard").union(session.sql("SELECT null, 'y'"))
    for r in sharding.sharded(rows, shards).collect():
        assert (r.shard, r.grown_shard) == (jump(r.doc_id, shards), jump(r.doc_id, shards + 1))


def test_shares_are_even(session):
    counts = Counter(r.shard for r in sharding.sharded(session.range(8000).toDF("doc_id"), 8).collect())
    assert all(850 < counts[s] < 1150 for s in range(8))


def test_slots(session, odd_docs, no_docs):
    placed = sharding.with_slots(sharding.sharded(odd_docs, 3), ["doc_id", "text"])
    rows = placed.collect()
    assert len(rows) == odd_docs.count() and set(odd_docs.columns) < set(placed.columns)
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert sharding.with_slots(sharding.sharded(no_docs, 3), ["doc_id"]).collect() == []
    with pytest.raises(ValueError):
        sharding.sharded(odd_docs, 0)


def test_no_python_in_the_plan(session, odd_docs):
    placed = sharding.with_slots(sharding.sharded(odd_docs, 8), ["doc_id"])
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_rows_of_a_null_key_spread_over_the_blocks(session):
    """A third of the rows without a key: numbered without gaps, and no block has more than a few of them."""
    rows = session.range(9000).selectExpr("if(id % 3 = 0, NULL, id) AS doc_id", "id AS size", "crc32(cast(cast(id AS STRING) AS BINARY)) AS text_crc32")
    placed = sharding.with_slots(sharding.sharded(rows, 2), ["doc_id", "size", "text_crc32"]).collect()
    for shard in (0, 1):
        assert sorted(r.slot for r in placed if r.shard == shard) == list(range(sum(r.shard == shard for r in placed)))
    unnamed = sorted(r.slot for r in placed if r.doc_id is None)
    # In one block their numbers would follow each other.
    assert sum(b - a == 1 for a, b in zip(unnamed, unnamed[1:], strict=False)) < 0.9 * len(unnamed)
