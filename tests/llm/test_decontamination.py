from __future__ import annotations

import re
from collections import Counter

import pytest

from kpiloom.llm import decontamination


def shingled(text, size):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if x]
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}, w


def plain(docs, items, share=0.8):
    found = Counter()
    rows = {(i, t) for i, t in docs}
    for item, text in items:
        _, w = shingled(text, 1)
        size = min(5, len(w))
        own = shingled(text, size)[0] if w else set()
        for doc, other in rows:
            held = len(own & shingled(other, size)[0]) if own else 0
            if own and 1000 * held >= round(1000 * share) * len(own):
                found[doc, item, held, len(own)] += 1
    return found


def pairs(docs, items, **how):
    return Counter(tuple(r)[:4] for r in decontamination.contained(docs, items, **how).collect())


ITEM = " ".join(f"word{i}" for i in range(24))


@pytest.fixture
def items(session):
    rows = [(1, ITEM), (2, "Short Item"), (3, None), (4, "  "), (5, "one"), (6, ITEM + " tail"), (7, "a a a a a a a a a"), (None, "é x y z é")]
    return session.createDataFrame([(*r, "x") for r in rows], "item_id INT, text STRING, doc_id STRING")


@pytest.fixture
def docs(session, odd_docs):
    long = " ".join(f"l{i}" for i in range(30_000))
    cut = ITEM.split()
    rows = [
        (50, f"{long} {ITEM.upper()} {long}"),
        (51, " ".join([*cut[:20], "zzz"])),
        (52, " ".join(cut[:19])),
        (53, " ".join([*cut[:12], "x", *cut[12:]])),
        (53, "another text of the same id with a short  ITEM"),
        (54, "a a a a a"),
        (55, "É x\ty z é one"),
        (56, ITEM),
        (56, ITEM),
    ]
    return session.createDataFrame(rows, "doc_id BIGINT, text STRING").union(odd_docs.select("doc_id", "text"))


@pytest.mark.parametrize("share", [0.8, 0.5, 1.0])
def test_awkward_rows(docs, items, share):
    expected = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], share)
    assert pairs(docs, items, share=share) == expected and sum(expected.values()) > 6


def test_large_indexes_are_joined_by_shuffling(docs, items, monkeypatch):
    expected = pairs(docs, items)
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", -1)
    assert pairs(docs, items) == expected


def test_broadcasts_are_checked_by_bytes(session, monkeypatch):
    """Few rows of very long words are no small index."""
    monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 100_000)
    hinted = lambda index: "hint" in index._jdf.queryExecution().logical().toString().lower()
    short = session.createDataFrame([(1, "a b"), (2, "c d")], "item INT, shingle STRING")
    long = session.createDataFrame([(1, "a" * 200_000)], "item INT, shingle STRING")
    assert hinted(decontamination._small(short)) and not hinted(decontamination._small(long))


def test_items_with_repeated_and_null_ids_are_items_of_their_own(session):
    texts = [" ".join(f"{name}{i}" for i in range(24)) for name in "abcde"]
    ids = [1, 1, None, None, None]
    items = session.createDataFrame([*zip(ids, texts, strict=True), (None, texts[4])], "item_id INT, text STRING")
    rows = [*enumerate(texts), (5, f"{texts[0]} {texts[1]}"), (None, f"x {texts[2]}")]
    docs = session.createDataFrame(rows, "doc_id BIGINT, text STRING")
    expected = plain(rows, list(zip(ids, texts, strict=True)))
    assert pairs(docs, items) == expected and sum(expected.values()) == 8


def test_empty_tables(docs, items, no_docs):
    assert pairs(no_docs, items) == pairs(docs, items.limit(0)) == pairs(no_docs, items.limit(0)) == Counter()


def test_no_python_in_the_plan(docs, items):
    plan = decontamination.contained(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
