from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kpiloom.llm import toxicity

FIT = toxicity.Fit(hash_bits=16)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | st.text(alphabet=st.sampled_from("abé \n"), max_size=25), min_size=1, max_size=4))
def test_features_are_the_runs_inside_words(texts):
    text, _ = toxicity.features(texts, toxicity.Fit(hash_bits=40, sizes=(3, 4, 5)))
    counts = np.bincount(text, minlength=len(texts)).tolist()
    for value, count in zip(texts, counts, strict=True):
        runs = set()
        for word in (value or "").split():
            padded = f" {word} "
            runs |= {padded[i : i + n] for n in (3, 4, 5) for i in range(len(padded) - n + 1)}
        assert count == len(runs)


def test_held_out_accuracy():
    """Fit and tested on different rows of the larger test table."""
    import duckdb

    folder = "/root/testdata/sf0.1"
    rows = duckdb.sql(
        f"SELECT d.doc_id, d.text, l.toxic FROM '{folder}/documents.parquet' d JOIN '{folder}/labels.parquet' l USING (doc_id) "
        "ORDER BY doc_id"
    ).fetchall()
    held = [zlib.crc32(str(i).encode()) % 3 == 1 for i, _, _ in rows]
    learn = [(t, y) for (_, t, y), out in zip(rows, held, strict=True) if not out and len(t) <= 20_000]
    model = toxicity.fitted(learn, Counter(y for _, y in learn))
    test = [(t, y) for (_, t, y), out in zip(rows, held, strict=True) if out]
    predicted = model.scores([t for t, _ in test]) >= 0.7
    label = np.array([y for _, y in test], bool)
    assert (predicted & ~label).sum() <= 0.005 * (~label).sum() and (predicted & label).sum() >= 0.75 * label.sum()


@pytest.fixture(scope="module")
def model(small):
    return toxicity.trained(small("documents"), small("labels"), fit=FIT)


def test_awkward_rows(odd_docs, no_docs, model):
    rows = toxicity.scored(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not (r.text or "").strip()}) == 1
    assert toxicity.scored(no_docs, model).collect() == []


def test_one_label_alone(odd_docs, small):
    none = toxicity.trained(small("documents"), small("labels").where("toxic = 0"), fit=FIT)
    assert all(r.score < 0.05 for r in toxicity.scored(odd_docs, none).collect())
    empty = toxicity.trained(small("documents"), small("labels").limit(0), fit=FIT)
    assert {r.score for r in toxicity.scored(odd_docs, empty).collect()} == {0.5}
