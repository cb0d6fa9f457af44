from __future__ import annotations

import itertools
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kpiloom.llm import quality


def plain(text):
    w = (text or "").encode().split()
    runs = list(zip(w, w[1:], w[2:], strict=False))
    count = Counter(runs)
    covered = {i + k for i, run in enumerate(runs) if count[run] > 1 for k in range(3)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            repeated += line in seen
            seen.add(line)
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text or ""), repeated, len(covered))


ANY = st.text(alphabet=st.sampled_from("ab #|\n\té🙂\x1c\xa0"), max_size=60)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.none() | ANY, max_size=5))
def test_counts(texts):
    lines, base = quality.measured(pa.array(texts, pa.string()))
    assert [tuple(int(base[c][i]) for c in quality.BASE) for i in range(len(texts))] == [plain(t) for t in texts]
    with_words = [line for t in texts for line in (t or "").split("\n") if line.encode().split()]
    assert lines.n_words.tolist() == [len(line.encode().split()) for line in with_words]
    assert lines.features.shape == (len(with_words), quality.N_FEATURES)


def test_decoding_is_the_best_of_all_labellings():
    rng = np.random.default_rng(3)
    for size in (1, 2, 5, 7):
        features = rng.random((size, quality.N_FEATURES)) < 0.3
        field = quality.Field(rng.normal(size=quality.N_FEATURES), rng.normal(size=(2, 2)), rng.normal(size=2))
        emit = features @ field.weights

        def value(labels):
            steps = sum(field.steps[a, b] for a, b in itertools.pairwise(labels))
            return field.start[labels[0]] + steps + sum(e for e, y in zip(emit, labels, strict=True) if y)

        best = max(itertools.product((0, 1), repeat=size), key=value)
        lines = quality.Lines(features, np.ones(size, np.int64), np.zeros(size, np.int64))
        assert tuple(quality.decoded(lines, field).astype(int)) == best


@pytest.fixture(scope="module")
def field(small):
    return quality.trained(small("documents"), small("labels"), fit=quality.Fit(steps=60))


def test_junk_goes_and_clean_text_stays(session, small, field):
    judged = quality.judged(small("documents"), field).join(small("labels"), "doc_id").where("NOT base_failed").collect()
    right = Counter((r.quality, r.kept) for r in judged)
    assert right[1, False] <= 0.02 * (right[1, True] + right[1, False])
    assert right[0, True] <= 0.2 * (right[0, True] + right[0, False])


def test_slope_is_that_of_the_likelihood():
    rng = np.random.default_rng(5)
    text = np.repeat(np.arange(5), [1, 4, 2, 7, 3])
    features = (rng.random((len(text), quality.N_FEATURES)) < 0.3).astype(float)
    label = rng.integers(0, 2, len(text))
    values = rng.normal(size=quality.N_FEATURES + 6)
    _, slope = quality.likelihood(values, features, text, label)
    for i in range(len(values)):
        step = np.zeros(len(values))
        step[i] = 1e-5
        above, below = (quality.likelihood(values + s, features, text, label)[0] for s in (step, -step))
        assert abs((above - below) / 2e-5 - slope[i]) < 1e-6


def test_likelihood_is_a_share_of_all_labellings():
    rng = np.random.default_rng(6)
    text = np.array([0, 0, 0, 1, 1])
    features = (rng.random((5, quality.N_FEATURES)) < 0.3).astype(float)
    values = rng.normal(size=quality.N_FEATURES + 6)
    each = [quality.likelihood(values, features, text, np.array(y))[0] for y in itertools.product((0, 1), repeat=5)]
    assert abs(np.exp(each).sum() - 1) < 1e-9


def test_mixed_texts_have_a_label_for_each_line():
    texts = [("a\nb\n\n c", 1), ("x\ny", 0), ("d", 1), ("  ", 0), ("lone", 1)]
    assert quality.mixed(texts, 2) == [("a\nx\ny\nb\n c", [1, 0, 0, 1, 1]), ("d", [1])]


def test_lines_of_mixed_held_out_texts(small):
    """Content and boilerplate lines of texts that were not learnt from are told apart within one text."""
    rows = small("documents").join(small("labels"), "doc_id").select("doc_id", "text", "quality").where("text IS NOT NULL").collect()
    field = quality.fitted([(r.text, r.quality) for r in rows if r.doc_id % 2])
    both = quality.mixed([(r.text, r.quality) for r in rows if not r.doc_id % 2], 5)
    lines, _ = quality.measured(pa.array([text for text, _ in both]))
    label = np.array([label for _, labels in both for label in labels], bool)
    found = quality.decoded(lines, field)
    print(len(label), [float((found[label == v] == v).mean()) for v in (False, True)])
    assert (found[label] == 1).mean() >= 0.85 and (found[~label] == 0).mean() >= 0.6
    per_text = [found[lines.text == t].mean() for t in np.unique(lines.text)]
    assert sum(0 < share < 1 for share in per_text) >= len(per_text) / 2


def test_awkward_rows(odd_docs, no_docs, field):
    judged = quality.judged(odd_docs, field)
    rows = judged.collect()
    assert Counter((r.doc_id, *(r[c] for c in quality.BASE)) for r in rows) == Counter(
        (r.doc_id, *plain(r.text)) for r in odd_docs.collect()
    )
    assert all(not r.kept and r.base_failed for r in rows if r.n_words < 50)
    assert quality.judged(no_docs, field).collect() == []


def test_without_labels(odd_docs, small):
    field = quality.trained(odd_docs, small("labels").limit(0))
    assert not field.weights.any() and len(quality.judged(odd_docs, field).collect()) == odd_docs.count()
