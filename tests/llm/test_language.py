from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kpiloom.llm import language

AB = st.lists(st.integers(1, 3), max_size=60)


def model_of(*known):
    """Languages named by their place, of texts."""
    return language.Languages.of({f"l{i}": np.array([ord(c) for c in k], np.int64) for i, k in enumerate(known)})


def phrases(model, *texts):
    codes = model.codes()[[ord(c) for c in "".join(texts)]]
    return model.phrases(codes, np.cumsum([0, *map(len, texts)])).tolist()


@settings(max_examples=200, deadline=None)
@given(AB, AB)
def test_automaton_knows_exactly_the_substrings(text, other):
    moves = language.Transitions.of(language.automaton(text), 4)
    inside = {tuple(text[i:j]) for i in range(len(text)) for j in range(i + 1, len(text) + 1)}
    for i in range(len(other)):
        state, j = 0, i
        while j < len(other) and moves.owner[moves.base[state] + other[j]] == state:
            state, j = moves.target[moves.base[state] + other[j]], j + 1
        assert all((tuple(other[i:k]) in inside) == (k <= j) for k in range(i + 1, len(other) + 1))


def parsed(text, known):
    """Phrases of a greedy parse by looking for substrings."""
    count, i = 0, 0
    while i < len(text):
        j = i + 1
        while j < len(text) and text[i : j + 1] in known:
            j += 1
        if text[i:j] not in known:
            j = i + 1
        count, i = count + 1, j
    return count


KNOWN = ["abcabdab ca", "dd cc bb a", "a"]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="abcde ", max_size=50), min_size=1, max_size=4))
def test_phrases(texts):
    assert phrases(model_of(*KNOWN), *texts) == [[parsed(t, k) for t in texts] for k in KNOWN]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abcd ", max_size=60), min_size=1, max_size=4), st.integers(1, 9))
def test_phrases_go_on_over_cuts(texts, stretch):
    before, language.STRETCH = language.STRETCH, stretch
    try:
        assert phrases(model_of(*KNOWN), *texts) == [[parsed(t, k) for t in texts] for k in KNOWN]
    finally:
        language.STRETCH = before


def test_a_long_match_is_one_phrase():
    model = model_of("ab" * 2000, "ba" * 700)
    assert phrases(model, "ab" * 1500, "", "ba" * 1500) == [[1, 0, 1], [3, 0, 3]]


def test_many_symbols_take_little_room():
    rng = np.random.default_rng(1)
    text = rng.zipf(1.3, 20_000) % 3000 + 0x4E00
    model = language.Languages.of({"x": text})
    assert len(model.symbols) > 1500
    assert sum(a.nbytes for a in (model.moves.base, model.moves.owner, model.moves.target, model.first)) < 20 << 20
    codes = model.codes()[text]
    assert model.phrases(codes, np.array([0, len(text)])).tolist() == [[1]]
    with pytest.raises(ValueError, match="1 of 1 languages"):
        language.Languages.of({"x": text}, 1000)


def test_long_texts_are_learnt_by_their_beginning(session):
    rows = [(i, ("le chat noir " if i % 2 else "the black cat ") * 1500, "fr" if i % 2 else "en") for i in range(4)]
    rows += [(10, "12 34", "en"), (11, None, "fr"), (12, "un chat", None)]
    docs = session.createDataFrame(rows, "doc_id INT, text STRING, lang STRING")
    model = language.learnt(docs, "doc_id", "text", "lang", language.Sample(rows=2))
    assert model.names == ["en", "fr"]
    found = {r.doc_id: r.lang_pred for r in language.identified(docs, model).collect()}
    assert found == {0: "en", 1: "fr", 2: "en", 3: "fr", 10: "und", 11: "und", 12: "fr"}


@pytest.fixture(scope="module")
def languages(small):
    return language.learnt(small("documents").where("doc_id % 4 <> 2"), "doc_id", "text", "lang")


def test_held_out_accuracy(small, languages):
    rows = language.identified(small("documents").where("doc_id % 4 = 2"), languages).collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)


def test_awkward_rows(odd_docs, no_docs, languages):
    rows = language.identified(odd_docs, languages).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert (r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or ""))
        assert 0 <= r.score <= 1 and (r.lang_pred != "und" or r.score == 0)
    assert language.identified(no_docs, languages).collect() == []


def test_nothing_learnt(odd_docs, no_docs):
    nothing = language.learnt(no_docs, "doc_id", "text", "lang")
    assert {r.lang_pred for r in language.identified(odd_docs, nothing).collect()} == {"und"}
    one = language.learnt(odd_docs, "doc_id", "text", "lang")
    assert {r.score for r in language.identified(odd_docs, one).collect() if r.lang_pred == "xx"} == {1.0}
