from __future__ import annotations

import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from kpiloom.llm import words

ANY = st.text(alphabet=st.sampled_from("ab AB\t\n\x0b\xa0é\x1c🙂"), max_size=40)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | ANY, max_size=5))
def test_words_are_equal_when_their_bytes_are(texts):
    hashes, counts = words.words(pa.array(texts, pa.string()))
    low = str.maketrans("AB", "ab")
    split = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) for t in texts]
    assert [b - a for a, b in zip(counts, counts[1:], strict=False)] == [len(x) for x in split]
    flat = [w for x in split for w in x]
    assert len(set(zip(flat, hashes.tolist(), strict=True))) == len(set(flat)) == len(set(hashes.tolist()))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.none() | ANY, max_size=4), st.integers(1, 4))
def test_shingle_sets(texts, size):
    sets = list(words.shingle_sets(pa.array(texts, pa.string()), size))
    for text, found in zip(texts, sets, strict=True):
        w = (text or "").replace("A", "a").replace("B", "b").encode().split()
        expected = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}
        assert len(found) == len(expected)


def test_long_words_and_blocks():
    column = pa.array(["x" * 100_000, "x" * 100_001, None, "y " * 10])
    hashes, counts = words.words(column)
    assert hashes[0] != hashes[1] and counts.tolist() == [0, 1, 2, 2, 12]
    assert list(words.blocks(column, 100)) == [(0, 1), (1, 2), (2, 4)]
    assert list(words.blocks(pa.array([], pa.string()))) == []
    assert words.shingle_sets(column.slice(3, 1), 2).__next__().size == 1
