from __future__ import annotations

import pytest

from kpiloom.llm.store import share_code

# Null, empty, blank, short, repeated and very long texts; ids are not in order, one is null, one row is repeated.
TEXTS = [
    (7, "The quick brown fox jumps over the lazy dog again and again"),
    (3, None),
    (4, ""),
    (5, " \t\n"),
    (None, "one"),
    (9, "the QUICK brown fox jumps over the lazy dog again and again"),
    (9, "the QUICK brown fox jumps over the lazy dog again and again"),
    (1, "é " * 30 + "#$ | <a> 123"),
    (2, " ".join(f"w{i % 977}x{i % 31}" for i in range(20_000))),
]


@pytest.fixture(scope="session")
def session(spark):
    share_code(spark)
    return spark


@pytest.fixture
def odd_docs(session):
    """Awkward rows with columns whose names operators use themselves."""
    rows = [(i, text, "xx", "src", 1, f"s{n}", n, "m") for n, (i, text) in enumerate(TEXTS)]
    return session.createDataFrame(
        rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, score STRING, key INT, kept STRING"
    )


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def small(session):
    """A table of the smallest test data."""
    return lambda name: session.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
