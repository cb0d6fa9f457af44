from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

from kpiloom.llm import neardup, words
from kpiloom.llm.components import components

SHAPE = neardup.MinHash(shingle_words=4)
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, size=4):
    """(key, shingles, least key reachable) of each row, by comparing all rows that share a shingle."""
    sets, holders = [], defaultdict(list)
    for n, (_, text) in enumerate(rows):
        w = (text or "").translate(LOW).encode().split()
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()})
        for x in sets[-1]:
            holders[x].append(n)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, own in enumerate(sets):
        for m, both in Counter(m for x in own for m in holders[x] if m < n).items():
            if 100 * both >= 80 * (len(own) + len(sets[m]) - both):
                parent[find(n)] = find(m)
    least = defaultdict(list)
    for n, (key, _) in enumerate(rows):
        least[find(n)].append(key)
    out = []
    for n, (key, _) in enumerate(rows):
        keys = [k for k in least[find(n)] if k is not None]
        out.append((key, len(sets[n]), min(keys, default=None) if sets[n] else key))
    return Counter((k, n, c, k == c) for k, n, c in out)


def classes(docs, shape=SHAPE):
    return Counter(tuple(r) for r in neardup.near_duplicates(docs, shape=shape).collect())


def test_test_table(small):
    docs = small("documents")
    assert classes(docs) == plain([(r.doc_id, r.text) for r in docs.collect()])


def test_awkward_rows(odd_docs, no_docs):
    assert classes(odd_docs) == plain([(r.doc_id, r.text) for r in odd_docs.collect()])
    assert neardup.near_duplicates(no_docs).collect() == []


@pytest.fixture(scope="module")
def family():
    """Chains and a crowd of near copies that are like some of the others only, and texts that share a passage."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for n in range(260):
        words = list(base)
        for _ in range(rng.choice([1, 2, 4, 5, 6])):
            words[rng.randrange(120)] = f"x{n}y{rng.randrange(50)}"
        texts.append(" ".join(words))
    chain = [f"c{i}" for i in range(100)]
    for _ in range(25):
        chain = [*chain[6:], *(f"c{rng.random()}" for _ in range(6))]
        texts.append(" ".join(chain))
    passage = " ".join(f"p{i}" for i in range(40))
    texts += [f"{passage} {' '.join(f'q{n}z{i}' for i in range(rng.randrange(5, 60)))}" for n in range(150)]
    texts += [t.upper() for t in texts[::7]] + texts[:40] * 3
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_crowds_and_chains(session, family, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 32)
    expected = plain(family)
    assert len({c for _, _, c, _ in expected}) > 100
    assert classes(session.createDataFrame(family, "doc_id BIGINT, text STRING")) == expected


def test_estimates_agree_with_each_other_and_the_truth(session):
    import numpy as np
    import pyarrow as pa

    sets = [np.sort(words.mix(np.arange(1, 1001, dtype=np.uint64) + np.uint64(k))) for k in (0, 50, 111, 500, 5000)]
    for shape in (neardup.MinHash(), neardup.MinHash(bits=1), neardup.MinHash(bits=4), neardup.MinHash(bits=8)):
        _, packed = neardup._sign(sets, shape)
        matrix = np.array(packed.to_pylist(), np.int64)
        guess = neardup._estimates(matrix, matrix, shape)
        for i in range(5):
            for j in range(5):
                both = len(np.intersect1d(sets[i], sets[j]))
                assert abs(guess[i, j] - both / (2000 - both)) < 0.1
    rows = session.createDataFrame(pa.table({"x": packed.take([0] * 5), "y": packed}))
    native = [r[0] for r in rows.select(neardup.estimate("x", "y", shape)).collect()]
    assert np.allclose(native, guess[0])


def test_components(session):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(500 + i, 501 + i) for i in range(30)]
    links += [(7, 7), (None, 3), (900, 901), (900, 901), *((1000, 1000 + i) for i in range(1, 200))]
    got = {r.node: r.root for r in components(session.createDataFrame(links, "a INT, b INT")).collect()}
    parent = {x: x for p in links if None not in p and p[0] != p[1] for x in p}
    for _ in range(len(parent)):
        moved = False
        for a, b in links:
            if a in parent and b in parent and parent[a] != parent[b]:
                parent[a] = parent[b] = min(parent[a], parent[b])
                moved = True
        if not moved:
            break
    assert got == parent
    assert components(session.createDataFrame([], "a INT, b INT")).collect() == []
