from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kpiloom.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def whole(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def test_parts_encode_like_the_whole_text():
    texts = [
        "", " ", "  a  b ", "a b", "it's  we'll\n x\t y \x1c z", "é ü\xa0 ñ  漢字 🙂 x", "<|endoftext|> a <|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b <|endoftext", "<|endoftext|>",
        "1 2 33 !? a,b . c", "\n\n a\r\n b", "a   b　c d", "x" * 5000 + " y", " lead and trail ",
    ]
    random.seed(1)
    texts += ["".join(random.choices("ab 1.'\n\té\x85​ s", k=60)) for _ in range(300)]
    encode = packing.Encoder(PATH)
    for _ in range(2):
        assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == [whole(t) for t in texts]


def test_words_and_marks_are_parts_of_their_own():
    """A word is encoded once, whatever marks follow it; next to apostrophes and digits nothing is split."""
    assert packing.PARTS.findall("ab ab%%% (ab) ab#ab") == ["ab", " ab", "%%%", " (", "ab", ")", " ab", "#", "ab"]
    assert packing.PARTS.findall("it's (4) a_'s") == ["it's", " (4)", " a", "_'s"]
    marks = [chr(n) for n in range(0x21, 0x7F) if not chr(n).isalnum()]
    random.seed(2)
    texts = ["".join(random.choices([*marks, "'", "a", "Zé", "3", " ", "\n", " b", "'s", "\u4e00"], k=50)) for _ in range(1500)]
    encode, plain = packing.Encoder(PATH), Tokenizer.from_file(PATH)
    right = [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in encode(texts)] == right


def test_parts_met_again_are_kept_when_there_are_too_many(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    encode, encoded = packing.Encoder(PATH), []
    ids = encode.ids
    monkeypatch.setattr(encode, "ids", lambda part: encoded.append(part) or ids(part))
    texts = [["a b c d"], ["a b e f g"], ["a b c"], [""], ["a b"]]
    for batch in texts:
        assert [np.frombuffer(x, "<u4").tolist() for x in encode(batch)] == [whole(t) for t in batch]
    # The fourth block leaves at most what it has, which is nothing.
    assert sorted(encoded) == sorted(["a", " b", " c", " d", " e", " f", " g", " c"])
    assert len(encode.known) <= 3


@pytest.mark.parametrize("capacity", [8, 64])
def test_rows_are_packed_whole(session, odd_docs, capacity):
    rows = packing.packed(odd_docs, PATH, capacity, keep_ids=True).collect()
    texts = Counter((r.doc_id, r.text) for r in odd_docs.collect())
    pieces = defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 and 0 < r.length <= capacity
        pieces[r.doc_id, r.piece, r.start].append(np.frombuffer(r.ids, "<u4").tolist())
    for (doc, text), copies in texts.items():
        ids = [*whole(text), 2]
        first = len(ids) % capacity or capacity
        edges = [0, *range(first, len(ids) + 1, capacity)]
        for n, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            assert pieces[doc, n, a].count(ids[a:b]) == copies
    assert_gapless(rows, capacity)


def assert_gapless(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    assert sorted(sequences) == list(range(len(sequences)))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity


def test_no_rows(no_docs):
    assert packing.packed(no_docs, PATH).collect() == []


def used(patterns):
    total = Counter()
    for lengths, times in patterns:
        for length in lengths:
            total[length] += times
    return +total


@pytest.mark.parametrize("seed", range(12))
def test_plan_uses_every_piece_once_and_comes_near_the_bound(seed):
    random.seed(seed)
    capacity = random.choice([10, 50, 200])
    counts = Counter(random.randint(1, capacity) for _ in range(random.choice([0, 1, 30, 3000])))
    patterns = packing.plan(counts, capacity, 2000)
    assert used(patterns) == counts and all(sum(x) <= capacity for x, _ in patterns)
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    sequences = sum(t for _, t in patterns)
    assert packing.lower_bound(left, capacity) <= sequences <= packing.lower_bound(left, capacity) * 1.02 + 1
    first = packing.best_fit(left, capacity)
    assert used(first) == counts and sequences <= sum(t for _, t in first)


def fewest(lengths, capacity):
    """The least number of sequences, by trying everything."""
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for k in {room: k for k, room in enumerate(rooms) if room >= lengths[i]}.values():
            place(i + 1, [r - lengths[i] * (j == k) for j, r in enumerate(rooms)])
        place(i + 1, [*rooms, capacity - lengths[i]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(15))
def test_small_plans_are_optimal(seed):
    random.seed(seed)
    lengths = sorted((random.randint(2, 15) for _ in range(9)), reverse=True)
    assert sum(t for _, t in packing.plan(Counter(lengths), 20)) == fewest(lengths, 20)


def test_search_beats_best_fit():
    """Best fit by falling length needs three sequences here, completion two."""
    counts = Counter([6, 5, 4, 3, 1, 1])
    assert sum(t for _, t in packing.plan(counts, 10)) == 2
    assert sum(t for _, t in packing.plan(Counter([44, 24, 24, 22, 21, 17, 8, 8, 6, 6]), 60)) == 3


@pytest.mark.parametrize("seed", range(25))
def test_search_without_a_step_limit_is_optimal(seed):
    """Few lengths, each many times: patterns have to be used fewer times than they could be."""
    random.seed(100 + seed)
    capacity = random.choice([12, 20, 30])
    counts = Counter(random.choices(random.sample(range(2, capacity // 2 + 3), 4), k=10))
    found = packing.plan(counts, capacity, 10**9)
    assert used(found) == counts
    assert sum(t for _, t in found) == fewest(sorted(counts.elements(), reverse=True), capacity)


@pytest.mark.parametrize("seed", range(10))
def test_fillings_are_all_choices_by_waste(seed):
    random.seed(seed)
    left = np.zeros(21, np.int64)
    pieces = [random.randint(2, 14) for _ in range(8)]
    for length in pieces:
        left[length] += 1
    pieces.remove(max(pieces))
    room = 20 - int(np.flatnonzero(left)[-1])
    every = {tuple(sorted(c, reverse=True)) for n in range(9) for c in itertools.combinations(pieces, n)}
    found = list(packing.fillings(left, 20))
    assert [lost for lost, _ in found] == sorted(room - sum(x) for x in every if sum(x) <= room)
    assert {x for _, x in found} == {x for x in every if sum(x) <= room} and len(found) == len({x for _, x in found})


def test_search_saves_sequences_on_many_pieces():
    """Here best fit takes one more than the bound, which the search reaches."""
    random.seed(5)
    wins = 0
    for _ in range(20):
        counts = Counter(random.randint(20, 90) for _ in range(200))
        left = np.zeros(129, np.int64)
        for length, count in counts.items():
            left[length] = count
        found, first = (sum(t for _, t in x) for x in (packing.plan(counts, 128), packing.best_fit(left, 128)))
        assert packing.lower_bound(left, 128) <= found <= first
        wins += found < first
    assert wins >= 3


def test_dominated_fillings():
    assert packing._dominates((6,), (3, 3)) and packing._dominates((5, 2), (4, 2))
    assert not packing._dominates((4, 2), (5,))
