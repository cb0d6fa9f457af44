"""Languages of texts by cross-parsing entropy.

Each language has the suffix automaton of a bounded amount of labelled text, which knows all substrings of it. A
text is parsed with each automaton into longest matches: a phrase goes on as long as the automaton knows it, and
the next character begins a new one. The language whose text explains the other in the fewest phrases wins,
phrases being normalised to phrases * log2(size of the language's text) / length, bits for each character.

Texts are compared in lower case, with all runs of other characters than letters as one space. They are parsed in
full, many at a time: all stretches of ``STRETCH`` characters of the texts of a block take one step together, in all
languages, as rows of arrays. Phrases go on over the cuts: stretches are parsed as if a phrase began with each, then
again from the state that the one before ended in, until both parses are in the same state, from where they agree.

The automata keep only the transitions that there are, so a language of thousands of symbols takes no more room
than one of thirty.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.llm import words

STRETCH = 512
UNKNOWN = "und"


@dataclass(frozen=True)
class Sample:
    """The labelled text to learn from: rows of each language, of each row its first characters, characters in all.

    ``most_bytes`` bounds the automata of all languages together, which every worker gets; more is an error.
    """

    rows: int = 100
    row_chars: int = 4000
    chars: int = 20_000
    most_bytes: int = 256 << 20


@functools.cache
def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def normalised(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts end to end, and where each starts; a text is its letters with single spaces between."""
    lowered = [(text or "").lower() for text in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.cumsum([0, *map(len, lowered)])
    letter = letters()[points]
    first = np.zeros(len(points) + 1, bool)
    first[offsets] = True
    after = np.zeros(len(points), bool)
    after[1:] = letter[:-1]
    kept = letter | (after & ~first[:-1])
    places = np.concatenate(([0], np.cumsum(kept)))
    return np.where(letter, points, ord(" "))[kept], places[offsets]


def automaton(text: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a text: for each state, the next one by symbol."""
    moves: list[dict[int, int]] = [{}]
    links, longest, last = [-1], [0], 0
    for symbol in text:
        state = len(moves)
        moves.append({})
        longest.append(longest[last] + 1)
        links.append(0)
        at = last
        while at >= 0 and symbol not in moves[at]:
            moves[at][symbol] = state
            at = links[at]
        if at >= 0:
            target = moves[at][symbol]
            if longest[target] == longest[at] + 1:
                links[state] = target
            else:
                split = len(moves)
                moves.append(moves[target].copy())
                longest.append(longest[at] + 1)
                links.append(links[target])
                while at >= 0 and moves[at].get(symbol) == target:
                    moves[at][symbol] = split
                    at = links[at]
                links[target] = links[state] = split
        last = state
    return moves


@dataclass(frozen=True)
class Transitions:
    """Transitions as displaced rows: slot ``base[state] + symbol`` is a state's if it is the slot's owner."""

    base: np.ndarray
    owner: np.ndarray
    target: np.ndarray

    @staticmethod
    def of(moves: list[dict[int, int]], size: int) -> Transitions:
        """Of symbols below ``size``. Long rows take the first place they fit in, rows of one fill what is left."""
        base = np.full(len(moves), size, np.int32)
        used = np.zeros(2 * size + 2 * sum(map(len, moves)) + 1, bool)
        used[:size] = True
        rows = sorted((state for state, known in enumerate(moves) if len(known) > 1), key=lambda state: -len(moves[state]))
        low = size
        for state in rows:
            symbols = np.sort(np.fromiter(moves[state], np.int64, len(moves[state])))
            low += int(used[low:].argmin())
            at, width = low, 64
            while True:
                if at + width + size > len(used):
                    used = np.concatenate((used, np.zeros(len(used) + width, bool)))
                free = at + np.flatnonzero(~used[at : at + width])
                fits = free[~used[free[:, None] + (symbols - symbols[0])].any(axis=1)]
                if len(fits):
                    break
                at, width = at + width, min(2 * width, 4096)
            base[state] = fits[0] - symbols[0]
            used[base[state] + symbols] = True
        single = [state for state, known in enumerate(moves) if len(known) == 1]
        free = np.flatnonzero(~used)[: len(single)]
        base[single] = free - np.array([next(iter(moves[state])) for state in single], np.int64)
        states = np.repeat(np.arange(len(moves)), [len(known) for known in moves])
        symbols = np.array([symbol for known in moves for symbol in known], np.int64)
        slots = base[states] + symbols
        owner = np.full(int(max(base.max(), slots.max(initial=0))) + size, -1, np.int32)
        target = np.zeros(len(owner), np.int32)
        owner[slots] = states
        target[slots] = [state for known in moves for state in known.values()]
        return Transitions(base, owner, target)


@dataclass(frozen=True)
class Languages:
    """Names in order, the symbol of each code point (0: in no language), and the automata of all, end to end.

    ``first`` has for each language and symbol the state after it at the beginning of a phrase, the language's root
    if it doesn't know the symbol.
    """

    names: list[str]
    symbols: dict[int, int]
    moves: Transitions
    roots: np.ndarray
    first: np.ndarray
    bits: np.ndarray

    @staticmethod
    def of(texts: dict[str, np.ndarray], most_bytes: int = Sample.most_bytes) -> Languages:
        """The automata of a text of code points for each language."""
        names = sorted(texts)
        every = sorted({int(p) for points in texts.values() for p in np.unique(points)})
        symbols = {point: i + 1 for i, point in enumerate(every)}
        size = len(symbols) + 1
        parts, roots, first, used = [], [], np.zeros((len(names), size), np.int32), 4 * len(names) * size
        states = slots = 0
        for row, name in enumerate(names):
            known = automaton([symbols[int(p)] for p in texts[name]])
            part = Transitions.of(known, size)
            used += part.base.nbytes + part.owner.nbytes + part.target.nbytes
            if used > most_bytes:
                raise ValueError(f"the automata of {row + 1} of {len(names)} languages take over {most_bytes} bytes")
            first[row] = states
            first[row, list(known[0])] = [states + state for state in known[0].values()]
            roots.append(states)
            owner = np.where(part.owner >= 0, part.owner + states, -1).astype(np.int32)
            parts.append((part.base + np.int32(slots), owner, part.target + np.int32(states)))
            states, slots = states + len(part.base), slots + len(owner)
        none = np.zeros(0, np.int32)
        moves = Transitions(*(np.concatenate(arrays) for arrays in zip(*parts, strict=True))) if parts else Transitions(none, none, none)
        bits = np.array([math.log2(len(texts[name]) + 1) for name in names])
        return Languages(names, symbols, moves, np.array(roots, np.int32), first, bits)

    def codes(self) -> np.ndarray:
        codes = np.zeros(0x110000, np.uint8 if len(self.symbols) < 255 else np.int32)
        codes[list(self.symbols)] = list(self.symbols.values())
        return codes

    def step(self, states: np.ndarray, symbol: np.ndarray, roots: np.ndarray, again: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after a symbol, and whether a phrase began with it. A symbol nobody knows is a phrase of its own."""
        slot = self.moves.base[states] + symbol
        ended = self.moves.owner[slot] != states
        return np.where(ended, again, self.moves.target[slot]), ended | (states == roots)

    def phrases(self, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For every language (rows) and text (columns), the phrases that the text is parsed into."""
        sizes = np.diff(offsets)
        cuts = -(-sizes // STRETCH)
        text = np.repeat(np.arange(len(sizes)), cuts)
        begin = offsets[text] + STRETCH * (np.arange(len(text)) - np.repeat(np.cumsum(cuts) - cuts, cuts))
        length = np.minimum(offsets[text + 1] - begin, STRETCH)
        order = np.argsort(-length, kind="stable")
        sorted_begin = begin[order]
        live = np.searchsorted(-length[order], -np.arange(int(length.max(initial=0))), "left")
        roots = self.roots[:, None]
        states = np.repeat(roots, len(begin), axis=1)
        found = np.zeros(states.shape, np.int64)
        for at, count in enumerate(live.tolist()):
            symbol = symbols[sorted_begin[:count] + at]
            states[:, :count], began = self.step(states[:, :count], symbol, roots, self.first[:, symbol])
            found[:, :count] += began
        back = np.argsort(order, kind="stable")
        found = found[:, back]
        self._join(symbols, text, begin, length, states[:, back], found)
        out = np.zeros((len(self.names), len(sizes)), np.int64)
        for language, row in enumerate(found):
            out[language] = np.bincount(text, row, len(sizes))
        return out

    def _join(
        self, symbols: np.ndarray, text: np.ndarray, begin: np.ndarray, length: np.ndarray, last: np.ndarray, found: np.ndarray
    ) -> None:
        """Mend ``found``, counted with a new phrase in each stretch, where a phrase goes on from the stretch before.

        ``last`` has the state after each stretch. At first all stretches are parsed anew, then only the first of each
        run whose beginning was wrong, so that work stays in proportion to the text however long it takes to agree.
        """
        follows = np.append(False, text[1:] == text[:-1])[: len(text)]
        begun = np.repeat(self.roots[:, None], len(text), axis=1)
        everything = True
        while True:
            should = begun.copy()
            should[:, 1:] = np.where(follows[1:], last[:, :-1], should[:, 1:])
            wrong = begun != should
            if not everything:
                wrong[:, 1:] &= ~wrong[:, :-1].copy()
            everything = False
            language, stretch = np.nonzero(wrong)
            if not len(stretch):
                return
            old, new = begun[language, stretch], should[language, stretch]
            begun[language, stretch] = new
            at = 0
            while len(stretch):
                symbol, roots = symbols[begin[stretch] + at], self.roots[language]
                again = self.first[language, symbol]
                old, was = self.step(old, symbol, roots, again)
                new, now = self.step(new, symbol, roots, again)
                found[language, stretch] += now.astype(np.int64) - was
                at += 1
                ends = length[stretch] == at
                last[language[ends], stretch[ends]] = new[ends]
                go = (old != new) & ~ends
                language, stretch, old, new = language[go], stretch[go], old[go], new[go]


def learnt(rows: DataFrame, key: str, text: str, language: str, sample: Sample = Sample()) -> Languages:
    """The automata of a bounded sample of rows with a language: of each, the rows first by a hash of the key.

    Of a long text its first ``row_chars`` characters are learnt. Rows with a null language or text, and those without
    a letter there, are not taken. With more languages than ``most_bytes`` has room for it fails.
    """
    beginning = F.substring(F.col(text), 1, sample.row_chars)
    usable = rows.select(F.col(key).alias("key"), F.col(language).alias("language"), beginning.alias("text"))
    usable = usable.where("language IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    first = Window.partitionBy("language").orderBy(F.xxhash64("key"), "hash")
    hashed = usable.select("language", "key", F.xxhash64("text").alias("hash"))
    chosen = hashed.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= sample.rows).collect()
    chosen = sorted(chosen, key=lambda row: (row["language"], row["rank"]))
    hashes = rows.sparkSession.createDataFrame([(row["hash"],) for row in chosen], "hash BIGINT").distinct()
    texts = usable.withColumn("hash", F.xxhash64("text")).join(F.broadcast(hashes), "hash", "left_semi")
    found = dict(texts.groupBy("hash").agg(F.first("text")).collect())
    joined: dict[str, np.ndarray] = {}
    for row in chosen:
        points, _ = normalised([found[row["hash"]]])
        known = joined.get(row["language"], np.zeros(0, np.uint32))
        if len(points) and len(known) < sample.chars:
            joined[row["language"]] = np.concatenate((known, points, [ord(" ")]))
    return Languages.of(joined, sample.most_bytes)


def identified(rows: DataFrame, languages: Languages, text: str = "text") -> DataFrame:
    """``rows`` with lang_pred and score.

    lang_pred is ``und``, with score 0, for a null text and one without a letter, and if no language was learnt.
    The score is how much fewer normalised phrases the language needs than the next one, as a share of the
    latter's (1 if there is no other). Ties go to the name that sorts first, with score 0. Columns of these
    names that ``rows`` has are replaced.
    """
    rows = rows.drop("lang_pred", "score")
    model = rows.sparkSession.sparkContext.broadcast(languages)
    at = rows.columns.index(text)

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        codes = known.codes()
        for batch in batches:
            for start, stop in words.blocks(batch.column(at)):
                points, offsets = normalised(batch.column(at).slice(start, stop - start).to_pylist())
                found, scores = [UNKNOWN] * (stop - start), np.zeros(stop - start)
                some = np.flatnonzero(np.diff(offsets))
                if known.names and len(some):
                    need = known.phrases(codes[points], offsets)[:, some] * known.bits[:, None]
                    best = need.argmin(axis=0)
                    for i, language in zip(some, best, strict=True):
                        found[i] = known.names[language]
                    least = need.min(axis=0)
                    second = np.partition(need, 1, axis=0)[1] if len(need) > 1 else np.full(len(some), np.inf)
                    scores[some] = 1 - least / second
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(start, stop - start) for c in batch.columns), pa.array(found), pa.array(scores)],
                    names=[*batch.schema.names, "lang_pred", "score"],
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(identify, f"{schema}, lang_pred STRING, score DOUBLE")
