"""Quality of texts by labelling their lines with a linear-chain conditional random field.

Each line that has a word is content or boilerplate. A line is described by yes-or-no features (its number of
words, the shares of distinct words, symbols, capitals and digits, how it ends, whether it repeats an earlier
line, ...); the field has a weight for each feature, one for each step from a label to the next, and one for each
label to begin with. It is fitted by its exact likelihood to a bounded sample of labelled texts. The lines of a
text have its label; so that the field learns how content and boilerplate follow each other within a text, it is
fitted as well to mixed ones, each made of a content and a boilerplate text cut into runs of lines that take turns.
Viterbi decoding gives a text's lines their most likely labels together, and
the share of its words that lie in content lines decides whether the text is kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kpiloom.llm import words
from kpiloom.llm.labelled import sampled

# The characters that count as symbols.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
NEWLINE = 0x0A
CAPITALS, SMALL, DIGITS, ENDS = (np.zeros(256, bool) for _ in range(4))
CAPITALS[0x41:0x5B] = SMALL[0x61:0x7B] = DIGITS[0x30:0x3A] = True
ENDS[list(b".!?:;\"'")] = True
# Edges of the classes that each measure of a line falls into.
EDGES = {
    "words": [2, 3, 6, 11, 21, 41],
    "distinct": [0.3, 0.5, 0.7, 0.85, 0.999],
    "symbols": [0.001, 0.03, 0.1, 0.25],
    "marks": [0.02, 0.05, 0.1, 0.2],
    "capitals": [0.05, 0.2, 0.5, 0.8],
    "digits": [0.05, 0.2, 0.5],
    "length": [3.0, 4.5, 6.0, 8.0, 12.0],
}
FLAGS = ["ends", "repeats", "first", "last", "starts_high"]
N_FEATURES = sum(len(e) + 1 for e in EDGES.values()) + len(FLAGS) + 1


@dataclass(frozen=True)
class Fit:
    """The bounds of the sample (rows of each label, characters of a row) and the settings of the fit.

    ``run`` is the most lines of a run in mixed texts.
    """

    per_label: int = 600
    most_chars: int = 20_000
    steps: int = 100
    rate: float = 0.1
    penalty: float = 1.0
    run: int = 4


@dataclass(frozen=True)
class Field:
    """Weights of the features for content over boilerplate, of steps (from, to) and of the first label; 1 is content."""

    weights: np.ndarray
    steps: np.ndarray
    start: np.ndarray


@dataclass
class Lines:
    """The lines with words of a block of texts, in order: their features, numbers of words and texts."""

    features: np.ndarray
    n_words: np.ndarray
    text: np.ndarray


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measured(column: pa.Array) -> tuple[Lines, dict[str, np.ndarray]]:
    """The lines of all texts of a column, and the texts' plain counts."""
    data, offsets = words.utf8(column)
    texts = len(column)
    starts, ends, counts = words.word_spans(data, offsets)
    hashes = words.hash_spans(data, starts, ends)
    text_of_word = np.repeat(np.arange(texts), np.diff(counts))
    inside = ~words.SPACE[data]
    points = inside & ((data & 0xC0) != 0x80)
    n_words = np.diff(counts)

    breaks = np.union1d(np.flatnonzero(data == NEWLINE) + 1, offsets[:-1]).astype(np.int64)
    breaks = breaks[breaks < len(data)]
    line_of_word = np.searchsorted(breaks, starts, "right") - 1
    used, line, line_words = np.unique(line_of_word, return_inverse=True, return_counts=True)
    begin = breaks[used]
    stop = np.append(breaks, len(data))[used + 1] if len(used) else begin
    ended = (stop > begin) & (data[stop - 1] == NEWLINE) if len(used) else np.zeros(0, bool)
    raw = words.hash_spans(data, begin, stop - ended)
    text = np.searchsorted(offsets, begin, "right") - 1
    first_word = np.cumsum(line_words) - line_words

    def per_line(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[stop] - total[begin]

    def per_text(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[offsets[1:]] - total[offsets[:-1]]

    repeats = _seen_before(text, raw)
    distinct = np.zeros(len(used), np.int64)
    if len(used):
        order = np.lexsort((hashes, line))
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (line[order][1:] != line[order][:-1])
        distinct = np.bincount(line[order], new, len(used))
    chars = np.maximum(per_line(points), 1)
    marks = inside & ~CAPITALS[data] & ~SMALL[data] & ~DIGITS[data] & (data < 0x80)
    high, low = per_line(CAPITALS[data]), per_line(SMALL[data])
    last_byte = data[ends[first_word + line_words - 1] - 1] if len(used) else np.zeros(0, np.uint8)
    first_byte = data[starts[first_word]] if len(used) else np.zeros(0, np.uint8)
    measures = {
        "words": line_words,
        "distinct": distinct / np.maximum(line_words, 1),
        "symbols": per_line(SYMBOLS[data]) / chars,
        "marks": per_line(marks) / chars,
        "capitals": high / np.maximum(high + low, 1),
        "digits": per_line(DIGITS[data]) / chars,
        "length": chars / np.maximum(line_words, 1),
    }
    edge = np.ones(len(used), bool)
    edge[1:] = text[1:] != text[:-1]
    flags = [ENDS[last_byte], repeats, edge, np.append(edge[1:], True)[: len(used)], CAPITALS[first_byte]]
    columns = []
    for name, values in measures.items():
        classes = np.searchsorted(EDGES[name], values, "right")
        columns.append(classes[:, None] == np.arange(len(EDGES[name]) + 1)[None, :])
    features = np.concatenate([*columns, *(f[:, None] for f in flags), np.ones((len(used), 1), bool)], axis=1)

    windows = words.windows(hashes, 3)
    same = text_of_word[2:] == text_of_word[:-2] if len(hashes) > 2 else np.zeros(0, bool)
    at = np.flatnonzero(same)
    often = _repeated(text_of_word[at], windows[at])
    covered = np.zeros(len(hashes), bool)
    for k in range(3):
        covered[at[often] + k] = True
    base = {
        "n_words": n_words,
        "word_chars": per_text(points),
        "n_symbols": per_text(SYMBOLS[data]),
        "n_dup_lines": np.bincount(text, repeats, texts).astype(np.int64),
        "n_repeat_words": np.bincount(text_of_word, covered, texts).astype(np.int64),
    }
    return Lines(features, line_words, text), base


def _seen_before(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether a value is in an earlier place of its group."""
    order = np.lexsort((np.arange(len(value)), value, group))
    again = np.zeros(len(value), bool)
    again[order[1:]] = (value[order][1:] == value[order][:-1]) & (group[order][1:] == group[order][:-1])
    return again


def _repeated(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether a value is twice or more in its group."""
    order = np.lexsort((value, group))
    same = (value[order][1:] == value[order][:-1]) & (group[order][1:] == group[order][:-1])
    out = np.zeros(len(value), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def decoded(lines: Lines, field: Field) -> np.ndarray:
    """The most likely labels of the lines of each text, by Viterbi; ties go to boilerplate."""
    emit = (lines.features @ field.weights).tolist()
    (t00, t01), (t10, t11) = field.steps.tolist()
    s0, s1 = field.start.tolist()
    labels = np.zeros(len(emit), bool)
    if not emit:
        return labels
    edges = np.flatnonzero(np.append(True, lines.text[1:] != lines.text[:-1])).tolist()
    for begin, stop in zip(edges, [*edges[1:], len(emit)], strict=True):
        low, high, back = s0, s1 + emit[begin], []
        for e in emit[begin + 1 : stop]:
            from_low, to_low = low + t00 >= high + t10, max(low + t00, high + t10)
            from_low_up, to_high = low + t01 >= high + t11, max(low + t01, high + t11) + e
            back.append((not from_low, not from_low_up))
            low, high = to_low, to_high
        label = high > low
        labels[stop - 1] = label
        for at in range(len(back) - 1, -1, -1):
            label = back[at][label]
            labels[begin + at] = label
    return labels


def has_word(line: str) -> bool:
    return bool(line.encode("utf-8", "surrogatepass").split())


def mixed(texts: list[tuple[str, int]], run: int) -> list[tuple[str, list[int]]]:
    """The lines with words of the i-th content and the i-th boilerplate text in turns, and the label of each line.

    Runs have 1 to ``run`` lines by a fixed rule of the place; every other text begins with boilerplate. Texts
    without a partner are not used.
    """
    lines = [[list(filter(has_word, text.split("\n"))) for text, own in texts if own == label] for label in (0, 1)]
    out = []
    for i, pair in enumerate(zip(*lines, strict=False)):
        at, label, turn, made, labels = [0, 0], (i + 1) % 2, 0, [], []
        while at[0] < len(pair[0]) or at[1] < len(pair[1]):
            part = pair[label][at[label] : at[label] + 1 + (i // 2 + turn) % run]
            at[label] += len(part)
            made += part
            labels += [label] * len(part)
            label, turn = 1 - label, turn + 1
        out.append(("\n".join(made), labels))
    return out


def likelihood(
    values: np.ndarray, features: np.ndarray, text: np.ndarray, label: np.ndarray
) -> tuple[float, np.ndarray]:
    """The log-likelihood of the lines' labels and its slope, for weights, steps and starts end to end.

    ``text`` is the text of each line, from 0 and without gaps, in order.
    """
    size = np.bincount(text)
    order = np.argsort(-size, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    begin = np.cumsum(size) - size
    row, column = rank[text], np.arange(len(text)) - np.repeat(begin, size)
    size = size[order]
    live = [int((size > t).sum()) for t in range(size[0])]
    weights, steps, start = values[:N_FEATURES], values[N_FEATURES:-2].reshape(2, 2), values[-2:]
    emit = np.zeros((len(size), size[0], 2))
    emit[row, column, 1] = features @ weights
    ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
    ahead[:, 0] = start + emit[:, 0]
    for t in range(1, size[0]):
        n = live[t]
        ahead[:n, t] = np.logaddexp.reduce(ahead[:n, t - 1, :, None] + steps, axis=1) + emit[:n, t]
    for t in range(size[0] - 2, -1, -1):
        n = live[t + 1]
        behind[:n, t] = np.logaddexp.reduce(steps + (emit[:n, t + 1] + behind[:n, t + 1])[:, None, :], axis=2)
    total = np.logaddexp.reduce(ahead[np.arange(len(size)), size - 1], axis=1)
    is_content = np.exp(ahead[row, column, 1] + behind[row, column, 1] - total[row])
    expected = np.zeros((2, 2))
    for t in range(1, size[0]):
        n = live[t]
        both = ahead[:n, t - 1, :, None] + steps + (emit[:n, t] + behind[:n, t])[:, None, :]
        expected += np.exp(both - total[:n, None, None]).sum(axis=0)
    follows = np.flatnonzero(text[1:] == text[:-1])
    seen = np.bincount(2 * label[follows] + label[follows + 1], minlength=4).reshape(2, 2)
    seen_first = np.bincount(label[begin], minlength=2)
    first_content = np.exp(ahead[:, 0, 1] + behind[:, 0, 1] - total).sum()
    value = emit[row, column, label].sum() + (seen * steps).sum() + seen_first @ start - total.sum()
    slope = features.T @ (label - is_content), (seen - expected).ravel(), seen_first - [len(size) - first_content, first_content]
    return float(value), np.concatenate(slope)


def fitted(texts: list[tuple[str, int]], fit: Fit = Fit()) -> Field:
    """The field of greatest penalised likelihood, label 1 being content; without texts all weights are 0."""
    both = mixed(texts, fit.run)
    lines, _ = measured(pa.array([text for text, _ in [*texts, *both]], pa.string()))
    own, text = np.unique(lines.text, return_inverse=True)
    values = np.zeros(N_FEATURES + 6)
    if len(own):
        plain = lines.text < len(texts)
        whole = np.array([label for _, label in texts])[lines.text[plain]]
        label = np.concatenate((whole, [label for _, labels in both for label in labels])).astype(np.int64)
        features = lines.features.astype(float)
        first, second = np.zeros_like(values), np.zeros_like(values)
        for step in range(1, fit.steps + 1):
            _, slope = likelihood(values, features, text, label)
            slope = (slope - fit.penalty * values) / len(text)
            first = 0.9 * first + 0.1 * slope
            second = 0.999 * second + 0.001 * slope**2
            values = values + fit.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Field(values[:N_FEATURES], values[N_FEATURES:-2].reshape(2, 2), values[-2:])


def trained(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", fit: Fit = Fit()) -> Field:
    """Fit to a bounded sample of the texts whose keys ``labels`` has."""
    texts, _ = sampled(docs, labels, label, fit.per_label, fit.most_chars, key, text)
    return fitted(texts, fit)


def judged(rows: DataFrame, field: Field, text: str = "text", least_share: float = 0.5) -> DataFrame:
    """``rows`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share and kept.

    base_failed: fewer than 50 words, or more than half of them in repeated windows of three. kept: not
    base_failed, and a content share of ``least_share`` or more. A null text, and one without words, has counts of
    0, share 0, and isn't kept. Columns of these names that ``rows`` has are replaced.
    """
    made = [*BASE, "base_failed", "content_share", "kept"]
    rows = rows.drop(*made)
    model = rows.sparkSession.sparkContext.broadcast(field)
    at = rows.columns.index(text)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in words.blocks(batch.column(at)):
                part = batch.slice(start, stop - start)
                lines, base = measured(part.column(at))
                content = np.bincount(lines.text, lines.n_words * decoded(lines, model.value), stop - start)
                share = content / np.maximum(base["n_words"], 1)
                failed = (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])
                values = [*(base[c] for c in BASE), failed, share, ~failed & (share >= least_share)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *map(pa.array, values)], names=[*part.schema.names, *made]
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    counts = ", ".join(f"{c} BIGINT" for c in BASE)
    return rows.mapInArrow(judge, f"{schema}, {counts}, base_failed BOOLEAN, content_share DOUBLE, kept BOOLEAN")
