"""Toxicity by a linear classifier of character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the distinct runs of 4, 6 and 8 characters, in lower case, that lie in a word, its two edges
included, hashed. The ratio of a feature is the logarithm of its share in toxic texts over its share in others;
a logistic regression is fitted to the features scaled by their ratios. Both are learnt from a bounded sample of
labelled texts. Weights too small to matter are left out of the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from kpiloom.llm import words
from kpiloom.llm.labelled import sampled

SPACES = np.array([0x20, *range(0x09, 0x0E)])
ADAM = 0.9, 0.999, 1e-8


@dataclass(frozen=True)
class Fit:
    """The bounds of the sample (rows of each label, characters of a row) and the settings of the fit."""

    per_label: int = 2000
    most_chars: int = 20_000
    sizes: tuple[int, ...] = (4, 6, 8)
    hash_bits: int = 20
    least_texts: int = 3
    least_ratio: float = 2.0
    smoothing: float = 1.0
    penalty: float = 3.0
    steps: int = 60
    rate: float = 0.02


@dataclass(frozen=True)
class Classifier:
    weights: np.ndarray
    bias: float
    fit: Fit

    def scores(self, texts: list[str]) -> np.ndarray:
        """The probability of label 1 for each text; an empty one has the bias alone."""
        text, feature = features(texts, self.fit, self.weights != 0)
        sums = np.bincount(text, self.weights[feature], len(texts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(sums, -500, 500)))


def features(texts: list[str], fit: Fit, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) pairs, each once and in order; ``wanted`` says which features are looked for."""
    lowered = [f" {(text or '').lower()} " for text in texts]
    points = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(x) for x in lowered])
    space = np.isin(points, SPACES)
    doubled = np.zeros(len(points), bool)
    doubled[1:] = space[1:] & space[:-1] & (owner[1:] == owner[:-1])
    points, owner, space = points[~doubled], owner[~doubled], space[~doubled]
    points = np.where(space, 0x20, points).astype(np.uint64)
    inside = np.cumsum(space)
    found = []
    for size in fit.sizes:
        count = len(points) - size + 1
        if count <= 0:
            continue
        whole = np.flatnonzero(inside[size - 2 : size - 2 + count] == inside[:count])
        hashed = np.full(len(whole), size, np.uint64)
        for k in range(size):
            hashed = (hashed ^ points[whole + k]) * words.GOLDEN
            hashed ^= hashed >> np.uint64(29)
        feature = (hashed >> np.uint64(64 - fit.hash_bits)).astype(np.int64)
        kept = slice(None) if wanted is None else wanted[feature]
        found.append((owner[whole[kept]] << fit.hash_bits) | feature[kept])
    pairs = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
    return pairs >> fit.hash_bits, pairs & ((1 << fit.hash_bits) - 1)


def fitted(texts: list[tuple[str, int]], counts: dict[int, int], fit: Fit = Fit()) -> Classifier:
    """Fit to labelled texts; ``counts`` are the labels' numbers in all labelled rows, for the bias.

    If a label is missing, there is nothing to tell apart, and every score is the share of label 1.
    """
    size = 1 << fit.hash_bits
    labels = np.array([label for _, label in texts], np.int64)
    some = np.bincount(labels, minlength=2)[:2] if len(labels) else np.zeros(2, np.int64)
    prior = (counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5)
    if not some.all():
        return Classifier(np.zeros(size), float(np.log(prior)), fit)
    parts, held = [], np.zeros((2, size))
    for start, stop in words.blocks(pa.array([text for text, _ in texts])):
        text, feature = features([text for text, _ in texts[start:stop]], fit)
        text = (text + start).astype(np.int32)
        parts.append((text, feature.astype(np.int32)))
        for label in (0, 1):
            held[label] += np.bincount(feature[labels[text] == label], minlength=size)
    shares = (held + fit.smoothing) / (some + 2 * fit.smoothing)[:, None]
    ratio = np.log(shares[1] / shares[0])
    ratio[(held.sum(axis=0) < fit.least_texts) | (np.abs(ratio) < fit.least_ratio)] = 0
    kept = [(text[ratio[feature] != 0], feature[ratio[feature] != 0]) for text, feature in parts]
    text, feature = (np.concatenate(x) for x in zip(*kept, strict=True))
    del parts, kept, held, shares

    share = labels.mean()
    weight, bias = np.zeros(size), float(np.log(share / (1 - share)))
    state = [np.zeros(size), np.zeros(size), 0.0, 0.0]
    for step in range(1, fit.steps + 1):
        sums = np.bincount(text, (weight * ratio)[feature], len(texts)) + bias
        error = (1 / (1 + np.exp(-np.clip(sums, -500, 500))) - labels) / len(texts)
        slope = np.bincount(feature, error[text], size) * ratio + fit.penalty / len(texts) * weight
        for at, grad in ((0, slope), (2, float(error.sum()))):
            state[at] = ADAM[0] * state[at] + (1 - ADAM[0]) * grad
            state[at + 1] = ADAM[1] * state[at + 1] + (1 - ADAM[1]) * grad**2
            move = state[at] / (1 - ADAM[0] ** step) / (np.sqrt(state[at + 1] / (1 - ADAM[1] ** step)) + ADAM[2])
            if at:
                bias -= fit.rate * float(move)
            else:
                weight -= fit.rate * move
    weights = weight * ratio
    weights[np.abs(weights) < 0.02 * np.abs(weights).max()] = 0
    return Classifier(weights.astype(np.float64), bias + float(np.log(prior / (some[1] / some[0]))), fit)


def trained(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", fit: Fit = Fit()) -> Classifier:
    """Fit to a bounded sample of the texts whose keys ``labels`` has."""
    return fitted(*sampled(docs, labels, label, fit.per_label, fit.most_chars, key, text), fit)


def scored(rows: DataFrame, classifier: Classifier, text: str = "text") -> DataFrame:
    """``rows`` with score, the probability of label 1, of the whole text; a null text counts as empty.

    A column of this name that ``rows`` has is replaced.
    """
    rows = rows.drop("score")
    model = rows.sparkSession.sparkContext.broadcast(classifier)
    at = rows.columns.index(text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in words.blocks(batch.column(at)):
                part = batch.slice(start, stop - start)
                scores = model.value.scores(part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], names=[*part.schema.names, "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(score, f"{schema}, score DOUBLE")
