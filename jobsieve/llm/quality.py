"""Document quality by a linear-chain CRF over lines.

Every line is labelled good or bad from its own features and those of its neighbours. The marginals of the lines, weighted by their lengths, give the document's score."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from jobsieve.llm import crf
from jobsieve.llm.common import slices, texts
from jobsieve.llm.labelled import sample

UPPER, LOWER, MARK, DIGIT = (re.compile(p) for p in (r"[A-ZÀ-ÖØ-Þ]", r"[a-zß-öø-ÿ]", r"[^\w\s.,]", r"\d"))
BINS = 8
FIELDS = 10


def line_features(lines: list[str]) -> np.ndarray:
    """One row of numbers per line."""
    seen = Counter(lines)
    out = np.zeros((len(lines), FIELDS))
    for i, line in enumerate(lines):
        words = line.split()
        n, w = max(1, len(line)), max(1, len(words))
        upper, lower, marks = len(UPPER.findall(line)), len(LOWER.findall(line)), len(MARK.findall(line))
        out[i] = (
            np.log1p(len(line)), np.log1p(len(words)), len(line) / w, upper / max(1, upper + lower), marks / w, len(DIGIT.findall(line)) / n,
            len(set(words)) / w, line.count("|") / w, seen[line] - 1, line.rstrip().endswith((".", "!", "?")),
        )
    return out


def lines_of(text: str) -> list[str]:
    return [line for line in (text or "").split("\n") if line.strip()]


def binned(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    return np.stack([np.searchsorted(edges[f], values[:, f], side="right") for f in range(FIELDS)], axis=1)


def slots(bins: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indexes of the features of each line: its own bins, those of the line before and of the line after."""
    none = np.full((1, FIELDS), BINS)
    before, after = np.concatenate([none, bins[:-1]]), np.concatenate([bins[1:], none])
    before[starts] = BINS
    after[:-1][starts[1:]] = BINS
    each = np.concatenate([bins, before, after], axis=1)
    return each + np.arange(3 * FIELDS) * (BINS + 1)


SIZE = 3 * FIELDS * (BINS + 1)


class Dense:
    def __init__(self, rows: np.ndarray):
        self.rows = rows

    def score(self, weights: np.ndarray) -> np.ndarray:
        return weights[self.rows].sum(axis=1)

    def gather(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows.ravel(), np.repeat(values, self.rows.shape[1]), SIZE)


@dataclass
class Model:
    edges: np.ndarray
    weights: np.ndarray
    transitions: np.ndarray
    initial: np.ndarray
    link: np.ndarray

    def measures(self, docs: list[str]) -> np.ndarray:
        """Per text the mean goodness of its lines weighted by length, the least goodness, and whether it has lines at all."""
        lines = [lines_of(text) for text in docs]
        lengths = [len(own) for own in lines]
        out = np.zeros((len(docs), 3))
        if not sum(lengths):
            return out
        values = np.concatenate([line_features(own) for own in lines if own])
        starts = np.zeros(len(values), bool)
        ends = np.cumsum(lengths)
        starts[[e - n for e, n in zip(ends, lengths) if n]] = True
        scores = self.weights[slots(binned(values, self.edges), starts)].sum(axis=1)
        p = crf.Chains(scores, starts, self.transitions, self.initial).marginals()
        weight = np.array([len(line) for own in lines for line in own], float)
        at = [e - n for e, n in zip(ends, lengths) if n]
        has = np.array(lengths) > 0
        out[has, 0] = np.add.reduceat(p * weight, at) / np.add.reduceat(weight, at)
        out[has, 1] = np.minimum.reduceat(p, at)
        out[has, 2] = 1
        return out


def fit(pairs: list[tuple[str, int]]) -> Model:
    """From (text, label) pairs; every line of a text is taken to have its label. Without both labels every text scores one half."""
    docs = [(lines_of(text), label) for text, label in pairs]
    kept = [d for d in docs if d[0]]
    if len({label for _, label in kept}) < 2:
        return Model(np.zeros((FIELDS, BINS - 1)), np.zeros(SIZE), np.zeros((2, 2)), np.zeros(2), np.zeros(4))
    values = np.concatenate([line_features(own) for own, _ in kept])
    lengths = [len(own) for own, _ in kept]
    starts = np.zeros(len(values), bool)
    starts[np.cumsum([0, *lengths[:-1]])] = True
    labels = np.repeat([label for _, label in kept], lengths)
    edges = np.quantile(values, np.arange(1, BINS) / BINS, axis=0).T
    rows = slots(binned(values, edges), starts)
    model = Model(edges, *crf.train(Dense(rows), labels, starts, SIZE, rounds=150, rate=0.1, ridge=1.0), np.zeros(4))
    model.link = crf.logistic(model.measures([text for text, _ in pairs]), np.array([label for _, label in pairs], float))
    return model


def scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            scores = crf.probability(model.measures(part.column(1).to_pylist()), model.link)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores)], ["doc_id", "score"])

    return run


def train(docs: DataFrame, labels: DataFrame, rows: int = 6000) -> Model:
    """Learns ``labels.quality`` from at most ``rows`` labelled documents of at most 20,000 code points that are not held out."""
    return fit(sample(docs, labels, "quality", rows))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1) for every row of ``docs`` (doc_id, text).

    Null, empty and blank texts have no lines and share one score; texts are read whole; null and repeated doc_ids keep their rows; an empty table gives
    none. Other columns are not read."""
    return texts(docs).mapInArrow(scorer(model), "doc_id bigint, score double")
