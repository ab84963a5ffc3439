"""Toxicity by a linear-chain CRF over tokens.

Labels mark documents, so tokens get their labels first: a token of a toxic document counts as toxic if its word or its first letters occur in
many different toxic documents and hardly in others. The field learns from those, tags every token of a text, and the marginals of
forward and backward passes give the offending offsets and, by how many more toxic tokens are expected than in a clean text of its length, the score of the document."""

from __future__ import annotations

import math
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsieve.llm import crf
from jobsieve.llm.common import slices
from jobsieve.llm.labelled import sample

WORD = re.compile(r"\w+")
SLOTS = 1 << 16
#: Tokens whose scores a worker remembers at a time.
REMEMBERED = 300_000
SPAN = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("p", pa.float64())])


def names(word: str) -> list[str]:
    return [f"w{word}", f"4{word[:4]}" if len(word) > 4 else "-", f"5{word[:5]}" if len(word) > 5 else "-", f"s{word[-3:]}"]


def slots(word: str) -> list[int]:
    return [zlib.crc32(name.encode("utf-8", "surrogatepass")) % SLOTS for name in names(word)]


@dataclass
class Model:
    weights: np.ndarray
    transitions: np.ndarray
    initial: np.ndarray
    link: np.ndarray
    #: Expected toxic tokens per token of clean documents.
    background: float = 0.0

    def tagger(self) -> "Tagger":
        return Tagger(self)


class Scores(dict):
    """Words to their scores."""

    def __init__(self, weights: list[float]):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = sum(map(self.weights.__getitem__, slots(word)))
        return found


class Tagger:
    def __init__(self, model: Model):
        self.model, self.known = model, Scores(model.weights.tolist())

    def marginals(self, words: list[list[str]]) -> list[np.ndarray]:
        lengths = [len(own) for own in words]
        n = sum(lengths)
        if not n:
            return [np.empty(0) for _ in words]
        ends = np.cumsum(lengths)
        scores = np.fromiter(map(self.known.__getitem__, chain.from_iterable(words)), float, n)
        starts = np.zeros(n, bool)
        starts[[e - k for e, k in zip(ends, lengths) if k]] = True
        p = crf.Chains(scores, starts, self.model.transitions, self.model.initial).marginals()
        return np.split(p, ends[:-1])


def measures(p: np.ndarray, background: float) -> tuple[float, float]:
    """By how many deviations the expected toxic tokens exceed those of a clean text as long as this, and the surest one."""
    if not len(p):
        return 0.0, 0.0
    usual = background * len(p)
    return min(5.0, (float(p.sum()) - usual) / math.sqrt(usual + 1)), float(p.max())


def words_of(text: str | None) -> list[str]:
    """Words in lower case; they are found in the text as it is, so that their places are those of the text."""
    return [word.lower() for word in WORD.findall(text or "")]


class Sparse:
    def __init__(self, rows: np.ndarray):
        self.rows = rows

    def score(self, weights: np.ndarray) -> np.ndarray:
        return weights[self.rows].sum(axis=1)

    def gather(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows.ravel(), np.repeat(values, self.rows.shape[1]), SLOTS)


def evidence(docs: list[tuple[list[str], int]], chance: float = 100.0, ratio: float = 4.0) -> set[str]:
    """Words and beginnings of words that mark toxic documents: the likelihood ratio of their documents' labels against the share of all documents must exceed a bound
    that grows with the number of names tried (``chance`` of them would be let through at most), and they must be ``ratio`` times as frequent in toxic documents.

    Near copies count once: of documents with one label and the same least hash of three words one is counted."""
    counts, seen = [defaultdict(int), defaultdict(int)], [set(), set()]
    for words, label in docs:
        if not words:
            continue
        own = set(words)
        least = min(zlib.crc32(" ".join(t).encode("utf-8", "surrogatepass")) for t in zip(words, words[1:] or [""], words[2:] or [""]))
        if least in seen[label]:
            continue
        seen[label].add(least)
        for name in {n for w in own for n in names(w)[:3] if n != "-"}:
            counts[label][name] += 1
    clean, toxic = max(1, len(seen[0])), max(1, len(seen[1]))
    share = toxic / (clean + toxic)
    tried = len(set(counts[0]) | set(counts[1]))
    bound = 2 * math.log(max(2.0, tried / chance))
    out = set()
    for name, k in counts[1].items():
        c = counts[0].get(name, 0)
        both = 2 * (k * math.log(k / ((k + c) * share)) + (c * math.log(c / ((k + c) * (1 - share))) if c else 0.0))
        if both > bound and k / toxic > ratio * c / clean:
            out.add(name)
    return out


def fit(pairs: list[tuple[str, int]], chain_docs: int = 250) -> Model:
    """From (text, label) pairs; the field is trained on the first ``chain_docs`` of each label. Without both labels every text scores low."""
    docs = [(words_of(text), label) for text, label in pairs]
    if len({label for _, label in docs}) < 2:
        return Model(np.zeros(SLOTS), np.zeros((2, 2)), np.array([0.0, -9.0]), np.array([0.0, 0.0, -5.0]))
    marks = evidence(docs)
    chosen = [d for value in (0, 1) for d in [d for d in docs if d[1] == value and d[0]][:chain_docs]]
    words = [w for own, _ in chosen for w in own]
    lengths = [len(own) for own, _ in chosen]
    is_toxic = {w: any(n in marks for n in names(w)[:3]) for w in set(words)}
    labels = np.fromiter((value and is_toxic[w] for own, value in chosen for w in own), np.int64, len(words))
    starts = np.zeros(len(words), bool)
    starts[np.cumsum([0, *lengths[:-1]])] = True
    slot = {w: slots(w) for w in is_toxic}
    weights, transitions, initial = crf.train(Sparse(np.array([slot[w] for w in words])), labels, starts, SLOTS, rounds=40, rate=0.5)
    model = Model(weights, transitions, initial, np.zeros(3))
    tagger = model.tagger()
    ps = [p for at in range(0, len(docs), 200) for p in tagger.marginals([own for own, _ in docs[at : at + 200]])]
    clean = [p for p, (_, label) in zip(ps, docs) if not label]
    model.background = float(sum(p.sum() for p in clean) / max(1, sum(map(len, clean))))
    x = np.array([measures(p, model.background) for p in ps])
    model.link = crf.logistic(x, np.array([label for _, label in docs], float))
    return model


def scorer(model: Model, threshold: float = 0.5):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = model.tagger()
        for part in slices(batches):
            given = part.column(1).to_pylist()
            ps = tagger.marginals([words_of(text) for text in given])
            spans = []
            for text, p in zip(given, ps):
                hits = set(np.flatnonzero(p >= threshold).tolist())
                places = enumerate(WORD.finditer(text)) if hits else ()
                spans.append([{"start": m.start(), "stop": m.end(), "p": float(p[i])} for i, m in places if i in hits])
            scores = crf.probability(np.array([measures(p, model.background) for p in ps]).reshape(-1, 2), model.link)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores), pa.array(spans, pa.list_(SPAN))], ["row", "score", "spans"])

    return run


def train(docs: DataFrame, labels: DataFrame, rows: int = 9000) -> Model:
    """Learns ``labels.toxic`` from at most ``rows`` labelled documents of at most 20,000 code points that are not held out; the field itself from the first 250 of
    each label."""
    return fit(sample(docs, labels, "toxic", rows))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """row (all columns of ``docs``), score (0 to 1), spans (start and stop in code points of the text, p): one row per row of ``docs``.

    Null and empty texts have no spans and the score of a text without toxic words. Texts are tagged whole, a chain per text, in memory in proportion to
    their own length. Other columns are passed on whatever their names; an empty table gives no rows."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    return rows.mapInArrow(scorer(model), T.StructType([rows.schema["row"], *T.StructType.fromDDL("score double, spans array<struct<start:int,stop:int,p:double>>")]))
