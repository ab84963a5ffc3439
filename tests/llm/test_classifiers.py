import random
import zlib
from itertools import product
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest

from jobsieve.llm import crf, quality, toxicity
from jobsieve.llm.labelled import sample


@pytest.mark.parametrize("lengths", [[1], [3, 1, 2], [5, 6]])
def test_marginals_by_enumeration(lengths, monkeypatch):
    monkeypatch.setattr(crf, "BLOCK", 4)
    rng = np.random.default_rng(len(lengths))
    n = sum(lengths)
    scores, t, first = rng.normal(size=n), rng.normal(size=(2, 2)), rng.normal(size=2)
    starts = np.zeros(n, bool)
    starts[np.cumsum([0, *lengths[:-1]])] = True
    weight = np.zeros((n, 2))
    pairs = np.zeros((2, 2))
    total = 0.0
    for states in product((0, 1), repeat=n):
        w = np.exp(sum(s * x for s, x in zip(states, scores)) + sum(first[s] if b else t[states[i - 1], s] for i, (s, b) in enumerate(zip(states, starts))))
        total += w
        for i, s in enumerate(states):
            weight[i, s] += w
            if not starts[i]:
                pairs[states[i - 1], s] += w
    chains = crf.Chains(scores, starts, t, first)
    assert np.allclose(chains.marginals(), weight[:, 1] / total)
    assert np.allclose(chains.pairs(starts), pairs / total)


def prose(rng, n=60):
    return " ".join("".join(rng.choice(["th", "er", "on", "ing", "ea"]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_toxicity(spark):
    rng = random.Random(7)
    bad = ["loser", "vekuaire", "vekuso", "vekumo", "trash"]
    docs, labels = [], []
    for i in range(240):
        words = prose(rng).split()
        if i % 3 == 0:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 3 == 0)))
    docs += [(1000, None), (1001, ""), (None, "a loser and trash"), (1000, "again"), (1002, "x " * 60000 + "loser vekunew")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as score", "2 as row", "3 as spans")
    model = toxicity.train(df, spark.createDataFrame(labels + [(5, None), (None, 1)], "doc_id bigint, toxic int"))
    found = toxicity.scored(df, model).select("row.doc_id", "row.text", "score", "spans").collect()
    assert len(found) == len(docs)
    by = {r.doc_id: r for r in found if r.doc_id != 1000}
    right = sum((by[i].score >= 0.3) == bool(y) for i, y in labels if toxicity.zlib.crc32(str(i).encode()) % 4 == 2)
    assert right >= 0.95 * sum(toxicity.zlib.crc32(str(i).encode()) % 4 == 2 for i, _ in labels)
    assert by[1001].score < 0.3 and by[1002].score >= 0.3  # an unseen word is caught by its beginning
    assert [by[None].text[s.start : s.stop] for s in by[None].spans] == ["loser", "trash"]
    assert toxicity.scored(df.limit(0), model).collect() == []
    assert toxicity.fit([("a", 0)]).link is not None and toxicity.fit([]).link is not None


def test_quality(spark):
    rng = random.Random(8)
    docs, labels = [], []
    for i in range(300):
        good = i % 3 > 0
        lines = [prose(rng, 30) + "." if good else rng.choice([prose(rng, 12).upper().replace(" ", "!! "), "menu | home | about | login", "buy buy buy buy"]) for _ in range(5)]
        docs.append((i, "\n".join(lines)))
        labels.append((i, int(good)))
    docs += [(1000, None), (1001, " \n"), (None, "x"), (3, "again"), (1002, "Some words here.\n" * 30000)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 as score")
    model = quality.train(df, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    found = quality.scored(df, model).collect()
    assert len(found) == len(docs) and all(0 <= r.score <= 1 for r in found)
    by = {r.doc_id: r.score for r in found if r.doc_id != 3}
    test = [(i, y) for i, y in labels if i != 3 and toxicity.zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((by[i] >= 0.7) == bool(y) for i, y in test) >= 0.95 * len(test)
    assert quality.scored(df.limit(0), model).collect() == [] and quality.fit([]).link is not None


SF_DIR = Path("/root/testdata/sf0.1")


@pytest.fixture(scope="module")
def labelled():
    if not SF_DIR.exists():
        pytest.skip("test tables are not here")
    docs = pq.read_table(SF_DIR / "documents.parquet", columns=["doc_id", "text"]).to_pylist()
    toxic = {r["doc_id"]: r["toxic"] for r in pq.read_table(SF_DIR / "labels.parquet").to_pylist() if r["toxic"] is not None}
    pairs = [(r["doc_id"], r["text"] or "", toxic[r["doc_id"]]) for r in docs if r["doc_id"] in toxic]
    pairs.sort(key=lambda r: zlib.crc32(b"%d" % r[0]) * 2654435761 % 2**32)
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    return [r[1:] for r in pairs if not held(r[0])], [r[1:] for r in pairs if held(r[0])]


def test_false_flags_do_not_depend_on_the_size_of_the_sample(labelled):
    train, test = labelled
    shares = []
    for rows in (640, 6000):
        model = toxicity.fit(train[:rows])
        ps = model.tagger().marginals([toxicity.words_of(text) for text, _ in test])
        flagged = crf.probability(np.array([toxicity.measures(p, model.background) for p in ps]), model.link) >= 0.3
        label, size = np.array([y for _, y in test]), np.array([len(text) for text, _ in test])
        shares.append(flagged[label == 0].mean())
        assert flagged[(label == 0) & (size > 10_000)].mean() < 0.05
        assert flagged[label == 1].mean() > (0.8 if rows == 640 else 0.9)
    assert max(shares) < 0.04 and abs(shares[0] - shares[1]) < 0.02


def test_sample(spark):
    docs = spark.createDataFrame([(i, f"text {i}", i % 10) for i in range(400)] + [(7, "other", 1)] * 50 + [(8, None, 1), (None, "x", 1)], "doc_id bigint, text string, label int")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(400)] + [(7, 1)] * 30 + [(None, 1), (9, None)], "doc_id bigint, toxic int")
    found = sample(docs, labels, "toxic", 1000)
    kept = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert len(found) == len(kept) and sum(y for _, y in found) == sum(i % 10 == 0 for i in kept)
    part = sample(docs, labels, "toxic", 100)
    assert len(part) == 100 and set(part) <= set(found)
    assert sample(docs.limit(0), labels, "toxic", 10) == []


def test_held_out_labels_have_no_influence(spark):
    rng = random.Random(9)
    docs = spark.createDataFrame([(i, prose(rng) + (" loser trash" if i % 3 == 0 else "")) for i in range(90)], "doc_id bigint, text string")
    scores = []
    for turned in (False, True):
        labels = [(i, int(i % 3 == 0) ^ int(turned and zlib.crc32(str(i).encode()) % 4 == 2)) for i in range(90)]
        model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        scores.append(sorted((r.doc_id, r.score) for r in toxicity.scored(docs, model).select("row.doc_id", "score").collect()))
    assert scores[0] == scores[1]


def test_spans_are_places_in_the_text(spark):
    text = "İİ İstanbul LOSER ß trash"
    model = toxicity.fit([("good words here", 0)] * 40 + [(f"a{i} loser trash b{i}", 1) for i in range(40)])
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    spans = toxicity.scored(df, model).first().spans
    assert [text[s.start : s.stop] for s in spans] == ["LOSER", "trash"]


def test_gradient_of_the_field():
    """The likelihood that training climbs is highest near the weights it ends with."""
    rng = np.random.default_rng(2)
    rows = rng.integers(0, 6, (80, 2))
    labels, starts = rng.integers(0, 2, 80), np.zeros(80, bool)
    starts[::8] = True
    found = crf.train(Six(rows), labels, starts, 6, rounds=400, rate=0.05, ridge=1e-3)

    def likelihood(weights, transitions, initial):
        scores, total = weights[rows].sum(axis=1), 0.0
        for at in range(0, 80, 8):
            table = []
            for states in product((0, 1), repeat=8):
                s = np.array(states)
                table.append((scores[at : at + 8] * s).sum() + initial[s[0]] + transitions[s[:-1], s[1:]].sum())
            own = labels[at : at + 8]
            mine = (scores[at : at + 8] * own).sum() + initial[own[0]] + transitions[own[:-1], own[1:]].sum()
            total += mine - np.logaddexp.reduce(table)
        return total / 80 - 1e-3 / 160 * (weights**2).sum()

    best = likelihood(*found)
    for k, part in enumerate(found):
        for at in np.ndindex(part.shape):
            for step in (-0.2, 0.2):
                moved = [p.copy() for p in found]
                moved[k][at] += step
                assert likelihood(*moved) < best + 1e-6


class Six(toxicity.Sparse):
    def gather(self, values):
        return np.bincount(self.rows.ravel(), np.repeat(values, self.rows.shape[1]), 6)
