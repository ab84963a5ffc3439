"""N-gram CRCs from prefixes against CRCs of the n-grams, and the draw against a plain one."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from jobsieve.llm import importance as I

SCHEMA = "doc_id bigint, text string, rank string, score string, bucket int"


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


TEXTS = ["", "one", "...", "Hello, WORLD a1_b é日本 \x00z", "x" * 95 + " " + "y" * 96 + " " + "z" * 5000 + " end", " a\tb\nc  d " * 40, "İ ß Ⅷ"]


@pytest.mark.parametrize("n", [1, 2, 4])
def test_crcs(n):
    runs, counts = I.ngram_crcs([t.encode() for t in TEXTS], n)
    words = [words_of(t) for t in TEXTS]
    assert counts.tolist() == [len(w) for w in words]
    for k, (owner, crcs) in enumerate(runs, 1):
        want = [(i, zlib.crc32(" ".join(w[a : a + k]).encode())) for i, w in enumerate(words) for a in range(len(w) - k + 1)]
        assert list(zip(owner.tolist(), crcs.tolist())) == want


def test_shift_cancels_any_prefix():
    rng = random.Random(3)
    for length in (0, 1, 95, 96, 97, 1000, 65_537):
        a, b = rng.randbytes(rng.randrange(50)), rng.randbytes(length)
        whole = I.shifted(np.array([zlib.crc32(a)], np.uint32), np.array([length]))[0] ^ zlib.crc32(b)
        assert int(whole) == zlib.crc32(a + b)


def plain(rows, target, buckets, percent, least, seed=7):
    grams = lambda w: w + [f"{a} {b}" for a, b in zip(w, w[1:])]
    own = [[zlib.crc32(g.encode()) % buckets for g in grams(words_of(t))] for _, t in rows]
    aim = [zlib.crc32(g.encode()) % buckets for t in target for g in grams(words_of(t))]
    s, t = [0] * buckets, [0] * buckets
    for b in (b for o in own for b in o):
        s[b] += 1
    for b in aim:
        t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out, able = [], []
    for (i, text), o in zip(rows, own):
        weight = sum(gain[b] for b in o) // len(o) if o else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        if len(words_of(text)) >= least:
            able.append((-score, i is None, i or 0, len(out)))
        out.append([i, len(o), weight, score, None])
    for rank, (*_, at) in enumerate(sorted(able)[: percent * len(able) // 100], 1):
        out[at][4] = rank
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("buckets, percent", [(10_000, 25), (7, 60)])
def test_draw(spark, buckets, percent):
    rng = random.Random(11)
    vocabulary = ["Alpha", "beta", "gämma", "delta9", "x", "y", "z"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(40)))) for i in range(150)]
    rows += [(200, "beta " * 30), (200, "beta " * 30), (None, "alpha " * 25), (300, None), (301, ""), (302, "y " * 20_000)]
    target = ["beta beta x", "Alpha, y!", ""]
    docs = spark.createDataFrame([(*r, "r", "s", 1) for r in rows], SCHEMA).repartition(4)
    aim = spark.createDataFrame([(t,) for t in [*target, None]], "text string")
    found = I.resampled(docs, aim, percent, buckets=buckets, min_words=5).collect()
    assert sorted(map(tuple, found), key=str) == plain(rows, target, buckets, percent, 5)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "text string")
    assert I.resampled(spark.createDataFrame([], SCHEMA), none).collect() == []
    one = I.resampled(spark.createDataFrame([(1, "a " * 30, "", "", 0)], SCHEMA), none, percent=100).collect()
    assert [(r.n_features, r.rank) for r in one] == [(59, 1)]
