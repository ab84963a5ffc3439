import io
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobsieve.llm import lm_scoring

A, B = lm_scoring.PRIOR


def plain(rows):
    """rows of (text, in training) to (n_tokens, n_known, N, base score, score) by dictionaries."""
    texts = [["<", "<", *"".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split(), ">"] for text, _ in rows]
    counts = Counter()
    for own, (_, train) in zip(texts, rows):
        if train:
            for i in range(2, len(own)):
                counts.update([tuple(own[i : i + 1]), tuple(own[i - 1 : i + 1]), tuple(own[i - 2 : i + 1]), ("after", own[i - 1]), ("after", own[i - 2], own[i - 1])])
    words = [c for k, c in counts.items() if len(k) == 1]
    for own in texts:
        base = score = 0.0
        for i in range(2, len(own)):
            p = p1 = (counts[(own[i],)] + 1) / (sum(words) + len(words) + 1)
            p = (counts[tuple(own[i - 1 : i + 1])] + A * p) / (counts["after", own[i - 1]] + A)
            p = (counts[tuple(own[i - 2 : i + 1])] + B * p) / (counts["after", own[i - 2], own[i - 1]] + B)
            base, score = base + math.log10(p1), score + math.log10(p)
        yield len(own) - 2, sum(counts[(w,)] > 0 for w in own[2:]), sum(words), base, score


def rows_of(seed, n=60):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(["a", "B", "b", "the", "É", "c\x1cd", "\tx"]) for _ in range(rng.randrange(40))) for _ in range(n)]
    return [(t, rng.random() < 0.7) for t in [None, "", " \n", "only here once", "the " * 3000, *texts, texts[0]]]


@pytest.mark.parametrize("hot, chunk, shard", [(1 << 16, 3 << 20, 1 << 19), (3, 500, 64)])
def test_against_dictionaries(spark, monkeypatch, hot, chunk, shard):
    monkeypatch.setattr(lm_scoring, "HOT", hot)
    rows = rows_of(5)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "doc_id bigint, text string, own boolean").selectExpr("*", "1 as train", "2 as tokens").repartition(3)
    found = {r.doc_id: r for r in lm_scoring.scored(df, F.col("own"), chunk, shard).collect()}
    assert len(found) == len(rows)
    for i, (n, known, total, base, score) in enumerate(plain(rows)):
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-3)


def test_empty_table_and_ids(spark):
    schema = "doc_id bigint, text string"
    assert lm_scoring.scored(spark.createDataFrame([], schema), F.lit(True)).collect() == []
    odd = spark.createDataFrame([(None, "a b"), (1, "a"), (1, "a")], schema)
    assert sorted((r.doc_id or 0, r.n_tokens) for r in lm_scoring.scored(odd, F.lit(None).cast("boolean")).collect()) == [(0, 3), (1, 2), (1, 2)]


def test_monotone_sequences():
    rng = np.random.default_rng(1)
    for n, top in ((0, 1), (1, 1), (5, 3), (1000, 100), (1000, 2000), (5000, 1 << 18), (1000, 1 << 63), (1000, (1 << 64) - 1)):
        values = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        file = io.BytesIO(b"")
        packed = lm_scoring.EliasFano(values, file)
        mapped = np.frombuffer(file.getvalue(), np.uint8)
        assert (packed.values(mapped) == values).all()
        if n:
            asked = np.concatenate([values, values + np.uint64(1), np.maximum(values, 1) - np.uint64(1), rng.integers(0, top, 500, dtype=np.uint64), np.array([0, (1 << 64) - 1], np.uint64)])
            assert (packed.next_at_least(mapped, asked) == np.searchsorted(values, asked)).all()
            place, there = packed.place(mapped, asked)
            assert (there == np.isin(asked, values)).all() and (values[place[there]] == asked[there]).all()
            shuffled = rng.permutation(n)
            assert (packed.get(mapped, shuffled) == values[shuffled]).all()
    assert len(file.getvalue()) < 9 * n


def test_a_level_in_its_packed_form():
    rng = np.random.default_rng(3)
    context, token = rng.integers(1, 1 << 60, 300, dtype=np.uint64), rng.integers(1, 1 << 24, 200, dtype=np.uint64)
    pairs = np.unique(rng.integers(0, 300 * 200, 5000))
    share = rng.uniform(1e-4, 1, len(pairs))
    level = lm_scoring.Level(context[pairs // 200], token[pairs % 200], share)
    every = np.arange(300 * 200)
    codes = level.find(np.append(context[every // 200], np.uint64(7)), np.append(token[every % 200], token[0]))
    level.close()
    assert codes[-1] == lm_scoring.ABSENT
    assert ((codes[:-1] != lm_scoring.ABSENT) == np.isin(every, pairs)).all()
    assert (codes[pairs] == lm_scoring.quantised(share)).all()


def test_ngrams_travel_as_differences():
    rng = np.random.default_rng(4)
    for n, top in ((1, 3), (50, 2), (3000, 60), (500, (1 << 64) - 1)):
        columns = rng.integers(0, top, (3, n), dtype=np.uint64)
        for own in (columns, columns[:, np.lexsort(columns[::-1])]):
            starts = lm_scoring.starts_of([1, n - 1] if n > 1 else [1])
            assert all((a == b).all() for a, b in zip(lm_scoring.absolute(*lm_scoring.relative(*own, starts), starts), own))
    # Sorted ones cost far less than as they are.
    size = lambda parts: sum(len(lm_scoring.packed(p)) for p in parts)
    columns = np.stack([rng.integers(0, top, 3000, dtype=np.uint64) for top in (1 << 20, 4, 256)])
    columns = np.ascontiguousarray(columns[:, np.lexsort(columns[::-1])])
    assert size(lm_scoring.relative(*columns, lm_scoring.starts_of([3000]))) < 0.9 * size(columns)


def test_ngrams_of_a_chunk_are_sorted():
    rng = np.random.default_rng(6)
    words = np.append(lm_scoring.MARKS, rng.integers(3, 1 << 63, 40, dtype=np.uint64))
    tokens = np.append(rng.integers(2, 42, 300), lm_scoring.END).astype(np.uint32)
    row = {"chunk_id": 0, "doc_ids": [1], "train": [True], "ends": [len(tokens)], "words": words.tobytes(), "tokens": tokens.tobytes()}
    sent = lm_scoring.Chunk(row, 0).sent[0]
    assert not sent[1].any() and not sent[2].any()  # a word alone is told once
    order = rng.permutation(len(sent[0]))
    told = {"shard": 0, "answer": lm_scoring.packed(sent[3].astype(np.int64)), "numbers": lm_scoring.packed((order + 1).astype(np.uint64))}
    chunk = lm_scoring.Chunk(row | {"told0": [told]}, 0)
    number = dict(zip(sent[0].tolist(), (order + 1).tolist()))
    assert chunk.numbers[chunk.tokens].tolist() == [number[words[t]] for t in tokens.tolist()]
    first, _, token = (c.tolist() for c in chunk.sent[1][:3])
    assert list(zip(first, token)) == sorted(zip(first, token)) and first[0] == 0


def test_shards_are_not_doubled_by_a_few_tokens():
    assert [lm_scoring.shard_bits(n, 1 << 20) for n in (0, 1 << 20, (1 << 27) - 9, (1 << 27) + 9, 3 << 26)] == [0, 0, 7, 7, 8]


def test_answers_are_dealt_to_their_chunks_once(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows_of(7))], "doc_id bigint, text string").repartition(3)
    scored = lm_scoring.scored(df, F.lit(True), 500, 64)
    assert "Exchange hashpartitioning" not in scored._jdf.queryExecution().executedPlan().toString()


def test_ranks():
    for values in ([], [4], [1, 1, 2, 7, 7], [7, 1, 2, 1, 7]):
        distinct, which = lm_scoring.ranked(np.array(values, np.uint64))
        assert distinct.tolist() == sorted(set(values)) and distinct[which].tolist() == values


def test_place_beside_values_with_the_same_high_part():
    values = np.array([0, 5, 5, 6, 900, 901, 1 << 20], np.uint64)
    file = io.BytesIO(b"")
    packed = lm_scoring.EliasFano(values, file)
    mapped = np.frombuffer(file.getvalue(), np.uint8)
    asked = np.array([0, 1, 4, 5, 6, 7, 899, 901, 902, 1 << 20, (1 << 20) + 1, 1 << 40], np.uint64)
    place, there = packed.place(mapped, asked)
    assert there.tolist() == np.isin(asked, values).tolist() and (values[place[there]] == asked[there]).all()
    assert packed.next_at_least(mapped, asked).tolist() == np.searchsorted(values, asked).tolist()
