import random

import numpy as np
import pyarrow as pa

from jobsieve.llm import suffix_dedup as S


def brute(rows, length=50):
    data = [(i, (t or "").encode()) for i, t in rows]
    key = lambda i: S.LAST if i is None else i
    least = {}
    for i, t in data:
        for a in range(len(t) - length + 1):
            s = t[a : a + length]
            least[s] = min(key(i), least.get(s, S.LAST))
    out = []
    for i, t in data:
        gone = [False] * len(t)
        for a in range(len(t) - length + 1):
            if least[t[a : a + length]] < key(i):
                gone[a : a + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, bytes(b for b, g in zip(t, gone) if not g)))
    return sorted(out, key=str)


def test_suffixes_in_order():
    rng = random.Random(10)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 30))).encode() for _ in range(40)]
    size = np.array([len(t) for t in texts])
    text, length, common = S.column_wise(np.frombuffer(b"".join(texts), np.uint8), np.cumsum(size) - size, size, 200)
    suffixes = [texts[t][len(texts[t]) - n :] for t, n in zip(text.tolist(), length.tolist())]
    assert len(suffixes) == sum(size) + len(texts)
    assert [(s, t) for s, t in zip(suffixes, text.tolist())] == sorted(zip(suffixes, text.tolist()))
    shared = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert common[1:].tolist() == [shared(a, b) for a, b in zip(suffixes, suffixes[1:])]


def test_against_brute_force(spark):
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abcdeé") for _ in range(n))
    passages = [word(n) for n in (49, 50, 51, 80, 200)] + ["a" * 130, "ab" * 90]
    rows = [(i, word(rng.randrange(60)) + "".join(rng.choice(passages) + word(rng.randrange(3)) for _ in range(rng.randrange(4))) + word(rng.randrange(60))) for i in range(80)]
    rows += [(200, rows[3][1]), (201, rows[3][1]), (202, None), (203, ""), (None, rows[5][1]), (5, rows[7][1]), (3, rows[3][1]), (204, "x" * 20000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as chunk_id", "2 as kept", "3 as told")
    found = [tuple(r[:4]) + (bytes(r.kept),) for r in S.without_repeats(df.repartition(3), chunk_bytes=2000, bucket_bytes=500).collect()]
    assert sorted(found, key=str) == brute(rows)
    assert S.without_repeats(df.limit(0)).collect() == []


def test_only_keys_with_several_texts_are_a_collection(monkeypatch):
    seen, whole = [], S.column_wise
    monkeypatch.setattr(S, "column_wise", lambda data, begin, size, depth: seen.append(len(size)) or whole(data, begin, size, depth))
    docs, text = np.array([7, 3]), b"q" * 81
    which, best = S.smallest_documents(np.frombuffer(text * 2, np.uint8), np.array([0, 81]), np.array([81, 81]), docs, np.uint32([5, 5]), 50)
    assert which.tolist() == [0, 0] and (best == 3).all() and seen == []


def test_removed_starts_travel_as_runs():
    text, near = b"q" * 30 + b"r" * 51, b"q" * 30 + b"r" * 50 + b"s"
    rows = [
        {"chunk_id": c, "first": np.uint32([100]).tobytes(), "doc_ids": np.int64([d]).tobytes(), "starts": np.uint8([32]).tobytes(), "key": np.uint32([5]).tobytes(), "data": t}
        for c, d, t in ((0, 7, text), (1, 3, text), (2, 9, near))
    ]
    found = S.judge(50)(pa.Table.from_pylist(rows)).to_pylist()
    runs = {r["chunk_id"]: (np.frombuffer(r["first"], np.uint32).tolist(), np.frombuffer(r["count"], np.uint8).tolist()) for r in found}
    assert runs == {0: ([100], [32]), 2: ([100], [31])}


def test_keys_travel_in_few_bytes():
    rng = np.random.default_rng(5)
    for n, top in ((1, 5), (10, 3), (4000, 1 << 38), (100, (1 << 64) - 1)):
        keys = np.sort(rng.integers(0, top, n, dtype=np.uint64))
        assert (S.unpacked(S.packed(keys)) == keys).all()
    assert len(S.packed(np.sort(rng.integers(0, 1 << S.kept_bits(1 << 27), 100_000, dtype=np.uint64)))) < 400_000
    assert S.kept_bits(0) == 8 and S.kept_bits(1 << 62) == 64
