"""Codes of vectors against plain rounds; the tree against comparing with every entry."""

import hashlib
import math

import numpy as np
import pytest

from jobsieve.llm import vector_codes as V

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, error string"


@pytest.mark.parametrize("scale, seed", [(2, 0), (50, 1), (5000, 2), (1 << 22, 3)])
def test_tree_finds_what_comparing_all_finds(scale, seed):
    rng = np.random.default_rng(seed)
    entries = rng.integers(-scale, scale + 1, (256, 4))
    entries[200:220] = entries[:20]
    queries = np.concatenate([rng.integers(-scale, scale + 1, (500, 4)), entries, (entries[:-1] + entries[1:]) // 2])
    tree = V.Gnat(entries)
    index, apart = tree.nearest(queries)
    full = ((queries[:, None, :] - entries[None]) ** 2).sum(2)
    assert (index == full.argmin(1)).all() and (apart == full.min(1)).all()
    assert tree.compared < full.size


def plain(rows, parts=4, entries=256, rounds=4):
    kept = [(i, [math.floor(1024 * float(x)) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    nearest = lambda v, p: min((apart(cut(v, p), e), i) for i, e in enumerate(books[p]))
    for _ in range(rounds):
        used = [{} for _ in range(parts)]
        for _, v, _ in kept:
            for p in range(parts):
                used[p].setdefault(nearest(v, p)[1], []).append(cut(v, p))
        books = [[[sum(c) // len(own) for c in zip(*own)] if (own := used[p].get(i)) else e for i, e in enumerate(books[p])] for p in range(parts)]
    found = [[nearest(v, p) for p in range(parts)] for _, v, _ in kept]
    errors = [sum(d for d, _ in f) for f in found]
    of = {}
    for (_, _, label), error in zip(kept, errors):
        of[label] = of.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted((str(i), "".join(f"{k:02x}" for _, k in f), e, of[label], sha) for (i, _, label), f, e in zip(kept, found, errors))


def rows_of(df):
    return sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


def test_codes(spark):
    rng = np.random.default_rng(5)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.2, 8)], int(i) % 3 if i % 4 else None) for i in rng.permutation(120)]
    rows += [(500 + i, rows[0][1], 1) for i in range(40)] + [(7, rows[1][1], 2), (None, rows[2][1], None)]
    rows += [(600, None, 1), (601, [float("nan")] * 8, 1), (602, [0.5] * 7 + [None], 1), (603, [float("inf")] * 8, 1)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    assert rows_of(V.coded(df, entries=16)) == plain(rows, entries=16)
    assert rows_of(V.coded(df)) == plain(rows)


def test_odd_tables(spark):
    assert V.coded(spark.createDataFrame([], SCHEMA)).collect() == []
    assert V.coded(spark.createDataFrame([(1, None, 1, "", "")], SCHEMA)).collect() == []
    one = V.coded(spark.createDataFrame([(1, [0.5] * 4, None, "", "")], SCHEMA)).collect()
    assert [(r.code, r.error, r.label_error) for r in one] == [("00000000", 0, 0)]
    for bad in ([[0.5] * 4, [0.5] * 8], [[0.5] * 6], [[1e30] * 4]):
        with pytest.raises(ValueError):
            V.coded(spark.createDataFrame([(i, v, 1, "", "") for i, v in enumerate(bad)], SCHEMA))
