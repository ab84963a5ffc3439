import random

from jobsieve.llm import exact_dedup as X


def brute(rows):
    norm = lambda t: "".join(c for c in (t or "") if c not in " \t\n\x0b\x0c\r")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append((-len(t or ""), i is None, i))
    best = {k: (sorted(v, key=lambda x: (x[0], x[1], x[2] or 0))[0][2], len(v)) for k, v in groups.items()}
    return sorted(((i, *best[norm(t)], i == best[norm(t)][0]) for i, t in rows), key=str)


def found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect()), key=str)


def test_groups_colliding_keys_and_splits(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a b", "ab", " a\tb", "", None, "é x", "x" * 9000, f"t{rng.randrange(60)}"])) for i in range(400)] + [(None, "ab"), (3, "a b")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("doc_id", "text", "1 as entry_id", "2 as norm", "3 as key")
    weak = lambda data: len(data) % 3 << 60  # noqa: E731  many texts share a key
    expected = brute(rows)
    assert found(X.exact_groups(df.repartition(3))) == expected
    assert found(X.exact_groups(df.repartition(3), capacity=2, page_bytes=500)) == expected
    assert found(X.exact_groups(df.repartition(5), capacity=1, key_of=weak)) == expected


def test_directory_covers_all_slots(spark):
    keys = spark.range(3000).selectExpr("xxhash64(id) as key")
    directory, depth = X.build_directory(keys, 10)
    rows = directory.collect()
    assert len({r.slot for r in rows}) == len(rows) <= 2**depth
    per = keys.join(directory, X.prefix(depth) == directory.slot).groupBy("bucket").count().collect()
    assert sum(r["count"] for r in per) == 3000 and max(r["count"] for r in per) <= 10


def test_empty(spark):
    assert X.exact_groups(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
