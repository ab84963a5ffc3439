import random
import re

import xxhash

from jobsieve.llm import simhash_near_dedup as S


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << b for b in range(64) if counts[b] * 2 > len(shingles))


def brute(fps):
    """fps: (doc_id, fingerprint) rows to their components."""
    left, out = dict(enumerate(fps)), {}
    while left:
        stack, group = [left.popitem()], []
        while stack:
            _, (i, f) = stack.pop()
            group.append((i, f))
            for k in [k for k, (_, g) in left.items() if (f ^ g).bit_count() <= 3]:
                stack.append((k, left.pop(k)))
        least = min((i for i, _ in group if i is not None), default=None)
        for i, f in group:
            out[(i, f"{f:016x}")] = least
    return out


def test_fingerprints_and_groups(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["", None, "one", "One  two", "A b\tc", "x y z É w " * 40])) for i in range(20)] + [(None, "lone words here now"), (7, "again Here")]
    for i in range(60):
        words = [rng.choice(["aa", "Bb", "cé", "d"]) + str(rng.randrange(300)) for _ in range(120)]
        for copy in range(3):
            rows.append((100 + 3 * i + copy, " ".join(words)))
            words[rng.randrange(120)] = "changed"
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 as fp", "2 as root")
    expected = brute([(i, slow_fingerprint(t)) for i, t in rows])
    for size in (256, 2):
        found = S.near_groups(df.repartition(3), group_size=size).collect()
        assert len(found) == len(rows)
        assert {(r.doc_id, r.fingerprint): r.component_id for r in found} == expected
    assert S.near_groups(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_crowded_keys_lose_no_link(spark):
    rng = random.Random(6)
    base, fps = rng.getrandbits(64), set()
    for _ in range(900):
        f = base
        for _ in range(rng.randrange(9)):
            f ^= 1 << rng.randrange(64)
        fps.add(f)
    fps = list(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    spans = S.segments(3)
    keys = spark.createDataFrame([(f,) for f in signed], "fp bigint").mapInArrow(S.expander(spans), "variant smallint, masked bigint, fp bigint")
    links = keys.repartition("variant", "masked").sortWithinPartitions("variant", "masked").mapInArrow(S.linker(spans, 3, 16), "a bigint, b bigint").collect()
    parent = {f: f for f in signed}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        assert bin((r.a ^ r.b) & (2**64 - 1)).count("1") <= 3
        parent[root(r.a)] = root(r.b)
    groups = brute(list(enumerate(fps)))
    assert len({root(f) for f in signed}) == len(set(groups.values()))
