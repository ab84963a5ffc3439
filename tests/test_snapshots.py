"""Deliveries merged into the snapshot table."""

import random
from pathlib import Path

from jobsieve.sources import snapshots as S


def state(folder: Path):
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in folder.glob("part=*")}


def expected(deliveries):
    best = {}
    for number, rows in enumerate(deliveries):
        for url, render_pass, final, html, body, ok in rows:
            key = (url.strip().rstrip("/"), render_pass or 0)
            rank = (-number, not ok, url != key[0], url)
            if key not in best or rank < best[key][0]:
                best[key] = (rank, html)
    return {k: html for k, (_, html) in best.items()}


def test_deliveries(spark, tmp_path):
    rng = random.Random(4)
    store = str(tmp_path / "store")

    def delivery(number, sites):
        rows = []
        for i in sites:
            for variant in rng.sample(["", "/", "//", " "], 3):
                rows.append((f"https://x.com/{i}{variant}", rng.choice([0, 1, None]), None, f"{number} {i} {variant!r}", None, rng.random() < 0.7))
        return rows

    deliveries = [delivery(0, range(60)), delivery(1, [3, 4, 61]), delivery(2, [3])]
    assert S.read_store(spark, store).count() == 0
    before = {}
    for number, rows in enumerate(deliveries):
        df = spark.createDataFrame(rows, S.SNAPSHOT_SCHEMA).repartition(3)
        touched = S.merge(spark, store, df, number, parts=16)
        after = state(Path(store))
        untouched = {name for name in before if int(name.split("=")[1]) not in touched}
        assert all(after[name] == before[name] for name in untouched)
        assert number == 0 or untouched
        got = {(r.url, r.render_pass): r.html for r in S.read_store(spark, store).collect()}
        want = expected(deliveries[: number + 1])
        assert set(got) == set(want)
        # Ties among equal ranks go by content; all others are decided.
        assert all(got[k].split(" ")[0] == want[k].split(" ")[0] for k in want)
        before = after
    again = S.merge(spark, store, spark.createDataFrame(deliveries[2], S.SNAPSHOT_SCHEMA), 2, parts=16)
    assert again and {(r.url, r.render_pass): r.html for r in S.read_store(spark, store).collect()} == got


def test_an_empty_delivery_changes_nothing(spark, tmp_path):
    store = str(tmp_path / "store")
    assert S.merge(spark, store, spark.createDataFrame([], S.SNAPSHOT_SCHEMA), 0) == []
    assert S.read_store(spark, store).count() == 0
