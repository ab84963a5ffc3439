"""Hilbert order and the shards cut from it."""

import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from jobsieve.llm import hilbert_sharding as H

SCHEMA = "doc_id bigint, text string, lang string, source string, shard string, slot int, curve double"


@pytest.mark.parametrize("dims, bits", [(1, 3), (2, 3), (3, 3), (4, 2)])
def test_curve_visits_every_cell_in_steps_of_one(spark, dims, bits):
    cells = [(list(c),) for c in itertools.product(range(1 << bits), repeat=dims)]
    rows = spark.createDataFrame(cells, "c array<int>").withColumn("i", H.hilbert_index(F.col("c"), dims, bits)).orderBy("i").collect()
    assert [r.i for r in rows] == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(x.c, y.c)) == 1 for x, y in zip(rows, rows[1:]))


def documents(spark, n, seed=1):
    rng = random.Random(seed)
    hot = lambda i: "hot" if i % 3 == 0 else f"s{rng.randrange(9)}"
    rows = [(i, "é" * rng.randrange(300), rng.choice(["de", "en", None]), hot(i), "x", 5, 0.5) for i in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("slice_rows", [3, 100_000])
def test_shards_hold_runs_of_the_curve(spark, slice_rows):
    rows, df = documents(spark, 500)
    found = H.placed(df, 24, slice_rows=slice_rows).collect()
    assert sorted(r.doc_id for r in found) == list(range(500))
    assert sorted(r.place for r in found) == list(range(500))
    for r in found:
        text = rows[r.doc_id][1].encode()
        assert (r.size, r.text_crc32) == (len(text) + 8, zlib.crc32(text))
    ordered = sorted(found, key=lambda r: r.place)
    assert [r.curve for r in ordered] == sorted(r.curve for r in found)
    counts = [sum(r.shard == s for r in found) for s in range(24)]
    assert max(counts) - min(counts) <= 1
    assert [(r.shard, r.slot) for r in ordered] == [(s, i) for s in range(24) for i in range(counts[s])]
    # The order does not depend on how cells are sliced.
    assert {r.doc_id: r.place for r in H.placed(df, 24).collect()} == {r.doc_id: r.place for r in found}


def test_pruning_beats_the_order_of_ids(spark):
    rows, df = documents(spark, 2000)
    shards = H.manifest(H.placed(df, 20)).collect()
    read = sum(s.min_source <= "s4" <= s.max_source for s in shards)
    assert read <= 12 and sum(s.n_rows for s in shards) == 2000


def test_odd_rows(spark):
    rows = [(None, None, None, None, "x", 1, 0.0), (None, "a", None, "", "x", 1, 0.0), (3, "", "en", "s", "x", 1, 0.0), (3, "", "en", "s", "x", 1, 0.0), (4, "w " * 50_000, "en", "s", "y", 1, 0.0)]
    found = H.placed(spark.createDataFrame(rows, SCHEMA), 24).collect()
    assert sorted(r.size for r in found) == [8, 8, 8, 9, 100_008]
    assert sorted(r.place for r in found) == list(range(5))
    assert all(r.slot == 0 for r in found)
    assert H.placed(spark.createDataFrame([], SCHEMA), 24).collect() == []
    only = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "doc_id int, text string")
    assert sorted(r.shard for r in H.placed(only, 2).collect()) == [0, 0, 1]


def test_written_shards(spark, tmp_path):
    rows, df = documents(spark, 200)
    shards = H.write_shards(df, str(tmp_path / "out"), 8).collect()
    assert sum(s.n_rows for s in shards) == 200 and len(shards) == 8
    found = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in found.collect()) == list(range(200))
    assert set(df.columns) <= set(found.columns)


def test_the_plan_does_not_hold_a_step_twice(spark):
    plan = H.placed(documents(spark, 50)[1], 24)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 5 and plan.count("Aggregate") == 0
