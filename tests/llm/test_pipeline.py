import re
from pathlib import Path

import public_tokenizers as P
import pytest
import xxhash

import corpus_pipeline as C
from jobsieve.llm import bpe, decontamination

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="test tables are not here")


def test_stages_on_planted_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    item = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").orderBy("item_id").first().text
    base = docs.orderBy("doc_id").filter("length(text) > 2000").first().text
    planted = [(10001, base + " "), (10002, " ".join([*base.split()[:-1], "changed"])), (10003, f"before that {item} and then"), (10004, None), (10005, ""), (10001, base + " "), (None, "no id")]
    extra = spark.createDataFrame(planted, "doc_id bigint, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True).selectExpr("*", "doc_id as row", "1 as matches", "2 as keep_id", "3 as `a b`")
    kept = {"documents": docs}
    rows = docs
    for number, (name, stage) in enumerate(C.STAGES):
        out = stage(spark, rows, str(SF_DIR))
        if number < 4:
            assert out.schema.simpleString() == docs.schema.simpleString(), name
        out.write.parquet(str(tmp_path / str(number)))
        rows = kept[name] = spark.read.parquet(str(tmp_path / str(number)))
    ids = {name: [r.doc_id for r in df.select("doc_id").collect()] for name, df in kept.items()}
    assert set(ids["exact dedup"]) & {10001}
    assert len(set(ids["exact dedup"]) & {10004, 10005}) == 1 and None in ids["exact dedup"]
    texts = [r.text for r in kept["exact dedup"].collect()]
    squeezed = ["".join((t or "").split()) for t in texts]
    assert len(squeezed) == len(set(squeezed))
    assert not {10001, 10002} <= set(ids["near dedup"])
    assert 10003 in ids["near dedup"] and 10003 not in ids["decontamination"]
    gone = set(ids["near dedup"]) - set(ids["decontamination"])
    items = [decontamination.normal(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    clean = {r.doc_id: decontamination.normal(r.text) for r in kept["near dedup"].collect()}
    assert {i for i, t in clean.items() if any(x in t for x in items)} <= gone
    assert sorted(ids["encoding"], key=str) == sorted(ids["decontamination"], key=str)
    vocabulary = {v: k for k, v in bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")).items()}
    text_of = [(str(r.doc_id), r.text or "") for r in kept["decontamination"].collect()]
    assert sorted((str(r.doc_id), b"".join(vocabulary[i] for i in r.token_ids).decode()) for r in kept["encoding"].collect()) == sorted(text_of)
    # The two stages that choose one of each group, against plain versions.
    first = {}
    for r in kept["toxicity"].collect():
        text = r.text or ""
        rank = (-len(text), r.doc_id is None, r.doc_id or 0)
        key = text.translate({ord(c): None for c in " \t\n\x0b\x0c\r"})
        first[key] = min(first.get(key, rank), rank)
    assert sorted(str(r[2] if not r[1] else None) for r in first.values()) == sorted(map(str, ids["exact dedup"]))
    assert sorted(plain_near([(r.doc_id, r.text) for r in kept["exact dedup"].collect()]), key=str) == sorted(ids["near dedup"], key=str)


def plain_near(rows):
    """The smallest id of every group of fingerprints that are linked by three bits or fewer."""
    prints = []
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints.append((sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)), (doc_id is None, doc_id or 0)))
    group = list(range(len(prints)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, (a, _) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][0]).bit_count() <= 3:
                group[top(i)] = top(j)
    best = {}
    for i, (_, rank) in enumerate(prints):
        best[top(i)] = min(best.get(top(i), rank), rank)
    return [None if none else doc_id for none, doc_id in best.values()]


def test_repeated_and_missing_ids(spark):
    rows = [(1, "alpha text"), (1, "totally other words"), (None, "no id one"), (None, "another without"), (2, "alpha text"), (2, " alpha  text"), (3, None), (3, ""), (1, "alpha text")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(1)
    exact = C.exact(spark, docs, str(SF_DIR)).collect()
    key = lambda r: (str(r[0]), str(r[1]))
    kept = sorted(map(tuple, exact), key=key)
    assert [r for r in kept if r[0] != 3] == sorted([(1, "totally other words"), (2, " alpha  text"), (None, "another without"), (None, "no id one")], key=key)
    assert len(kept) == 5
    assert len(C.near(spark, docs, str(SF_DIR)).collect()) == 5


def test_empty(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        assert stage(spark, docs, str(SF_DIR)).collect() == []


def test_a_task_of_the_encoding_holds_one_python_worker(spark):
    out = C.encode(spark, spark.createDataFrame([(1, "some words"), (2, None), (None, "")], "doc_id bigint, text string"), str(SF_DIR))
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sorted((str(r.doc_id), r.n_tokens > 0) for r in out.collect()) == [("1", True), ("2", False), ("None", False)]
