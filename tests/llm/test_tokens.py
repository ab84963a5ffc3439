import random

import public_tokenizers as P
import pytest

from jobsieve.llm import bpe, token_counts

TEXTS = ["", None, "Hello  world's 12345\n\n  x", "<|endoftext|> a<|startoftext|>b", "naïve ÉCOLE ΣΑΣ σας ñ", "  \t ", "日本語テキスト 😀😀", "a" * 3000, "\x1c x\x85y\xa0z", "don't WE'LL é", "=" * 700 + "\r\n\r\n", "Hello  world's 12345\n\n  x"]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)) + [(None, "ab c"), (0, "again")], "doc_id bigint, text string").selectExpr("*", "1 as token_ids", "2 as digest", "3 as content")


def random_texts(n, seed=3):
    rng = random.Random(seed)
    syllables = ["th", "er", "on", "ción", "ñ", "ß", " ", " ", "\n", ".", "1", "'s", "É", "ü", "é", "\t", "zz", "  "]
    return ["".join(rng.choice(syllables) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_counts_match_the_library(spark, tmp_path):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    model = Tokenizer.from_file(path)
    df = frame(spark, TEXTS + random_texts(100))
    expected = sorted((r.doc_id or -1, len((r.text or "").encode()), len(model.encode(r.text or "", add_special_tokens=False).ids)) for r in df.collect())
    cache = str(tmp_path / "cache")
    for _ in range(2):
        found = token_counts.token_counts(df, path, cache).collect()
        assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in found) == expected
        stored = spark.read.parquet(cache).groupBy("digest").count().collect()
        assert {r["count"] for r in stored} == {1}  # nothing is encoded twice, within a run or in the next
    assert token_counts.token_counts(spark.createDataFrame([], "doc_id bigint, text string"), path).collect() == []


def test_a_digest_that_is_stored_twice(spark, tmp_path):
    df = spark.createDataFrame([(1, "some text"), (2, "some text"), (3, "more")], "doc_id bigint, text string")
    path, cache = P.path("word_bpe_49k.json"), str(tmp_path / "cache")
    first = sorted(map(tuple, token_counts.token_counts(df, path, cache).collect()))
    # As if another run had appended the same misses.
    spark.read.parquet(cache).cache().write.mode("append").parquet(cache)
    assert sorted(map(tuple, token_counts.token_counts(df, path, cache).collect())) == first


def test_pieces_model(spark):
    import sentencepiece

    path = P.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    df = frame(spark, TEXTS)
    found = token_counts.token_counts(df, path, content=lambda c: c, by_piece=False).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in found) == sorted((r.doc_id or -1, len(model.encode(r.text or ""))) for r in df.collect())


@pytest.mark.parametrize("name", ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"])
def test_bpe_matches_the_library(spark, name):
    import tiktoken

    path = P.path(name)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    df = frame(spark, TEXTS + random_texts(300))
    for r in bpe.decode(bpe.encode(df.repartition(2), path, P.PATTERN), path).join(df.select("doc_id", "text"), "doc_id").filter("doc_id > 0").collect():
        assert r.token_ids == library.encode_ordinary(r.text or "")
        assert r.decoded == (r.text or "").encode()
    assert bpe.encode(spark.createDataFrame([], "doc_id bigint, text string"), path, P.PATTERN).collect() == []


def test_appends_and_edits():
    vocabulary = bpe.Vocabulary(bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken")))
    rng = random.Random(4)
    data = lambda n: "".join(rng.choice(["th", "er", "ón", "ab", "aa", "x", "ñ", "ing"]) for _ in range(n)).encode()
    for _ in range(40):
        table, text = bpe.Prefixes(vocabulary, data(5)), None
        table.append(more := data(20))
        a = rng.randrange(len(table.data))
        b = rng.randrange(a, min(len(table.data), a + 6) + 1)
        text = table.data[:a] + (new := data(rng.randrange(3))) + table.data[b:]
        table.replace(a, b, new)
        assert (table.data, table.last) == (text, bpe.Prefixes(vocabulary, text).last), more
    long = bpe.Prefixes(vocabulary, b"the thing " * 400)
    assert long.replace(100, 103, b"q") < 600


def test_a_worker_remembers_a_bounded_number_of_pieces():
    from jobsieve.llm import bpe

    pieces = bpe.Bpe({bytes([i]): i for i in range(256)}, r"\S+").pieces
    for start in range(0, 500_000, 25_000):
        found = pieces.learn({f"{i:x}" for i in range(start, start + 25_000)})
        assert found[f"{start:x}"] == b"".join(ord(c).to_bytes(4, "little") for c in f"{start:x}")
        assert len(pieces) + len(pieces.older) <= 300_000


def test_pieces_that_come_again_are_encoded_once():
    made = []
    pieces = bpe.Bpe({bytes([i]): i for i in range(256)}, r"\S+").pieces
    pieces.make = lambda new, whole=pieces.make: made.extend(new) or whole(new)
    often, batches = [f"often{i}" for i in range(10_000)], 40
    for k in range(batches):
        new = [f"{i:x}" for i in range(k * 20_000, (k + 1) * 20_000)]
        got = pieces.values_of([often[:5000] + new, often[5000:]])
        assert len(got[0]) == 25_000 and len(got[1]) == 5000 and got[1][0] == b"".join(ord(c).to_bytes(4, "little") for c in "often5000")
    # In 20,000 new ones each, 10,000 come with every batch.
    assert len(made) < batches * 20_000 + 3 * len(often)
    assert "x" * 500 not in pieces and pieces.values_of([["x" * 500, "y"]])[0][0] == b"x\0\0\0" * 500 and "x" * 500 not in pieces and "y" in pieces


def test_tasks_of_a_worker_share_their_counts(monkeypatch):
    import pyarrow as pa

    seen = []
    monkeypatch.setattr(token_counts, "load_tokenizer", lambda path: lambda batch: seen.extend(batch) or list(map(len, batch)))
    for _ in range(2):
        run = token_counts.encoder("a file of this test", True)
        batches = [pa.record_batch({"digest": ["a", "b"], "content": ["one three", "three " + "long" * 100]})]
        assert [n for b in run(iter(batches)) for n in b.column(1).to_pylist()] == [8, 405]
    assert sorted(seen) == ["long" * 100] * 2 + ["one", "three"]
