"""Token counts through a digest cache.

The cache is a table (digest, tokenizer, n_tokens) on shared files. Documents are joined to it by the digest of their normalised
content and the digest of the tokenizer's file; only contents that it lacks are encoded, each once, and appended."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsieve.llm.common import Remembered, per_worker, shared_folder, slices, texts, written

CACHE_SCHEMA = "digest string, tokenizer string, n_tokens bigint"


def same_content(text: Column) -> Column:
    """Runs of ASCII white space become one space and vanish at the ends: tokenizers that drop white space see no difference."""
    return F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))


def file_digest(path: str) -> str:
    with open(path, "rb") as file:
        return hashlib.file_digest(file, "sha256").hexdigest()


def load_tokenizer(path: str) -> Callable[[list[str]], list[int]]:
    """Texts to their numbers of tokens."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda batch: [len(ids) for ids in model.encode(batch, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(path)
    model.no_truncation()
    model.no_padding()
    return lambda batch: [len(e.ids) for e in model.encode_batch_fast(batch, add_special_tokens=False)]


def encoder(path: str, by_piece: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A worker's later tasks find the tokenizer and the pieces of its earlier ones.
        count = per_worker(("token counts", path), lambda: load_tokenizer(path))
        pieces = per_worker(("token counts by piece", path), lambda: Remembered(count))
        total = (lambda texts: list(map(sum, pieces.values_of([text.split(" ") for text in texts])))) if by_piece else count
        for part in slices(batches, 200, 1 << 20):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total(part.column(1).to_pylist()), pa.int64())], ["digest", "n_tokens"])

    return run


def read_cache(spark, path: str) -> DataFrame:
    try:
        return spark.read.schema(CACHE_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], CACHE_SCHEMA)
        raise


def stored(spark, path: str, version: str) -> DataFrame:
    """(digest, n_tokens) of one tokenizer. Two runs at a time may append the same digest; its counts are equal, and one is taken."""
    return read_cache(spark, path).filter(F.col("tokenizer") == version).groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: str, cache: str | None = None, content: Callable[[Column], Column] = same_content, by_piece: bool = True) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_tokens.

    ``tokenizer`` is a file of the tokenizers (.json) or sentencepiece (.model) library that all machines have. ``cache`` is the
    table to use and extend (none: a new one below the shared folder). ``content`` must map texts to the same value only if their counts are
    equal. With ``by_piece`` a text's count is the sum over its pieces between spaces, which needs a tokenizer that splits there
    and drops white space; otherwise whole texts go to the library, whatever the tokenizer.
    Null text counts as empty (0 tokens); null and repeated doc_ids keep their rows; an empty table gives none. Other columns are not read."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "token-counts")
    cache, version = cache or f"{folder}/cache", file_digest(tokenizer)
    rows = texts(docs).withColumn("content", content(F.col("text"))).withColumn("digest", F.sha2("content", 256))
    keys = written(rows.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "digest"), f"{folder}/keys")
    known = stored(spark, cache, version)
    wanted = keys.groupBy("digest").agg(F.min("doc_id").alias("first_id")).join(known, "digest", "left_anti")
    first = rows.withColumnRenamed("digest", "own").join(
        wanted, (F.col("own") == F.col("digest")) & F.col("doc_id").eqNullSafe(F.col("first_id")), "left_semi"
    ).select(F.col("own").alias("digest"), "content")
    # A document may come twice; its content then has two equal counts.
    counted = first.mapInArrow(encoder(tokenizer, by_piece), "digest string, n_tokens bigint")
    counted = counted.groupBy("digest").agg(F.first("n_tokens").alias("n_tokens"))
    counted.select("digest", F.lit(version).alias("tokenizer"), "n_tokens").write.mode("append").parquet(cache)
    return keys.join(stored(spark, cache, version), "digest").select("doc_id", "n_bytes", "n_tokens")
