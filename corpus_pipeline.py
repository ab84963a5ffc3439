"""A training corpus from ``documents``, as stages that each work on what the stage before has kept.

All stages but the last return the columns of documents, whatever these are; the last returns the token ids. Every row is a document of its own: stages decide by the
place of a row in their input, which ``run`` reads from files, so rows without an id or with a repeated one are neither mixed up nor lost."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsieve.llm import bpe, decontamination, exact_dedup, simhash_near_dedup
from jobsieve.llm import toxicity as tox
from jobsieve.llm.common import shared_folder, table, written

TOXIC = 0.3


ROW = "__place__"


def placed(docs: DataFrame) -> DataFrame:
    """Rows with their place in the files that ``docs`` is read from."""
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def one_of_each(rows: DataFrame, classes: DataFrame, *order: Column) -> DataFrame:
    """The first row by ``order``, then by place, of every class; ``classes`` has (place, class)."""
    ranked = rows.select(ROW, F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col(ROW).alias("place")).alias("rank"))
    winners = ranked.join(classes.toDF(ROW, "class"), ROW).groupBy("class").agg(F.min("rank").alias("best"))
    return rows.join(winners.select(F.col("best.place").alias(ROW)), ROW, "left_semi").drop(ROW)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score 0.3 or more. Null and empty texts stay, repeated rows share their score, long texts are judged whole; an empty table stays one."""
    model = tox.train(docs, table(spark, sf_dir, "labels"))
    return tox.scored(docs, model).filter(F.col("score") < TOXIC).select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the longest of documents with equal texts, then the one with the smallest id (none comes last), then the first.

    Null texts equal empty ones; repeated rows are copies; rows with one id and different texts all stay; an empty table stays one."""
    rows = placed(docs)
    groups = exact_dedup.exact_groups(rows.select(F.col(ROW).alias("doc_id"), "text"))
    points = F.char_length(F.coalesce("text", F.lit("")))
    return one_of_each(rows, groups.select("doc_id", "keep_id"), -points, F.col("doc_id").isNull(), F.col("doc_id"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id (none comes last), then the first, of every group of linked fingerprints.

    Texts without words share a fingerprint and are a group; repeated rows are linked; an empty table stays one."""
    rows = placed(docs)
    groups = simhash_near_dedup.near_groups(rows.select(F.col(ROW).alias("doc_id"), "text"))
    return one_of_each(rows, groups.select("doc_id", "component_id"), F.col("doc_id").isNull(), F.col("doc_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which an item of the benchmark occurs. Null and empty texts stay, texts are searched whole, rows are judged each on its own."""
    found = decontamination.with_matches(docs, table(spark, sf_dir, "benchmark"))
    return found.filter(F.size("matches") == 0).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, token_ids, and the digest of the bytes that they decode to: one row per row; null counts as empty and has no tokens.

    The ids are written before they are decoded: in one stage every task would hold two Python workers, and each of them comes to keep the tables of both steps."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = written(bpe.encode(docs, path, public_tokenizers.PATTERN), f"{shared_folder(spark, 'encoded')}/ids")
    decoded = bpe.decode(encoded, path)
    return decoded.select("doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"), "token_ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [("toxicity", toxicity), ("exact dedup", exact), ("near dedup", near), ("decontamination", decontaminate), ("encoding", encode)]
#: Learned weights and fingerprints have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "corpus")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{number}")
    return docs
