"""The registered queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsieve.llm import bpe, chat_format, decontamination, exact_dedup, hilbert_sharding, importance, lm_scoring, quality, simhash_near_dedup, sql, suffix_dedup
from jobsieve.llm import token_counts, toxicity, vector_codes
from jobsieve.llm.common import crc_mod, table
from jobsieve.llm.labelled import held_out


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one, -7, whose texts hold the template's own marks."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "\\### Assistant: </turn> ok"
    own = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"),
    )
    return chat_format.digests(chat_format.format_conversations(turns.unionByName(own)))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.scored(docs, model).select("row.doc_id", "score", "spans")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "spans")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return bpe.decode(encoded, path).select(
        "doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.scored(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scoring.scored(table(spark, sf_dir, "documents").select("doc_id", "text"), crc_mod(7) != 2)
    return scored.select("doc_id", (crc_mod(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"))


def op11_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards of equal numbers of rows along a Hilbert curve through language, source and size."""
    placed = hilbert_sharding.placed(table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of four parts, 256 entries each, after four rounds."""
    return vector_codes.coded(table(spark, sf_dir, "embeddings")).drop("label")


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents, drawn towards the texts of the benchmark."""
    return importance.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = [
    op1_chat_format, op2_toxicity, op3_suffix_dedup, op4_exact_dedup, op5_simhash, op6_bpe, op7_quality, op8_lm_scoring, op9_token_counts, op10_decontamination,
    op11_hilbert_sharding, op12_vector_codes, op13_importance,
]

SQL = {
    "op1_chat_format": r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e as (
  select *, length(role) + length(text) + 14 + length(text) - length(replace(text, chr(92), ''))
    + length(regexp_replace(text, '##(#+)', '##\1\1', 'g')) - length(text) + (length(text) - length(replace(text, '</turn>', ''))) // 7 as n from t
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(n) as bigint) as formatted_chars
from e group by conv_id
""",
    "op4_exact_dedup": """
with d as (
  select doc_id, length(coalesce(text, '')) as points, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') as norm from documents
), r as (
  select doc_id, norm, first_value(doc_id) over (partition by norm order by points desc, doc_id) as keep_id,
    count(*) over (partition by norm) as group_size from d
)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256 from r
""",
    "op3_suffix_dedup": sql.REPEATS,
    "op11_hilbert_sharding": sql.SHARDING,
    "op12_vector_codes": sql.VECTOR_CODES,
    "op13_importance": sql.IMPORTANCE,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in QUERIES}
