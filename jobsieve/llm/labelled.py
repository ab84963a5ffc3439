"""A bounded sample of labelled documents, for classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsieve.llm.common import crc_mod


def held_out():
    return crc_mod(4) == 2


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, longest: int = 20_000) -> list[tuple[str, int]]:
    """(text, label) of at most ``rows`` labelled documents outside the held-out part, texts of at most ``longest`` code points, in the order of a hash of the id: so
    labels keep the share they have in the table, whatever its size.

    Null labels and texts are left out. Of an id that has several labels the least counts, of several texts the first in order; an id gives one pair."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label")).filter("label in (0, 1)")
    known = known.filter(~held_out() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("label").alias("label"))
    rows_of = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").filter(F.col("text").isNotNull() & (F.char_length("text") <= longest))
    ids = rows_of.select("doc_id").join(known, "doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    found = rows_of.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return [(r.text, r.label) for r in found.orderBy(F.xxhash64("doc_id"), "doc_id").collect()]
