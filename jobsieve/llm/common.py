"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator
from itertools import islice
from types import ModuleType
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Space and the five ASCII control characters that separate words.
SPACES = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, so that further columns cannot clash; a null text counts as empty."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one that driver and executors share: ``spark.checkpoint.dir``, or the warehouse where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str, **options: str) -> DataFrame:
    """The rows as a table in the shared folder: lineage ends there, and lost executors cost nothing that is in it."""
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows and, beyond a single row, ``size`` bytes."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            n = min(rows, batch.num_rows - at)
            while n > 1 and batch.slice(at, n).get_total_buffer_size() and batch.slice(at, n).nbytes > size:
                n //= 2
            yield batch.slice(at, n)
            at += n


def per_worker(key: object, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once in a Python worker and used by all tasks it runs. Results must not depend on what earlier tasks left in it."""
    kept = sys.modules.setdefault("_jobsieve_kept", ModuleType("_jobsieve_kept")).__dict__.setdefault("values", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


class Remembered(dict):
    """Pieces of text to what ``make`` gives for a list of them, for a bounded number of pieces.

    New ones come in windows: a full window becomes the older one, and pieces of that which come again are proven and stay; of too many proven ones the earlier half goes.
    Long pieces are not remembered."""

    WINDOW, PROVEN, LONGEST = 75_000, 150_000, 200

    def __init__(self, make: Callable[[list[str]], list]):
        self.make, self.older, self.proven = make, {}, {}

    def learn(self, new: set[str]) -> dict[str, Any]:
        """The values of pieces that are not here."""
        if len(self) - len(self.proven) + len(new) > self.WINDOW:
            self.older = {piece: value for piece, value in self.items() if piece not in self.proven}
            if len(self.proven) > self.PROVEN:
                self.proven = dict(islice(self.proven.items(), len(self.proven) // 2, None))
            self.clear()
            self.update(self.proven)
        again = {piece: self.older.pop(piece) for piece in new if piece in self.older}
        self.proven.update(again)
        unknown = sorted(new.difference(again))
        out = again | dict(zip(unknown, self.make(unknown) if unknown else ()))
        self.update(out if max(map(len, unknown), default=0) <= self.LONGEST else {piece: value for piece, value in out.items() if len(piece) <= self.LONGEST})
        return out

    def values_of(self, texts: list[list[str]]) -> list[list]:
        """The values of the pieces of some texts."""
        found = [list(map(self.get, own)) for own in texts]
        gaps = [[i for i, value in enumerate(got) if value is None] if None in got else () for got in found]
        learned = self.learn({own[i] for own, at in zip(texts, gaps) for i in at})
        for own, got, at in zip(texts, found, gaps):
            for i in at:
                got[i] = learned[own[i]]
        return found


def crc_mod(divisor: int) -> Column:
    """crc32 of the decimal ``doc_id`` modulo ``divisor``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % divisor
