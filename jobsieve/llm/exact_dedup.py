"""Exact dedup on an extendible-hash index that lies on shared files.

1. One pass over the documents puts every row into the page of its input task: rows with equal bytes are chained to one
   entry, which alone carries the bytes. So copies are combined before anything is shuffled.
2. The directory of the index is built from the keys of the entries: the buckets of a level are counted, and the overfull ones are
   split by one more bit of the key (the directory doubles) until every bucket fits or holds a single key.
3. Each bucket, a range of keys, has one owner task. It reads its entries in key order, chains those that collide and compares
   their bytes; entries with equal bytes get one class.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsieve.llm.common import SPACES, shared_folder, slices, texts, written

PAGE_SCHEMA = "entry_id bigint, key bigint, doc_id bigint, n_points int, text_sha256 string, norm binary"
#: Bytes of text that a task holds in its page before it begins a new one.
PAGE_BYTES = 48 << 20
#: The directory is broadcast up to so many slots (of 20 bytes), and joined by shuffle beyond.
BROADCAST_SLOTS = 1 << 16


def hash64(data: bytes) -> int:
    """XXH64 as a signed number."""
    h = xxhash.xxh64_intdigest(data)
    return h - (1 << 64) if h >> 63 else h


def page_writer(page_bytes: int, key_of=hash64):
    """Rows of (doc_id, text) to page rows; the first of equal texts in a page carries the bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial, page, held = TaskContext.get().partitionId() << 36, {}, 0
        for part in slices(batches):
            out = [[] for _ in range(6)]
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                norm = text.encode("utf-8", "surrogatepass").translate(None, SPACES)
                key = key_of(norm)
                chain = page.setdefault(key, [])
                found = next((x for x in chain if x[0] == norm), None)
                new = found is None
                if new:
                    if held > page_bytes:
                        page, held = {key: (chain := [])}, 0
                    found = (norm, serial, hashlib.sha256(norm).hexdigest())
                    chain.append(found)
                    serial, held = serial + 1, held + len(norm) + 200
                for column, value in zip(out, (found[1], key, doc_id, len(text), found[2], norm if new else None)):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["entry_id", "key", "doc_id", "n_points", "text_sha256", "norm"])

    return run


def prefix(depth: int) -> Column:
    """The first ``depth`` bits of the key."""
    return F.shiftrightunsigned("key", 64 - depth) if depth else F.lit(0).cast("bigint")


def build_directory(keys: DataFrame, capacity: int, max_depth: int = 48) -> tuple[DataFrame, int]:
    """(slot, bucket, depth) for all slots of the global depth, and that depth.

    A bucket is named by its first slot at the greatest depth. Buckets over ``capacity`` different keys are split; only keys that
    agree in ``max_depth`` bits stay together whatever their number."""
    keys = keys.select("key").distinct()
    count = keys.count()
    depth = max(0, math.ceil(math.log2(max(1, count) / capacity)))
    closed, still_open = [], keys
    while True:
        counts = still_open.groupBy(prefix(depth).alias("prefix")).agg(F.count("*").alias("n")).persist()
        full = counts.filter(F.lit(depth < max_depth) & (F.col("n") > capacity))
        closed.append((depth, counts.filter(F.lit(depth >= max_depth) | (F.col("n") <= capacity)).select("prefix")))
        if full.isEmpty():
            break
        still_open = still_open.join(full.select("prefix"), prefix(depth) == F.col("prefix"), "left_semi")
        depth += 1
    levels = [
        level.select(F.explode(F.sequence(F.shiftleft("prefix", depth - d), F.shiftleft(F.col("prefix") + 1, depth - d) - 1)).alias("slot"),
                     F.shiftleft("prefix", depth - d).alias("bucket"), F.lit(d).alias("depth"))
        for d, level in closed
    ]
    directory = levels[0]
    for level in levels[1:]:
        directory = directory.unionAll(level)
    return directory, depth


def compare_chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in key order to (entry_id, class_id): within the chain of a key, equal bytes share the id of the first."""
    last, chain = None, []
    for part in slices(batches, 2000, 16 << 20):
        ids, classes = part.column(0).to_pylist(), []
        for entry, key, norm in zip(ids, part.column(1).to_pylist(), part.column(2).to_pylist()):
            if key != last:
                last, chain = key, []
            own = next((c for n, c in chain if n == norm), None)
            if own is None:
                chain.append((norm, own := entry))
            classes.append(own)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(classes, pa.int64())], ["entry_id", "class_id"])


def exact_groups(docs: DataFrame, capacity: int = 4096, page_bytes: int = PAGE_BYTES, key_of=hash64) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are the same after white space (space, \\t to \\r) is deleted. Of a group the row with the most code
    points, then the smallest doc_id is kept. Null text counts as empty; a null doc_id sorts after all others; rows that repeat
    a doc_id count on their own, and all rows of the kept id are marked kept; an empty table gives no rows. Other columns are not read."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "exact-index")
    rows = texts(docs).mapInArrow(page_writer(page_bytes, key_of), PAGE_SCHEMA)
    pages = written(rows, f"{folder}/pages", compression="zstd")
    entries = pages.filter(F.col("norm").isNotNull())
    directory, depth = build_directory(entries, capacity)
    directory = written(directory, f"{folder}/directory")
    if directory.count() <= BROADCAST_SLOTS:
        directory = F.broadcast(directory)
    owned = (
        entries.select("entry_id", "key", "norm", prefix(depth).alias("slot"))
        .join(directory, "slot")
        .repartition("bucket")
        .sortWithinPartitions("key")
        .select("entry_id", "key", "norm")
    )
    classes = written(owned.mapInArrow(compare_chains, "entry_id bigint, class_id bigint"), f"{folder}/classes")
    best = F.min(F.struct((-F.col("n_points")).alias("less"), F.col("doc_id").isNull().alias("unnamed"), "doc_id"))
    by_entry = pages.groupBy("entry_id").agg(best.alias("best"), F.count("*").alias("n"))
    by_entry = by_entry.join(classes, "entry_id")
    by_class = by_entry.groupBy("class_id").agg(F.min("best").alias("best"), F.sum("n").alias("n"))
    decided = by_entry.select("entry_id", "class_id").join(by_class, "class_id").select("entry_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"))
    return pages.select("entry_id", "doc_id", "text_sha256").join(decided, "entry_id").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
