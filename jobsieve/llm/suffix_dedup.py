"""Removal of repeated passages by column-wise construction of a collection's Burrows-Wheeler transform.

1. Documents are packed into chunks, a table in the warehouse that is bucketed by chunk, so that later joins move no text.
2. Every string of ``length`` bytes is keyed by the least hash of the ``GRAM``-byte strings in it: equal strings have equal keys. Keys of one document only
   need no further look; which others there are is told to the chunks as bits. Keys are told by their leading bits.
3. Runs of neighbouring strings with one key become pieces of at most ``length`` + 31 bytes. A bucket of keys is a collection of its own: one symbol of each piece
   is put in front per round, from the right, and the transform and its common prefixes go from one sequential file to the next. A text whose key no other text
   has shares no string with the others and stays out of the collection.
4. Suffixes that agree in ``length`` bytes form an interval of the common prefixes; its smallest document keeps the string, others lose it."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsieve.llm.common import shared_folder, slices, texts, written

GRAM = 26
#: Starts in a piece.
STARTS = 32
#: Bytes of a file of a round that stay in memory; beyond, the task's own unnamed scratch file takes them, which ends with the task.
SPOOL = 32 << 20
#: Stands in the transform where a text is complete; no byte of UTF-8 has this value.
DONE = 255
#: Collections that a bucket is divided into, by further bits of the keys, so that one fits into a processor's cache.
PARTS = 16
MIX = np.uint64(0x9E3779B97F4A7C15)
LAST = np.iinfo(np.int64).max


def chunker(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial = TaskContext.get().partitionId() << 36
        for part in slices(batches, 2000, size):
            ids = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column(0))
            data = part.column(1).cast(pa.binary())
            own = pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), data)
            yield pa.RecordBatch.from_arrays([pa.array([serial], pa.int64()), pa.array([part.column(1).nbytes], pa.int64()), ids, own], ["chunk_id", "size", "doc_ids", "texts"])
            serial += 1

    return run


def least_keys(data: np.ndarray, length: int) -> np.ndarray:
    """For every start of a string of ``length`` bytes the least hash of the GRAM-byte strings in it."""
    hashes, width = [data.astype(np.uint64) + np.uint64(1)], 1
    while width < 16:
        x = hashes[-1]
        x = (x[:-width] * MIX) ^ (x[width:] + (x[width:] >> np.uint64(31)))
        hashes.append(x * MIX)
        width *= 2
    n = len(data) - GRAM + 1
    h = (hashes[4][:n] * MIX + hashes[3][16 : 16 + n]) * MIX + hashes[1][24 : 24 + n]
    h = (h ^ (h >> np.uint64(32))) * MIX
    least, width, wanted = h, 1, length - GRAM + 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    return np.minimum(least[: n - wanted + 1], least[wanted - width : wanted - width + n - wanted + 1])


def kept_bits(total: int) -> int:
    """Leading bits of keys to tell for so many bytes: few different keys agree in them, and those that do only cost a further look."""
    return min(64, total.bit_length() + 8)


def packed(ordered: np.ndarray) -> bytes:
    """Sorted numbers by the byte planes of their differences, compressed."""
    steps = np.diff(ordered, prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(steps.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


class Chunk:
    """The texts of a chunk one after another, and the runs of strings with one key that do not cross documents."""

    def __init__(self, doc_ids: list, data: list[bytes], length: int):
        self.ids = np.array([LAST if i is None else i for i in doc_ids], np.int64)
        self.sizes = np.array([len(t) for t in data], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.data = np.frombuffer(b"".join(data), np.uint8)
        self.first = self.stop = np.empty(0, np.int64)
        self.key = np.empty(0, np.uint64)
        if len(self.data) >= length:
            keys = least_keys(self.data, length)
            doc = np.repeat(np.arange(len(data)), self.sizes)
            inside = doc[: len(keys)] == doc[length - 1 :]
            cut = np.flatnonzero((keys[1:] != keys[:-1]) | (doc[1 : len(keys)] != doc[: len(keys) - 1])) + 1
            first, stop = np.r_[0, cut], np.r_[cut, len(keys)]
            # Starts near the end of a document have no whole string; they end its last run.
            last = self.ends[doc[first]] - length + 1
            stop = np.minimum(stop, last)
            ok = stop > first
            self.first, self.stop = first[ok], stop[ok]
            self.key, self.doc = keys[self.first], doc[self.first]
            assert inside[self.first].all()

    def by_part(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(order, part): the different (key, document) pairs sorted by key, and their parts."""
        order = np.lexsort((self.doc, self.key)) if len(self.key) else np.empty(0, np.int64)
        k = self.key[order]
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = (k[1:] != k[:-1]) | (self.doc[order][1:] != self.doc[order][:-1])
        order = order[new]
        return order, (self.key[order] >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(order), np.int64)


def chunks_of(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            get = lambda name, row=row: row.column(row.schema.get_field_index(name))[0].as_py()
            yield get("chunk_id"), Chunk(get("doc_ids"), get("texts"), length), get


def key_sender(bits: int, length: int, kept: int = 64):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk_id, chunk, _ in chunks_of(batches, length):
            order, part = chunk.by_part(bits)
            cuts = np.flatnonzero(np.diff(part)) + 1
            keys = np.split(chunk.key[order] >> np.uint64(64 - kept), cuts) if len(order) else []
            parts = part[np.r_[0, cuts]] if len(order) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(parts), pa.array([chunk_id] * len(keys), pa.int64()), pa.array([packed(k) for k in keys], pa.binary())], ["part", "chunk_id", "keys"])

    return run


def mark_shared(table: pa.Table) -> pa.Table:
    """For the keys that each chunk has sent, whether they occur in more than one document, as bits."""
    sent = [unpacked(k) for k in table.column("keys").to_pylist()]
    ordered = np.sort(np.concatenate(sent))
    shared = np.append(ordered[1:][ordered[1:] == ordered[:-1]], np.uint64(0xFFFFFFFFFFFFFFFF))
    bits = [np.packbits(shared[np.searchsorted(shared, k)] == k).tobytes() for k in sent]
    return pa.table([table.column("chunk_id"), table.column("part"), pa.array(bits, pa.binary())], ["chunk_id", "part", "bits"])


def piece_sender(bits: int, bucket_bits: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk_id, chunk, get in chunks_of(batches, length):
            order, part = chunk.by_part(bits)
            shared = np.zeros(len(order), bool)
            for told in get("told") or []:
                at = np.flatnonzero(part == told["part"])
                shared[at] = np.unpackbits(np.frombuffer(told["bits"], np.uint8))[: len(at)].astype(bool)
            keys = np.append(np.unique(chunk.key[order[shared]]), np.uint64(0xFFFFFFFFFFFFFFFF))
            own = np.flatnonzero(keys[np.searchsorted(keys, chunk.key)] == chunk.key) if len(keys) > 1 else np.empty(0, np.int64)
            # Long runs are cut into pieces.
            count = -(-(chunk.stop[own] - chunk.first[own]) // STARTS)
            run_of = np.repeat(own, count)
            turn = np.arange(len(run_of)) - np.repeat(np.cumsum(count) - count, count)
            first = chunk.first[run_of] + turn * STARTS
            starts = np.minimum(chunk.stop[run_of] - first, STARTS)
            bucket = (chunk.key[run_of] >> np.uint64(64 - bucket_bits)).astype(np.int64) if bucket_bits else np.zeros(len(run_of), np.int64)
            inner = (chunk.key[run_of] << np.uint64(bucket_bits) >> np.uint64(32)).astype(np.uint32)
            by = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[by])) + 1
            groups = np.split(by, cuts) if len(by) else []
            out = [[] for _ in range(6)]
            for g in groups:
                size = starts[g] + length - 1
                at = np.repeat(first[g] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                for column, value in zip(out, (int(bucket[g[0]]), first[g].astype(np.uint32).tobytes(), chunk.ids[chunk.doc[run_of[g]]].tobytes(), starts[g].astype(np.uint8).tobytes(), inner[g].tobytes(), chunk.data[at].tobytes())):
                    column.append(value)
            arrays = [pa.array(out[0], pa.int64()), pa.array([chunk_id] * len(groups), pa.int64()), *(pa.array(c, pa.binary()) for c in out[1:])]
            yield pa.RecordBatch.from_arrays(arrays, ["bucket", "chunk_id", "first", "doc_ids", "starts", "key", "data"])

    return run


class Rounds:
    """The files of the transform and of the common prefixes: each round reads those of the last from start to end and writes new ones."""

    def __init__(self):
        self.files = [tempfile.SpooledTemporaryFile(SPOOL) for _ in range(2)]

    def write(self, symbols: np.ndarray, prefixes: np.ndarray) -> None:
        for file, values in zip(self.files, (symbols, prefixes)):
            file.seek(0)
            file.truncate()
            file.write(memoryview(values).cast("B"))

    def read(self) -> tuple[np.ndarray, np.ndarray]:
        for file in self.files:
            file.seek(0)
        return np.frombuffer(self.files[0].read(), np.uint8), np.frombuffer(self.files[1].read(), np.uint8)

    def close(self) -> None:
        for file in self.files:
            file.close()


def least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of values[low + 1 .. high] for each pair, low < high."""
    span = high - low
    level = np.frexp(span.astype(np.float32))[1] - 1
    out = np.empty(len(low), values.dtype)
    order = np.argsort(level.astype(np.uint8), kind="stable")
    cuts = np.searchsorted(level[order], np.arange(int(level.max(initial=0)) + 2))
    table = values
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if k:
            half = 1 << (k - 1)
            table = np.minimum(table[:-half], table[half:])
        own = order[a:b]
        out[own] = np.minimum(table[low[own] + 1], table[high[own] - (1 << k) + 1])
    return out


def column_wise(data: np.ndarray, begin: np.ndarray, size: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, length of suffix, common prefix with the one before) of all suffixes in order; prefixes are counted up to ``depth``.

    Each text ends with a mark of its own. Before round j the transform has the symbols in front of all suffixes shorter than j. How many symbols are smaller, or equal and
    before it, is the place of the suffix that begins with it; of these, the ones of length j are new and are inserted."""
    m = len(size)
    text, length, fresh = np.arange(m, dtype=np.int32), np.zeros(m, np.uint8), np.ones(m, bool)
    files = Rounds()
    files.write(data[begin + size - 1], np.zeros(m, np.uint8))
    for turn in range(1, int(size.max(initial=0)) + 1):
        symbols, prefixes = files.read()
        order = np.argsort(symbols, kind="stable")[: len(symbols) - np.count_nonzero(symbols == DONE)]
        new = np.zeros(m + len(order), bool)
        new[m:] = fresh[order]
        old, at = ~new, np.flatnonzero(new)
        grown = text[order[at - m]]
        before = size[grown] - turn
        symbol = np.where(before > 0, data[begin[grown] + np.maximum(before, 1) - 1], np.uint8(DONE))
        # The common prefixes of new suffixes with their neighbours follow from those of the suffixes one symbol shorter.
        near = np.unique(np.concatenate([at, at[at + 1 < len(new)] + 1]))
        near = near[near > m]
        low, high = order[near - m - 1], order[near - m]
        common = np.zeros(len(near), np.uint8)
        same = symbols[low] == symbols[high]
        common[same] = np.minimum(least_between(prefixes, low[same], high[same]), depth - 1) + 1
        text, length, symbols, prefixes = (inserted(o, old, new, n) for o, n in ((text, grown), (length, turn), (symbols, symbol), (prefixes, 0)))
        prefixes[near] = common
        files.write(symbols, prefixes)
        fresh = new
    files.close()
    return text, length, prefixes


def inserted(values: np.ndarray, old: np.ndarray, new: np.ndarray, more: np.ndarray | int) -> np.ndarray:
    out = np.empty(len(new), values.dtype)
    out[old], out[new] = values, more
    return out


def smallest_documents(data: np.ndarray, begin: np.ndarray, size: np.ndarray, docs: np.ndarray, key: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each piece the number of its text, and for each text and start the smallest document with that string. Pieces with a string in common have the same key."""
    # Equal pieces are one text of the collection, with their smallest document.
    known: dict[bytes, int] = {}
    which = np.fromiter((known.setdefault(data[a:b].tobytes(), len(known)) for a, b in zip(begin.tolist(), (begin + size).tolist())), np.int64, len(size))
    least = np.full(len(known), LAST)
    np.minimum.at(least, which, docs)
    sample = np.empty(len(known), np.int64)
    sample[which[::-1]] = np.arange(len(size))[::-1]
    best = np.repeat(least[:, None], STARTS, axis=1)
    _, family, members = np.unique(key[sample], return_inverse=True, return_counts=True)
    several = np.flatnonzero(members[family] > 1)
    if len(several):
        sample = sample[several]
        text, suffix, common = column_wise(data, begin[sample], size[sample], length)
        groups = np.flatnonzero(common < length)
        smallest = np.repeat(np.minimum.reduceat(least[several[text]], groups), np.diff(np.r_[groups, len(text)]))
        long = suffix >= length
        best[several[text[long]], size[sample][text[long]] - suffix[long]] = smallest[long]
    return which, best


def judge(length: int):
    """Pieces of one bucket to the starts, in their chunks, of strings that a document with a smaller id has as well, as runs of neighbouring starts."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        first = np.concatenate([np.frombuffer(r["first"], np.uint32) for r in rows])
        docs = np.concatenate([np.frombuffer(r["doc_ids"], np.int64) for r in rows])
        starts = np.concatenate([np.frombuffer(r["starts"], np.uint8) for r in rows]).astype(np.int64)
        chunk = np.repeat(np.arange(len(rows)), [len(r["starts"]) for r in rows])
        data = np.frombuffer(b"".join(r["data"] for r in rows), np.uint8)
        size = starts + length - 1
        begin = np.cumsum(size) - size
        key = np.concatenate([np.frombuffer(r["key"], np.uint32) for r in rows])
        part = key // np.uint32((1 << 32) // PARTS)
        which, best = np.zeros(len(size), np.int64), []
        for p in range(PARTS):
            own = np.flatnonzero(part == p)
            known = sum(map(len, best))
            if len(own):
                which[own], found = smallest_documents(data, begin[own], size[own], docs[own], key[own], length)
                which[own] += known
                best.append(found)
        best = np.concatenate(best)
        gone = np.zeros((len(size), STARTS + 2), np.int8)
        gone[:, 1:-1] = (best[which] < docs[:, None]) & (np.arange(STARTS) < starts[:, None])
        step = np.diff(gone, axis=1)
        piece, begin = np.nonzero(step > 0)
        count = (np.nonzero(step < 0)[1] - begin).astype(np.uint8)
        where = (first[piece] + begin).astype(np.uint32)
        cuts = np.searchsorted(chunk[piece], np.arange(len(rows) + 1))
        out = [(r["chunk_id"], where[a:b].tobytes(), count[a:b].tobytes()) for r, a, b in zip(rows, cuts, cuts[1:]) if b > a]
        return pa.table([pa.array([o[k] for o in out], kind) for k, kind in enumerate((pa.int64(), pa.binary(), pa.binary()))], ["chunk_id", "first", "count"])

    return run


def cutter(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                data = b"".join(row["texts"])
                change = np.zeros(len(data) + 1, np.int32)
                told = row["told"] or []
                at, count = (np.frombuffer(b"".join(t[name] for t in told), kind).astype(np.int64) for name, kind in (("first", np.uint32), ("count", np.uint8)))
                np.add.at(change, at, 1)
                np.add.at(change, at + count + (length - 1), -1)
                covered = np.cumsum(change[:-1]) > 0
                out, at = [[] for _ in range(5)], 0
                for doc_id, text in zip(row["doc_ids"], row["texts"]):
                    own = covered[at : at + len(text)]
                    at += len(text)
                    kept = np.frombuffer(text, np.uint8)[~own].tobytes()
                    spans = int(own[:1].sum() + (own[1:] & ~own[:-1]).sum())
                    for column, value in zip(out, (doc_id, len(text), int(own.sum()), spans, kept)):
                        column.append(value)
                kinds = (pa.int64(),) * 4 + (pa.binary(),)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def without_repeats(docs: DataFrame, length: int = 50, chunk_bytes: int = 3 << 20, bucket_bytes: int = 1 << 21) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes).

    A byte goes if a string of ``length`` (36 to 200) bytes covers it that also starts in a document with a smaller doc_id. Null text counts as empty; a null doc_id comes after
    all others; rows that repeat a doc_id are judged against smaller ids only; an empty table gives no rows. Other columns are not read."""
    spark = docs.sparkSession
    folder, name = shared_folder(spark, "suffix-dedup"), f"chunks_{uuid.uuid4().hex}"
    rows = texts(docs).mapInArrow(chunker(chunk_bytes), "chunk_id bigint, size bigint, doc_ids array<bigint>, texts array<binary>")
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.option("compression", "zstd").bucketBy(parallel, "chunk_id").saveAsTable(name)
    chunks = spark.table(name)
    total = chunks.agg(F.sum("size")).first()[0] or 0
    bucket_bits = max(0, math.ceil(math.log2(max(1, total / bucket_bytes))))
    bits = max(0, bucket_bits - 3)
    sent = chunks.mapInArrow(key_sender(bits, length, max(kept_bits(total), bits)), "part bigint, chunk_id bigint, keys binary")
    told = sent.groupBy("part").applyInArrow(mark_shared, "chunk_id bigint, part bigint, bits binary")
    told = written(told, f"{folder}/shared").groupBy("chunk_id").agg(F.collect_list(F.struct("part", "bits")).alias("told"))
    pieces = chunks.join(told, "chunk_id").mapInArrow(
        piece_sender(bits, bucket_bits, length), "bucket bigint, chunk_id bigint, first binary, doc_ids binary, starts binary, key binary, data binary"
    )
    gone = written(pieces.groupBy("bucket").applyInArrow(judge(length), "chunk_id bigint, first binary, count binary"), f"{folder}/gone")
    gone = gone.groupBy("chunk_id").agg(F.collect_list(F.struct("first", "count")).alias("told"))
    return chunks.join(gone, "chunk_id", "left").select("doc_ids", "texts", "told").mapInArrow(
        cutter(length), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    )
