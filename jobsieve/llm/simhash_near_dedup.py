"""SimHash near-dedup by deletion-variant signatures.

Fingerprints that differ in at most d bits agree up to one bit in one of (d + 1) // 2 segments. Every segment is indexed under its variants with
one bit masked out, so such pairs meet under an equal key; the full distance is then verified. Keys with more than
``group_size`` different fingerprints are divided once more by the variants of the rest, and what is still larger is compared in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsieve.llm.common import shared_folder, slices, texts, written

BITS = 64


def fingerprint(data: bytes, shingle: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles of a text: a bit is 1 if over half of the shingles' XXH64 values have it."""
    words = data.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    digest, joined = xxhash.xxh64_intdigest, b" ".join(words)
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
    pairs = zip(starts[:-shingle].tolist(), (starts[shingle:] - 1).tolist())
    hashes = np.array([digest(joined[a:b], seed) for a, b in pairs], np.uint64)
    total = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        block = hashes[at : at + (1 << 16)]
        total += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprinter(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = [fingerprint(t.encode("utf-8", "surrogatepass"), shingle) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["doc_id", "fp"])

    return run


def segments(max_distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of so few segments that one of them differs in at most one bit."""
    count = (max_distance + 2) // 2
    cuts = [BITS * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def variant_keys(fps: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the fingerprint, number of the variant, masked segment) of all variants with one masked bit."""
    which, number, value = [], [], []
    at = np.arange(len(fps))
    for first, width in spans:
        mask = ((1 << width) - 1) << first
        for bit in range(first, first + width):
            which.append(at)
            number.append(np.full(len(fps), bit, np.int16))
            value.append(fps & np.uint64(mask & ~(1 << bit)))
    return np.concatenate(which), np.concatenate(number), np.concatenate(value)


def expander(spans: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fps = batch.column(0).slice(at, 4096).to_numpy().view(np.uint64)
                which, number, value = variant_keys(fps, spans)
                yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(value.view(np.int64)), pa.array(fps[which].view(np.int64))], ["variant", "masked", "fp"])

    return run


class Links:
    """A forest of verified links among the fingerprints of one key."""

    def __init__(self, fps: np.ndarray, max_distance: int, group_size: int):
        self.fps, self.most, self.size = fps, max_distance, group_size
        self.label = np.arange(len(fps))
        self.edges: list[tuple[int, int]] = []

    def compare(self, members: np.ndarray) -> None:
        """Every pair of ``members``, in blocks; pairs that are connected already add no link."""
        values = self.fps[members]
        for a in range(0, len(members), 512):
            for b in range(a, len(members), 512):
                near = np.bitwise_count(values[a : a + 512, None] ^ values[None, b : b + 512]) <= self.most
                for i in np.flatnonzero(near.any(axis=1)).tolist():
                    one, others = members[a + i], members[b : b + 512][near[i]]
                    labels, first = np.unique(self.label[others], return_index=True)
                    for label, at in zip(labels.tolist(), first.tolist()):
                        if label != self.label[one]:
                            self.edges.append((int(one), int(others[at])))
                            self.label[self.label == label] = self.label[one]

    def run(self, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """``spans``: the bits in which the fingerprints may still differ."""
        n = len(self.fps)
        if n <= self.size:
            self.compare(np.arange(n))
            return self.edges
        # Within a key the rest differs in at most max_distance bits: cut it as the whole was cut, and meet by variants again.
        for first, width in spans:
            for at in range(first, first + width):
                mask = np.uint64(((1 << width) - 1) << first & ~(1 << at))
                keys = self.fps & mask
                order = np.argsort(keys, kind="stable")
                cuts = np.flatnonzero(np.diff(keys[order])) + 1
                for members in np.split(order, cuts):
                    if len(members) > 1:
                        self.compare(members)
        return self.edges


def rest_spans(variant: int, spans: list[tuple[int, int]], max_distance: int) -> list[tuple[int, int]]:
    """The bits outside the variant's segment, cut so that one part differs in at most one bit."""
    out, parts = [], (max_distance + 2) // 2
    outside = [(f, w) for f, w in spans if not f <= variant < f + w]
    if len(outside) != 1:
        return outside
    first, width = outside[0]
    cuts = [first + width * i // parts for i in range(parts + 1)]
    out += [(a, b - a) for a, b in zip(cuts, cuts[1:])]
    return out


def linker(spans: list[tuple[int, int]], max_distance: int, group_size: int):
    """Rows (variant, masked, fp) in key order to links (a, b) that connect all that is near."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def closed(rows: np.ndarray) -> np.ndarray:
            new = np.flatnonzero((np.diff(rows[:, 0]) != 0) | (np.diff(rows[:, 1]) != 0)) + 1
            starts, ends = np.r_[0, new], np.r_[new, len(rows)]
            out = []
            for a, b in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
                fps = rows[a:b, 2].view(np.uint64)
                links = Links(fps, max_distance, group_size).run(rest_spans(int(rows[a, 0]), spans, max_distance))
                out += [(int(rows[a + i, 2]), int(rows[a + j, 2])) for i, j in links]
            return np.array(out, np.int64).reshape(-1, 2)

        def batch_of(links: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(links.min(axis=1, initial=2**63 - 1)), pa.array(links.max(axis=1, initial=-(2**63)))], ["a", "b"])

        for batch in batches:
            if batch.num_rows:
                rows = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)], axis=1)
                rows = np.concatenate([*held, rows])
                cut = len(rows) - 1
                differs = np.flatnonzero((rows[:, 0] != rows[-1, 0]) | (rows[:, 1] != rows[-1, 1]))
                cut = differs[-1] + 1 if len(differs) else 0
                held = [rows[cut:]]
                if cut:
                    yield batch_of(closed(rows[:cut]))
        if held:
            yield batch_of(closed(held[0]))

    return run


def components(links: DataFrame, folder: str) -> DataFrame:
    """(node, root) for every node of ``links`` (a < b): root is the least node reachable.

    Each round points all neighbours of a node at the least of them, first the larger ones, then the smaller ones, until nothing
    changes; the number of rounds grows with the logarithm of the longest path."""
    edges = written(links.select("a", "b").distinct(), f"{folder}/links-0")
    for turn in range(1, 60):
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("x"), F.least("a", "least").alias("y"))
        large = large.filter("x != y").distinct()
        low = large.groupBy("x").agg(F.min("y").alias("least"))
        small = large.join(low, "x").select(F.when(F.col("y") == F.col("least"), F.col("x")).otherwise(F.col("y")).alias("b"), F.col("least").alias("a"))
        changed = written(small.distinct().select("a", "b"), f"{folder}/links-{turn}")
        if changed.exceptAll(edges).isEmpty() and edges.exceptAll(changed).isEmpty():
            break
        edges = changed
    else:
        raise RuntimeError("links did not settle")
    return edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))


def near_groups(docs: DataFrame, shingle: int = 3, max_distance: int = 3, group_size: int = 256) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, fingerprint (16 hex digits), component_id.

    Null and empty texts have fingerprint zero and are linked like any other; of equal fingerprints all rows share a component; a null doc_id
    is never the smallest unless all are null; repeated doc_ids keep their rows; an empty table gives none. Other columns are not read."""
    spark = docs.sparkSession
    folder = shared_folder(spark, "simhash")
    rows = written(texts(docs).mapInArrow(fingerprinter(shingle), "doc_id bigint, fp bigint"), f"{folder}/fingerprints")
    own = written(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), f"{folder}/distinct")
    spans = segments(max_distance)
    keys = own.select("fp").mapInArrow(expander(spans), "variant smallint, masked bigint, fp bigint")
    met = keys.repartition("variant", "masked").sortWithinPartitions("variant", "masked")
    links = met.mapInArrow(linker(spans, max_distance, group_size), "a bigint, b bigint")
    roots = components(links, folder)
    tree = own.join(roots, own["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    tree = written(tree, f"{folder}/tree")
    least = tree.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = tree.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
