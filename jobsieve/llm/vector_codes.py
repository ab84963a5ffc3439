"""Product codes of vectors, trained by rounds of assignment and averaging in whole numbers; the nearest entry is found in a GNAT.

A codebook's entries lie in a tree. A node holds split points, entries far from each other, and every other entry of the node belongs to the
nearest of them; for each pair of a split point and a child the node stores the least and the greatest distance from the point to
the child's entries. A query measures its distance to the split points; a child whose stored range says that nothing in it can be as near as the best entry found so
far is left out with its whole subtree. The comparison is strict and its rounding goes against leaving out, so that ties are always met; what is met
is compared by whole squared distances, then by index.

Codebooks are small and travel with the tasks; vectors stay where they are. Tasks return sums per entry, so a round shuffles no vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsieve.llm.common import shared_folder, written

SCALE = 1024
#: Whole components must be smaller, so that squared distances of whole vectors fit 64 bits.
LARGEST = 1 << 27
#: Doubles hold products and sums of so small components exactly.
EXACT = 1 << 20
LEAF, FANOUT = 24, 12
#: Queries that a task answers at a time.
QUERIES = 4096
#: Relative room for the rounding of roots, far above what they need.
ROOM = 1e-9


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole squared distances between the rows of ``a`` and of ``b``."""
    if a.size and b.size and max(np.abs(a).max(), np.abs(b).max()) < EXACT:
        x, y = a.astype(float), b.astype(float)
        return np.rint((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T)).astype(np.int64)
    out = np.zeros((len(a), len(b)), np.int64)
    for k in range(a.shape[1]):
        out += (a[:, k][:, None] - b[:, k][None]) ** 2
    return out


class Node:
    """Entries ``ids`` with their split points (by position in ``ids``), children, and ranges[split, child] = (least, greatest) distance."""

    def __init__(self, entries: np.ndarray, ids: np.ndarray):
        self.ids, self.children = ids, []
        self.points = entries[ids]
        if len(ids) <= LEAF:
            return
        # Split points: each the farthest from those before it.
        near, chosen = squared(self.points, self.points[:1])[:, 0], [0]
        while len(chosen) < FANOUT and near.max() > 0:
            chosen.append(int(near.argmax()))
            near = np.minimum(near, squared(self.points, self.points[chosen[-1:]])[:, 0])
        if len(chosen) < 2:
            return
        apart = squared(self.points, self.points[chosen])
        owner = apart.argmin(1)
        owner[chosen] = np.arange(len(chosen))
        roots = np.sqrt(apart.astype(float))
        groups = [np.flatnonzero(owner == j) for j in range(len(chosen))]
        self.least = np.array([[roots[g, i].min() for g in groups] for i in range(len(chosen))])
        self.greatest = np.array([[roots[g, i].max() for g in groups] for i in range(len(chosen))])
        inner = [g[g != s] for g, s in zip(groups, chosen)]
        self.children = [Node(entries, ids[g]) if len(g) else None for g in inner]
        self.ids, self.points = ids[chosen], self.points[chosen]


class Gnat:
    def __init__(self, entries: np.ndarray):
        self.root = Node(entries, np.arange(len(entries)))
        self.compared = 0

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry, the lower index of equally near ones."""
        best, index = np.full(len(queries), np.iinfo(np.int64).max), np.full(len(queries), -1)
        self._search(self.root, queries, np.arange(len(queries)), best, index)
        return index, best

    def _search(self, node: Node, queries: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        apart = squared(queries[rows], node.points)
        self.compared += apart.size
        least = apart.min(1)
        ids = np.where(apart == least[:, None], node.ids, np.iinfo(np.int64).max).min(1)
        better = (least < best[rows]) | ((least == best[rows]) & (ids < index[rows]))
        best[rows[better]], index[rows[better]] = least[better], ids[better]
        if not node.children:
            return
        roots = np.sqrt(apart.astype(float))
        own = apart.argmin(1)
        # The child of the nearest split point comes first: what is found there leaves more out of the others.
        for first in (True, False):
            for j, child in enumerate(node.children):
                if child is None:
                    continue
                at = np.flatnonzero((own == j) == first)
                reach = np.sqrt(best[rows[at]].astype(float))
                d = roots[at]
                room = ROOM * (1 + d + node.greatest[:, j] + reach[:, None])
                out = (d - node.greatest[:, j] > reach[:, None] + room) | (node.least[:, j] - d > reach[:, None] + room)
                at = at[~out.any(1)]
                if len(at):
                    self._search(child, queries, rows[at], best, index)


def whole(batch: pa.Array, length: int) -> np.ndarray:
    """Lists of 64-bit integers as a matrix."""
    return batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), length)


def parts_of(vectors: np.ndarray, parts: int) -> list[np.ndarray]:
    return np.split(vectors, parts, axis=1)


def assignments(batches: Iterator[pa.RecordBatch], codebooks: np.ndarray, length: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], np.ndarray, np.ndarray]]:
    """Per slice of a batch: the slice, its parts, their entries (rows x parts) and squared distances."""
    trees = [Gnat(book) for book in codebooks]
    for batch in batches:
        for at in range(0, batch.num_rows, QUERIES):
            part = batch.slice(at, QUERIES)
            pieces = parts_of(whole(part.column(part.schema.get_field_index("v")), length), len(trees))
            found = [tree.nearest(piece) for tree, piece in zip(trees, pieces)]
            yield part, pieces, np.stack([i for i, _ in found], 1), np.stack([d for _, d in found], 1)


def summing(codebooks: np.ndarray, length: int):
    """Vectors to (part, entry, n, sums): one row per entry that a task has used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(codebooks.shape[:2], np.int64), np.zeros(codebooks.shape, np.int64)
        for _, pieces, entries, _ in assignments(batches, codebooks, length):
            for p, piece in enumerate(pieces):
                counts[p] += np.bincount(entries[:, p], minlength=counts.shape[1])
                np.add.at(sums[p], entries[:, p], piece)
        part, entry = np.nonzero(counts)
        columns = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry], pa.int64()), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", "sums"])

    return run


def coding(codebooks: np.ndarray, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, entries, distances in assignments(batches, codebooks, length):
            codes = [row.tobytes().hex() for row in entries.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(codes, pa.string()), pa.array(distances.sum(1), pa.int64())], ["vec_id", "label", "code", "error"]
            )

    return run


def kept_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label and ``v``, the whole components, of the rows that have all of their components."""
    sound = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE))
    return vectors.filter(F.coalesce(sound, F.lit(False))).select("vec_id", "label", scaled.alias("v"))


def checked(rows: DataFrame) -> tuple[int, int]:
    """(rows, length of the vectors); ValueError where they differ in length or a component is too large."""
    length, size = F.size("v"), F.array_max(F.transform("v", F.abs))
    found = rows.agg(F.count("*").alias("n"), F.min(length).alias("least"), F.max(length).alias("most"), F.max(size).alias("size")).first()
    if found.n and found.least != found.most:
        raise ValueError(f"vectors of {found.least} and of {found.most} components")
    if found.n and found.size is not None and found.size >= LARGEST:
        raise ValueError(f"a component is beyond {LARGEST // SCALE}")
    return found.n, found.least or 0


def train(rows: DataFrame, length: int, parts: int = 4, entries: int = 256, rounds: int = 4) -> np.ndarray:
    """Codebooks (parts x entries x components) of ``kept_vectors``. They start as the vectors of the smallest ids (ties by components, null ids last) and are
    averaged ``rounds`` times, rounding down; entries that no vector uses stay. What comes back per round is one row per entry."""
    start = rows.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    books = np.array([r.v for r in start], np.int64).reshape(len(start), parts, length // parts).transpose(1, 0, 2)
    for _ in range(rounds):
        sums = rows.select("v").mapInArrow(summing(books, length), "part int, entry int, n bigint, sums array<bigint>")
        totals = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(length // parts)])
        books = books.copy()
        for part, entry, n, *own in totals.collect():
            books[part, entry] = np.array(own, np.int64) // n
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def coded(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, salts: int = 32) -> DataFrame:
    """vec_id, label, code (two hex digits per part), error (squared distance to the entries), label_error (its sum over the label; nulls are a label), codebooks_sha256.

    ``vectors`` has vec_id, embedding, label; other columns are not read. Rows whose vector is null, or holds a null or non-finite component, are dropped; the
    others must agree in length, a multiple of ``parts``, with components below 131,072, else ValueError. Repeated rows and ids are coded each on its own. With fewer
    than ``entries`` vectors the codebooks are smaller; an empty table gives no rows."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry is two hex digits")
    folder = shared_folder(vectors.sparkSession, "codes")
    rows = written(kept_vectors(vectors), f"{folder}/vectors")
    n, length = checked(rows)
    if length % parts:
        raise ValueError(f"{length} components do not make {parts} equal parts")
    books = train(rows, length, parts, entries, rounds) if n else np.zeros((parts, 0, 0), np.int64)
    kinds = rows.select("vec_id", "label").schema
    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in kinds], "code string", "error bigint"])
    codes = written(rows.mapInArrow(coding(books, length), schema), f"{folder}/codes")
    # A label may hold a third of all rows: its sum is repeated for each of ``salts`` parts of it.
    label, missing = F.coalesce(F.col("label"), F.lit(0)), F.col("label").isNull()
    salted = codes.withColumn("__salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts))).withColumn("__label", label).withColumn("__missing", missing)
    sums = codes.groupBy(label.alias("__label"), missing.alias("__missing")).agg(F.sum("error").alias("label_error"))
    sums = sums.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    joined = salted.join(sums, ["__label", "__missing", "__salt"])
    return joined.select("vec_id", "label", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
