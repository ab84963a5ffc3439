"""Benchmark decontamination by q-gram lemma filtering.

A region of a document within e edits of an item of m code points shares at least m - q + 1 - q * e q-grams with it, all on diagonals that lie at most e apart. Shared q-grams
are counted in overlapping bands of diagonals, bands under that bound are dropped, and banded alignment decides on the rest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsieve.llm.common import slices

Q = 8
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
TABLE_BITS = 22
#: Code points of items that are searched for in one pass; a larger benchmark takes more passes.
BLOCK_CHARS = 8 << 20
MATCH = pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("edits", pa.int32())])


def normal(text: str | None) -> str:
    """Lower case, runs of white space as one space."""
    return " ".join((text or "").lower().split())


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def grams(x: np.ndarray) -> np.ndarray:
    """Hashes of all strings of eight code points."""
    for width, mix in zip((1, 2, 4), MIX):
        x = (x[:-width] * mix + x[width:]) if len(x) > width else x[:0]
        x = x ^ (x >> np.uint64(29))
    return x


def align(item: np.ndarray, region: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """(edits, start, stop): the cheapest place of the item in the region whose path stays on the diagonals from ``low`` to ``high``."""
    width, big = high - low + 1, 1 << 20
    offsets = np.arange(width)
    columns = offsets + low
    ok = (columns >= 0) & (columns <= len(region))
    cost, start = np.where(ok, 0, big), columns.copy()
    for i in range(len(item)):
        at = offsets + low + i + 1  # region positions after this row, one per diagonal
        inside = (at >= 1) & (at <= len(region))
        same = np.zeros(width, bool)
        same[inside] = region[at[inside] - 1] == item[i]
        straight = cost + ~same
        down = np.append(cost[1:] + 1, big)
        new, begun = np.where(straight <= down, straight, down), np.where(straight <= down, start, np.append(start[1:], 0))
        new = np.where((at >= 0) & (at <= len(region)), np.where(inside | (down <= straight), new, big), big)
        run = np.minimum.accumulate(new - offsets)
        source = np.maximum.accumulate(np.where(new - offsets == run, offsets, 0))
        cost, start = run + offsets, begun[source]
    best = int(np.argmin(cost))
    return int(cost[best]), int(start[best]), best + low + len(item)


class Index:
    """The q-grams of the items, in the order of their hashes."""

    def __init__(self, items: list[tuple[int, str]], share: float):
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        self.points = [points(t) for t in self.texts]
        length = np.array([len(p) for p in self.points], np.int64)
        self.budget = np.minimum((length * share).astype(np.int64), np.maximum(0, (length - Q) // Q))
        self.length, self.need = length, length - Q + 1 - Q * self.budget
        own = [grams(p) for p in self.points]
        hashes = np.concatenate([*own, np.empty(0, np.uint64)])
        item = np.repeat(np.arange(len(own)), [len(g) for g in own])
        place = np.concatenate([*(np.arange(len(g)) for g in own), np.empty(0, np.int64)]).astype(np.int64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.item, self.place = hashes[order], item[order], place[order]
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[self.slot(self.hashes)] = True
        self.short = [(k, t) for k, t in enumerate(self.texts) if len(t) < Q]

    @staticmethod
    def slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes * MIX[0]) >> np.uint64(64 - TABLE_BITS)

    def hits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, item, place in the item) of every shared q-gram."""
        found = grams(x)
        at = np.flatnonzero(self.table[self.slot(found)])
        low = np.searchsorted(self.hashes, found[at], "left")
        count = np.searchsorted(self.hashes, found[at], "right") - low
        at, low, count = at[count > 0], low[count > 0], count[count > 0]
        which = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(at, count), self.item[which], self.place[which]

    def matches(self, text: str, x: np.ndarray, at: np.ndarray, item: np.ndarray, place: np.ndarray) -> list[dict]:
        out = [{"item_id": self.ids[k], "start": text.index(t), "stop": text.index(t) + len(t), "edits": 0} for k, t in self.short if t in text]
        if not len(at):
            return out
        diagonal = at - place
        band = (diagonal + self.length[item]) // (self.budget[item] + 1)
        # Every band overlaps the next, so diagonals that lie within the budget of each other share one.
        present, own = np.unique(item, return_inverse=True)
        bands_of, places = int(band.max()) + 2, int(place.max()) + 1
        key = (own * bands_of + band + 1) * places + place
        seen = np.unique(np.concatenate([key, key - places])) // places  # every place counts once in a band
        bands, counts = np.unique(seen, return_counts=True)
        owner, bands = np.divmod(bands, bands_of)
        full = counts >= self.need[present[owner]]
        for n, k in enumerate(present.tolist()):
            best = None
            wide = int(self.budget[k]) + 1
            for b in (bands[full & (owner == n)] - 1).tolist():
                low = b * wide - int(self.length[k])
                high = low + 2 * wide - 1
                start = max(0, low)
                region = x[start : high + int(self.length[k]) + 1]
                shared = diagonal[(item == k) & (diagonal >= low) & (diagonal <= high)]
                edits, a, z = self.exact(k, x, shared) or align(self.points[k], region, low - start - wide, high - start + wide)
                if edits <= self.budget[k] and (best is None or edits < best["edits"]):
                    if a < 0:  # an exact place is given from the start of the text
                        best = {"item_id": self.ids[k], "start": z - int(self.length[k]), "stop": z, "edits": 0}
                    else:
                        best = {"item_id": self.ids[k], "start": start + a, "stop": start + z, "edits": edits}
                if best and not best["edits"]:
                    break
            if best:
                out.append(best)
        return out

    def exact(self, k: int, x: np.ndarray, diagonals: np.ndarray) -> tuple[int, int, int] | None:
        """An alignment without edits, on the diagonal with the most shared q-grams."""
        values, counts = np.unique(diagonals, return_counts=True)
        d = int(values[np.argmax(counts)])
        if d >= 0 and np.array_equal(x[d : d + int(self.length[k])], self.points[k]):
            return 0, -1, d + int(self.length[k])
        return None


def matcher(items: list[tuple[int, str]], share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(items, share)
        for part in slices(batches):
            texts = [normal(t) for t in part.column(1).to_pylist()]
            arrays = [points(t) for t in texts]
            gap = np.zeros(Q, np.uint64)
            ends = np.cumsum([0, *(len(a) + Q for a in arrays)])
            at, item, place = index.hits(np.concatenate([y for a in arrays for y in (a, gap)]))
            doc = np.searchsorted(ends, at, "right") - 1
            # A pair of text and item with too few shared q-grams on all its diagonals has too few in every band.
            pair = doc * len(index.ids) + item
            _, inverse, counts = np.unique(pair, return_inverse=True, return_counts=True) if len(texts) * len(index.ids) > 1 << 24 else (None, pair, np.bincount(pair, minlength=1))
            enough = counts[inverse] >= index.need[item]
            at, item, place, doc = at[enough], item[enough], place[enough], doc[enough]
            cuts = np.searchsorted(doc, np.arange(len(texts) + 1))
            found = [
                index.matches(texts[i], arrays[i], at[a:b] - ends[i], item[a:b], place[a:b]) if b > a or index.short else []
                for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
            ]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(MATCH))], ["row", "matches"])

    return run


def with_matches(docs: DataFrame, benchmark: DataFrame, share: float = 0.1) -> DataFrame:
    """row (all columns of ``docs``) and matches: item_id, start, stop (code points of the lower-cased text with single spaces) and edits of the best place of every item
    that occurs with at most ``share`` of its code points edited. One row per row of ``docs``.

    Items under eight code points, which share no q-gram, must occur as they are; empty and null items match nothing, null texts have no match; repeated items are all
    reported. The benchmark is the stated set of queries: it is taken in blocks of ``BLOCK_CHARS`` code points, one pass over the documents each.
    Other columns are passed on whatever their names; an empty table gives no rows."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(F.struct(*columns).alias("row"), "text")
    result, block, held = None, [], 0

    def pass_over(rows: DataFrame, items: list[tuple[int, str]]) -> DataFrame:
        return rows.mapInArrow(matcher(items, share), T.StructType([rows.schema["row"], *T.StructType.fromDDL("matches array<struct<item_id:bigint,start:int,stop:int,edits:int>>")]))

    def search(found: DataFrame | None, items: list[tuple[int, str]]) -> DataFrame:
        if found is None:
            return pass_over(rows, items)
        more = pass_over(found.select(F.struct("row", "matches").alias("row"), F.col("row.text").alias("text")), items)
        return more.select(F.col("row.row").alias("row"), F.concat("row.matches", "matches").alias("matches"))

    for r in benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").toLocalIterator():
        text = normal(r.text)
        if text:
            block.append((r.item_id, text))
            held += len(text)
        if held >= BLOCK_CHARS:
            result, block, held = search(result, block), [], 0
    return search(result, block) if block or result is None else result


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = 0.1) -> DataFrame:
    """doc_id, item_id, start, stop, edits of every match; documents without one have no row."""
    found = with_matches(docs, benchmark, share)
    return found.select(F.col("row.doc_id").alias("doc_id"), F.explode("matches").alias("m")).select("doc_id", "m.*")
