"""Importance resampling towards a target: documents are drawn by how much likelier hashed n-grams are in the target than in the corpus.

A text is scanned once, with its words separated by one space, and the CRC up to the end of every word is kept. The CRC of any n-gram follows from two of these
prefixes: the CRC of the bytes before it, shifted by the length of the n-gram, cancels against the CRC up to its end. Shifting by a byte is a linear map over GF(2), so
shifting by n bytes is one too; it is applied to many numbers at a time by looking their four bytes up in a table of the map."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsieve.llm.common import shared_folder, slices, written

#: A-Z to a-z, digits and bytes beyond ASCII as they are, all else to a space.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
POLYNOMIAL = 0xEDB88320
#: n-grams up to so many bytes have a table of their own; longer ones are shifted by powers of two.
SHORT = 96


def map_of(columns: list[int]) -> np.ndarray:
    """A linear map, given by its images of the 32 bits, as a table: images[k][b] is that of byte ``b`` at place ``k``."""
    images = np.zeros((4, 256), np.uint32)
    for k in range(4):
        for bit in range(8):
            images[k, 1 << bit : 2 << bit] = images[k, : 1 << bit] ^ np.uint32(columns[8 * k + bit])
    return images


def apply(images: np.ndarray, x: np.ndarray) -> np.ndarray:
    return images[0][x & 255] ^ images[1][x >> 8 & 255] ^ images[2][x >> 16 & 255] ^ images[3][x >> 24]


@lru_cache(1)
def shifts() -> tuple[np.ndarray, np.ndarray]:
    """Tables of the shifts by 0 to SHORT - 1 bytes, and by 2^0 to 2^31 bytes."""
    units = np.uint32(1) << np.arange(32, dtype=np.uint32)
    one = units
    for _ in range(8):
        one = (one >> 1) ^ np.where(one & 1, np.uint32(POLYNOMIAL), np.uint32(0))
    step = map_of(one.tolist())
    short, images = [], units
    for _ in range(SHORT):
        short.append(map_of(images.tolist()))
        images = apply(step, images)
    powers = [step]
    for _ in range(31):
        powers.append(map_of(apply(powers[-1], apply(powers[-1], units)).tolist()))
    return np.stack(short), np.stack(powers)


def shifted(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The CRCs moved on by ``by`` bytes each."""
    short, powers = shifts()
    near = np.minimum(by, SHORT - 1)
    out = short[near, 0, crc & 255] ^ short[near, 1, crc >> 8 & 255] ^ short[near, 2, crc >> 16 & 255] ^ short[near, 3, crc >> 24]
    far = np.flatnonzero(by >= SHORT)
    if len(far):
        moved, left = crc[far], by[far]
        for k in range(int(left.max()).bit_length()):
            moved = np.where(left >> k & 1, apply(powers[k], moved), moved)
        out[far] = moved
    return out


def longer(crc: int, piece: bytes) -> int:
    return zlib.crc32(piece, crc)


def ngram_crcs(texts: list[bytes], n: int) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """For runs of 1 to ``n`` words: (number of the text, CRC-32) of every run. Then the number of words of each text."""
    ends, lengths, counts = [], [], []
    for text in texts:
        words = b" ".join(text.translate(NORMAL).split())
        pieces = words.replace(b" ", b"\0 ").split(b"\0") if words else []
        ends.extend(accumulate(pieces, longer, initial=0))
        lengths.append(0)
        lengths.extend(map(len, pieces))
        counts.append(len(pieces))
    # Every text has one more prefix than words: the empty one.
    ends, stops, counts = np.array(ends, np.uint32), np.cumsum(lengths), np.array(counts, np.int64)
    owner = np.repeat(np.arange(len(texts)), counts + 1)
    first = np.ones(len(owner), bool)
    first[1:] = owner[1:] != owner[:-1]
    # Up to the word's own start: the prefix before it, and the space unless the word is the first.
    starts, before = stops + 1, shifted(ends, np.ones(len(ends), np.int64)) ^ np.uint32(zlib.crc32(b" "))
    starts[first], before[first] = stops[first], 0
    out = []
    for k in range(1, n + 1):
        at = np.flatnonzero(owner[k:] == owner[: max(0, len(owner) - k)])
        out.append((owner[at], shifted(before[at], stops[at + k] - starts[at]) ^ ends[at + k]))
    return out, counts


def utf8(column: pa.Array) -> list[bytes]:
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def counting(n: int, buckets: int):
    """Texts to (bucket, n): at most one row per bucket and task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for part in slices(batches):
            for _, crcs in ngram_crcs(utf8(part.column(0)), n)[0]:
                counts += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used], pa.int64())], ["bucket", "n"])

    return run


def weighing(gains: np.ndarray, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            runs, words = ngram_crcs(utf8(part.column(1)), n)
            features, total = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
            for owner, crcs in runs:
                features += np.bincount(owner, minlength=part.num_rows)
                np.add.at(total, owner, gains[crcs % np.uint32(len(gains))])
            weights = np.where(features > 0, total // np.maximum(features, 1), 0)
            yield pa.RecordBatch.from_arrays([part.column(0), *[pa.array(x, pa.int64()) for x in (words, features, weights)]], ["doc_id", "n_words", "n_features", "weight"])

    return run


def bucket_counts(texts: DataFrame, n: int, buckets: int) -> np.ndarray:
    """How many n-grams of all texts are in each bucket. What comes back is one row per bucket."""
    rows = texts.select("text").mapInArrow(counting(n, buckets), "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for bucket, count in rows:
        out[bucket] = count
    return out


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket, a thousand times the logarithm of how much likelier it is in the target; one n-gram is added to every bucket of both."""
    s, t, own, aim, k = corpus.tolist(), target.tolist(), int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((b + 1) * (own + k) / ((a + 1) * (aim + k)))) for a, b in zip(s, t)], np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """A thousand times a Gumbel variate that the id decides, rounded down."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.left(F.sha2(name, 256), F.lit(8)), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def resampled(docs: DataFrame, target: DataFrame, percent: int = 25, n: int = 2, buckets: int = 10_000, min_words: int = 20, seed: int = 7) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_features, weight, score, rank. ``target`` has text.

    Drawn are ``percent`` of a hundred of the rows with at least ``min_words`` words, the highest scores first, ties by smaller doc_id (null last); their ranks count
    from 1, others have none. Null and empty texts have no features and weight 0; repeated rows count and are drawn each on its own, in any order among themselves; an empty target
    leaves all counts at the added ones; an empty table gives no rows. A text's words are held in memory while it is scanned. Other columns are not read.

    Ranks need no global sort: scores are whole and, being logarithms of counts, take fewer than 300,000 values, whose counts are summed up; the window only orders rows of one score."""
    gains = gains_of(bucket_counts(docs, n, buckets), bucket_counts(target, n, buckets))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").mapInArrow(weighing(gains, n), f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")
    rows = rows.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    rows = written(rows, f"{shared_folder(docs.sparkSession, 'importance')}/scores")
    able = F.col("n_words") >= min_words
    counts = rows.filter(able).groupBy("score").agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1))
    draw = F.floor(F.sum("__n").over(Window.partitionBy()) * percent / 100)
    counts = counts.select("score", F.coalesce(before, F.lit(0)).alias("__before"), draw.alias("__draw")).filter("__before < __draw")
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last())) + F.col("__before")
    drawn = rows.filter(able).join(F.broadcast(counts), "score").withColumn("rank", place.cast("bigint"))
    rest = rows.filter(~able).unionByName(rows.filter(able).join(F.broadcast(counts), "score", "left_anti"))
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= F.col("__draw"), F.col("rank")))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return drawn.select(*columns).unionByName(rest.withColumn("rank", F.lit(None).cast("bigint")).select(*columns))
