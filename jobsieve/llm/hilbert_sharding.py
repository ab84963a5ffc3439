"""Shards cut from a Hilbert curve through metadata.

1. Every dimension is quantised into cells of about equal numbers of rows: a fixed fine grid over its values is counted over all rows, and the
   counts are cut at equal steps. A string's grid is the two characters after the beginning that its least and its greatest value share.
2. A row's cells are its coordinates; their index on the Hilbert curve is its place. The curve is only computed once per occupied cell of the grid.
3. Rows are ranked along the curve, and the ranking is cut into shards of equal numbers of rows. So a shard covers a compact region in all
   dimensions, and readers can skip files by the least and greatest value of any of them.

The ranking never sorts all rows or one cell in one task: a place is the rows before the cell (a table of at most 2^(bits * dimensions) rows), plus those
before the row's slice of the cell, plus its number in the slice; slices are cut by bits of a digest and hold some ``SLICE_ROWS`` rows whatever
the size of the cell. Everything is column expressions and SQL functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsieve.llm.common import shared_folder, written

#: Expected rows of a slice of a cell that one task sorts.
SLICE_ROWS = 100_000
#: Bits of the position in a number's grid below its leading one.
GRID_BITS = 5


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8


def shared_start(least: str | None, greatest: str | None) -> int:
    """How many characters all values between the two begin with."""
    pairs = enumerate(zip(least or "", greatest or ""))
    return next((i for i, (a, b) in pairs if a != b), min(len(least or ""), len(greatest or "")))


def number_grid(x: Column) -> Column:
    """Whole numbers of 0 and more by their bit length and the next bits: at most 64 * 2^GRID_BITS cells, in order."""
    x = F.greatest(x.cast("bigint"), F.lit(0).cast("bigint"))
    width = F.length(F.bin(x))
    shift = F.greatest(width - 1 - GRID_BITS, F.lit(0))
    return (width * (1 << GRID_BITS) + F.call_function("shiftright", x, shift).bitwiseAND((1 << GRID_BITS) - 1)).cast("int")


def string_grid(x: Column, start: int) -> Column:
    """Strings by the two characters after ``start`` ones, in order (but for characters beyond 255, which share a cell); null comes first."""
    code = lambda at: F.least(F.coalesce(F.ascii(F.substring(x, at, 1)), F.lit(0)), F.lit(255))
    return (code(start + 1) * 256 + code(start + 2)).cast("int")


def hilbert_index(cells: Column, dims: int, bits: int) -> Column:
    """The place of a cell, an array of ``dims`` coordinates of ``bits`` bits each, on the Hilbert curve.

    Coordinates are turned back level by level from the top, Gray-coded, and their bits are interleaved."""
    levels = [(1 << b, i) for b in range(bits - 1, 0, -1) for i in range(dims)]
    steps = F.array(*[F.struct(F.lit(q).alias("q"), F.lit(i).alias("i")) for q, i in levels])

    def turn(x: Column, s: Column) -> Column:
        low, own, first = s["q"] - 1, F.get(x, s["i"]), F.get(x, F.lit(0))
        swap = first.bitwiseXOR(own).bitwiseAND(low)
        hit = own.bitwiseAND(s["q"]) != 0
        return F.transform(
            x,
            lambda v, j: v.bitwiseXOR(
                F.when(hit, F.when(j == 0, low).otherwise(0)).when((j == 0) | (j == s["i"]), swap).otherwise(0)
            ),
        )

    turned = F.aggregate(steps, cells, turn) if levels else cells
    # Gray code: each coordinate takes all before it.
    gray = F.transform(turned, lambda v, j: F.aggregate(F.slice(turned, 1, j + 1), F.lit(0), lambda a, w: a.bitwiseXOR(w)))
    last = F.element_at(gray, -1)
    flips = [F.when(last.bitwiseAND(1 << b) != 0, (1 << b) - 1).otherwise(0) for b in range(1, bits)]
    flip = reduce(lambda a, b: a.bitwiseXOR(b), flips, F.lit(0))
    index = F.lit(0).cast("bigint")
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            bit = F.shiftright(F.get(gray, F.lit(i)).bitwiseXOR(flip), b).bitwiseAND(1)
            index = index * 2 + bit
    return index


def grids(docs: DataFrame, dims: tuple[str, ...]) -> list[Column]:
    """A grid per dimension; ``size`` stands for the size of the text. Dimensions that the table lacks are left out."""
    kinds = dict(docs.dtypes)
    strings = [d for d in dims if kinds.get(d) == "string"]
    ends = docs.agg(F.lit(0).alias("_"), *[f(d).alias(f"{f.__name__}_{d}") for d in strings for f in (F.min, F.max)]).first()
    out = []
    for d in dims:
        if d in strings:
            out.append(string_grid(F.col(d), shared_start(ends[f"min_{d}"], ends[f"max_{d}"])))
        elif d == "size":
            out.append(number_grid(size_of(F.col("text"))))
        elif d in kinds:
            out.append(number_grid(F.coalesce(F.col(d), F.lit(0))))
    return out


def digest(doc_id: Column, text_crc32: Column) -> Column:
    """32 bits by which rows of one cell are ordered."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), text_crc32.cast("string"))
    return F.conv(F.left(F.md5(name.cast("binary")), F.lit(8)), 16, 10).cast("bigint")


def placed(docs: DataFrame, shards: int, dims: tuple[str, ...] = ("lang", "source", "size"), bits: int = 5, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, and any of ``dims``): doc_id, size, text_crc32, curve (index on the curve), place (0, 1, ... along it),
    shard and slot (0, 1, ... in the shard), and the values of ``dims`` that are columns. Shards differ by at most one row.

    Rows of one cell follow a digest of doc_id and text, then doc_id, size. A null text has no bytes, a null id counts as an empty one and null dimensions come
    first. Repeated rows are placed each on its own, in any order among themselves; with fewer rows than shards some shards stay empty; an empty table gives no rows.
    Other columns are not read, whatever their names."""
    named = [d for d in dims if d in docs.columns and d not in ("doc_id", "size")]
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    keys = [g.alias(f"__g{i}") for i, g in enumerate(grids(docs, dims))] or [F.lit(0).alias("__g0")]
    axes = range(len(keys))
    rows = docs.select("doc_id", *named, size_of(F.col("text")).alias("__size"), crc.alias("__crc"), *keys)
    rows = rows.withColumn("__digest", digest(F.col("doc_id"), F.col("__crc")))
    folder = shared_folder(docs.sparkSession, "hilbert")
    base = rows = written(rows, f"{folder}/rows")

    # 1. Equal steps through the counts of every grid: tables of at most 65,536 rows. What a step finds is written, so that no plan holds those before it.
    for i in axes:
        counts = base.groupBy(f"__g{i}").agg(F.count("*").alias("__n"))
        before = F.sum("__n").over(Window.orderBy(f"__g{i}").rowsBetween(Window.unboundedPreceding, -1))
        cell = F.floor(F.coalesce(before, F.lit(0)) * (1 << bits) / F.sum("__n").over(Window.partitionBy())).cast("int")
        steps = written(counts.select(f"__g{i}", cell.alias(f"__c{i}")), f"{folder}/steps_{i}")
        rows = rows.join(F.broadcast(steps), f"__g{i}")

    # 2. The curve through the occupied cells: at most 2^(bits * dimensions) rows.
    cells = [f"__c{i}" for i in axes]
    curve = rows.groupBy(*cells).agg(F.count("*").alias("__n")).withColumn("curve", hilbert_index(F.array(*cells), len(cells), bits))
    before = F.sum("__n").over(Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1))
    curve = curve.select(
        *cells, "curve", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__n").over(Window.partitionBy()).alias("__all"),
        F.greatest(F.lit(0), F.least(F.lit(32), F.ceil(F.log2(F.col("__n") / slice_rows)))).cast("int").alias("__depth"),
    )
    rows = rows.join(F.broadcast(written(curve, f"{folder}/curve")), cells)

    # 3. Slices of the cells, and numbers in the slices.
    rows = rows.withColumn("__slice", F.floor(F.col("__digest") / F.pow(F.lit(2), 32 - F.col("__depth"))).cast("bigint"))
    own = ["curve", "__slice"]
    slices = rows.groupBy(*own).agg(F.count("*").alias("__n"))
    ahead = F.sum("__n").over(Window.partitionBy("curve").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1))
    slices = written(slices.select(*own, F.coalesce(ahead, F.lit(0)).alias("__ahead")), f"{folder}/slices")
    number = F.row_number().over(Window.partitionBy(*own).orderBy("__digest", "doc_id", "__size")) - 1
    rows = rows.withColumn("__number", number).join(slices, own)
    rows = rows.withColumn("place", F.col("__before") + F.col("__ahead") + F.col("__number"))
    shard = F.expr(f"place * {shards} div __all")
    rows = rows.withColumn("shard", shard.cast("int"))
    slot = F.col("place") - F.expr(f"(shard * __all + {shards - 1}) div {shards}")
    return rows.select("doc_id", F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), "curve", "place", "shard", slot.alias("slot"), *named)


def manifest(placed_rows: DataFrame, dims: tuple[str, ...] = ("lang", "source", "size")) -> DataFrame:
    """Per shard: rows, bytes, and least and greatest value of every dimension, by which readers choose shards."""
    ends = [f(d).alias(f"{f.__name__}_{d}") for d in dims for f in (F.min, F.max)]
    return placed_rows.groupBy("shard").agg(F.count("*").alias("n_rows"), F.sum("size").alias("n_bytes"), *ends)


def write_shards(docs: DataFrame, path: str, shards: int, dims: tuple[str, ...] = ("lang", "source", "size")) -> DataFrame:
    """All columns of the documents as a folder ``hilbert_shard=N`` per shard, rows along the curve in each; returns the manifest.

    A row finds its place by doc_id and the CRC of its text; rows that agree in both are copies and all take the first of their places."""
    first = F.min(F.struct("place", "shard")).alias("spot")
    spots = placed(docs, shards, dims).groupBy(F.col("doc_id").alias("__id"), F.col("text_crc32").alias("__crc")).agg(first)
    same = docs["doc_id"].eqNullSafe(spots["__id"]) & (F.crc32(F.coalesce(docs["text"], F.lit("")).cast("binary")) == spots["__crc"])
    rows = docs.join(spots, same).select(*[docs[f"`{c}`"] for c in docs.columns], F.col("spot.place").alias("__place"), F.col("spot.shard").alias("hilbert_shard"))
    rows.repartitionByRange(shards, "__place").sortWithinPartitions("__place").drop("__place").write.partitionBy("hilbert_shard").parquet(path)
    found = docs.sparkSession.read.parquet(path)
    return manifest(found.withColumn("shard", F.col("hilbert_shard")).withColumn("size", size_of(F.col("text"))), dims)
