"""The pages that every root has queued so far, as a table that grows by a segment per level, each with Bloom filters.

Segments are partitioned by a hash of the root. A filter is made of blocks of 32,768 bits; a page sets ``PROBES`` bits of one block. A link whose bits are not
all set in any segment is new and needs no join with the pages themselves; only the others are looked up, in the partitions they fall into. Filters take some
1.4 bytes a page. When there are many segments their filters become one, which reads one number per page and no page."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsieve.sources.files import materialize

#: Bits of a block, as many as one bitmap of Spark's bitmap functions holds.
BLOCK_BITS = 32_768
PAGES_PER_BLOCK = 3_000
PROBES = 4
#: Filters that a link is tested against before they are merged.
MOST_FILTERS = 8

KEY = ["root_ord", "page_url"]


def page_hash() -> Column:
    return F.xxhash64("root_ord", "page_url")


def probes(h: Column) -> list[Column]:
    """The bits of a page in its block."""
    return [F.pmod(F.xxhash64(h, F.lit(i)), F.lit(BLOCK_BITS)) for i in range(PROBES)]


def block_of(h: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(h, F.lit(-1)), blocks)


def words(bits: Column) -> Column:
    """A bitmap as numbers of 64 bits, made once per block, so that a probe is one access and needs no text."""
    at = F.sequence(F.lit(0), F.lit(BLOCK_BITS // 64 - 1))
    return F.transform(at, lambda i: F.conv(F.hex(F.substring(bits, i * 8 + 1, F.lit(8))), 16, -10).cast("bigint"))


def is_set(numbers: Column, at: Column) -> Column:
    """The bytes of a bitmap follow each other from the highest of a number to its lowest."""
    byte = F.shiftright(at, 3)
    return F.bit_get(F.get(numbers, F.shiftright(at, 6).cast("int")), ((7 - byte % 8) * 8 + at % 8).cast("int")) == 1


class Visited:
    def __init__(self, spark: SparkSession, folder: str, parts: int | None = None):
        self.spark, self.folder = spark, folder
        self.parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.segments: list[DataFrame] = []
        self.sizes: list[int] = []
        self.filters: list[tuple[int, DataFrame]] = []  # blocks, (block, bits as numbers)
        self.merges = 0

    def part(self) -> Column:
        return F.pmod(F.xxhash64("root_ord"), F.lit(self.parts)).cast("int")

    def _filter(self, hashes: DataFrame, pages: int, name: str) -> tuple[int, DataFrame]:
        blocks = max(1, -(-pages // PAGES_PER_BLOCK))
        bits = hashes.select(block_of(F.col("h"), F.lit(blocks)).alias("block"), F.explode(F.array(*probes(F.col("h")))).alias("bit"))
        maps = bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")).select("block", words(F.col("bits")).alias("bits"))
        return blocks, materialize(maps, self.folder, name)

    def add(self, pages: DataFrame) -> tuple[DataFrame, int]:
        """Writes a segment of new pages (root_ord, page_url and what else they have); they must not be in the set. Returns them and their number."""
        number = len(self.segments)
        path = f"{self.folder}/visited_{number}"
        rows = pages.withColumns({"h": page_hash(), "part": self.part()})
        rows.repartition("part").write.partitionBy("part").option("compression", "zstd").parquet(path)
        rows = self.spark.read.schema(rows.schema).parquet(path)
        self.segments.append(rows)
        self.sizes.append(rows.count())
        if self.sizes[-1]:
            self.filters.append(self._filter(rows.select("h"), self.sizes[-1], f"filter_{number}"))
        if len(self.filters) > MOST_FILTERS:
            hashes = reduce(DataFrame.unionAll, [s.select("h") for s in self.segments])
            self.filters = [self._filter(hashes, sum(self.sizes), f"merged_{self.merges}")]
            self.merges += 1
        return rows.drop("h", "part"), self.sizes[-1]

    def maybe(self, found: DataFrame) -> DataFrame:
        """``found`` with ``maybe``: false where the filters say that the page is new. One join, of a short row per link and filter."""
        if not self.filters:
            return found.withColumn("maybe", F.lit(False))
        filters = reduce(DataFrame.unionAll, [f.select(F.lit(i).alias("__filter"), F.col("block").alias("__block"), "bits") for i, (_, f) in enumerate(self.filters)])
        tested = found.select(*KEY, page_hash().alias("h"))
        where = F.array(*[F.struct(F.lit(i).alias("__filter"), block_of(F.col("h"), F.lit(blocks)).alias("__block")) for i, (blocks, _) in enumerate(self.filters)])
        tested = tested.select(*KEY, "h", F.inline(where)).join(filters, ["__filter", "__block"])
        # Most links are refuted by the first bit or two; the others are not looked at then, nor is a block copied for a link.
        hit = reduce(Column.__and__, [is_set(F.col("bits"), at) for at in probes(F.col("h"))])
        hits = tested.filter(hit).select(*KEY).distinct().withColumn("maybe", F.lit(True))
        return found.join(hits, KEY, "left").withColumn("maybe", F.coalesce("maybe", F.lit(False)))

    def lookup(self, parts: list[int]) -> DataFrame:
        """The pages of some partitions."""
        return reduce(DataFrame.unionAll, [s.filter(F.col("part").isin(parts)).select(*KEY) for s in self.segments])

    def new(self, found: DataFrame, name: str) -> DataFrame:
        """The rows of ``found``, distinct in (root_ord, page_url), that are not in the set."""
        # Links are found once: testing them reads them twice.
        if self.filters:
            found = materialize(found, self.folder, f"{name}_found")
        tested = materialize(self.maybe(found), self.folder, name)
        fresh, maybes = tested.filter("not maybe").drop("maybe"), tested.filter("maybe").drop("maybe")
        parts = sorted(r.part for r in maybes.select(self.part().alias("part")).distinct().collect())
        return fresh.unionByName(maybes.join(self.lookup(parts), KEY, "left_anti")) if parts else fresh
