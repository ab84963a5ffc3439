"""Page snapshots, one row per page and render pass, kept current by deliveries.

The store is partitioned by a hash of the page's normalized URL. A delivery is merged by rewriting only the partitions it touches; all
others keep their files. Merging a delivery twice changes nothing, so a merge that broke off can simply be repeated."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsieve.functions.urls import normalize_url
from jobsieve.sources.files import materialize, stage_dir

SNAPSHOT_SCHEMA = "url string, render_pass int, final_url string, html string, body_text string, fetch_ok boolean"
COLUMNS = ["url", "render_pass", "final_url", "html", "body_text", "fetch_ok"]
STORE_SCHEMA = f"{SNAPSHOT_SCHEMA}, delivery bigint, part int"


def precedence(delivery: Column | None = None) -> Column:
    """Of snapshots of one page and pass the least of these counts: the latest delivery, then one that was fetched, then one under the normalized
    URL itself, then by content."""
    newest = -F.coalesce(delivery, F.lit(0)) if delivery is not None else F.lit(0)
    url = F.coalesce("url", F.lit(""))
    content = F.xxhash64("final_url", "html", "body_text")
    return F.struct(newest.cast("bigint").alias("a"), (~F.coalesce("fetch_ok", F.lit(False))).alias("b"), (url != normalize_url(url)).alias("c"), url.alias("d"), content.alias("e"))


def one_per_page(snapshots: DataFrame, delivery: str | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows under their normalized URLs, one per URL and pass. Which one counts is decided on short columns."""
    order = precedence(F.col(delivery) if delivery else None)
    keyed = snapshots.withColumn("__key", normalize_url(F.col("url"))).withColumn("render_pass", F.coalesce("render_pass", F.lit(0)))
    whole = F.struct(*[c for c in COLUMNS if c not in ("url", "render_pass")], *extra)
    kept = keyed.groupBy("__key", "render_pass").agg(F.min_by(whole, order).alias("__row"))
    return kept.select(F.col("__key").alias("url"), "render_pass", "__row.*").select(*COLUMNS, *extra)


def part_of(url: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(parts)).cast("int")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """All snapshots of the store with their ``delivery``; empty where there is none."""
    try:
        return spark.read.schema(STORE_SCHEMA).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], STORE_SCHEMA)
        raise


def merge(spark: SparkSession, path: str, snapshots: DataFrame, delivery: int, parts: int = 256) -> list[int]:
    """Merge a delivery into the store at ``path`` and return the partitions that were written, at most ``parts`` numbers.

    ``parts`` must stay what it was at the first delivery. The new state of the touched partitions is written aside first, so that the store is
    complete again as soon as a repeated merge has ended, wherever the first one broke off."""
    folder = stage_dir(spark)
    fresh = snapshots.select(*COLUMNS, F.lit(delivery).cast("bigint").alias("delivery"))
    fresh = fresh.withColumn("part", part_of(normalize_url(F.col("url")), parts))
    fresh = materialize(fresh, folder, "delivery")
    touched = sorted(r.part for r in fresh.select("part").distinct().collect())
    held = read_store(spark, path).filter(F.col("part").isin(touched))
    kept = one_per_page(held.unionByName(fresh), "delivery", ("delivery",))
    kept = materialize(kept.withColumn("part", part_of(F.col("url"), parts)), folder, "merged")
    kept.repartition("part").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
    return touched
