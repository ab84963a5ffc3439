"""A3: what became of every page, without rows that grow with a page.

The items of a page (seeds, jobs, refusals, cards, links) are cut into parts by the running sum of their bytes, each kind on its own, and the
part's number is a part of the row's key. Descriptions stay in the page store; jobs name where."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobsieve import constants as C
from jobsieve.operators.answers import SEED_FIELDS
from jobsieve.operators.classify import VISIT, with_samples
from jobsieve.operators.pages import PageStore

#: A part closes with the item that reaches so many bytes of its kind.
PART_BYTES = 1 << 20
KINDS = ["job_seeds", "jobs", "skipped_jobs", "cards", "next_pages"]
JOB_FIELDS = [c for c in C.JOB_COLUMNS if c not in ("job_description", "company_domain", "career_page_url")] + ["text_url", "text_pass"]


def in_parts(items: DataFrame, kind: str, part_bytes: int) -> DataFrame:
    """(VISIT, order, item) -> (VISIT, part, kind): the items in order, in arrays of bounded size."""
    size = F.octet_length(F.to_json(F.struct("item")))
    before = F.sum("__size").over(Window.partitionBy(*VISIT).orderBy("order").rowsBetween(Window.unboundedPreceding, -1))
    numbered = items.withColumn("__size", size).withColumn("part", F.floor(F.coalesce(before, F.lit(0)) / part_bytes).cast("int"))
    listed = F.array_sort(F.collect_list(F.struct("order", "item")))
    return numbered.groupBy(*VISIT, "part").agg(F.transform(listed, lambda x: x["item"]).alias(kind))


def side_by_side(kinds: list[DataFrame]) -> DataFrame:
    """One row per visit and part with the arrays of all kinds."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), kinds)
    return rows.groupBy(*VISIT, "part").agg(*[F.first(k, ignorenulls=True).alias(k) for k in KINDS if k in rows.columns])


def trace_rows(pages: DataFrame, seeds: DataFrame, results: DataFrame, store: PageStore, checked_at: str, source: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """One row per processed page and part, keyed by VISIT and ``part``. ``pages`` is what the crawl opened, ``results`` every classified seed."""
    order = F.struct("origin_rank", "seed_ord").alias("order")
    seed = F.struct(*SEED_FIELDS)
    jobs = results.filter(F.col("skip_reason").isNull()).withColumns(
        {"source": F.lit(source), "checked_at_utc": F.lit(checked_at)}
    )
    lengths = jobs.join(store.wide, F.col("text_url") == F.col("url"), "left")
    described = F.when(F.col("text_pass") == 0, F.col("t0.description")).otherwise(F.col("t1.description"))
    jobs = lengths.select(*jobs.columns, F.length(F.coalesce(described, F.lit(""))).alias("job_description_length"))
    skips = with_samples(results.filter(F.col("skip_reason").isNotNull()), store)
    sample = F.when(F.col("is_early"), F.col("job_page_text_sample")).otherwise("")
    url = F.when(F.col("skip_reason") == C.GATE_NO_URL, "").otherwise(F.col("final_job_url"))
    refused = F.struct(
        F.col("seed_job_title").alias("job_title"), F.col("seed_job_url").alias("job_url"), F.col("skip_reason").alias("reason"), url.alias("final_job_url"),
        sample.alias("job_page_text_sample"),
    )
    items = {
        "job_seeds": seeds.select(*VISIT, order, seed.alias("item")),
        "jobs": jobs.select(*VISIT, order, F.struct(*JOB_FIELDS).alias("item")),
        "skipped_jobs": skips.select(*VISIT, order, refused.alias("item")),
        "cards": pages.select(*VISIT, F.posexplode("cards").alias("order", "item")),
        "next_pages": pages.select(*VISIT, F.posexplode("next_pages").alias("order", "item")),
    }
    parts = side_by_side([in_parts(rows, kind, part_bytes) for kind, rows in items.items()])
    deeper = F.col("render_pass") == 1
    return pages.drop("cards", "next_pages").join(parts, VISIT, "left").select(
        *VISIT,
        F.coalesce("part", F.lit(0)).alias("part"),
        "company_domain",
        F.col("root_url").alias("career_page_url"),
        F.col("page_url").alias("processed_page_url"),
        *[F.coalesce(k, F.array()).alias(k) for k in KINDS],
        F.when(F.col("opened"), "").otherwise(C.PAGE_ERROR).alias("error"),
        deeper.alias("force_deeper"),
        "career_page_text_sample",
        F.when(deeper, C.RETRY_REASON).otherwise("").alias("retry_reason"),
    )
