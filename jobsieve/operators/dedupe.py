"""Ordered first-wins de-duplication (D1-D6) and ordered caps (L1, L2).

``row_number() <= n`` lets Spark keep only the first n rows of a group in every map task before the
shuffle (WindowGroupLimit), so a group holding a third of all rows reaches its task as at most
n rows per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsieve import constants as C
from jobsieve.functions.text import normalize_text, present
from jobsieve.functions.urls import is_bad_url, is_profile_url, normalize_domain, normalize_url


def first_per_group(df: DataFrame, groups: list[Column], order: list[str], n: int = 1) -> DataFrame:
    """L1: the first n rows of each group."""
    window = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") <= n).drop("__rank")


def ordered_distinct(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key with the smallest order value."""
    return df.groupBy(key).agg(F.min(order).alias(order))


def first_n(df: DataFrame, order: list[str], n: int | None = None) -> DataFrame:
    """L2: global ordered cap, where one is asked for."""
    return df.orderBy(*order).limit(n) if n else df


def job_key(job_url: Column, company_domain: Column, job_title: Column) -> Column:
    by_title = F.concat_ws("|", normalize_domain(company_domain), normalize_text(job_title))
    return F.coalesce(present(normalize_url(job_url)), by_title)


def dedupe_jobs(jobs: DataFrame, order: list[str]) -> DataFrame:
    """D1."""
    keyed = jobs.withColumn("__key", job_key(F.col("job_url"), F.col("company_domain"), F.col("job_title")))
    return first_per_group(keyed, [F.col("__key")], order).drop("__key")


def dedupe_card_seeds(seeds: DataFrame, groups: list[str], order: list[str]) -> DataFrame:
    """D3: one seed per title and URL of a page; seeds without a URL go by the page's."""
    keyed = seeds.withColumn("__title", normalize_text(F.col("job_title"))).withColumn(
        "__url", F.coalesce(present(F.col("job_url")), F.col("page_url"))
    )
    keys = [F.col(c) for c in (*groups, "__title", "__url")]
    return first_per_group(keyed, keys, order).drop("__title", "__url")


def merge_seeds(seeds: DataFrame, groups: list[str]) -> DataFrame:
    """Rule seeds before model seeds, one per title and URL of a page.

    Expects ``origin`` ('rule' or 'llm') and ``seed_ord``. Seeds without a title go; URLs of legal,
    news and profile pages are blanked before the key is built. The result is ordered by
    ``(origin_rank, seed_ord)``.
    """
    url = normalize_url(F.col("job_url"))
    keyed = (
        seeds.withColumn("__title", normalize_text(F.col("job_title")))
        .filter(F.col("__title") != "")
        .withColumn("origin_rank", F.when(F.col("origin") == "rule", 0).otherwise(1))
        .withColumn("job_url", F.when(is_bad_url(url) | is_profile_url(url), "").otherwise(F.col("job_url")))
        .withColumn("__url", normalize_url(F.col("job_url")))
    )
    keys = [F.col(c) for c in (*groups, "__title", "__url")]
    return first_per_group(keyed, keys, ["origin_rank", "seed_ord"]).drop("__title", "__url")


def cap_seeds(seeds: DataFrame, groups: list[str], n: int | None = None) -> DataFrame:
    """L1 on merged seeds, where a cap is asked for."""
    return first_per_group(seeds, [F.col(g) for g in groups], ["origin_rank", "seed_ord"], n) if n else seeds


def distinct_titles(seeds: DataFrame, groups: list[str]) -> DataFrame:
    """A1, the count: distinct non-empty titles per page. Partial counts run per page and title first."""
    title = present(normalize_text(F.col("job_title")))
    return seeds.groupBy(*groups).agg(F.countDistinct(title).cast("int").alias("title_count"))


def is_large_board(title_count: Column, board_signal: Column) -> Column:
    """A1, the verdict."""
    return (title_count >= C.BOARD_MIN_TITLES) | ((title_count >= C.BOARD_MIN_TITLES_WITH_SIGNAL) & board_signal)
