"""T5: rule-based seeds from the cards of a page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsieve import constants as C
from jobsieve.functions.text import once, title_or
from jobsieve.functions.urls import (
    host_is_blocked,
    host_within,
    is_ats,
    is_attachment,
    is_bad_url,
    is_profile_url,
    normalize_domain,
    normalize_url,
    url_host,
)
from jobsieve.operators.dedupe import dedupe_card_seeds


def card_rows(pages: DataFrame, groups: list[str]) -> DataFrame:
    """Pages with ``cards`` -> one row per card with its position ``seed_ord``."""
    return pages.select(*groups, F.posexplode("cards").alias("seed_ord", "card")).select(*groups, "seed_ord", "card.*")


def card_seeds(cards: DataFrame, groups: list[str]) -> DataFrame:
    """Cards (with ``page_url`` and ``company_domain`` among the groups) -> seeds.

    Cards carry ``heading`` and ``location``, what their block of text says, instead of the block. A card without a title that looks like one, or with a URL that leads elsewhere, gives no seed.
    A document URL is blanked and the seed kept.
    """
    cards = once(cards, href_url=normalize_url(F.col("href")))
    url = F.col("href_url")
    cards = once(cards, href_host=url_host(url), href_ats=is_ats(url))
    own = host_within(F.col("href_host"), normalize_domain(F.col("company_domain"))) | F.col("href_ats")
    leads_elsewhere = host_is_blocked(F.col("href_host")) | is_bad_url(url) | is_profile_url(url) | ~own
    cards = cards.filter((url == "") | ~leads_elsewhere)
    titled = once(cards, job_title=title_or(F.col("card_title"), F.col("link_text"), F.col("heading")))
    seeds = titled.filter(F.col("job_title") != "").select(
        *groups,
        "seed_ord",
        F.lit("rule").alias("origin"),
        F.lit("").alias("company_name"),
        "job_title",
        F.when(is_attachment(url), "").otherwise(url).alias("job_url"),
        F.col("location").alias("job_location"),
        F.lit(C.CARD_SEED_CONFIDENCE).alias("confidence"),
    )
    reason = F.when(F.col("job_url") == "", C.CARD_SEED_REASON_NO_URL).otherwise(C.CARD_SEED_REASON)
    return dedupe_card_seeds(seeds.withColumn("reason", reason), groups, ["seed_ord"])
