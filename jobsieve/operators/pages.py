"""What one page snapshot tells, independent of who links to it: T1, T2, T4 and the text verdicts, and the store these are kept in.

The store is moved and written once: a row per URL with links, cards, flags and texts of both render passes, bucketed and sorted by URL, so that no join on a page's
URL moves it. Of a text there is one copy: samples are cut from it, and a description is written only where it differs from the text of its page. The columns
of the table are read apart, so who asks for flags reads no text. The model's answers about pages are a table of their own, bucketed alike."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsieve import constants as C
from jobsieve.functions.text import (
    any_of,
    has_board_signal,
    has_retry_signal,
    heading_title,
    location_from_text,
    normalize_text,
    once,
    present,
    strip,
    text,
    with_description,
)
from jobsieve.functions.urls import (
    host_is_blocked,
    host_within,
    is_ats,
    is_attachment,
    is_bad_url,
    normalize_domain,
    normalize_url,
    url_host,
)
from jobsieve.operators.answers import JOB_FIELDS, answer_text, refuses
from jobsieve.operators.html import extract_pages
from jobsieve.sources.files import bucketed

PASSES = (0, 1)
FACTS = [
    "fetch_ok", "final_url", "has_text", "real_description", "apply_only", "board_signal", "retry_signal", "posted_date", "posted_date_source", "links", "cards",
]
#: What is written of a page and pass.
NARROW = [*FACTS, "body_text", "own_description"]
#: The texts of a pass as they are read.
WIDE = ["body_text", "description"]


@dataclass
class PageStore:
    """``narrow``: url, p0 and p1 (facts of the two passes). ``wide``: url, t0 and t1 (texts). ``samples``: url, s0 and s1 (beginnings of the texts). All three read
    the same files. ``answers``: url, a_refuses and a_* (what the model said about the page)."""

    narrow: DataFrame
    wide: DataFrame
    samples: DataFrame
    answers: DataFrame


def block_facts(blocks: Column) -> Column:
    """The digest of each block of text around a card, and what T5 asks of the text."""
    return F.transform(
        blocks, lambda b: F.struct(F.md5(b.cast("binary")).alias("digest"), heading_title(b).alias("heading"), location_from_text(b).alias("location"))
    )


def cards_by_digest(cards: Column, facts: Column) -> Column:
    """Cards with the digest of their block instead of its text, first copies in document order."""
    return F.array_distinct(F.transform(
        cards,
        lambda c: F.struct(
            c["href"].alias("href"), strip(c["link_text"]).alias("link_text"), strip(c["card_title"]).alias("card_title"), F.get(facts, c["block"]).alias("b")
        ),
    ))


def cards_with_text(cards: Column, blocks: Column) -> Column:
    """T1 for prompts: cards with the text around them, first copies in document order."""
    return F.array_distinct(F.transform(
        cards,
        lambda c: F.struct(
            c["href"].alias("href"), strip(c["link_text"]).alias("link_text"), F.get(blocks, c["block"]).alias("nearby_text"), strip(c["card_title"]).alias("card_title")
        ),
    ))


def flat_cards(cards: Column) -> Column:
    return F.transform(cards, lambda c: F.struct(
        c["href"], c["link_text"], c["card_title"], c["b"]["digest"].alias("digest"), c["b"]["heading"].alias("heading"), c["b"]["location"].alias("location")
    ))


def with_cards(pages: DataFrame) -> DataFrame:
    """Extracted pages with ``cards`` as (href, link_text, card_title, digest, heading, location)."""
    pages = once(pages, __blocks=block_facts(F.col("blocks")))
    return pages.withColumn("cards", flat_cards(cards_by_digest(F.col("cards"), F.col("__blocks")))).drop("__blocks")


def block_store(pages: DataFrame) -> DataFrame:
    """(digest, nearby_text): one row per distinct block of all extracted pages."""
    blocks = pages.select(F.explode("blocks").alias("nearby_text")).withColumn("digest", F.md5(F.col("nearby_text").cast("binary")))
    return blocks.groupBy("digest").agg(F.min("nearby_text").alias("nearby_text"))


def follow_links(links: Column) -> Column:
    """T2 and P13 without the company test: links worth following, each with its host and ATS flag."""
    hrefs = F.transform(
        links,
        lambda x: F.struct(normalize_url(x["href"]).alias("href"), F.concat_ws(" ", strip(x["text"]), strip(x["outer_html"])).alias("words")),
    )
    hrefs = F.filter(hrefs, lambda x: F.startswith(x["href"], F.lit("http")) & ~is_bad_url(x["href"]) & ~is_attachment(x["href"]))
    seen = F.transform(
        hrefs,
        lambda x: F.struct(x["href"], url_host(x["href"]).alias("host"), is_ats(x["href"]).alias("ats"), x["words"]),
    )
    kept = F.filter(
        seen,
        lambda x: ~host_is_blocked(x["host"]) & (x["ats"] | F.rlike(normalize_text(x["words"]), F.lit(any_of(C.NEXT_PAGE_KEYWORDS)))),
    )
    return F.transform(kept, lambda x: F.struct(x["href"], x["host"], x["ats"]))


def next_pages(links: Column, company_domain: Column, n: int | None = None) -> Column:
    """T2, D5 and, where asked for, L1: the links of one page that a company may follow, first copies, in document order."""
    # The outer one-element array holds the normalized domain, which a lambda would recompute for every link.
    own = F.transform(
        F.array(normalize_domain(company_domain)),
        lambda domain: F.filter(links, lambda x: x["ats"] | host_within(x["host"], domain)),
    )
    found = F.array_distinct(F.transform(F.get(own, F.lit(0)), lambda x: x["href"]))
    return found if n is None else F.slice(found, 1, n)


def lowered_page(body_text: Column) -> Column:
    """N1 of a page text, which has no whitespace runs any more."""
    return F.trim(F.lower(body_text))


def first_date(dates: Column, field: str) -> Column:
    """T4."""
    return F.coalesce(F.try_element_at(dates, F.lit(1))[field], F.lit(""))


def link_facts(snapshots: DataFrame) -> DataFrame:
    """What T2 and T9 ask of a page, without any work on its text."""
    pages = extract_pages(snapshots).select(normalize_url(F.col("url")).alias("url"), "render_pass", "fetch_ok", F.col("links").alias("__links"))
    return once(pages, links=follow_links(F.col("__links"))).drop("__links")


def page_facts(
    snapshots: DataFrame,
    min_chars: int = C.MIN_DESCRIPTION_CHARS,
    max_chars: int | None = None,
) -> DataFrame:
    """One row per snapshot with everything later stages ask of a page."""
    pages = extract_pages(snapshots).withColumnRenamed("url", "raw_url")
    pages = pages.withColumn("url", normalize_url(F.col("raw_url"))).withColumn("final_url", normalize_url(F.col("final_url")))
    # The extractor already collapsed the text.
    pages = with_description(once(pages, __nt=text(lowered_page(F.col("body_text")))), "body_text", min_chars, max_chars, collapsed=True, lowered="__nt")
    pages = with_cards(pages)
    return pages.select(
        "raw_url",
        "url",
        "render_pass",
        "final_url",
        "fetch_ok",
        "body_text",
        "description",
        "real_description",
        "apply_only",
        (F.col("__nt") != "").alias("has_text"),
        has_board_signal(F.col("__nt")).alias("board_signal"),
        has_retry_signal(F.col("__nt")).alias("retry_signal"),
        F.left("body_text", F.lit(C.JOB_SAMPLE_CHARS)).alias("sample"),
        follow_links(F.col("links")).alias("links"),
        "cards",
        first_date(F.col("dates"), "date").alias("posted_date"),
        first_date(F.col("dates"), "source").alias("posted_date_source"),
    )


def by_url(facts: DataFrame, columns: list[str], prefix: str) -> DataFrame:
    """One row per URL with a struct per pass. Of repeated snapshots of one page and pass, one that was fetched counts, then one under the normalized URL,
    then by content."""
    order = F.struct(
        (~F.col("fetch_ok")).alias("a"), (F.col("raw_url") != F.col("url")).alias("b"), F.col("raw_url").alias("c"), F.xxhash64("final_url", "sample", "posted_date").alias("d")
    )
    picks = [F.min_by(F.struct(*columns), F.when(F.col("render_pass") == p, order)).alias(f"{prefix}{p}") for p in PASSES]
    return facts.groupBy("url").agg(*picks)


def job_answers(narrow: DataFrame, answers: DataFrame) -> DataFrame:
    """J6 for job pages: (url, a_refuses, a_*), the answer about each page that has a real description.

    ``answers`` is (answer_url, render_pass, data) with normalized URLs; a job page is asked for under its final URL on the first pass."""
    p = F.col("p0")
    asked = narrow.filter(p["fetch_ok"] & p["real_description"]).select("url", F.coalesce(present(p["final_url"]), F.col("url")).alias("answer_url"))
    fields = [answer_text(F.col("data"), f).alias(f"a_{f}") for f in JOB_FIELDS]
    return asked.join(answers.filter("render_pass = 0"), "answer_url").select("url", refuses(F.col("data")).alias("a_refuses"), *fields)


def facts_of(p: Column) -> Column:
    """The facts of a written pass and the sample of its text that the trace shows."""
    return F.struct(*[p[f].alias(f) for f in FACTS], F.left(p["body_text"], F.lit(C.PAGE_SAMPLE_CHARS)).alias("page_sample"))


def samples_of(p: Column) -> Column:
    """What the skip log shows of a written pass."""
    samples = {"sample": p["body_text"], "description_sample": description_of(p)}
    return F.struct(p["fetch_ok"].alias("fetch_ok"), *[F.left(x, F.lit(C.JOB_SAMPLE_CHARS)).alias(f) for f, x in samples.items()])


def description_of(p: Column) -> Column:
    return F.coalesce(p["own_description"], p["body_text"])


def texts_of(p: Column) -> Column:
    return F.struct(*[x.alias(f) for f, x in zip(WIDE, (p["body_text"], description_of(p)))])


def page_store(facts: DataFrame, answers: DataFrame, folder: str) -> PageStore:
    """Write the store. ``facts`` may have several rows per page; ``answers`` are those of stage 'job'."""
    own = F.when(F.col("description") == F.col("body_text"), F.lit(None).cast("string")).otherwise(F.col("description"))
    stored = bucketed(by_url(facts.withColumn("own_description", own), NARROW, "p"), folder, "pages", "url")

    def read(prefix: str, of: Callable[[Column], Column]) -> DataFrame:
        return stored.select("url", *[of(F.col(f"p{p}")).alias(f"{prefix}{p}") for p in PASSES])

    # Whom the model was asked about takes three short fields.
    asked = stored.select("url", F.struct(*[F.col(f"p0.{f}").alias(f) for f in ("fetch_ok", "final_url", "real_description")]).alias("p0"))
    return PageStore(read("p", facts_of), read("t", texts_of), read("s", samples_of), bucketed(job_answers(asked, answers), folder, "page_answers", "url"))


def of_pass(prefix: str, field: str, render_pass: Column | None = None) -> Column:
    """A field of the store's facts in the row's pass."""
    own = F.col("render_pass") if render_pass is None else render_pass
    return F.when(own == 0, F.col(f"{prefix}0.{field}")).otherwise(F.col(f"{prefix}1.{field}"))
