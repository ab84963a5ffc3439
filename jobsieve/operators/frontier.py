"""Where to start and which pages to visit next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsieve import constants as C
from jobsieve.functions.urls import company_website, is_career_link, normalize_url
from jobsieve.operators.dedupe import first_per_group
from jobsieve.operators.lists import union_all
from jobsieve.operators.pages import next_pages
from jobsieve.operators.visited import Visited
from jobsieve.sources.files import bucketed, stage_dir

VISIT_COLUMNS = ["root_ord", "root_url", "company_domain", "page_ord", "page_url"]


def career_urls(companies: DataFrame, facts: DataFrame, n: int | None = None) -> DataFrame:
    """Add ``career_urls`` to companies (ord, company_domain): links of the home page that look like career
    links, then the usual paths; distinct, in order. Without a home page only the paths remain.

    ``facts`` has url, render_pass, fetch_ok and links, one row per page and pass.
    """
    home = facts.filter((F.col("render_pass") == 0) & F.col("fetch_ok")).select(F.col("url").alias("home_url"), "links")
    site = company_website(F.col("company_domain"))
    # Rows of home pages carry all their links: they are sorted and merged, not sent whole to every task, however small their source is.
    joined = companies.withColumn("home_url", normalize_url(site)).join(home.hint("merge"), "home_url", "left")
    linked = F.filter(next_pages(F.col("links"), F.col("company_domain")), is_career_link)
    paths = F.array(*[F.concat(site, F.lit(p)) for p in C.CAREER_PATHS])
    no_links = F.array().cast("array<string>")
    urls = F.transform(F.concat(F.coalesce(linked, no_links), paths), normalize_url)
    urls = F.array_distinct(F.filter(urls, lambda u: u != ""))
    return joined.select("ord", "company_domain", (urls if n is None else F.slice(urls, 1, n)).alias("career_urls"))


def roots_from_companies(companies: DataFrame, facts: DataFrame, used: int | None = None) -> DataFrame:
    """Discovery: the career URLs of every company, each a root of its own."""
    urls = career_urls(companies, facts, used)
    rows = urls.select("ord", "company_domain", F.posexplode("career_urls").alias("pos", "root_url"))
    # ``ord`` may use all but the sign bit, so the pair is kept as a decimal.
    order = F.col("ord").cast("decimal(20,0)") * 1_000_000 + F.col("pos")
    return rows.select(order.cast("decimal(27,0)").alias("root_ord"), "company_domain", "root_url")


def roots_from_pages(pages: DataFrame) -> DataFrame:
    """Direct mode: every listed career page is a root."""
    return pages.select(
        F.col("ord").cast("decimal(27,0)").alias("root_ord"), "company_domain", F.col("career_page").alias("root_url")
    )


def first_level(roots: DataFrame) -> DataFrame:
    page = normalize_url(F.col("root_url"))
    return roots.select("root_ord", "root_url", "company_domain", F.lit(0).alias("page_ord"), page.alias("page_url")).filter(
        F.col("page_url") != ""
    )


def queued(found: DataFrame, visited: Visited, max_pages: int | None, level: int) -> DataFrame:
    """One step of the traversal (J7, U2): the pages that the last level's pages lead to and that their roots have not queued yet.

    ``found`` holds links, ordered by (page_ord, turn, pos), and ``done``, the number of pages the root has queued so far; it is the next place in its queue.
    Pages beyond the budget are queued too, as not ``visited``: nothing is left out unsaid."""
    first = found.groupBy("root_ord", "page_url").agg(
        F.min(F.struct("page_ord", "turn", "pos")).alias("found_at"),
        *[F.first(c).alias(c) for c in ("root_url", "company_domain", "done")],
    )
    fresh = visited.new(first, f"tested_{level}")
    queue = Window.partitionBy("root_ord").orderBy("found_at")
    ordered = fresh.withColumn("page_ord", (F.col("done") + F.row_number().over(queue) - 1).cast("int"))
    return ordered.select(*VISIT_COLUMNS, within(max_pages).alias("visited"))


def within(max_pages: int | None) -> Column:
    return F.lit(True) if max_pages is None else F.col("page_ord") < max_pages


def with_done(links: DataFrame, level: DataFrame) -> DataFrame:
    """Add ``done`` to the links of a level's pages: pages are numbered in the order of the queue, so the last level tells how many its root has queued."""
    done = level.groupBy("root_ord").agg((F.max("page_ord") + 1).alias("done"))
    return links.join(done, "root_ord")


def traverse(roots: DataFrame, links: DataFrame, max_pages: int | None = None, max_links: int | None = None) -> DataFrame:
    """T10 over a link table (page_url, pos, target): the pages each root queues, in order, and whether they are ``visited`` within the budget.

    One round of joins per level. Links are written once, bucketed by page, so that a level moves its pages only; each level is written as a segment of
    the visited pages, so the plan does not grow.
    """
    spark = roots.sparkSession
    folder = stage_dir(spark)
    links = links.select("page_url", "pos", normalize_url(F.col("target")).alias("target"))
    if max_links:
        links = first_per_group(links, [F.col("page_url")], ["pos"], max_links)
    links = bucketed(links.withColumnRenamed("page_url", "__from"), folder, "links", "__from")
    visited, levels = Visited(spark, folder), []
    level, _ = visited.add(first_level(roots).withColumn("visited", within(max_pages)))
    while True:
        levels.append(level)
        found = with_done(level.filter("visited"), level).join(links, F.col("page_url") == F.col("__from")).select(
            "root_ord", "root_url", "company_domain", "page_ord", "done", F.lit(0).alias("turn"), "pos", F.col("target").alias("page_url")
        )
        level, n = visited.add(queued(found, visited, max_pages, len(levels)))
        if not n:
            return union_all(levels)
