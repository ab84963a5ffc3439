"""The whole job, from input tables to jobs, skip log and trace."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsieve import constants as C
from jobsieve.functions.text import once, text
from jobsieve.operators.answers import answer_seeds, answers_of
from jobsieve.operators.classify import PAGE_FLAGS, PAGE_GROUPS, VISIT, classify, job_rows, skip_rows
from jobsieve.operators.dedupe import cap_seeds, dedupe_jobs, first_n, merge_seeds
from jobsieve.operators.frontier import VISIT_COLUMNS, first_level, queued, roots_from_companies, roots_from_pages, with_done, within
from jobsieve.operators.keywords import keyword_index
from jobsieve.operators.lists import key_flags, union_all
from jobsieve.operators.pages import PASSES, PageStore, next_pages, page_facts, page_store
from jobsieve.operators.seeds import card_rows, card_seeds
from jobsieve.operators.trace import trace_rows
from jobsieve.operators.visited import Visited
from jobsieve.sources.files import bucketed, materialize, stage_dir

ROW_ORDER = ["root_ord", "page_ord", "render_pass", "origin_rank", "seed_ord"]


@dataclass
class Limits:
    """Nothing is cut unless a limit is given."""

    max_jobs: int | None = None
    max_seeds: int | None = None
    max_pages: int | None = None
    max_links: int | None = None
    max_roots: int | None = None
    min_description: int = C.MIN_DESCRIPTION_CHARS
    max_description: int | None = None


@dataclass
class Inputs:
    """Pages or companies to start from (both with ``ord``), snapshots, model answers, list keys, keywords."""

    snapshots: DataFrame
    answers: DataFrame
    keys: DataFrame
    keywords: DataFrame
    career_pages: DataFrame | None = None
    companies: DataFrame | None = None


@dataclass
class Outputs:
    """``unvisited`` are pages that were found when their root's budget was used up."""

    jobs: DataFrame
    skipped: DataFrame
    trace: DataFrame
    unvisited: DataFrame


def choose_roots(inputs: Inputs, store: PageStore, max_roots: int | None = None) -> DataFrame:
    """Listed career pages when there are any, else career URLs of the companies (at most ``max_roots`` each, where given)."""
    if inputs.career_pages is not None and not inputs.career_pages.isEmpty():
        return roots_from_pages(inputs.career_pages)
    if inputs.companies is None:
        raise ValueError("neither career pages nor companies given")
    homes = store.narrow.select("url", F.lit(0).alias("render_pass"), F.col("p0.fetch_ok").alias("fetch_ok"), F.col("p0.links").alias("links"))
    return roots_from_companies(inputs.companies, homes, max_roots)


def open_pages(visits: DataFrame, store: PageStore, max_links: int | None = None) -> DataFrame:
    """Visited pages per pass with what seeds, verdicts, trace and traversal need; ``opened`` tells if there is a snapshot. The store is joined once for both passes.

    ``hopeful`` first passes seem to have jobs; ``deep`` ones of them have a snapshot of the deeper pass, too."""
    facts = ["links", "cards", "retry_signal", "page_sample", *PAGE_FLAGS]
    joined = visits.join(store.narrow, F.col("page_url") == F.col("url"), "left")
    per_pass = F.array(*[
        F.struct(F.lit(p).alias("render_pass"), F.coalesce(F.col(f"p{p}.fetch_ok"), F.lit(False)).alias("opened"), *[F.col(f"p{p}.{f}").alias(f) for f in facts])
        for p in PASSES
    ])
    rows = joined.select(*VISIT_COLUMNS, F.coalesce("p1.fetch_ok", F.lit(False)).alias("deeper"), F.inline(per_pass))
    rows = rows.withColumns({f: F.when(F.col("opened"), F.col(f)) for f in facts})
    rows = once(rows, next_pages=next_pages(F.coalesce("links", F.array()), F.col("company_domain"), max_links))
    hopeful = (F.col("render_pass") == 0) & (F.coalesce("retry_signal", F.lit(False)) | (F.size("next_pages") > 0))
    return rows.select(
        *PAGE_GROUPS,
        "opened",
        hopeful.alias("hopeful"),
        (hopeful & F.col("deeper")).alias("deep"),
        *[F.coalesce(f, F.lit(False)).alias(f) for f in PAGE_FLAGS],
        "next_pages",
        text(F.col("page_sample")).alias("career_page_text_sample"),
        F.coalesce("cards", F.array()).alias("cards"),
    )


def retried(pages: DataFrame, results: DataFrame) -> DataFrame:
    """C4: the deeper passes that count: of pages where the first pass kept no job although there seem to be some."""
    productive = results.filter("skip_reason is null and render_pass = 0").select("root_ord", "page_ord").distinct()
    again = pages.filter(F.col("hopeful")).select("root_ord", "page_ord").join(productive, ["root_ord", "page_ord"], "left_anti")
    return pages.filter("render_pass = 1").join(again, ["root_ord", "page_ord"], "left_semi")


def page_seeds(pages: DataFrame, model_seeds: DataFrame) -> DataFrame:
    """Merged seeds of opened pages, by rule from their cards and by the model's answer for the same pass."""
    by_rule = card_seeds(card_rows(pages, PAGE_GROUPS), PAGE_GROUPS)
    answered = model_seeds.withColumnsRenamed({"answer_url": "__url", "render_pass": "__pass"})
    own = (F.col("page_url") == F.col("__url")) & (F.col("render_pass") == F.col("__pass"))
    by_model = pages.filter("opened").select(*PAGE_GROUPS).join(answered, own).drop("__url", "__pass")
    return merge_seeds(by_rule.unionByName(by_model), PAGE_GROUPS)


def card_titles(store: PageStore) -> DataFrame:
    """What cards of all pages call their jobs, to tell rare pieces of titles from frequent ones."""
    cards = store.narrow.select(F.explode(F.concat(*[F.coalesce(F.col(f"p{p}.cards"), F.array()) for p in PASSES])).alias("c"))
    return cards.select(F.explode(F.array("c.card_title", "c.link_text", "c.heading")).alias("job_title"))


def run(inputs: Inputs, checked_at: str, limits: Limits | None = None, source: str = C.SOURCE_LABEL) -> Outputs:
    """C6. Stages are written to the shared folder: the page store once, pages per level, seeds and results.

    Where to go next depends on verdicts only for pages that have a deeper snapshot: their first pass is classified level by level, all other
    pages in one go at the end. The driver only steers: it starts one round of jobs per traversal level and asks whether these pages and the next level are empty.
    """
    limits = limits or Limits()
    spark = inputs.snapshots.sparkSession
    folder = stage_dir(spark)

    def keep(df: DataFrame, name: str) -> DataFrame:
        return materialize(df, folder, name)

    facts = page_facts(inputs.snapshots, limits.min_description, limits.max_description)
    store = page_store(facts, answers_of(inputs.answers, "job"), folder)
    model_seeds = bucketed(answer_seeds(answers_of(inputs.answers, "career"), ["answer_url", "render_pass"]), folder, "model_seeds", "answer_url")
    flags, index = keep(key_flags(inputs.keys), "list_flags"), keep(keyword_index(inputs.keywords, card_titles(store)), "keyword_index")
    all_seeds, all_results = [], []

    def classified(pages: DataFrame, name: str) -> DataFrame:
        seeds = keep(page_seeds(pages, model_seeds), f"seeds_{name}")
        capped = cap_seeds(seeds, PAGE_GROUPS, limits.max_seeds)
        page_flags = pages.filter("opened").select(*VISIT, "page_url", *PAGE_FLAGS)
        written = classify(
            capped, page_flags, store, flags, index, lambda df: keep(df, f"resolved_{name}"), lambda df, what: keep(df, f"{what}_{name}")
        )
        results = keep(written, f"results_{name}")
        all_seeds.append(seeds)
        all_results.append(results)
        return results

    levels, opened_pages, deeper = [], [], []
    visited = Visited(spark, folder)
    level, _ = visited.add(first_level(choose_roots(inputs, store, limits.max_roots)).withColumn("visited", within(limits.max_pages)))
    while True:
        number = len(levels)
        levels.append(level)
        opened = keep(open_pages(level.filter("visited"), store, limits.max_links), f"opened_{number}")
        opened_pages.append(opened)
        sources = [opened.filter("render_pass = 0")]
        deep = opened.filter("deep")
        if not deep.isEmpty():
            again = keep(retried(opened.filter("deep or render_pass = 1"), classified(deep, f"deep_{number}")), f"retried_{number}")
            deeper.append(again)
            sources.append(again)
        links = union_all(sources).select(
            "root_ord", "root_url", "company_domain", "page_ord", F.when(F.col("render_pass") == 1, 0).otherwise(1).alias("turn"),
            F.posexplode("next_pages").alias("pos", "page_url"),
        )
        level, n = visited.add(queued(with_done(links, level), visited, limits.max_pages, number))
        if not n:
            break

    opened = union_all(opened_pages)
    rest = classified(union_all([opened.filter("render_pass = 0 and not deep"), *deeper]), "rest")
    # Deeper passes without a snapshot have nothing to classify; the trace says that they could not be opened.
    missing = keep(retried(opened.filter("not deep"), rest), "missing")
    pages = union_all([opened.filter("render_pass = 0"), *deeper, missing])
    seeds, results = union_all(all_seeds), union_all(all_results)
    kept = dedupe_jobs(results.filter(F.col("skip_reason").isNull()), ROW_ORDER)
    kept = first_n(kept, ROW_ORDER, limits.max_jobs)
    jobs = job_rows(kept, store, checked_at, source, tuple(ROW_ORDER))
    return Outputs(
        jobs=jobs.orderBy(*ROW_ORDER).select(*C.JOB_COLUMNS),
        skipped=skip_rows(results, store, checked_at),
        trace=trace_rows(pages, seeds, results, store, checked_at, source),
        unvisited=union_all(levels).filter("not visited"),
    )
