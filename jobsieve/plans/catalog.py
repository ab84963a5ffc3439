"""Named queries over the test tables, one or more per operator of the inventory."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsieve import constants as C
from jobsieve.functions import text as T
from jobsieve.functions import urls as U
from jobsieve.operators import answers as A
from jobsieve.operators import classify as K
from jobsieve.operators import dedupe as D
from jobsieve.operators import frontier as R
from jobsieve.operators import lists as L
from jobsieve.operators import pages as P
from jobsieve.operators import seeds as S
from jobsieve.operators.html import extract_pages
from jobsieve.operators import keywords as W
from jobsieve.plans import crawl, derived, sites
from jobsieve.sources import files, snapshots

CHECKED_AT = "2024-01-01T00:00:00+00:00"


class Tables:
    """The test tables of one folder as views, and the tables derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def folder(self) -> str:
        return files.stage_dir(self.spark)

    def sql(self, query: str) -> DataFrame:
        for name in derived.TABLES:
            if re.search(rf"\b{name}\b", query):
                self.read(name).createOrReplaceTempView(name)
        return self.spark.sql(query)

    def keys(self) -> DataFrame:
        return L.list_keys(self.sql(derived.LIST_ROWS))

    def flags(self) -> DataFrame:
        return files.materialize(L.key_flags(self.keys()), self.folder(), "flags")

    def index(self, titles: DataFrame, keywords: str = derived.KEYWORDS) -> DataFrame:
        """Written, so that joins know how small it is: titles then meet it without a copy of each per piece being moved."""
        return files.materialize(W.keyword_index(self.sql(keywords), titles), self.folder(), "keyword_index")

    def job_pages(self) -> DataFrame:
        return self.sql(derived.JOB_PAGES)


# --- scalar columns ------------------------------------------------------------------------------


def normalize_keys(t: Tables) -> DataFrame:
    companies = t.sql(derived.COMPANIES).select(
        F.lit("company").alias("src"), F.col("cid").alias("id"), F.col("company_website").alias("raw"), F.col("company_name").alias("name")
    )
    pages = t.read("pages").select(F.lit("page").alias("src"), F.col("page_id").alias("id"), F.col("url").alias("raw"), F.lit(None).cast("string").alias("name"))
    raw, name = F.col("raw"), F.col("name")
    return companies.unionByName(pages).select(
        "src",
        "id",
        T.normalize_text(raw).alias("nt"),
        T.normalize_text(name).alias("nt_name"),
        U.normalize_domain(raw).alias("domain"),
        U.normalize_url(raw).alias("url"),
        U.company_website(raw).alias("website"),
        U.url_host(raw).alias("host"),
        U.with_scheme(raw).alias("schemed"),
        D.job_key(F.when(F.col("src") == "page", raw), raw, name).alias("job_key"),
    )


def url_flags(t: Tables) -> DataFrame:
    jobs = t.job_pages().select(F.lit("job").alias("src"), F.col("doc_id").alias("id"), F.col("job_url").alias("url"), "company_domain")
    pages = t.read("pages").select(F.lit("page").alias("src"), F.col("page_id").alias("id"), "url", F.lit("example.com").alias("company_domain"))
    url = F.col("url")
    return jobs.unionByName(pages).select(
        "src",
        "id",
        U.same_or_subdomain(url, F.col("company_domain")).alias("own"),
        U.is_attachment(url).alias("attachment"),
        U.is_ats(url).alias("ats"),
        U.is_blocked_board(url).alias("blocked"),
        U.is_bad_url(url).alias("bad"),
        U.is_profile_url(url).alias("profile"),
        U.is_career_link(url).alias("career"),
    )


def clean_description(t: Tables) -> DataFrame:
    df = T.with_description(t.job_pages(), "page_text")
    return df.select(
        "doc_id",
        T.clean_page_text(F.col("page_text")).alias("page_text"),
        "description",
        F.length("description").alias("description_length"),
    )


def signal_counts(t: Tables) -> DataFrame:
    df = T.once(T.with_description(t.job_pages(), "page_text"), nt=T.normalize_text(F.col("page_text")))
    nt = F.col("nt")
    return df.select(
        "doc_id",
        T.description_signals(nt).alias("n_describe"),
        T.apply_signals(nt).alias("n_apply"),
        T.is_closed(nt).alias("closed"),
        T.is_apply_only(nt).alias("apply_only"),
        T.has_retry_signal(nt).alias("retry_signal"),
        F.col("real_description"),
    )


def title_screen(t: Tables) -> DataFrame:
    jobs = t.job_pages().select("doc_id", "job_title")
    df = W.with_keyword_hit(jobs, t.index(jobs), ids=("doc_id",))
    return df.select("doc_id", T.looks_like_title(F.col("job_title")).alias("is_title"), "has_keyword")


def keyword_index(t: Tables) -> DataFrame:
    """Documents' first words as titles, against some hundred keywords drawn from the parts' names."""
    titles = t.read("documents").select("doc_id", F.substring_index("text", " ", 12).alias("job_title"))
    hits = W.with_keyword_hit(titles, t.index(titles, derived.MANY_KEYWORDS), ids=("doc_id",))
    return hits.select("doc_id", "has_keyword")


def location_from_text(t: Tables) -> DataFrame:
    return t.job_pages().select("doc_id", T.location_from_text(F.col("page_text")).alias("location"))


def headings(t: Tables) -> DataFrame:
    cards = t.sql(derived.CARDS).select(F.lit("card").alias("src"), F.col("card_ord").cast("bigint").alias("id"), "card_title", "link_text", "nearby_text")
    docs = t.read("documents").select(
        F.lit("document").alias("src"), F.col("doc_id").alias("id"), F.lit("").alias("card_title"), F.lit("").alias("link_text"), F.col("text").alias("nearby_text")
    )
    return cards.unionByName(docs).select(
        "src",
        "id",
        F.array_join(T.headings(F.col("nearby_text")), "|").alias("headings"),
        T.best_title(F.col("card_title"), F.col("link_text"), F.col("nearby_text")).alias("title"),
    )


# --- lists, screening, de-duplication ------------------------------------------------------------


def list_counts(t: Tables) -> DataFrame:
    return L.key_counts(t.keys())


def list_membership(t: Tables) -> DataFrame:
    jobs = t.job_pages().select("doc_id", "company_domain", "company_name", "job_url")
    df = L.with_list_flags(jobs, t.flags(), ("doc_id",), url="job_url")
    return df.select("doc_id", *[f"on_{n}" for n in L.LISTS], "on_active_url")


def screen_jobs(t: Tables) -> DataFrame:
    """The flagship: page texts -> URL gates, description gate, list screening, labels, first per key."""
    url = F.col("job_url")
    jobs = t.job_pages().filter(~U.is_bad_url(url) & ~U.is_blocked_board(url) & ~U.is_profile_url(url))
    jobs = T.with_description(jobs, "page_text").filter("real_description").drop("page_text")
    jobs = jobs.withColumn("job_description_length", F.length("description")).drop("description")
    jobs = L.with_screening(jobs, t.flags(), t.index(t.job_pages()), ("doc_id",)).filter(~F.col("is_removed"))
    return D.dedupe_jobs(jobs, ["doc_id"]).select(
        "doc_id", F.col("list_label").alias("List"), "company_domain", "company_name", "job_title",
        U.normalize_url(F.col("job_url")).alias("job_url"), "job_description_length",
    )


def first_jobs(t: Tables) -> DataFrame:
    """The flagship with a limit on jobs (L2)."""
    return D.first_n(screen_jobs(t), ["doc_id"], 10)


def dedupe_jobs(t: Tables) -> DataFrame:
    return D.dedupe_jobs(t.job_pages().drop("page_text"), ["doc_id"]).select(
        "doc_id", D.job_key(F.col("job_url"), F.col("company_domain"), F.col("job_title")).alias("job_key")
    )


def label_jobs(t: Tables) -> DataFrame:
    jobs = t.job_pages().drop("page_text")
    return L.with_screening(jobs, t.flags(), t.index(jobs), ("doc_id",)).select("doc_id", "list_label", "is_removed")


def input_companies(t: Tables) -> DataFrame:
    raw = t.sql(derived.COMPANIES).select(F.col("company_website").alias("company_domain"), F.col("cid").alias("ord"))
    return files.company_domains(raw)


def input_pages(t: Tables) -> DataFrame:
    """Career pages from page URLs and their bare hosts, so that keys repeat."""
    pages = t.read("pages")
    bare = F.regexp_replace("url", "^https?://([^/]+).*$", "$1")
    raw = pages.select(F.col("url").alias("career_page"), F.col("page_id").alias("ord")).unionByName(
        pages.select(bare.alias("career_page"), (F.col("page_id") + 1000000000).alias("ord"))
    )
    return files.career_pages(raw).select("ord", "company_domain", "career_page")


def first_inputs(t: Tables) -> DataFrame:
    """With a limit on inputs."""
    raw = t.read("pages").select(F.col("url").alias("career_page"), F.col("page_id").alias("ord"))
    return files.career_pages(raw, C.MAX_INPUTS).select("ord", "company_domain", "career_page")


def file_lists(t: Tables) -> DataFrame:
    """Lists and keywords written as CSV folders and read again."""
    folder, rows = t.folder(), t.sql(derived.LIST_ROWS)
    for name in L.LISTS:
        columns = ["company_website", "company_name"] + (["external_url"] if name == "active" else [])
        files.write_csv(rows.filter(F.col("list_name") == name), f"{folder}/{name}", columns)
    files.write_csv(t.sql(derived.MANY_KEYWORDS).withColumnRenamed("keyword", "irrelevant_names"), f"{folder}/keywords", ["irrelevant_names"])
    keys = files.read_list_keys(t.spark, {name: f"{folder}/{name}" for name in L.LISTS})
    keywords = files.read_keywords(t.spark, f"{folder}/keywords").distinct()
    return keys.unionByName(keywords.select(F.lit("keywords").alias("list_name"), F.lit("keyword").alias("key_kind"), F.col("keyword").alias("key")))


def file_inputs(t: Tables) -> DataFrame:
    """Companies and career pages written in order as folders of several files and read again (S5, S6): the first of equal inputs wins."""
    folder = t.folder()
    companies = t.sql(derived.COMPANIES).select(F.col("cid").alias("o"), F.col("company_website").alias("company_domain"))
    again = companies.select((F.col("o") + 1000000000).alias("o"), F.upper(F.trim("company_domain")).alias("company_domain"))
    pages = t.read("pages").select(F.col("page_id").alias("o"), F.col("url").alias("career_page"))
    repeated = pages.select((F.col("o") + 1000000000).alias("o"), F.concat("career_page", F.lit("/")).alias("career_page"))
    for name, rows in {"companies": companies.unionByName(again), "pages": pages.unionByName(repeated)}.items():
        files.write_csv(rows.repartitionByRange(5, "o").sortWithinPartitions("o"), f"{folder}/{name}", [c for c in rows.columns if c != "o"])
    domains = files.read_company_domains(t.spark, f"{folder}/companies").select(F.lit("company").alias("kind"), "ord", "company_domain", F.lit("").alias("career_page"))
    listed = files.read_career_pages(t.spark, f"{folder}/pages").select(F.lit("page").alias("kind"), "ord", "company_domain", "career_page")
    return domains.unionByName(listed)


def file_outputs(t: Tables) -> DataFrame:
    """Jobs written as CSV and read again."""
    path = f"{t.folder()}/jobs"
    columns = ["doc_id", "List", "company_domain", "company_name", "job_title", "job_url", "job_description_length"]
    files.write_csv(screen_jobs(t), path, columns)
    return files.read_csv(t.spark, path).select(*[F.coalesce(c, F.lit("")).alias(c) for c in columns])


def snapshot_store(t: Tables) -> DataFrame:
    """Three deliveries merged into a snapshot table."""
    path = f"{t.folder()}/snapshots"
    for number, rows in enumerate(sites.deliveries(t.read("pages"))):
        snapshots.merge(t.spark, path, rows, number, parts=8)
    return snapshots.read_store(t.spark, path).select("url", "render_pass", "delivery", "fetch_ok", "html")


# --- seeds ---------------------------------------------------------------------------------------


def rule_seeds(t: Tables) -> DataFrame:
    cards = t.sql(derived.CARDS).withColumnRenamed("card_ord", "seed_ord")
    cards = cards.withColumns({"heading": T.heading_title(F.col("nearby_text")), "location": T.location_from_text(F.col("nearby_text"))})
    seeds = S.card_seeds(cards, ["page_url", "company_domain"])
    return seeds.select("page_url", "seed_ord", "job_title", "job_url", "job_location", "confidence", "reason")


def merge_seeds(t: Tables) -> DataFrame:
    return D.merge_seeds(t.sql(derived.SEEDS), ["page_url"]).select("page_url", "seed_ord", "origin", "job_title", "job_url")


def first_seeds(t: Tables) -> DataFrame:
    """With a limit on the seeds of a page (L1)."""
    seeds = D.cap_seeds(D.merge_seeds(t.sql(derived.SEEDS), ["page_url"]), ["page_url"], 5)
    return seeds.select("page_url", "seed_ord", "origin", "job_title", "job_url")


def large_board(t: Tables) -> DataFrame:
    counts = D.distinct_titles(t.sql(derived.SEEDS), ["page_url", "page_text"])
    signal = T.has_board_signal(T.normalize_text(F.col("page_text")))
    return counts.select("page_url", "title_count", D.is_large_board(F.col("title_count"), signal).alias("large_board"))


# --- classification ------------------------------------------------------------------------------


def site_facts(t: Tables) -> DataFrame:
    pages = t.sql(derived.SITE_PAGES)
    meta = F.concat(F.lit('<meta name="date" content="'), F.col("posted"), F.lit('">'))
    return P.page_facts(pages.select(
        "url", F.lit(0).alias("render_pass"), "final_url", F.when(F.col("posted") != "", meta).alias("html"),
        F.col("body").alias("body_text"), F.lit(True).alias("fetch_ok"),
    ))


def site_store(t: Tables, folder: str) -> P.PageStore:
    answers = t.sql(derived.SITE_ANSWERS).select(
        F.lit("job").alias("stage"), "url", F.lit(None).cast("int").alias("render_pass"), "response_text", F.lit(None).cast("bigint").alias("answered_ord")
    )
    return P.page_store(site_facts(t), A.answers_of(answers, "job"), folder)


def site_seeds(t: Tables) -> DataFrame:
    return t.sql(derived.SITE_SEEDS).select(
        "event_id", F.col("doc_id").alias("root_ord"), F.col("page_url").alias("root_url"), "company_domain", F.lit(0).alias("page_ord"),
        "page_url", F.lit(0).alias("render_pass"), F.lit(0).alias("origin_rank"), "seed_ord", F.lit("rule").alias("origin"),
        *A.SEED_FIELDS,
    )


def site_flags(seeds: DataFrame, store: P.PageStore) -> DataFrame:
    return K.page_flags(seeds.select(*K.VISIT, "page_url").distinct(), store)


def site_results(t: Tables) -> tuple[DataFrame, P.PageStore]:
    folder = t.folder()
    store = site_store(t, folder)
    seeds = files.materialize(site_seeds(t).drop("event_id"), folder, "seeds")
    results = K.classify(
        seeds, site_flags(seeds, store), store, t.flags(), t.index(seeds),
        lambda df: files.materialize(df, folder, "resolved"), lambda df, name: files.materialize(df, folder, name),
    )
    return files.materialize(results, folder, "results"), store


def same_page_job(t: Tables) -> DataFrame:
    folder = t.folder()
    store = site_store(t, folder)
    seeds = files.materialize(site_seeds(t), folder, "seeds")
    return K.with_same_page(seeds, site_flags(seeds, store), store).select(
        "event_id", "title_count", F.coalesce("same_reason", F.lit("")).alias("same_reason")
    )


def classify_jobs(t: Tables) -> DataFrame:
    results, store = site_results(t)
    shown = [c for c in C.JOB_COLUMNS if c not in ("company_domain", "career_page_url", "checked_at_utc")]
    kept = K.job_rows(results.filter(F.col("skip_reason").isNull()), store, CHECKED_AT, extra=("root_url", "seed_ord"))
    return kept.select("seed_ord", "root_url", "company_domain", *shown)


def skip_log(t: Tables) -> DataFrame:
    return K.skip_rows(*site_results(t), CHECKED_AT).select(*C.SKIP_COLUMNS)


def skip_counts(t: Tables) -> DataFrame:
    return K.skip_counts(site_results(t)[0])


# --- model answers -------------------------------------------------------------------------------


def llm_parse(t: Tables) -> DataFrame:
    parsed = A.parse_answer(t.sql(derived.MODEL_ANSWERS), "response_text")
    data = F.col("data")
    return parsed.select(
        "doc_id", data.isNotNull().alias("is_object"), A.refuses(data).alias("refuses"),
        *[A.answer_text(data, f).alias(f) for f in ("job_title", "job_url", "job_location", "reason")],
    )


def llm_jobs(t: Tables) -> DataFrame:
    parsed = A.parse_answer(t.sql(derived.MODEL_ANSWERS), "response_text")
    return A.answer_seeds(parsed, ["doc_id"]).select("doc_id", "seed_ord", "job_title", "job_url", "reason")


def llm_requests(t: Tables) -> DataFrame:
    """Only job pages with a real description are worth a question."""
    jobs = T.with_description(t.job_pages(), "page_text").filter("real_description")
    return A.job_requests(jobs.select(
        F.col("job_url").alias("job_page_url"), "company_domain", "description",
        F.lit("").alias("posted_date"), F.lit("").alias("posted_date_source"),
    ))


def career_requests(t: Tables) -> DataFrame:
    pages = extract_pages(sites.snapshots_of_pages(t.read("pages")))
    cards = P.cards_with_text(F.col("cards"), F.col("blocks"))
    return A.career_requests(pages.select(
        U.normalize_url(F.col("url")).alias("page_url"), U.url_host(F.col("url")).alias("company_domain"), "body_text", cards.alias("cards")
    ))


# --- documents -----------------------------------------------------------------------------------


def page_text(t: Tables) -> DataFrame:
    return extract_pages(sites.snapshots_of_pages(t.read("pages"))).select("url", "body_text")


def page_links(t: Tables) -> DataFrame:
    pages = extract_pages(sites.snapshots_of_pages(t.read("pages")))
    return pages.select("url", F.posexplode("links").alias("pos", "link")).select("url", "pos", "link.href", "link.text", "link.outer_html")


def page_cards(t: Tables) -> DataFrame:
    """Cards name their block of text by digest; each distinct text is joined back for show."""
    pages = files.materialize(extract_pages(sites.snapshots_of_pages(t.read("pages"))).select("url", "cards", "blocks"), t.folder(), "pages")
    cards = P.with_cards(pages).select("url", F.posexplode("cards").alias("pos", "card"))
    cards = cards.select("url", "pos", "card.href", "card.link_text", "card.card_title", "card.digest")
    return cards.join(P.block_store(pages), "digest").drop("digest")


def home_facts(t: Tables) -> DataFrame:
    return P.link_facts(sites.home_snapshots(t.read("customer")))


def next_pages(t: Tables) -> DataFrame:
    facts = T.once(home_facts(t), next_pages=P.next_pages(F.col("links"), U.url_host(F.col("url"))))
    return facts.select("url", F.posexplode("next_pages").alias("pos", "next_page"))


def posted_dates(t: Tables) -> DataFrame:
    pages = extract_pages(sites.posting_snapshots(t.read("documents")))
    return pages.select("url", F.posexplode("dates").alias("pos", "hit")).select("url", "pos", "hit.date", "hit.source")


def first_date(t: Tables) -> DataFrame:
    pages = extract_pages(sites.posting_snapshots(t.read("documents")))
    return pages.select("url", *[P.first_date(F.col("dates"), f).alias(f) for f in ("date", "source")])


# --- traversal and whole job ---------------------------------------------------------------------


def career_urls(t: Tables) -> DataFrame:
    companies = t.read("customer").select(
        F.col("c_custkey").alias("ord"), F.concat(F.lit("company"), F.col("c_custkey"), F.lit(".example.com")).alias("company_domain")
    )
    urls = R.career_urls(companies, home_facts(t))
    return urls.select("ord", "company_domain", F.posexplode("career_urls").alias("pos", "career_url"))


def frontier(t: Tables) -> DataFrame:
    roots = t.read("customer").select(
        F.col("c_custkey").cast("decimal(27,0)").alias("root_ord"), F.lit("").alias("company_domain"),
        F.concat(F.lit("u"), F.col("c_custkey")).alias("root_url"),
    )
    links = t.sql(derived.LINKS).select(F.col("src").alias("page_url"), "pos", F.col("dst").alias("target"))
    pages = R.traverse(roots, links, max_pages=C.MAX_PAGES_PER_ROOT)
    return pages.select(F.col("root_ord").cast("bigint").alias("root_ord"), "page_ord", "page_url", "visited")


def crawl_site(t: Tables, discover: bool = False, **limits: int) -> crawl.Outputs:
    inputs = sites.crawl_inputs(t.spark, t.read("documents"), t.keys(), t.sql(derived.KEYWORDS), discover)
    return crawl.run(inputs, CHECKED_AT, crawl.Limits(**limits))


def crawl_jobs(t: Tables) -> DataFrame:
    return crawl_site(t).jobs


def discovered_jobs(t: Tables) -> DataFrame:
    """The same job from companies alone."""
    return crawl_site(t, discover=True).jobs


def unvisited_pages(t: Tables) -> DataFrame:
    """With a budget of one page per root, the pages that were found and not visited."""
    left = crawl_site(t, max_pages=1).unvisited
    return left.select("company_domain", F.col("root_url").alias("career_page_url"), "page_ord", "page_url")


def crawl_skips(t: Tables) -> DataFrame:
    return crawl_site(t).skipped


def raw_trace(t: Tables) -> DataFrame:
    """Every item of every processed page, from the trace as it is written."""
    trace, path = crawl_site(t).trace, f"{t.folder()}/trace"
    files.write_trace(trace, path)
    trace = t.spark.read.schema(trace.schema).json(path)
    kinds = {
        "seed": F.transform("job_seeds", lambda x: F.struct(x["job_title"].alias("title"), x["job_url"].alias("url"), F.lit("").alias("reason"))),
        "job": F.transform("jobs", lambda x: F.struct(x["job_title"].alias("title"), x["job_url"].alias("url"), x["reason"].alias("reason"))),
        "skip": F.transform("skipped_jobs", lambda x: F.struct(x["job_title"].alias("title"), x["final_job_url"].alias("url"), x["reason"].alias("reason"))),
        "next": F.transform("next_pages", lambda x: F.struct(F.lit("").alias("title"), x.alias("url"), F.lit("").alias("reason"))),
        "page": F.when(F.col("part") == 0, F.array(F.struct(F.lit("").alias("title"), F.col("career_page_url").alias("url"), F.col("retry_reason").alias("reason")))),
    }
    rows = [trace.select("company_domain", "processed_page_url", "force_deeper", "error", F.lit(kind).alias("kind"), F.inline(items)) for kind, items in kinds.items()]
    return L.union_all(rows)


QUERIES = [
    normalize_keys, url_flags, clean_description, signal_counts, title_screen, keyword_index, location_from_text, headings,
    list_counts, list_membership, screen_jobs, first_jobs, dedupe_jobs, label_jobs, input_companies, input_pages, first_inputs,
    file_lists, file_inputs, file_outputs, snapshot_store,
    rule_seeds, merge_seeds, first_seeds, large_board, same_page_job, classify_jobs, skip_log, skip_counts,
    llm_parse, llm_jobs, llm_requests, career_requests, page_text, page_links, page_cards, next_pages,
    posted_dates, first_date, career_urls, frontier, crawl_jobs, discovered_jobs, unvisited_pages, crawl_skips, raw_trace,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(query: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(Tables(spark, sf_dir))

    return {query.__name__: bind(query) for query in QUERIES}
