"""C1-C6, A3, T10 with retries: one small site, every outcome spelled out."""

import json

import pytest
from pyspark.sql import functions as F

from jobsieve import constants as C
from jobsieve.operators import classify
from jobsieve.operators import lists as L
from jobsieve.operators import trace as X
from jobsieve.plans import crawl
from jobsieve.sources import files, snapshots

GOOD = "About the role. Responsibilities, skills and duties. " + "x" * 200
APPLY = "apply for this job submit application attach your file(s) drag and drop maximum file size first name last name"


def card(title, href):
    return f"<div><div><div><div><div><div><h3>{title}</h3><a href='{href}'>go</a></div></div></div></div></div></div>"


def snap(url, html="", body=None, render_pass=0, final=None, ok=True):
    return (url, render_pass, final, html, body, ok)


ROOT = "https://www.x.com/careers"
SNAPSHOTS = [
    snap(ROOT + "/", "".join([
        card("Data Engineer", "/jobs/good"), card("Sales Lead", "/jobs/apply"), card("Buyer", "/jobs/closed"), card("Product Manager", "/jobs/gone"),
        card("Project Manager", "/jobs/moved"), card("CAD Manager", "/jobs/cad"), card("Finance Officer", "/spec.pdf"), card("Support Analyst", "/jobs/refused"),
        card("Account Manager", "/jobs/renamed"), "<a href='/vacancies/2'>more</a><a href='/vacancies/3'>more</a><a href='/vacancies/2/'>more</a>",
    ])),
    snap("https://www.x.com/jobs/good", '<meta name="date" content="2024-02-03">', GOOD, final="https://www.x.com/jobs/good?src=1/"),
    snap("https://www.x.com/jobs/apply", body=APPLY),
    snap("https://www.x.com/jobs/closed", body=GOOD + " this vacancy has closed"),
    snap("https://www.x.com/jobs/moved", body=GOOD, final="https://www.x.com/team/jo"),
    snap("https://www.x.com/jobs/cad", body=GOOD),
    snap("https://www.x.com/jobs/refused", body=GOOD),
    snap("https://www.x.com/jobs/renamed", body=GOOD),
    # nothing on the first pass; the deeper pass shows a job and other links, which queue before the first pass's
    snap("https://www.x.com/vacancies/2", "<p>Loading</p><a href='/vacancies/4'>Learn more</a>"),
    snap("https://www.x.com/vacancies/2", card("Data Analyst", "/jobs/deep") + "<div>" * 6 + "<a href='/vacancies/5'>Learn more</a>" + "</div>" * 6, render_pass=1),
    snap("https://www.x.com/jobs/deep", body=GOOD),
    snap("https://www.x.com/vacancies/3", "<p>Nothing</p>"),
    snap("https://www.x.com/vacancies/4", ok=False),
    snap("https://www.x.com/vacancies/5", body="Warehouse Operator " + GOOD),
]
ANSWERS = [
    ("job", "https://www.x.com/jobs/good?src=1/", None, '{"job_title": "Senior Data Engineer", "company_name": "X Ltd", "job_location": "Leeds"}'),
    ("job", "https://www.x.com/jobs/refused", 0, '{"is_valid_open_job": false}'),
    ("job", "https://www.x.com/jobs/renamed", None, '{"is_valid_open_job": "false", "job_url": "https://www.indeed.com/1"}'),
    ("career", "https://www.x.com/vacancies/5", None, 'Here: {"jobs": [{"job_title": "Warehouse Operator", "job_url": "/"}, {"job_title": "Ghost", "reason": "PDF only"}, {"job_title": "Other"}, 7]}'),
]


@pytest.fixture(scope="module")
def outputs(spark):
    keys = L.list_keys(spark.createDataFrame([("churned", "x.com", None, None)], files.LIST_SCHEMA))
    pages = files.career_pages(spark.createDataFrame([(ROOT, 4)], "career_page string, ord bigint"))
    inputs = crawl.Inputs(
        snapshots=spark.createDataFrame(SNAPSHOTS, snapshots.SNAPSHOT_SCHEMA).repartition(3),
        answers=spark.createDataFrame([(*a, None) for a in ANSWERS], files.ANSWER_SCHEMA),
        keys=keys,
        keywords=spark.createDataFrame([("cad",)], "keyword string"),
        career_pages=pages,
    )
    return crawl.run(inputs, "now")


def test_jobs(outputs):
    rows = outputs.jobs.collect()
    assert outputs.jobs.columns == C.JOB_COLUMNS
    assert [(r.job_title, r.job_url) for r in rows] == [
        ("Senior Data Engineer", "https://www.x.com/jobs/good?src=1"), ("Data Analyst", "https://www.x.com/jobs/deep"),
        ("Warehouse Operator", "https://www.x.com/vacancies/5"),
    ]
    first = rows[0]
    assert (first.List, first.company_domain, first.company_name, first.job_location, first.career_page_url) == ("churned", "x.com", "X Ltd", "Leeds", ROOT)
    assert (first.job_description, first.job_description_length) == (GOOD, len(GOOD))
    assert (first.job_posted_date, first.job_posted_date_source, first.confidence, first.checked_at_utc) == ("2024-02-03", "meta_date", "medium", "now")
    assert rows[2].reason == C.SAME_PAGE_ACCEPTED and rows[2].job_description == "Warehouse Operator " + GOOD


def test_skips(outputs):
    got = {(r.seed_job_title, r.seed_job_url): (r.skip_reason, r.final_job_url, r.job_page_text_sample) for r in outputs.skipped.collect()}
    site = "https://www.x.com/jobs/"
    expected = {
        ("Sales Lead", site + "apply"): (C.APPLY_FORM, site + "apply", APPLY),
        ("Buyer", site + "closed"): (C.CLOSED_PAGE, site + "closed", GOOD + " this vacancy has closed"),
        ("Product Manager", site + "gone"): (C.APPLY_FORM, site + "gone", ""),
        ("Project Manager", site + "moved"): (C.PROFILE_PAGE, "https://www.x.com/team/jo", GOOD),
        ("CAD Manager", site + "cad"): (C.GATE_LISTED, site + "cad", GOOD),
        ("Finance Officer", ""): (C.SAME_PAGE_BOARD, "https://www.x.com/careers", ""),
        ("Support Analyst", site + "refused"): (C.MODEL_REFUSED, site + "refused", ""),
        ("Account Manager", site + "renamed"): (C.GATE_BLOCKED_BOARD, "https://www.indeed.com/1", ""),
        ("Ghost", ""): (C.ATTACHMENT_ONLY, "", ""),
        ("Other", ""): (C.SAME_PAGE_NO_TITLE, "https://www.x.com/vacancies/5", ""),
        # the plain links of the first page share the first heading of the page as their title
        ("Data Engineer", "https://www.x.com/vacancies/2"): (C.CLOSED_PAGE, "https://www.x.com/vacancies/2", "Loading Learn more"),
        ("Data Engineer", "https://www.x.com/vacancies/3"): (C.CLOSED_PAGE, "https://www.x.com/vacancies/3", "Nothing"),
    }
    assert got == expected


def test_trace_follows_the_queue(outputs):
    rows = outputs.trace.orderBy("root_ord", "page_ord", "render_pass").collect()
    assert [(r.processed_page_url.rsplit("/", 1)[1], r.force_deeper, r.error != "") for r in rows] == [
        ("careers", False, False), ("2", False, False), ("2", True, False), ("3", False, False), ("5", False, False), ("4", False, True),
    ]
    first, deeper = rows[0], rows[2]
    assert list(first.next_pages) == ["https://www.x.com/vacancies/2", "https://www.x.com/vacancies/3"]
    assert [s.job_title for s in first.job_seeds][:2] == ["Data Engineer", "Sales Lead"] and len(first.job_seeds) == 11
    assert [j.job_title for j in first.jobs] == ["Senior Data Engineer"] and len(first.skipped_jobs) == 10
    assert deeper.retry_reason == C.RETRY_REASON and list(deeper.next_pages) == ["https://www.x.com/vacancies/5"]
    assert [j.job_url for j in deeper.jobs] == ["https://www.x.com/jobs/deep"]
    assert rows[5].error == C.PAGE_ERROR and rows[5].job_seeds == []


def test_every_seed_ends_once(outputs):
    for r in outputs.trace.collect():
        assert len(r.job_seeds) == len(r.jobs) + len(r.skipped_jobs)


def test_discovery_mode(spark):
    inputs = crawl.Inputs(
        snapshots=spark.createDataFrame([
            snap("https://y.com", "<a href='/careers/all'>Our vacancies</a>"), snap("https://y.com/careers/all", card("Data Engineer", "/jobs/1")),
            snap("https://y.com/jobs", card("Data Engineer", "/jobs/1") + card("Buyer", "/jobs/2")), snap("https://y.com/jobs/1", body=GOOD), snap("https://y.com/jobs/2", body=GOOD),
        ], snapshots.SNAPSHOT_SCHEMA),
        answers=spark.createDataFrame([], files.ANSWER_SCHEMA),
        keys=L.list_keys(spark.createDataFrame([], files.LIST_SCHEMA)),
        keywords=spark.createDataFrame([], "keyword string"),
        career_pages=spark.createDataFrame([], "career_page string, ord bigint, company_domain string"),
        companies=files.company_domains(spark.createDataFrame([("www.y.com", 7)], "company_domain string, ord bigint")),
    )
    out = crawl.run(inputs, "now", crawl.Limits(max_roots=8))
    assert [(r.job_title, r.job_url, r.career_page_url, r.List) for r in out.jobs.collect()] == [
        ("Data Engineer", "https://y.com/jobs/1", "https://y.com/careers/all", "inactive"), ("Buyer", "https://y.com/jobs/2", "https://y.com/jobs", "inactive"),
    ]
    assert out.trace.filter("error <> ''").count() == 6


def site(spark, pages, answers=(), **limits):
    inputs = crawl.Inputs(
        snapshots=spark.createDataFrame(pages, snapshots.SNAPSHOT_SCHEMA),
        answers=spark.createDataFrame(list(answers), files.ANSWER_SCHEMA),
        keys=L.list_keys(spark.createDataFrame([], files.LIST_SCHEMA)),
        keywords=spark.createDataFrame([], "keyword string"),
        career_pages=files.career_pages(spark.createDataFrame([("https://z.com/careers", 0)], "career_page string, ord bigint")),
    )
    return crawl.run(inputs, "now", crawl.Limits(**limits))


def test_budget_leaves_rows_and_repeats_do_not_multiply(spark):
    links = "".join(f"<a href='/vacancies/{i}'>more</a>" for i in range(6))
    pages = [snap("https://z.com/careers", links), snap("https://z.com/careers/", links), snap("https://z.com/careers//", "<p>gone</p>", ok=False)]
    pages += [snap(f"https://z.com/vacancies/{i}", body="nothing") for i in range(6)]
    out = site(spark, pages, max_pages=3)
    assert [(r.page_ord, r.processed_page_url) for r in out.trace.orderBy("page_ord").collect()] == [
        (0, "https://z.com/careers"), (0, "https://z.com/careers"), (1, "https://z.com/vacancies/0"), (2, "https://z.com/vacancies/1"),
    ]
    assert sorted((r.page_ord, r.page_url) for r in out.unvisited.collect()) == [(i + 1, f"https://z.com/vacancies/{i}") for i in range(2, 6)]


def test_each_pass_has_its_own_answer(spark):
    text = "Warehouse Operator. Forklift Driver. " + GOOD
    jobs = lambda title: '{"jobs": [{"job_title": "%s"}]}' % title
    pages = [snap("https://z.com/careers", body="Loading"), snap("https://z.com/careers", body=text, render_pass=1)]
    out = site(spark, pages, [("career", "https://z.com/careers/", 0, jobs("Ghost"), None), ("career", "https://z.com/careers", 1, jobs("Forklift Driver"), None)])
    assert [r.job_title for r in out.jobs.collect()] == ["Forklift Driver"]
    assert [[s.job_title for s in r.job_seeds] for r in out.trace.orderBy("render_pass").collect()] == [["Ghost"], ["Forklift Driver"]]


def test_trace_rows_stay_bounded(spark):
    visit = ["cast(1 as decimal(27,0)) as root_ord", "0 as page_ord", "0 as render_pass"]
    seeds = spark.range(10_000).selectExpr(*visit, "struct(1 as origin_rank, cast(id as int) as seed_ord) as order", "struct(repeat('x', 50) as job_title, id) as item")
    seeds = seeds.repartition(4)
    parts = X.in_parts(seeds, "job_seeds", 20_000).orderBy("part").collect()
    assert [i.id for p in parts for i in p.job_seeds] == list(range(10_000))
    assert max(len(json.dumps([i.asDict() for i in p.job_seeds])) for p in parts) < 30_000
    few = X.in_parts(seeds.limit(3).withColumn("item", F.lit("u")), "next_pages", 20_000)
    both = X.side_by_side([X.in_parts(seeds, "job_seeds", 20_000), few]).orderBy("part").collect()
    assert len(both) == len(parts) and list(both[0].next_pages) == ["u"] * 3 and both[1].next_pages is None


def test_nothing_to_start_from(spark):
    none = spark.createDataFrame([], "career_page string, ord bigint, company_domain string")
    inputs = crawl.Inputs(
        snapshots=spark.createDataFrame([], snapshots.SNAPSHOT_SCHEMA), answers=spark.createDataFrame([], files.ANSWER_SCHEMA),
        keys=L.list_keys(spark.createDataFrame([], files.LIST_SCHEMA)), keywords=spark.createDataFrame([], "keyword string"),
        career_pages=none, companies=spark.createDataFrame([], "company_domain string, ord bigint"),
    )
    out = crawl.run(inputs, "now")
    assert [out.jobs.count(), out.skipped.count(), out.trace.count(), out.unvisited.count()] == [0, 0, 0, 0]


def test_rows_to_be_screened_are_written_once(spark):
    """The titles are looked up apart from the rows; neither side resolves the rows again."""
    kept = []
    fields = "root_ord decimal(27,0), root_url string, company_domain string, page_ord int, page_url string, render_pass int, origin_rank int, seed_ord int, origin string, job_title string, job_url string, invalid_reason string, r_url string, r_company_name string, r_title string, r_location string, r_date string, r_date_source string, r_confidence string, r_reason string, r_real boolean, text_url string, text_pass int, early_kind string, early_url string, early_pass int"
    resolved = spark.createDataFrame([], fields)
    flags = spark.createDataFrame([], "key_kind string, key string, on_blacklist boolean, on_customers boolean, on_churned boolean, on_active boolean")
    index = spark.createDataFrame([], "piece string, keyword string")

    def keep(df):
        kept.append(df.columns)
        return spark.createDataFrame([], df.schema)

    assert classify.gate(resolved, flags, index, keep).count() == 0
    assert len(kept) == 1 and "r_real" in kept[0] and "r_title" not in kept[0]
