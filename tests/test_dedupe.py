"""Results depend on the order columns only, never on how rows are laid out."""

import random

import pytest
from pyspark.sql import functions as F

from jobsieve.functions.text import heading_title, location_from_text
from jobsieve.operators import dedupe as D
from jobsieve.operators.seeds import card_seeds


@pytest.fixture(scope="module")
def jobs():
    random.seed(5)
    return [(i, random.choice(["", "u/", "u", "V", " v "]), random.choice(["X.com", "www.x.com", "y.com"]), random.choice(["A b", "a  B", "c"])) for i in range(400)]


def test_first_job_per_key_wins(spark, jobs):
    expected, seen = [], set()
    for i, url, domain, title in jobs:
        key = url.strip().rstrip("/") or (domain.lower().replace("www.", ""), " ".join(title.lower().split()))
        if key not in seen:
            seen.add(key)
            expected.append(i)
    df = spark.createDataFrame(jobs, "ord int, job_url string, company_domain string, job_title string")
    for layout in (df.repartition(7), df.repartition(3, "job_title"), df.coalesce(1).orderBy(F.desc("ord"))):
        assert [r.ord for r in D.dedupe_jobs(layout, ["ord"]).orderBy("ord").collect()] == expected
        assert [r.ord for r in D.first_n(D.dedupe_jobs(layout, ["ord"]), ["ord"], 3).collect()] == expected[:3]


def test_merge_puts_rule_seeds_first_and_blanks_dead_urls(spark):
    rows = [
        ("p", 0, "llm", "Data Engineer", "https://x.com/jobs/1"), ("p", 5, "rule", "data  engineer", "https://x.com/jobs/1/"),
        ("p", 1, "llm", "Buyer", "https://x.com/team/a"), ("p", 2, "llm", " buyer", ""), ("p", 3, "llm", " ", "u"), ("q", 1, "llm", "Buyer", ""),
    ]
    df = spark.createDataFrame(rows, "page_url string, seed_ord int, origin string, job_title string, job_url string").repartition(5)
    got = D.merge_seeds(df, ["page_url"]).orderBy("page_url", "origin_rank", "seed_ord").collect()
    assert [(r.page_url, r.seed_ord, r.origin, r.job_url) for r in got] == [
        ("p", 5, "rule", "https://x.com/jobs/1/"), ("p", 1, "llm", ""), ("q", 1, "llm", ""),
    ]
    assert [r.seed_ord for r in D.cap_seeds(D.merge_seeds(df, ["page_url"]), ["page_url"], 1).orderBy("page_url").collect()] == [5, 1]


def test_a_hot_group_is_cut_before_the_shuffle(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(0).alias("page_url"), F.lit(0).alias("origin_rank"), F.col("id").alias("seed_ord"))
    assert D.cap_seeds(df, ["page_url"]).count() == 3000
    plan = D.cap_seeds(df, ["page_url"], 200)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_title_counts_and_boards(spark):
    rows = [("p", t) for t in ["A", " a ", "b", "", None, "C"]] + [("q", "x")]
    df = spark.createDataFrame(rows, "page_url string, job_title string")
    assert {r.page_url: r.title_count for r in D.distinct_titles(df, ["page_url"]).collect()} == {"p": 3, "q": 1}
    flags = spark.createDataFrame([(6, False), (5, False), (3, True), (2, True)], "n int, s boolean")
    assert [r[0] for r in flags.select(D.is_large_board(F.col("n"), F.col("s"))).collect()] == [True, False, True, False]


def test_card_seeds(spark):
    rows = [
        (0, "", "Data Analyst", "", "Remote"), (1, "https://x.com/1/", "Data Analyst", "", ""), (2, "https://x.com/1", "data  analyst", "", ""),
        (3, "https://other.org/1", "Buyer", "", ""), (4, "https://x.com/a.pdf", "Buyer", "", ""), (5, "https://jobs.lever.co/1", "", "Sales", ""),
        (6, "https://x.com/terms", "Buyer", "", ""), (7, "https://x.com/team/b", "Buyer", "", ""), (8, "https://uk.indeed.com/lever.co", "Buyer", "", ""),
        (9, "https://x.com/9", "Nothing", "here", ""), (10, "https://x.com/10", "", "", "Head of IT"),
    ]
    cards = spark.createDataFrame(rows, "seed_ord int, href string, card_title string, link_text string, nearby_text string").withColumns(
        {"page_url": F.lit("https://x.com/c"), "company_domain": F.lit("x.com")}
    )
    cards = cards.withColumns({"heading": heading_title(F.col("nearby_text")), "location": location_from_text(F.col("nearby_text"))})
    got = card_seeds(cards.repartition(4), ["page_url", "company_domain"]).orderBy("seed_ord").collect()
    assert [(r.seed_ord, r.job_title, r.job_url, r.job_location) for r in got] == [
        (0, "Data Analyst", "", "Remote"), (1, "Data Analyst", "https://x.com/1", ""), (4, "Buyer", "", ""), (5, "Sales", "https://jobs.lever.co/1", ""),
        (10, "Head of IT", "https://x.com/10", ""),
    ]
    assert [r.reason.startswith("Visible") for r in got] == [True, False, True, False, False]
