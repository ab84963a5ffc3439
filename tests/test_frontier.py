"""The traversal equals a plain first-in-first-out queue."""

import random
import re
from collections import deque

import pytest
from pyspark.sql import functions as F

from jobsieve.operators import frontier as R
from jobsieve.operators import visited as V
from jobsieve.plans.sites import home_snapshots


def queue_order(root, links, budget):
    """Pages in the order of the queue; the first ``budget`` are visited."""
    queue, order = deque([root]), [root]
    visits = 0
    while queue and (budget is None or visits < budget):
        page = queue.popleft()
        visits += 1
        for target in links.get(page, []):
            if target not in order:
                order.append(target)
                queue.append(target)
    return [(i, p, budget is None or i < budget) for i, p in enumerate(order)]


@pytest.mark.parametrize("budget", [10, 3, None])
def test_traversal_equals_a_queue(spark, budget):
    random.seed(11)
    nodes = [f"n{i}" for i in range(60)]
    links = {n: random.sample(nodes, random.randint(0, 5)) for n in nodes}
    links["n0"] = [f"m{i}" for i in range(130)]
    links |= {f"m{i}": [f"m{i + 1}"] for i in range(129, 141)}  # a chain makes many levels
    rows = [(src, pos, dst) for src, targets in links.items() for pos, dst in enumerate(targets)]
    table = spark.createDataFrame(rows, "page_url string, pos int, target string").repartition(5)
    starts = [f"n{i}" for i in range(0, 60, 8)] + ["n4", "n4/", ""]  # repeated roots walk on their own
    roots = spark.createDataFrame([(i, s, "x.com") for i, s in enumerate(starts)], "root_ord int, root_url string, company_domain string")
    roots = roots.withColumn("root_ord", F.col("root_ord").cast("decimal(27,0)"))
    got = {}
    for r in R.traverse(roots, table, budget).orderBy("root_ord", "page_ord").collect():
        got.setdefault(int(r.root_ord), []).append((r.page_ord, r.page_url, r.visited))
    assert got == {i: queue_order(s.rstrip("/"), links, budget) for i, s in enumerate(starts) if s}


def test_a_cap_on_links(spark):
    table = spark.createDataFrame([("a", i, f"b{i}") for i in range(130)], "page_url string, pos int, target string")
    roots = spark.createDataFrame([("a", "x.com")], "root_url string, company_domain string").withColumn("root_ord", F.lit(1).cast("decimal(27,0)"))
    assert R.traverse(roots, table).count() == 131
    assert R.traverse(roots, table, max_links=100).count() == 101


def pages(spark, keys):
    df = spark.createDataFrame(keys, "root_ord int, page_url string")
    return df.withColumn("root_ord", F.col("root_ord").cast("decimal(27,0)"))


def test_filters_never_lose_a_page_and_refute_most_others(spark, tmp_path):
    seen = V.Visited(spark, str(tmp_path), parts=4)
    for level in range(11):  # more segments than there may be filters
        seen.add(pages(spark, [(i % 7, f"p{level}_{i}") for i in range(300)]))
    assert len(seen.filters) <= V.MOST_FILTERS and seen.merges == 1
    old = [(i % 7, f"p{level}_{i}") for level in range(11) for i in range(0, 300, 10)]
    new = [(i % 7, f"q{i}") for i in range(2000)]
    tested = seen.maybe(pages(spark, old + new)).collect()
    maybes = {(int(r.root_ord), r.page_url) for r in tested if r.maybe}
    assert set(old) <= maybes and len(maybes) - len(old) < 200
    assert {(int(r.root_ord), r.page_url) for r in seen.new(pages(spark, old + new), "t").collect()} == set(new)


def test_new_links_skip_the_visited_pages(spark, tmp_path):
    seen = V.Visited(spark, str(tmp_path), parts=4)
    seen.add(pages(spark, [(1, "a"), (2, "b")]))
    fresh = seen.new(pages(spark, [(1, "c"), (2, "d")]), "t")
    plan = fresh._jdf.queryExecution().toString()
    assert "visited_0" not in plan and "LeftAnti" not in plan
    # A known page is looked up in its own partition only.
    again = seen.new(pages(spark, [(1, "a"), (2, "d")]), "u")
    plan = again._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in plan and re.search(r"PartitionFilters: \[[^\]]*part", plan)
    assert [r.page_url for r in again.collect()] == ["d"]


def test_career_urls(spark):
    facts = spark.createDataFrame(
        [("https://x.com", 0, True, [("https://x.com/careers/1", "x.com", False), ("https://x.com/all", "x.com", False), ("https://jobs.lever.co/x", "jobs.lever.co", True)])],
        "url string, render_pass int, fetch_ok boolean, links array<struct<href:string,host:string,ats:boolean>>",
    )
    companies = spark.createDataFrame([(0, "x.com"), (1, "y.com")], "ord bigint, company_domain string")
    x, y = R.career_urls(companies, facts).orderBy("ord").collect()
    assert x.career_urls[:3] == ["https://x.com/careers/1", "https://jobs.lever.co/x", "https://x.com/careers"] and len(x.career_urls) == 11
    assert len(y.career_urls) == 9 and y.career_urls[0] == "https://y.com/careers"
    roots = R.roots_from_companies(companies, facts, 8).orderBy("root_ord").collect()
    assert [r.root_url for r in roots][:2] == ["https://x.com/careers/1", "https://jobs.lever.co/x"] and len(roots) == 16
    assert R.roots_from_companies(companies, facts).count() == 20


def test_home_pages_are_not_sent_whole_to_every_task(spark):
    facts = spark.createDataFrame([], "url string, render_pass int, fetch_ok boolean, links array<struct<href:string,host:string,ats:boolean>>")
    companies = spark.createDataFrame([(0, "x.com")], "ord bigint, company_domain string")
    assert "BroadcastHashJoin" not in R.career_urls(companies, facts)._jdf.queryExecution().sparkPlan().toString()


def test_company_pages_are_made_and_read_by_many_tasks(spark, tmp_path):
    spark.range(40).toDF("c_custkey").coalesce(1).write.parquet(str(tmp_path / "customer"))
    pages = home_snapshots(spark.read.parquet(str(tmp_path / "customer")))
    assert pages.rdd.getNumPartitions() >= 4 and pages.count() == 40


def test_links_are_tested_without_a_lambda_over_bits(spark, tmp_path):
    """Blocks hold numbers; a test reads one per probe and stops at the first bit that is not set. Links are read from their table, not found twice."""
    seen = V.Visited(spark, str(tmp_path), parts=4)
    seen.add(pages(spark, [(i, f"p{i}") for i in range(50)]))
    assert dict(seen.filters[0][1].dtypes)["bits"] == "array<bigint>"
    tested = seen.maybe(pages(spark, [(1, "p1"), (1, "p2")]))
    assert "forall" not in tested._jdf.queryExecution().toString()
    assert {(r.page_url, r.maybe) for r in tested.collect()} >= {("p1", True)}
    seen.new(pages(spark, [(1, "p1"), (1, "q")]), "links").collect()
    assert (tmp_path / "links_found").exists()
