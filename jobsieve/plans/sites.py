"""Page snapshots that Spark derives from the test tables, in the shape of S7."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobsieve.operators.lists import union_all
from jobsieve.plans import derived
from jobsieve.plans.crawl import Inputs
from jobsieve.sources.files import spread


def snapshots(df: DataFrame, url: Column, html: Column, body_text: Column | None = None, render_pass: int = 0) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return df.select(
        url.alias("url"), F.lit(render_pass).alias("render_pass"), nothing.alias("final_url"), html.alias("html"),
        (nothing if body_text is None else body_text).alias("body_text"), F.lit(True).alias("fetch_ok"),
    )


def snapshots_of_pages(pages: DataFrame) -> DataFrame:
    return snapshots(pages, F.col("url"), F.col("html"))


def home_snapshots(customer: DataFrame) -> DataFrame:
    """A home page per company with up to 24 links of eight kinds and four labels."""
    links = F.expr("""
      transform(sequence(0, cast(c_custkey % 25 as int)), i -> if(i = c_custkey % 25, '', concat('<li><a href="',
        case (i * 7 + c_custkey) % 8
          when 0 then concat('/careers/', i)
          when 1 then concat('https://www.company', c_custkey, '.example.com/jobs-', i, '//')
          when 2 then concat('https://boards.greenhouse.io/co', c_custkey, '/', i)
          when 3 then concat('https://www.linkedin.com/company/', c_custkey, '/jobs/', i)
          when 4 then concat('/news/', i)
          when 5 then concat('https://elsewhere.example.org/jobs/', i)
          when 6 then concat('about/', i % 3)
          else concat('/files/vacancies-', i, '.pdf') end, '">',
        case (i + c_custkey) % 4 when 0 then 'View  <b>Jobs</b>' when 1 then 'About us' when 2 then 'Learn more' else 'Our team' end,
        '</a>')))
    """)
    html = F.concat(F.lit("<html><body><button>View jobs</button><ul>"), F.array_join(links, ""), F.lit("</ul></body></html>"))
    url = F.concat(F.lit("https://company"), F.col("c_custkey"), F.lit(".example.com/"))
    return snapshots(spread(customer.select("c_custkey")), url, html)


def posting_snapshots(documents: DataFrame) -> DataFrame:
    """A page per document with one of eight arrangements of posting dates before the document's text."""
    head = F.expr("""
      case doc_id % 8
        when 0 then concat('<script type="application/ld+json">{"@type":"JobPosting","z":{"datePosted":"2024-', doc_id, '"},"a":{"createdAt":"2023-01-01"}}</script>')
        when 1 then concat('<script type="application/ld+json">{"published_at":"2024"}</script><meta name="date" content="2024-', doc_id, '">')
        when 2 then concat('<meta property="article:published_time" content="2020-', doc_id, '"><script type="Application/LD+JSON; x"> [{"date created":"2021"}] </script>')
        when 3 then concat('<script type="application/ld+json">{"datePosted": </script><script type="application/ld+json">{"b":{"Upload_Date":', doc_id, '}}</script>')
        when 4 then '<meta name="description" content="2024"><meta name="date">'
        when 5 then concat('<meta name=" DatePosted " property="x" content="2024-', doc_id, '"/>')
        when 6 then '<script type="application/ld+json">{"datePosted":"","dateposted":{"x":1}}</script>'
        else '<script>{"datePosted":"2024"}</script><script type="application/ld+json">[[{"postedDate":true}],{"k":[{"datePublished":"2022"}]}]</script>' end
    """)
    html = F.concat(F.lit("<html><head>"), head, F.lit("</head><body><div>"), F.col("text"), F.lit("</div></body></html>"))
    return snapshots(documents, F.concat(F.lit("https://x.example.com/"), F.col("doc_id")), html)


def answers(df: DataFrame, stage: str, url: Column, said: Column, render_pass: int | None = None, answered: int | None = None) -> DataFrame:
    return df.select(
        F.lit(stage).alias("stage"), url.alias("url"), F.lit(render_pass).cast("int").alias("render_pass"), said.alias("response_text"),
        F.lit(answered).cast("bigint").alias("answered_ord"),
    )


TITLE = """
  case doc_id % 5 when 0 then concat('Data Engineer ', doc_id) when 1 then concat('Barista ', doc_id)
    when 2 then concat('Sales Manager ', doc_id) when 3 then concat('CAD Technician ', doc_id) else concat('Buyer ', doc_id) end
"""


def deliveries(pages: DataFrame) -> list[DataFrame]:
    """Three deliveries of snapshots: every page, at times under an address with slashes, some twice; every fourth page anew; every ninth that could not be fetched, and
    a page that is not new at all."""
    own = F.concat("url", F.lit("?p="), F.col("page_id"))
    marked = lambda mark: F.concat(F.lit(f"{mark} "), F.col("page_id"), F.lit(" "), F.col("html"))
    first = snapshots(pages, F.concat(own, F.when(F.col("page_id") % 3 == 0, "/").otherwise("")), marked("first"))
    twice = snapshots(pages.filter("page_id % 5 = 0"), F.concat(own, F.lit("//")), marked("twice"))
    failed = snapshots(pages.filter("page_id % 6 = 0"), own, marked("failed")).withColumn("fetch_ok", F.lit(False))
    deeper = snapshots(pages.filter("page_id % 7 = 0"), own, marked("deeper"), render_pass=1)
    anew = snapshots(pages.filter("page_id % 4 = 0"), F.concat(F.lit(" "), own), marked("anew"))
    late = snapshots(pages.filter("page_id % 9 = 0"), own, marked("late")).withColumn("fetch_ok", F.lit(False))
    return [union_all([first, twice, failed, deeper]), anew, late]


def crawl_inputs(spark: SparkSession, documents: DataFrame, keys: DataFrame, keywords: DataFrame, discover: bool = False) -> Inputs:
    """A company site for every five documents, of five kinds (with ``discover``, only the companies are known; some have a home page that links to the career page):

    0 the career page lists the jobs and links to a page that is gone; 1 it lists them only when rendered deeper;
    2 it is gone; 3 the jobs are on two pages behind it; 4 only the model sees the jobs, some without a URL.
    """
    documents.createOrReplaceTempView("documents")
    site = F.expr("cast(floor(doc_id / 5) as bigint)")
    jobs = spark.sql(derived.JOB_PAGES).select("doc_id", "page_text").withColumn("site", site)
    jobs = jobs.withColumn("job_title", F.expr(TITLE)).withColumn(
        "host", F.concat(F.lit("https://company"), "site", F.lit(".example.com"))
    )
    job_url = F.concat("host", F.lit("/jobs/"), "doc_id")
    job_snapshots = snapshots(jobs, job_url, F.lit('<meta name="date" content="2024-05-06">'), F.col("page_text"))

    card = F.concat(
        F.lit("<div><div><div><div><div><div><h3>"), "job_title", F.lit('</h3><a href="/jobs/'), "doc_id",
        F.lit('">Apply now</a></div></div></div></div></div></div>'),
    )
    answer = F.struct(
        "job_title",
        F.when(F.col("doc_id") % 5 == 4, "").otherwise(job_url).alias("job_url"),
        F.lit("high").alias("confidence"),
    )
    sites = (
        jobs.groupBy("site", "host")
        .agg(
            F.array_sort(F.collect_list(F.struct("doc_id", card.alias("card"), answer.alias("answer"), "job_title"))).alias("jobs"),
            F.max(F.when(F.col("doc_id") % 5 == 0, F.col("page_text"))).alias("first_text"),
        )
        .withColumn("kind", F.col("site") % 5)
    )
    cards = F.transform("jobs", lambda j: j["card"])
    titles = F.array_join(F.transform("jobs", lambda j: j["job_title"]), ", ")
    root = F.concat("host", F.lit("/careers"))
    body = F.when(F.col("kind") == 0, F.concat(F.array_join(cards, ""), F.lit('<a href="/careers/more">Learn more</a>')))
    body = body.when(F.col("kind") == 1, F.lit("Loading vacancies"))
    body = body.when(F.col("kind") == 3, F.lit('<a href="/careers/a">View jobs</a><a href="careers/b/">View jobs</a>'))
    body = body.otherwise("")
    about = F.concat(F.lit("About the role: "), titles, F.lit(". Responsibilities and skills. "), "first_text")
    pages = [
        job_snapshots,
        snapshots(sites.filter("kind <> 2"), root, body, F.when(F.col("kind") == 4, about)),
        snapshots(sites.filter("kind = 1"), root, F.array_join(cards, ""), render_pass=1),
        snapshots(sites.filter("kind = 3"), F.concat(root, F.lit("/a")), F.array_join(F.slice(cards, 1, 3), "")),
        snapshots(
            sites.filter("kind = 3"), F.concat(root, F.lit("/b")),
            F.concat(F.array_join(F.slice(cards, 4, 2), ""), F.lit('<a href="/careers">All jobs</a>')),
        ),
    ]
    said = F.to_json(F.struct(F.transform("jobs", lambda j: j["answer"]).alias("jobs")))
    career_answers = answers(sites.filter("kind = 4"), "career", root, said)
    # The page was asked about before, and the answer then was another one; addresses end in a slash at times.
    older = answers(sites.filter("kind = 4"), "career", F.concat(root, F.lit("/")), F.lit('{"jobs": [{"job_title": "Old Manager"}]}'), answered=-1)
    refused = jobs.filter("doc_id % 8 = 1")
    job_answers = answers(refused, "job", F.concat(job_url, F.lit("/")), F.lit('{"is_valid_open_job": false}'), render_pass=0)
    # An answer for the deeper pass, which job pages are not asked about.
    other = answers(refused, "job", job_url, F.lit('{"is_valid_open_job": true}'), render_pass=1, answered=9)
    career_pages = sites.select(
        F.col("site").alias("ord"), F.concat(F.lit("company"), "site", F.lit(".example.com")).alias("company_domain"), root.alias("career_page")
    )
    if discover:
        home = F.lit('<p><a href="/careers/">View jobs</a><a href="/news">All jobs</a></p>')
        pages.append(snapshots(sites.filter("kind = 0"), F.concat("host", F.lit("/")), home))
        companies = career_pages.select("ord", "company_domain")
        return Inputs(snapshots=union_all(pages), answers=union_all([career_answers, older, job_answers, other]), keys=keys, keywords=keywords, companies=companies)
    return Inputs(
        snapshots=union_all(pages), answers=union_all([career_answers, older, job_answers, other]), keys=keys, keywords=keywords, career_pages=career_pages
    )
