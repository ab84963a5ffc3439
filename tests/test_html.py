"""T0-T4 on hand-written pages."""

import pyarrow as pa
from pyspark.sql import functions as F

from jobsieve.operators.html import extract, extract_pages
from jobsieve.operators.pages import block_store, follow_links, next_pages, page_facts, with_cards


def page(html, url="https://x.com/c/d", **more):
    return extract({"url": url, "final_url": None, "html": html, "body_text": None, "fetch_ok": True, "render_pass": 0} | more)


def test_dates_come_in_document_order():
    html = """<meta property="article:published_time" content="2020-01-01">
      <script type="application/ld+json">{"@type":"JobPosting","z":{"datePosted":"2024-01-02"},"a":{"createdAt":"2023-01-01"}}</script>"""
    assert page(html)["dates"] == [
        {"date": "2024-01-02", "source": "structured_data_datePosted"},
        {"date": "2023-01-01", "source": "structured_data_createdAt"},
        {"date": "2020-01-01", "source": "meta_article:published_time"},
    ]


def test_dates_that_do_not_count():
    dead = '<script type="application/ld+json">{"published_at":"2024-01-02"}</script>'
    wrong_type = '<script type="text/javascript">{"datePosted":"2024"}</script>'
    broken = '<script type="application/ld+json">{"datePosted":</script><script type="APPLICATION/LD+JSON">[{"date_Created": 5}]</script>'
    assert page(dead + wrong_type)["dates"] == []
    assert page(broken)["dates"] == [{"date": "5", "source": "structured_data_date_Created"}]
    nested = '<script type="application/ld+json">{"datePosted":{"createdAt":"x"},"uploadDate":""}</script>'
    assert page(nested)["dates"] == [{"date": "{'createdAt': 'x'}", "source": "structured_data_datePosted"}]


def test_links_resolve_against_the_page():
    html = '<a href="/a">1</a><a href="b/">2</a><a href="../e">3</a><a href="?q">4</a><a href="#f">5</a><a href="//h.com/x">6</a><a>7</a><a href="mailto:x">8</a>'
    assert [x["href"] for x in page(html)["links"]] == [
        "https://x.com/a", "https://x.com/c/b/", "https://x.com/e", "https://x.com/c/d?q", "https://x.com/c/d#f", "https://h.com/x", "mailto:x",
    ]
    assert page('<base href="https://y.com/z/"><a href="q">1</a>')["links"][0]["href"] == "https://y.com/z/q"


def test_visible_text():
    html = """<title>t</title><body><script>no()</script><style>p{}</style><p>One  two<b>three</b></p><p hidden>never</p>
      <ul><li>a<li>b</ul>x<br>y<template>z</template><noscript>n</noscript></body>"""
    assert page(html)["body_text"] == "One twothree a b x y"
    assert page("plain &amp; simple")["body_text"] == "plain & simple"
    assert page(None)["body_text"] == ""
    assert page("<p>derived", body_text=" given\n text ")["body_text"] == "given text"


def test_cards():
    html = """<body><div id=1><div><div><div><div><div><h3>  </h3><h2>Data <i>Engineer</i></h2><a href="/1/">Apply</a></div></div></div></div></div></div>
      <button aria-label=" More "></button><div role="button" href="/z">Go<br>on</div><a role="button">nolink</a></body>"""
    got = page(html)
    cards = got["cards"]
    assert [(c["href"], c["link_text"], c["card_title"]) for c in cards] == [
        ("https://x.com/1", "Apply", "Data Engineer"), ("", "More", "Data Engineer"), ("https://x.com/z", "Go\non", "Data Engineer"),
        ("", "nolink", "Data Engineer"),
    ]
    assert got["blocks"][cards[0]["block"]] == "Data Engineer Apply"
    assert len(got["links"]) == 1


def test_cards_keep_first_copies_by_the_whole_text_around_them(spark):
    html = "".join(f'<a href="/{i % 1500}">x</a>' for i in range(4000))
    # Two blocks that differ in their last word only.
    far = "".join(f'<div><div><div><div><div><div><p>{"w " * 3000}{end}</p><a href="/far">y</a></div></div></div></div></div></div>' for end in ("a", "b", "a"))
    rows = [("https://x.com", 0, None, h, None, True) for h in (html, far)]
    df = spark.createDataFrame(rows, "url string, render_pass int, final_url string, html string, body_text string, fetch_ok boolean")
    extracted = extract_pages(df)
    many, two = [r.cards for r in with_cards(extracted).select("cards").collect()]
    assert [c.href for c in many] == [f"https://x.com/{i}" for i in range(1500)]
    assert [c.href for c in two] == ["https://x.com/far"] * 2 and two[0].digest != two[1].digest
    texts = {r.digest: r.nearby_text for r in block_store(extracted).collect()}
    assert [texts[c.digest][-3:] for c in two] == ["a y", "b y"] and len(texts) == 3


def test_unclosed_and_broken_markup():
    got = page("<body><p><b>Bold<br><p>next<div>in</span></div></b> <table><tr><td>1<td>2</table><![odd[x]]> <a href='/q'>one<a href='/r'>two")
    assert [x["text"] for x in got["links"]] == ["one", "two"]
    assert got["body_text"].startswith("Bold next in")
    deep = "<div>" * 5000 + '<a href="/q">x</a>' + "</div>" * 5000
    assert page(deep)["cards"][0]["href"] == "https://x.com/q"


def test_follow_links(spark):
    html = """<button>View jobs</button><a href="/more/">View  Jobs</a><a href="/more">see jobs</a><a href="/about">About</a>
      <a href="/vacancies">x</a><a href="https://sub.x.com/a">all jobs</a><a href="https://y.com/a">all jobs</a>
      <a href="https://jobs.lever.co/x/">x</a><a href="https://uk.indeed.com/">view jobs</a><a href="/news">view jobs</a>
      <a href="/a.pdf">view jobs</a><a href="javascript:void(0)">load more</a><a href="/people/">show more</a>"""
    rows = [("https://x.com", 0, None, html, None, True)]
    df = spark.createDataFrame(rows, "url string, render_pass int, final_url string, html string, body_text string, fetch_ok boolean")
    links = extract_pages(df).select(follow_links(F.col("links")).alias("links"))
    got = links.select(next_pages(F.col("links"), F.lit("www.X.com")).alias("n")).first().n
    assert got == ["https://x.com/more", "https://x.com/vacancies", "https://sub.x.com/a", "https://jobs.lever.co/x", "https://x.com/people"]


def test_page_facts(spark):
    body = "skills duties " + "x" * 200
    rows = [
        ("https://x.com/a/", 0, "https://x.com/b//", '<meta name="Date" content="d">', body, True),
        ("https://x.com/c", 1, None, "<p>Loading", None, False),
    ]
    df = spark.createDataFrame(rows, "url string, render_pass int, final_url string, html string, body_text string, fetch_ok boolean")
    a, c = page_facts(df).orderBy("url").collect()
    assert (a.url, a.final_url, a.real_description, a.posted_date, a.posted_date_source) == (
        "https://x.com/a", "https://x.com/b", True, "d", "meta_Date",
    )
    assert (c.final_url, c.fetch_ok, c.retry_signal, c.apply_only, c.body_text) == ("https://x.com/c", False, True, False, "Loading")


def test_results_are_laid_out_as_arrow_would():
    from jobsieve.operators import html

    pages = ['<a href="/x">É<b>1</b></a><button>b</button>', "", '<meta name="date" content="2024"><div><a href="y">2</a></div>', None]
    done = [html.extract({"url": "https://x.com", "render_pass": i % 2, "final_url": None, "html": page, "body_text": None, "fetch_ok": i != 3}) for i, page in enumerate(pages)]
    assert html.as_batch(done).equals(pa.RecordBatch.from_pylist(done, schema=html.ARROW_SCHEMA))
    assert html.as_batch([]).num_rows == 0
