"""J4 and the page store: titles against texts, joins that leave the texts where they are."""

import random

import pytest
from pyspark.sql import functions as F

from jobsieve.operators import pages as P
from jobsieve.operators import titles as T
from jobsieve.operators.classify import with_samples
from jobsieve.operators.keywords import keyword_index

ANSWERS = "answer_url string, render_pass int, data variant"


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma", "delta", "éta", "x"]
    rows = []
    for i in range(12):
        for render_pass in (0, 1):
            rows.append((f"https://x.com/{i}", render_pass, None, None, " ".join(rng.choice(words) for _ in range(60)), True))
    rows += [("https://x.com/0/", 0, None, None, "another text", True), ("https://x.com/1/", 0, None, None, "not fetched", False)]
    facts = P.page_facts(spark.createDataFrame(rows, "url string, render_pass int, final_url string, html string, body_text string, fetch_ok boolean"))
    return rows, P.page_store(facts, spark.createDataFrame([], ANSWERS), str(tmp_path_factory.mktemp("store")))


def test_one_row_per_page(store):
    rows, pages = store
    texts = {r.url: (r.t0.body_text, r.t1.body_text) for r in pages.wide.collect()}
    assert len(texts) == 12 and all(texts[u][p] == b for u, p, _, _, b, _ in rows[:24])


@pytest.mark.parametrize("per_part", [3, 256])
def test_titles(spark, store, per_part):
    rows, pages = store
    rng = random.Random(6)
    words = ["alpha", "beta", "gamma", "delta", "éta", "x", "omega"]
    asked = {(u, p, " ".join(rng.choice(words) for _ in range(rng.randint(1, 3)))) for u, p, *_ in rows[:24] for _ in range(30)}
    asked |= {("https://x.com/0", 0, f"title {i}") for i in range(700)} | {("https://gone.com", 0, "alpha")}
    df = spark.createDataFrame(sorted(asked), "page_url string, render_pass int, title string")
    df = df.join(df.groupBy("page_url").agg(F.count("*").alias("n")), "page_url")
    got = {tuple(r) for r in T.titles_in_texts(df, pages.wide, per_part).collect()}
    texts = {(u, p): b.lower() for u, p, _, _, b, _ in rows[:24]}
    assert got == {(u, p, t) for u, p, t in asked if t in texts.get((u, p), "")}


def test_texts_are_not_moved(spark, store):
    _, pages = store
    df = spark.createDataFrame([("https://x.com/0", 0, "alpha", 1)], "page_url string, render_pass int, title string, n int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = T.titles_in_texts(df, pages.wide)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-|*()0123456789"))
    above = []
    level = depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < level:
            above.append(line)
            level = depth(line)
    join = next(i for i, line in enumerate(above) if "Join" in line)
    assert not [line for line in above[:join] if "Exchange" in line]
    assert "Bucketed: true" in lines[scan]


def test_index_pieces_are_counted_where_they_are_made(spark):
    titles = spark.createDataFrame([("Barista",), ("barista ",), ("Data bar",)], "job_title string")
    keywords = spark.createDataFrame([("barista",), ("xy",), ("xyz",)], "keyword string")
    index = keyword_index(keywords, titles)
    assert "LeftSemi" not in index._jdf.queryExecution().optimizedPlan().toString()
    assert {r.keyword: r.piece for r in index.collect()} == {"barista": "ari", "xy": "xy", "xyz": "xyz"}


def test_store_moves_samples_and_cards_once(spark, tmp_path, monkeypatch):
    from jobsieve.operators import pages

    asked, by_url = [], pages.by_url
    monkeypatch.setattr(pages, "by_url", lambda facts, columns, prefix: (asked.append(columns), by_url(facts, columns, prefix))[1])
    monkeypatch.setattr(pages, "job_answers", lambda narrow, answers: (asked.append(narrow.schema["p0"].dataType.names), narrow.select("url"))[1])
    snapshots = [("https://x.com/a", 0, None, "<p>b</p>", None, True)]
    facts = pages.page_facts(spark.createDataFrame(snapshots, "url string, render_pass int, final_url string, html string, body_text string, fetch_ok boolean"))
    pages.page_store(facts, None, str(tmp_path))
    assert ["fetch_ok", "final_url", "real_description"] in asked and pages.NARROW in asked
    assert not {"cards", "links", "page_sample"} & set(asked[-2 if asked[-1] == pages.WIDE else -1])


def test_store_holds_a_text_once(spark, tmp_path):
    rng = random.Random(7)
    texts = [f"{rng.randbytes(3000).hex()} {i}" for i in range(40)]
    rows = [(f"https://x.com/{i}", 0, None, None, t, True) for i, t in enumerate(texts)]
    rows.append(("https://x.com/noisy", 1, None, None, "We use cookies to help. Accept. The role", True))
    facts = P.page_facts(spark.createDataFrame(rows, "url string, render_pass int, final_url string, html string, body_text string, fetch_ok boolean"))
    pages = P.page_store(facts, spark.createDataFrame([], ANSWERS), str(tmp_path))
    # Hexadecimal digits take half a byte each when they are compressed.
    written = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    assert written < 0.8 * sum(map(len, texts))
    got = {r.url: r for r in pages.narrow.join(pages.wide, "url").join(pages.samples, "url").collect()}
    for i, t in enumerate(texts):
        p, wide, cut = got[f"https://x.com/{i}"].p0, got[f"https://x.com/{i}"].t0, got[f"https://x.com/{i}"].s0
        assert (wide.body_text, wide.description, cut.sample, cut.description_sample, p.page_sample) == (t, t, t[:1000], t[:1000], t[:5000])
    noisy = got["https://x.com/noisy"]
    assert noisy.t1.body_text.startswith("We use") and noisy.t1.description != noisy.t1.body_text
    assert (noisy.s1.sample, noisy.s1.description_sample) == (noisy.t1.body_text, noisy.t1.description)
    assert noisy.p0.fetch_ok is None and noisy.t0.body_text is None


def test_flags_are_read_without_texts(store):
    _, pages = store
    flags = pages.narrow.select("url", "p0.has_text", "p1.fetch_ok")
    assert "body_text" not in flags._jdf.queryExecution().executedPlan().toString()


def test_samples_are_cut_from_the_texts_alone(spark, store):
    _, pages = store
    rows = spark.createDataFrame([("https://x.com/0", 1, "sample"), ("https://gone.com", 0, "description"), (None, 0, "sample")], "sample_url string, sample_pass int, sample_kind string")
    shown = with_samples(rows, pages)
    texts = {r.url: r.t1.body_text for r in pages.wide.collect()}
    assert {(r.sample_url, r.job_page_text_sample) for r in shown.collect()} == {("https://x.com/0", texts["https://x.com/0"][:1000]), ("https://gone.com", ""), (None, "")}
    scan = shown._jdf.queryExecution().executedPlan().toString().split("FileScan")[1].splitlines()[0]
    assert "own_description" in str(pages.samples._jdf.queryExecution().optimizedPlan().toString()) and "cards" not in scan
