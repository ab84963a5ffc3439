"""N2-N5, N10 and P1-P6, P15."""

from pyspark.sql import functions as F

from jobsieve.functions import urls as U


def test_domains(evaluate):
    values = ["https://awww.x.com/p", " HTTPS://WWW.X.com:80/a ", "user@x.com?q=1", "http://www.www.x.com", None, "https:// www.x.com /"]
    assert evaluate(U.normalize_domain, values) == ["ax.com", "x.com:80", "user@x.com?q=1", "x.com", "", "x.com"]


def test_urls(evaluate):
    assert evaluate(U.normalize_url, [" https://A.com/x// ", "/", None, "a /"]) == ["https://A.com/x", "", "", "a "]
    assert evaluate(U.with_scheme, ["x.com", "http://x.com", "httpfoo.com", "HTTP://x"]) == [
        "https://x.com", "http://x.com", "httpfoo.com", "https://HTTP://x",
    ]
    assert evaluate(U.company_website, ["www.X.com/"]) == ["https://x.com"]


def test_hosts(evaluate):
    values = [
        "//a.com/x", "a.com/x", "https://a_b.com/x", "https://[::1/x", "https://a.com?b", "https://a b.com/x", "mailto:x@y.com",
        "https://www.é.com#z", "1http://x.com", None, " https://a.com", "ht\ntps://a.com/x", "https://u:p@a.com:1/",
    ]
    assert evaluate(U.url_host, values) == [
        "a.com", "", "a_b.com", "", "a.com", "a b.com", "", "é.com", "", "", "a.com", "a.com", "u:p@a.com:1",
    ]


def test_same_site(spark):
    rows = [
        ("https://x.com/a", "x.com", True), ("https://jobs.x.com", "www.X.com", True), ("https://ax.com", "x.com", False),
        ("nothing", "", True), ("https://x.com.evil.org", "x.com", False), ("https://x.com:8080", "x.com", False),
    ]
    df = spark.createDataFrame(rows, "u string, d string, want boolean")
    assert df.filter(U.same_or_subdomain(F.col("u"), F.col("d")) != F.col("want")).count() == 0


def test_url_predicates(evaluate):
    assert evaluate(U.is_attachment, ["https://x/a.PDF", "https://x/a.docx?v=1", "https://x/a.pdf#page=2", "https://x/apdf", None]) == [
        True, True, False, False, False,
    ]
    assert evaluate(U.is_ats, ["https://boards.greenhouse.io/x", "https://x.com/?to=lever.co", "https://leverxco.com"]) == [True, True, False]
    assert evaluate(U.is_blocked_board, ["https://uk.linkedin.com/x", "https://notlinkedin.com", "https://x.com/linkedin.com", "https://indeed.com"]) == [
        True, False, False, True,
    ]
    assert evaluate(U.is_bad_url, ["https://newsco.com/jobs/1", "https://blog.x.com", "https://x.com/Terms", "https://x.com/jobs"]) == [
        True, True, True, False,
    ]
    assert evaluate(U.is_profile_url, ["https://x.com/team/a", "https://x.com/team", "https://x.com/Our-People/b"]) == [True, False, True]
    assert evaluate(U.is_career_link, ["https://x.com/careers", "https://x.com/open%20roles", "https://jobs.lever.co", "https://x.com/about"]) == [
        True, False, True, False,
    ]
