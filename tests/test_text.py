"""N1, N3, N6, N7, N11-N17 and P7-P11, P14."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from jobsieve.functions import text as T
from jobsieve.functions.urls import normalize_url

ODD_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       　"


def test_normalize_text(evaluate):
    values = ["  A\xa0 B\tc\x1cd\x85 ", None, "", "  ", "ÀB", ODD_SPACES + "x" + ODD_SPACES + "Y" + ODD_SPACES]
    assert evaluate(T.normalize_text, values) == ["a b c d", "", "", "", "àb", "x y"]


def test_whitespace_agrees_with_python(evaluate):
    """Every code point below U+3400, and random strings of odd spaces, letters and slashes."""
    values = ["a" + chr(c) + "b" for c in range(1, 0x3400)]
    expected = [" ".join(v.split()) for v in values]
    assert evaluate(T.collapse, values) == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=ODD_SPACES + "aB/é", max_size=12), min_size=20, max_size=60))
def test_strip_and_url_agree_with_python(evaluate, values):
    got = evaluate(lambda x: F.concat_ws("¦", T.strip(x), normalize_url(x), T.normalize_text(x)), values)
    assert got == ["¦".join([v.strip(), v.strip().rstrip("/"), " ".join(v.lower().split())]) for v in values]


def test_clean_page_text_caps_after_collapsing(evaluate):
    assert evaluate(lambda x: T.clean_page_text(x, 5), ["  ab   cd  ef", "ab c\n d", None]) == ["ab cd", "ab c ", ""]


def _described(spark, texts, **limits):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, body string")
    rows = T.with_description(df, "body", **limits).orderBy("i").collect()
    return [(r.description, r.apply_only, r.real_description) for r in rows]


def test_descriptions(spark):
    filler = "skills experience " + "x" * 200
    texts = [
        "Intro  SKIP to\ncontent " + filler,
        "We use cookies for fun and you may accept them. " + filler,
        "Cookie policy text Manage Preferences tail " + filler,
        filler + " error 404",
        "skills experience",
        "",
        None,
        # removing one phrase joins the halves of another: only the second pass of the verdict sees it
        "we use share this job cookies " + filler + " accept",
        "apply for this job submit application attach your file(s) drag and drop maximum file size first name last name " + "y" * 200,
        "apply for this job submit application attach your file(s) drag and drop maximum file size first name last name skills duties " + "y" * 200,
    ]
    got = _described(spark, texts)
    assert got[0] == ("Intro " + filler, False, True)
    assert got[1] == ("them. " + filler, False, True)
    assert got[2] == ("tail " + filler, False, True)
    assert got[3][1:] == (False, False)
    assert got[4] == ("skills experience", False, False)
    assert got[5] == got[6] == ("", True, False)
    assert got[7] == ("we use cookies " + filler + " accept", False, False)
    assert got[8][1:] == (True, False)
    assert got[9][1:] == (False, True)


def test_description_cap_and_threshold(spark):
    got = _described(spark, ["skills duties abc def"], min_chars=10, max_chars=14)
    assert got == [("skills duties ", False, True)]
    assert _described(spark, ["skills duties abc def"], min_chars=14, max_chars=14)[0][2] is False


def test_phrase_counts(evaluate):
    assert evaluate(T.description_signals, ["contractor", "about the role", "role", "duties duties"]) == [1, 2, 0, 1]
    assert evaluate(T.apply_signals, ["attach your file(s)", "attach your file", "x"]) == [2, 1, 0]


def test_page_verdicts(evaluate):
    assert evaluate(T.is_closed, ["call 0404 123", "", "open", "not found"]) == [True, True, False, True]
    seven = "apply for this job submit application attach your file(s) drag and drop maximum file size first name"
    nine = seven + " last name email address"
    assert evaluate(T.is_apply_only, ["", seven, seven + " skills duties", nine + " skills duties", nine + " skills duties hours"]) == [
        True, True, False, True, False,
    ]
    assert evaluate(T.has_retry_signal, ["now loading", "apply now", "nothing"]) == [True, True, False]
    assert evaluate(T.has_board_signal, ["filter by team", "jobs"]) == [True, False]


def test_titles(evaluate):
    values = ["Leadership Team", "Lead", "CEO", "leading", "  Data\n Engineer ", None, "x" * 120 + "lead", "Cookie Manager", "UX"]
    assert evaluate(T.looks_like_title, values) == [False, True, False, True, True, False, False, False, False]


def test_locations(evaluate):
    values = [
        "Leeds, UK, hybrid", "London, United Kingdom", "London , UK", "xremote", "éremote", "remote é", "Paris ,\xa0united kingdom!",
        "", None, "a, b", "ab, cd_", "Onsite.", "ab,cd",
    ]
    assert evaluate(T.location_from_text, values) == [
        "hybrid", "London, United", "London , UK", "", "", "remote", "Paris ,\xa0united kingdom", "", "", "", "", "Onsite", "ab,cd",
    ]


def test_headings(evaluate):
    values = ["One line", "ab", "A\r\nBoss lady\n\n  C  D—E \x1cno*", "Señor", "x" * 121, "x" * 120, None]
    assert evaluate(T.headings, values) == [
        ["One line"], [], ["Boss lady", "C D—E"], [], [], ["x" * 120], [],
    ]
    lines = "\n".join(f"line {i}" for i in range(30))
    assert len(evaluate(T.headings, [lines])[0]) == 30
    assert len(evaluate(lambda x: T.headings(x, 20), [lines])[0]) == 20


def test_best_title(spark):
    rows = [
        (" Data Analyst ", "Manager", "", "Data Analyst"), ("Learn more", " Manager ", "", "Manager"),
        ("", "View", "Nothing\nProject Lead\nBuyer", "Project Lead"), (None, None, None, ""), ("Privacy Manager", "x", "y", ""),
    ]
    df = spark.createDataFrame(rows, "c string, l string, n string, want string")
    bad = df.filter(T.best_title(F.col("c"), F.col("l"), F.col("n")) != F.col("want"))
    assert bad.count() == 0


def test_first_present(spark):
    df = spark.createDataFrame([("  ", "b"), ("", "b"), (None, " b "), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(T.first_present(F.col("a"), F.col("b"), "d")).collect()] == ["", "b", "b", "d"]


def test_attachment_reason(evaluate):
    assert evaluate(T.attachment_reason, ["Only a PDF", "see documents", "attachment", "none", None]) == [True, True, True, False, False]


def test_single_blanks_are_not_replaced_one_by_one(spark):
    """Runs collapse as before; a text of words between single blanks holds nothing to replace."""
    texts = ["a b c d", " a  b\t\tc d  \n", " ", "a  b  c", "a\xa0b"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string")
    got = rows.select("i", T.collapse(F.col("x")).alias("y"), F.regexp_count("x", F.lit(T.SPACE_RUN)).alias("n")).orderBy("i").collect()
    assert [r.y for r in got] == [" ".join(x.split()) for x in texts]
    assert [r.n for r in got] == [0, 3, 0, 2, 1]


def test_noise_is_found_whatever_its_case(evaluate):
    texts = ["x COOKIE policy a ACCEPT ALL y", "x We Use Cookies no Reject y", "x ſkip to content y", "x SHARE THIſ job y", "x cookie policy y"]
    assert evaluate(lambda x: T._remove_noise(x, None), texts) == ["x y"] * 4 + ["x cookie policy y"]
