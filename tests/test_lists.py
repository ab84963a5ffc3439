"""S4, J1-J3, P12."""

import random

from pyspark.sql import functions as F

from jobsieve.operators import keywords as W
from jobsieve.operators import lists as L
from jobsieve.operators.classify import gate
from jobsieve.sources.files import materialize

SCHEMA = "list_name string, company_website string, company_name string, external_url string"


def _flags(spark, rows):
    return L.key_flags(L.list_keys(spark.createDataFrame(rows, SCHEMA)))


def test_keys_are_normalized_and_distinct(spark):
    rows = [("customers", "https://www.X.com/", "  Big  CO ", None), ("customers", "x.com", "big co", None), ("customers", None, "", None), ("active", "", None, " https://A/b// ")]
    keys = L.list_keys(spark.createDataFrame(rows, SCHEMA))
    assert sorted(tuple(r) for r in keys.collect()) == [
        ("active", "url", "https://A/b"), ("customers", "domain", "x.com"), ("customers", "name", "big co"),
    ]
    assert sorted(tuple(r) for r in L.key_counts(keys).collect()) == [("active", "url", 1), ("customers", "domain", 1), ("customers", "name", 1)]


def test_screening_and_labels(spark):
    flags = _flags(spark, [
        ("blacklist", "bad.com", "Bad", None), ("customers", "cust.com", "Cust", None), ("churned", "old.com", "Old", None),
        ("active", "old.com", None, "https://x.com/Jobs/1"), ("active", "act.com", "Act", None),
    ])
    rows = [
        ("bad.com", "", "t", "u", True, "inactive"), ("x.com", " BAD ", "t", "u", True, "inactive"), ("jobs.bad.com", "", "t", "u", False, "inactive"),
        ("old.com", "", "t", "u", False, "churned"), ("act.com", None, "t", "u", False, "active"), ("x.com", "act", "t", "u", False, "active"),
        ("x.com", "", "Excellence Manager", "u", True, "inactive"), ("x.com", "", "t", "https://x.com/Jobs/1/", True, "inactive"),
        ("x.com", "", "t", "https://x.com/jobs/1", False, "inactive"), ("", "", "", "", False, "inactive"), (None, None, None, None, False, "inactive"),
    ]
    df = spark.createDataFrame(rows, "company_domain string, company_name string, job_title string, job_url string, want boolean, label string")
    keywords = spark.createDataFrame([("cell",)], "keyword string")
    got = L.with_screening(df, flags, W.keyword_index(keywords, df), ("company_domain", "company_name", "job_title", "job_url")).collect()
    assert len(got) == len(rows)
    assert [r for r in got if r.is_removed != r.want or r.list_label != r.label] == []


def test_no_pair_comparison_in_list_joins(spark):
    flags = _flags(spark, [("blacklist", "bad.com", "Bad", None)])
    df = spark.createDataFrame([("bad.com", "", "t", "u")], "company_domain string, company_name string, job_title string, job_url string")
    keywords = spark.createDataFrame([("cell",)], "keyword string")
    plan = L.with_screening(df, flags, W.keyword_index(keywords, df), ("job_url",))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_screened_rows_are_not_moved_for_each_kind_of_key(spark, tmp_path):
    rng = random.Random(9)
    many = [("blacklist", f"{rng.randbytes(12).hex()}.com", rng.randbytes(12).hex(), None) for _ in range(10000)]
    flags = _flags(spark, [*many, ("blacklist", "bad3.com", None, None), ("customers", None, "Bad 4", None), ("active", None, None, "https://x.com/jobs/5"), ("churned", "bad7.com", None, None)])
    resolved = spark.range(50).selectExpr(
        "id as root_ord", "'r' as root_url", "if(id = 0, null, concat('bad', id, '.com')) as company_domain", "0 as page_ord", "'p' as page_url", "0 as render_pass",
        "0 as origin_rank", "id as seed_ord", "'rule' as origin", "'t' as job_title", "'' as job_url", "if(id = 1, '', concat(' BAD  ', id)) as r_company_name",
        "if(id = 6, 'Excellence', 'Title') as r_title", "concat('https://x.com/jobs/', id, '/') as r_url", "cast(null as string) as invalid_reason", "'' as r_location",
        "'' as r_date", "'' as r_date_source", "'' as r_confidence", "'' as r_reason", "true as r_real", "'p' as text_url", "0 as text_pass",
        "cast(null as string) as early_kind", "cast(null as string) as early_url", "cast(null as int) as early_pass",
    )
    index = W.keyword_index(spark.createDataFrame([("cell",)], "keyword string"), resolved, "r_title")
    plain = gate(resolved, flags, index)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        written = materialize(flags, str(tmp_path), "flags")
        rows = gate(resolved, written, index, found=lambda df, name: materialize(df, str(tmp_path), name))
        assert "SortMergeJoin" not in rows._jdf.queryExecution().executedPlan().toString()
        got = rows.collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r.seed_ord for r in got if r.skip_reason} == {3, 4, 5, 6} and {r.seed_ord for r in got if r.List == "churned"} == {7}
    assert sorted(got, key=lambda r: r.seed_ord) == sorted(plain.collect(), key=lambda r: r.seed_ord)


def test_keywords_agree_with_brute_force(spark):
    random.seed(3)
    letters = "abc d"
    keywords = sorted({"".join(random.choices(letters, k=random.randint(1, 6))).strip() for _ in range(60)} - {""}) + ["a.c", "\\Ex"]
    titles = ["".join(random.choices(letters + "e", k=random.randint(0, 7))) for _ in range(300)] + ["A.C", "abc", None, "", "\\ex", "xx\\Ex", "e" * 5000 + "abcd"]
    titles += ["eee abc"] * 200  # one title holds a third of the rows
    df = spark.createDataFrame(list(enumerate(titles)), "i int, job_title string")
    table = spark.createDataFrame([(k,) for k in [*keywords, keywords[0], ""]], "keyword string")
    lowered = [" ".join(t.lower().split()) if t else "" for t in titles]
    for few in (keywords, [k for k in keywords if len(k) > 4], ["d"]):
        expected = [any(k in t for k in few) for t in lowered]
        own = table.filter(F.col("keyword").isin(few))
        # The index serves titles that it was not built with.
        for seen in (df, df.limit(3), df.limit(0)):
            got = [r.has_keyword for r in W.with_keyword_hit(df, W.keyword_index(own, seen), ids=("i",)).orderBy("i").collect()]
            assert got == expected
    none = W.keyword_index(spark.createDataFrame([], "keyword string"), df)
    assert not W.with_keyword_hit(df, none, ids=("i",)).filter("has_keyword").count()


def test_a_keyword_is_filed_under_its_rarest_piece(spark):
    titles = spark.createDataFrame([("abcd",), ("abce",), ("xbcd",), ("zq",)], "t string")
    keywords = spark.createDataFrame([("abcd",), ("bcd",), ("zq",), ("nowhere",), ("abcx",)], "keyword string")
    index = W.keyword_index(keywords, titles, "t")
    assert {r.keyword: r.piece for r in index.collect()} == {"abcd": "abc", "bcd": "bcd", "zq": "zq", "nowhere": "ere", "abcx": "bcx"}
    plan = W.with_keyword_hit(titles, index, "t")._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_rows_without_a_key_do_not_share_one(spark):
    df = spark.range(1000).select(F.col("id"), F.lit("").alias("company_name"), F.lit("x.com").alias("company_domain"))
    keyed = df.select(L.own_key(F.col("company_name"), "id").alias("k"))
    assert keyed.distinct().count() == 1000
    assert keyed.filter(~F.startswith("k", F.lit(" "))).count() == 0
