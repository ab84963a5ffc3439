"""T6-T8 and S8."""

import json

from pyspark.sql import functions as F

from jobsieve.operators import answers as A
from jobsieve.sources import files


def _parse(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, response_text string")
    return A.parse_answer(df, "response_text")


def test_objects_are_found_like_a_tolerant_reader_would(spark):
    texts = [
        '```json\n{"a": 1}\n```', '```JSON{"a": 1}```', 'Sure: {"a": 1} ok', "[1]", "5", "no", "", None, '{"a": 1} and {"b": 2}',
        '[1] {"a": 1}', ' {"a": 1}\n', '{"a": 1', '"{}"', "null", '{"a": 1}, {"a": 2}', '{"a": 1}]', "``` nothing ```",
        '1] , {"a": 1}', "```json\n[1]\n``` {\"a\": 1}",
    ]

    def expected(text):
        plain = (text or "").strip()
        if plain.startswith("```"):
            plain = plain[3:]
            plain = (plain[4:] if plain[:4].lower() == "json" else plain).strip()
            plain = plain.removesuffix("```").strip()
        for candidate in (plain, plain[plain.find("{"): plain.rfind("}") + 1]):
            try:
                found = json.loads(candidate)
            except ValueError:
                continue
            return isinstance(found, dict)
        return False

    got = _parse(spark, texts).select("i", F.col("data").isNotNull().alias("ok")).orderBy("i").collect()
    assert [r.ok for r in got] == [expected(t) for t in texts]


def test_fields_and_flags(spark):
    texts = [
        '{"v": "x", "is_valid_open_job": false}', '{"v": 0, "is_valid_open_job": "false"}', '{"v": null}', '{"v": false}', '{"v": true}',
        '{"v": []}', '{"v": 7}', '{"v": {"k": 1}}', '{"v": " s "}', "none", '{"is_valid_open_job": true}', '{"is_valid_open_job": null}',
    ]
    rows = _parse(spark, texts).select("i", A.answer_text(F.col("data"), "v").alias("v"), A.refuses(F.col("data")).alias("no")).orderBy("i").collect()
    assert [r.v for r in rows] == ["x", "", "", "", "True", "", "7", '{"k":1}', " s ", "", "", ""]
    assert [i for i, r in enumerate(rows) if r.no] == [0]


def test_seeds_from_a_mixed_list(spark):
    texts = ['{"jobs": [{"job_title": "A", "job_url": 5}, "str", null, {"job_title": null}]}', '{"jobs": {"job_title": "B"}}', '{"jobs": []}', "x", '{"jobs": "[{}]"}']
    seeds = A.answer_seeds(_parse(spark, texts), ["i"]).orderBy("i", "seed_ord").collect()
    assert [(s.i, s.seed_ord, s.job_title, s.job_url, s.origin) for s in seeds] == [(0, 0, "A", "5", "llm"), (0, 3, "", "", "llm")]


def test_one_answer_per_stage_and_url(spark):
    df = spark.createDataFrame(
        [
            ("job", "u", 0, '{"a": 2}', 1), ("job", "u/", 0, '{"a": 1}', 1), ("job", " u//", 0, '{"a": 0}', 0), ("career", "u", 0, '{"a": 3}', 5),
            ("job", "u", None, '{"a": 4}', 9), ("job", "v", None, '{"a": 5}', None), ("job", "v", None, '{"a": 6}', 3), ("job", "v", 1, "none", None),
        ],
        files.ANSWER_SCHEMA,
    )
    got = A.answers_of(df, "job").select("answer_url", "render_pass", F.col("data").cast("string").alias("d")).collect()
    assert sorted((r.answer_url, r.render_pass, r.d) for r in got if r.d) == [("u", 0, '{"a":1}'), ("u", 1, '{"a":4}'), ("v", 0, '{"a":6}')]
    assert len(got) == 4


def test_requests_hold_the_page_and_its_cards(spark):
    card = F.struct(F.lit("h").alias("href"), F.lit("l").alias("link_text"), F.lit("n").alias("nearby_text"), F.lit("t").alias("card_title"))
    pages = spark.range(1).select(
        F.lit("https://x.com/c").alias("page_url"), F.lit("x.com").alias("company_domain"), F.lit("BODY TEXT").alias("body_text"),
        F.array_repeat(card, 300).alias("cards"),
    )
    row = A.career_requests(pages).first()
    assert (row.stage, row.url) == ("career", "https://x.com/c")
    assert "BODY TEXT" in row.prompt and row.prompt.count('"card_title":"t"') == 300
    assert A.career_requests(pages, max_cards=250).first().prompt.count('"card_title":"t"') == 250
