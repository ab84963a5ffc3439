"""Model answers as tables: tolerant JSON (T6), job lists (T7), request texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsieve.functions.text import cut, once, strip
from jobsieve.functions.urls import normalize_url

SEED_FIELDS = ["company_name", "job_title", "job_url", "job_location", "confidence", "reason"]
JOB_FIELDS = [
    "company_name", "job_title", "job_url", "job_location", "job_posted_date", "job_posted_date_source",
    "confidence", "reason",
]


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def unfenced(answer: Column) -> Column:
    """Answer text without the code fence it may start and end with."""
    plain = strip(answer)
    opened = strip(F.regexp_replace(plain, r"(?i)\A```(?:json)?", ""))
    closed = strip(F.regexp_replace(opened, r"```\z", ""))
    return F.when(F.startswith(plain, F.lit("```")), closed).otherwise(plain)


def whole_json(value: Column) -> Column:
    """The value as a VARIANT if all of it is one JSON value, else null.

    The parser stops after the first value, so trailing text goes unnoticed. Inside ``[ ]`` it does not, unless the
    text closes the bracket itself; then it cannot also be a valid member of ``{ }``.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), value, F.lit("\n]")))
    member = F.try_parse_json(F.concat(F.lit('{"v":'), value, F.lit("\n}")))
    only = F.try_variant_get(listed, "$[0]", "variant")
    single = F.try_variant_get(listed, "$[1]", "variant").isNull() & only.isNotNull() & member.isNotNull()
    return F.when(single, only)


def parse_answer(df: DataFrame, answer: str, out: str = "data") -> DataFrame:
    """Add the answer's JSON object; null where there is none.

    Text around the object is tolerated by a second look at the outermost braces, but only when the text as a whole
    is no JSON: a list or a number is an answer without an object.
    """
    df = once(df, __plain=unfenced(F.col(answer)))
    df = once(df, __whole=whole_json(F.col("__plain")))
    braces = F.regexp_extract(F.col("__plain"), r"(?s)\{.*\}", 0)
    df = once(df, __json=F.coalesce(F.col("__whole"), whole_json(braces)))
    data = F.when(F.startswith(_kind(F.col("__json")), F.lit("OBJECT")), F.col("__json"))
    return df.withColumn(out, data).drop("__plain", "__whole", "__json")


def answer_text(data: Column, field: str) -> Column:
    """A field as text. Absent, null, false, zero and empty containers count as empty."""
    return value_text(F.try_variant_get(data, f"$.{field}", "variant"))


def value_text(value: Column) -> Column:
    kind, as_text = _kind(value), F.try_variant_get(value, "$", "string")
    number = F.rlike(kind, F.lit("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"))
    return (
        F.when(value.isNull() | (kind == "VOID"), "")
        .when(kind == "BOOLEAN", F.when(as_text == "true", "True").otherwise(""))
        .when(number & (F.try_variant_get(value, "$", "double") == 0), "")
        .when(as_text.isin("[]", "{}"), "")
        .otherwise(F.coalesce(as_text, F.lit("")))
    )


def refuses(data: Column) -> Column:
    """The answer says ``is_valid_open_job`` is the boolean false; the string "false" does not count."""
    flag = F.try_variant_get(data, "$.is_valid_open_job", "variant")
    is_false = (_kind(flag) == "BOOLEAN") & ~F.try_variant_get(flag, "$", "boolean")
    return F.coalesce(is_false, F.lit(False))


def answer_seeds(parsed: DataFrame, groups: list[str]) -> DataFrame:
    """The objects in the ``jobs`` list of a parsed answer, as seeds in list order."""
    jobs = F.try_variant_get("data", "$.jobs", "array<variant>")
    items = parsed.select(*groups, F.posexplode(jobs).alias("seed_ord", "item"))
    items = items.filter(F.startswith(_kind(F.col("item")), F.lit("OBJECT")))
    fields = [answer_text(F.col("item"), f).alias(f) for f in SEED_FIELDS]
    return items.select(*groups, "seed_ord", F.lit("llm").alias("origin"), *fields)


def answers_of(answers: DataFrame, stage: str) -> DataFrame:
    """The parsed answers of one stage, one per normalized URL and render pass, as (answer_url, render_pass, data).

    An answer without a pass counts for both, but one that names the pass goes before it; of several the latest counts (greatest ``answered_ord``),
    then the first by text."""
    own = answers.filter(F.col("stage") == stage).select(
        normalize_url(F.col("url")).alias("answer_url"), F.col("render_pass").isNull().alias("shared"),
        F.explode(F.when(F.col("render_pass").isNull(), F.array(F.lit(0), F.lit(1))).otherwise(F.array("render_pass"))).alias("render_pass"),
        F.col("response_text"), (-F.coalesce("answered_ord", F.lit(0))).alias("older"),
    )
    one = own.groupBy("answer_url", "render_pass").agg(F.min_by("response_text", F.struct("shared", "older", "response_text")).alias("response_text"))
    return parse_answer(one, "response_text").select("answer_url", "render_pass", "data")


def career_requests(pages: DataFrame, max_cards: int | None = None) -> DataFrame:
    """T8 for career pages: needs page_url, company_domain, body_text, cards (of which only the first ``max_cards`` are shown, where that is given)."""
    cards = F.col("cards") if max_cards is None else F.slice("cards", 1, max_cards)
    shape = F.to_json(F.struct(F.array(F.struct(*[F.lit("").alias(f) for f in SEED_FIELDS])).alias("jobs")))
    prompt = F.concat_ws(
        "\n",
        F.lit("List every open job that this career page shows. Answer with one JSON object and nothing else."),
        F.lit("Give the address of a job's own HTML page as job_url. Leave job_url empty for a job that is only "
              "shown on this page or only linked as a document, and say in reason when it is a document. Legal, "
              "privacy, cookie, team and people pages are no job pages. Invent nothing."),
        F.concat(F.lit("Form of the answer: "), shape),
        F.concat(F.lit("Company domain: "), F.col("company_domain")),
        F.concat(F.lit("Career page: "), F.col("page_url")),
        F.lit("Text of the page:"),
        F.col("body_text"),
        F.lit("Cards on the page:"),
        F.to_json(cards),
    )
    return pages.select(F.lit("career").alias("stage"), F.col("page_url").alias("url"), prompt.alias("prompt"))


def job_requests(jobs: DataFrame, max_chars: int | None = None) -> DataFrame:
    """T8 for job pages: needs job_page_url, company_domain, description, posted_date, posted_date_source."""
    shape = F.to_json(
        F.struct(F.lit(True).alias("is_valid_open_job"), *[F.lit("").alias(f) for f in JOB_FIELDS])
    )
    prompt = F.concat_ws(
        "\n",
        F.lit("Describe the open job on this page. Answer with one JSON object and nothing else."),
        F.lit('Answer {"is_valid_open_job": false} when the page holds no real job description; an apply form '
              "next to a real description is fine."),
        F.concat(F.lit("Form of the answer otherwise: "), shape),
        F.concat(F.lit("Company domain: "), F.col("company_domain")),
        F.concat(F.lit("Job page: "), F.col("job_page_url")),
        F.concat(F.lit("Posting date found in the page: "), F.col("posted_date")),
        F.concat(F.lit("Where it was found: "), F.col("posted_date_source")),
        F.lit("Text of the page:"),
        cut(F.col("description"), max_chars),
    )
    return jobs.select(F.lit("job").alias("stage"), F.col("job_page_url").alias("url"), prompt.alias("prompt"))
