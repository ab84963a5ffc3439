"""The decision tree per seed (C1, C2) and the gates per row.

Every verdict on a text is a flag of the page store, so the joins here (J4-J6) move flags and references, never texts per seed. Samples and descriptions
are looked up at the end, for the rows that show them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsieve import constants as C
from jobsieve.functions.text import (
    attachment_reason,
    first_present,
    normalize_text,
    once,
    own_key,
    present,
    strip,
    text,
)
from jobsieve.functions.urls import is_attachment, is_bad_url, is_blocked_board, is_profile_url, normalize_url
from jobsieve.operators.answers import JOB_FIELDS
from jobsieve.operators.dedupe import is_large_board
from jobsieve.operators.lists import with_screening
from jobsieve.operators.pages import PageStore, of_pass
from jobsieve.operators.titles import titles_in_texts

#: A visit of a page, and a seed on it.
VISIT = ["root_ord", "page_ord", "render_pass"]
SEED = [*VISIT, "origin_rank", "seed_ord"]
PAGE_GROUPS = ["root_ord", "root_url", "company_domain", "page_ord", "page_url", "render_pass"]
PAGE_FLAGS = ["has_text", "board_signal", "real_description"]
#: Writes rows and reads them back, and the same for a table under a name.
Keep, Found = Callable[[DataFrame], DataFrame], Callable[[DataFrame, str], DataFrame]


def page_flags(visits: DataFrame, store: PageStore) -> DataFrame:
    """VISIT, page_url and the flags of the page, for visits of pages that were fetched."""
    joined = visits.select(*VISIT, "page_url").join(store.narrow, F.col("page_url") == F.col("url"))
    flags = [of_pass("p", f).alias(f) for f in PAGE_FLAGS]
    return joined.filter(of_pass("p", "fetch_ok")).select(*VISIT, "page_url", *flags)


def same_page_reason(page_url: Column, has_text: Column, title: Column, board: Column, title_found: Column, real: Column) -> Column:
    """Null when the job on its career page is accepted, else why not."""
    missing = (normalize_url(page_url) == "") | ~has_text | (strip(title) == "")
    return (
        F.when(missing, C.SAME_PAGE_NO_URL)
        .when(board, C.SAME_PAGE_BOARD)
        .when(~title_found, C.SAME_PAGE_NO_TITLE)
        .when(~real, C.SAME_PAGE_NO_DESCRIPTION)
    )


def with_same_page(seeds: DataFrame, flags: DataFrame, store: PageStore) -> DataFrame:
    """Add ``title_count`` and ``same_reason``. ``flags`` is ``page_flags`` of the seeds' visits.

    The titles of a visit are made distinct first; its verdicts come back by visit, the titles found by title."""
    seeds = seeds.withColumn("__title", normalize_text(F.col("job_title")))
    titles = seeds.select(*VISIT, "__title").filter(F.col("__title") != "").distinct()
    counts = titles.groupBy(*VISIT).agg(F.count("*").cast("int").alias("title_count"))
    verdicts = flags.join(counts, VISIT, "left").withColumn("title_count", F.coalesce("title_count", F.lit(0)))
    verdicts = verdicts.withColumn("__board", is_large_board(F.col("title_count"), F.col("board_signal")))
    asked = titles.join(verdicts.filter("has_text and not __board"), VISIT).groupBy("page_url", "render_pass", F.col("__title").alias("title")).agg(
        F.max("title_count").alias("n")
    )
    found = titles_in_texts(asked, store.wide).select("page_url", "render_pass", F.col("title").alias("__title"), F.lit(True).alias("__found"))
    joined = seeds.join(verdicts.select(*VISIT, "title_count", "has_text", "__board", F.col("real_description").alias("__real")), VISIT, "left")
    # Seeds without a title are in no text; they keep apart from each other.
    joined = joined.withColumn("__title", own_key(F.col("__title"), *SEED)).join(found, ["page_url", "render_pass", "__title"], "left")
    false = F.lit(False)
    reason = same_page_reason(
        F.col("page_url"), F.coalesce("has_text", false), F.col("job_title"), F.coalesce("__board", false), F.coalesce("__found", false), F.coalesce("__real", false)
    )
    return joined.withColumns({"same_reason": reason, "title_count": F.coalesce("title_count", F.lit(0))}).drop("__title", "__found", "__real", "__board", "has_text")


def with_job_page(seeds: DataFrame, store: PageStore) -> DataFrame:
    """Add the facts of the linked job page and the model's answer about it, each looked up once per URL.

    Without a snapshot the page counts as empty: no description, and an empty text is an apply form.
    """
    seeds = once(seeds, seed_url=normalize_url(F.col("job_url")))
    p = F.col("p0")
    urls = seeds.select(F.col("seed_url").alias("__key")).filter(F.col("__key") != "").distinct()
    pages = urls.join(store.narrow, F.col("__key") == F.col("url")).filter(p["fetch_ok"]).join(store.answers, "url", "left").select(
        "__key",
        p["final_url"].alias("j_final_url"),
        p["real_description"].alias("j_real"),
        p["apply_only"].alias("j_apply_only"),
        p["posted_date"].alias("j_date"),
        p["posted_date_source"].alias("j_date_source"),
        "a_refuses",
        *[f"a_{f}" for f in JOB_FIELDS],
    )
    joined = seeds.withColumn("__key", own_key(F.col("seed_url"), *SEED)).join(pages, "__key", "left")
    filled = {c: text(F.col(c)) for c in ("j_date", "j_date_source")}
    filled |= {f"a_{f}": text(F.col(f"a_{f}")) for f in JOB_FIELDS}
    return joined.withColumns(
        filled
        | {
            "j_final_url": F.coalesce("j_final_url", F.col("seed_url")),
            "j_real": F.coalesce("j_real", F.lit(False)),
            "j_apply_only": F.coalesce("j_apply_only", F.lit(True)),
            "a_refuses": F.coalesce("a_refuses", F.lit(False)),
        }
    ).drop("__key")


def resolve(seeds: DataFrame) -> DataFrame:
    """C2 on joined seeds: ``outcome`` is 'same_page', 'job_page' or null with an ``invalid_reason``.

    ``r_*`` are the fields of the result; ``r_url`` is null where the result names no URL. ``text_url`` and ``text_pass`` name the page with the description,
    ``early_kind`` the sample that a refusal shows ('sample' or 'description', of ``early_url`` and ``early_pass``).
    """
    url, final = F.col("seed_url"), F.col("j_final_url")
    opened = F.coalesce(present(final), url)
    same_ok = F.col("same_reason").isNull()
    seeds = once(
        seeds,
        step=F.when((url == "") & attachment_reason(F.col("reason")), "attachment_reason")
        .when(url == "", F.when(same_ok, "same_page").otherwise("same_page_refused"))
        .when(is_attachment(url), "attachment")
        .when(is_profile_url(url), "profile")
        .when(is_profile_url(final), "final_profile")
        .when(~F.col("j_real") & same_ok, "same_page")
        .when(~F.col("j_real") & F.col("j_apply_only"), "apply_form")
        .when(~F.col("j_real"), "closed")
        .when(F.col("a_refuses") & same_ok, "same_page")
        .when(F.col("a_refuses"), "model_refused")
        .otherwise("job_page"),
    )
    step = F.col("step")
    invalid = (
        F.when(step.isin("attachment_reason", "attachment"), C.ATTACHMENT_ONLY)
        .when(step == "same_page_refused", F.col("same_reason"))
        .when(step.isin("profile", "final_profile"), C.PROFILE_PAGE)
        .when(step == "apply_form", C.APPLY_FORM)
        .when(step == "closed", C.CLOSED_PAGE)
        .when(step == "model_refused", C.MODEL_REFUSED)
    )
    same_page = step == "same_page"
    page_url = normalize_url(F.col("page_url"))
    named_url = (
        F.when(same_page, page_url)
        .when(step == "same_page_refused", F.when(F.col("same_reason") != C.SAME_PAGE_NO_URL, page_url))
        .when(step.isin("attachment", "profile"), url)
        .when(step == "final_profile", final)
        .when(step.isin("apply_form", "closed", "model_refused"), opened)
        .when(step == "job_page", normalize_url(F.coalesce(present(F.col("a_job_url")), opened)))
    )
    of_job = step.isin("final_profile", "apply_form", "closed")
    of_page = (step == "same_page_refused") & (F.col("same_reason") == C.SAME_PAGE_NO_DESCRIPTION)

    def field(name: str, *more: Column | str) -> Column:
        own = F.col(name)
        return F.when(same_page, first_present(own, *more)).otherwise(first_present(F.col(f"a_{name}"), own, *more))

    same_reason_text = F.coalesce(present(strip(F.col("reason"))), F.lit(C.SAME_PAGE_ACCEPTED))
    return once(
        seeds,
        invalid_reason=invalid,
        outcome=F.when(step.isin("same_page", "job_page"), step),
        r_url=named_url,
        r_company_name=field("company_name"),
        r_title=field("job_title"),
        r_location=field("job_location"),
        r_confidence=field("confidence", C.DEFAULT_CONFIDENCE),
        r_reason=F.when(same_page, same_reason_text).otherwise(first_present(F.col("a_reason"), F.col("reason"))),
        r_date=F.when(same_page, "").otherwise(first_present(F.col("a_job_posted_date"), F.col("j_date"))),
        r_date_source=F.when(same_page, "").otherwise(
            first_present(F.col("a_job_posted_date_source"), F.col("j_date_source"))
        ),
        r_real=F.when(step.isin("same_page", "job_page"), F.lit(True)).otherwise(F.lit(False)),
        text_url=F.when(same_page, F.col("page_url")).when(step == "job_page", url),
        text_pass=F.when(same_page, F.col("render_pass")).when(step == "job_page", F.lit(0)),
        early_kind=F.when(of_job, "sample").when(of_page, "description"),
        early_url=F.when(of_job, url).when(of_page, F.col("page_url")),
        early_pass=F.when(of_job, F.lit(0)).when(of_page, F.col("render_pass")),
    ).drop("step")


def gate_reason(
    invalid: Column, title: Column, url: Column, real: Column, removed: Column
) -> Column:
    """The first gate that stops a row, or null."""
    return (
        F.when(invalid.isNotNull(), invalid)
        .when(title == "", C.GATE_NO_TITLE)
        .when(url == "", C.GATE_NO_URL)
        .when(is_blocked_board(url), C.GATE_BLOCKED_BOARD)
        .when(is_bad_url(url), C.GATE_BAD_URL)
        .when(is_profile_url(url), C.GATE_PROFILE)
        .when(~real, C.GATE_DESCRIPTION)
        .when(removed, C.GATE_LISTED)
    )


def gate(resolved: DataFrame, flags: DataFrame, index: DataFrame, keep: Keep = lambda df: df, found: Found | None = None) -> DataFrame:
    """C3 with J2 and J3: one row per seed with ``skip_reason`` (null when kept) and all output fields; samples and descriptions by reference.

    ``keep`` may write the rows to be screened: titles are looked up apart from the rows, which are then not resolved a second time for that. ``found`` is the
    ``keep`` of ``with_screening``."""
    rows = resolved.withColumns({
        "seed_job_title": text(F.col("job_title")),
        "seed_job_url": text(F.col("job_url")),
        "company_name": F.col("r_company_name"),
        "job_title": F.col("r_title"),
        "job_url": normalize_url(F.coalesce(present(F.col("r_url")), F.col("job_url"))),
    })
    rows = keep(rows.select(
        *PAGE_GROUPS, "origin_rank", "seed_ord", "origin", "seed_job_title", "seed_job_url", "company_name", "job_title", "job_url", "invalid_reason",
        "r_url", "r_location", "r_date", "r_date_source", "r_confidence", "r_reason", "r_real", "text_url", "text_pass", "early_kind", "early_url", "early_pass",
    ))
    rows = once(with_screening(rows, flags, index, tuple(SEED), found), skip_reason=gate_reason(
        F.col("invalid_reason"), F.col("job_title"), F.col("job_url"), F.col("r_real"), F.col("is_removed")
    ))
    reason = F.col("skip_reason")
    invalid = F.col("invalid_reason").isNotNull()
    named = F.coalesce("r_url", F.col("seed_job_url"))
    final_url = F.when(invalid | (reason == C.GATE_NO_TITLE), named).when(reason == C.GATE_NO_URL, "").otherwise(F.col("job_url"))
    late = reason.isin(C.GATE_DESCRIPTION, C.GATE_LISTED)
    return rows.select(
        *PAGE_GROUPS, "origin_rank", "seed_ord", "origin", "seed_job_title", "seed_job_url", "skip_reason",
        final_url.alias("final_job_url"),
        invalid.alias("is_early"),
        F.when(invalid, F.col("early_kind")).when(late, "description").alias("sample_kind"),
        F.when(invalid, F.col("early_url")).when(late, F.col("text_url")).alias("sample_url"),
        F.when(invalid, F.col("early_pass")).when(late, F.col("text_pass")).alias("sample_pass"),
        F.col("list_label").alias("List"),
        "company_name", "job_title", "job_url",
        F.col("r_location").alias("job_location"),
        F.col("r_date").alias("job_posted_date"),
        F.col("r_date_source").alias("job_posted_date_source"),
        F.col("r_confidence").alias("confidence"),
        F.col("r_reason").alias("reason"),
        "text_url", "text_pass",
    )


def classify(
    seeds: DataFrame, page_flags: DataFrame, store: PageStore, flags: DataFrame, index: DataFrame, keep: Keep = lambda df: df, found: Found | None = None
) -> DataFrame:
    """C1-C3 for the seeds of processed pages. ``keep`` and ``found`` are those of ``gate``."""
    return gate(resolve(with_job_page(with_same_page(seeds, page_flags, store), store)), flags, index, keep, found)


def with_samples(results: DataFrame, store: PageStore) -> DataFrame:
    """Add ``job_page_text_sample``. Only rows that show one are joined, so that the others do not meet under an empty key."""
    shows = F.col("sample_kind").isNotNull() & F.col("sample_url").isNotNull()
    joined = results.filter(shows).join(store.samples, F.col("sample_url") == F.col("url"), "left")
    own = F.when(F.col("sample_kind") == "sample", of_pass("s", "sample", F.col("sample_pass"))).otherwise(of_pass("s", "description_sample", F.col("sample_pass")))
    fetched = of_pass("s", "fetch_ok", F.col("sample_pass"))
    found = joined.select(*results.columns, F.when(F.coalesce(fetched, F.lit(False)), text(own)).otherwise("").alias("job_page_text_sample"))
    return found.unionByName(results.filter(~shows).withColumn("job_page_text_sample", F.lit("")))


def skip_rows(results: DataFrame, store: PageStore, checked_at: str) -> DataFrame:
    """The skip log."""
    return with_samples(results.filter(F.col("skip_reason").isNotNull()), store).select(
        "company_domain",
        F.col("root_url").alias("career_page_url"),
        "seed_job_title", "seed_job_url", "final_job_url", "skip_reason", "job_page_text_sample",
        F.lit(checked_at).alias("checked_at_utc"),
    )


def job_rows(kept: DataFrame, store: PageStore, checked_at: str, source: str = C.SOURCE_LABEL, extra: tuple = ()) -> DataFrame:
    """Kept rows with their descriptions, which are only now read."""
    joined = kept.join(store.wide, F.col("text_url") == F.col("url"), "left")
    description = of_pass("t", "description", F.col("text_pass"))
    return once(joined, __description=strip(description), __length=F.length(text(description))).select(
        *extra,
        "List",
        F.lit(source).alias("source"),
        "company_domain", "company_name",
        F.col("root_url").alias("career_page_url"),
        "job_title", "job_url", "job_location",
        F.col("__description").alias("job_description"),
        F.col("__length").alias("job_description_length"),
        "job_posted_date", "job_posted_date_source", "confidence", "reason",
        F.lit(checked_at).alias("checked_at_utc"),
    )


def skip_counts(results: DataFrame) -> DataFrame:
    """A2: rows kept (blank reason) and skipped by reason."""
    return results.groupBy(F.coalesce("skip_reason", F.lit("")).alias("skip_reason")).agg(F.count("*").alias("n_rows"))
