"""Which titles stand in the text of their page.

The distinct titles of a page are gathered in parts of bounded size and the text is joined once per part: all titles of a part are tested against one
normalized text, and only those that are found go on. So no text is copied per title, and a page with any number of titles stays in small groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsieve.functions.text import once, text
from jobsieve.operators.pages import lowered_page, of_pass

TITLES_PER_PART = 256


def titles_in_texts(asked: DataFrame, wide: DataFrame, per_part: int = TITLES_PER_PART) -> DataFrame:
    """``asked`` has distinct (page_url, render_pass, title), titles normalized, and about how many titles the page has in ``n``; the result has those
    whose title occurs in the page's text."""
    page = ["page_url", "render_pass"]
    asked = asked.withColumn("__parts", F.ceil(F.col("n") / per_part))
    asked = asked.withColumn("__part", F.pmod(F.xxhash64("title"), F.greatest("__parts", F.lit(1))))
    gathered = asked.groupBy(*page, "__part").agg(F.collect_list("title").alias("__titles"))
    texts = gathered.join(wide, F.col("page_url") == F.col("url")).select(*page, "__titles", of_pass("t", "body_text").alias("__text"))
    texts = once(texts, __nt=text(lowered_page(F.col("__text"))))
    return texts.select(*page, F.explode(F.filter("__titles", lambda t: F.contains(F.col("__nt"), t))).alias("title"))
