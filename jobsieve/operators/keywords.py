"""Which titles contain a keyword anywhere, also inside a word, by an inverted index.

Each keyword is filed under the piece of three characters that fewest titles have (shorter keywords under themselves). A title meets the keywords
that are filed under its own pieces, by equality; whether it holds them is then looked up in the title. The index serves any titles; those it is built with only
say which pieces are rare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsieve.functions.text import normalize_text, own_key

PIECE = 3


def pieces(x: Column, sizes: tuple[int, ...]) -> Column:
    """The distinct substrings of the given sizes."""
    found = [
        F.when(F.length(x) >= n, F.transform(F.sequence(F.lit(1), F.length(x) - (n - 1)), lambda at: F.substring(x, at, F.lit(n)))).otherwise(F.array().cast("array<string>"))
        for n in sizes
    ]
    return F.array_distinct(F.concat(*found))


def title_pieces(titles: DataFrame, title: str = "job_title") -> DataFrame:
    """(__title, piece): the pieces of every distinct normalized title."""
    own = titles.select(normalize_text(F.col(title)).alias("__title")).filter(F.col("__title") != "").distinct()
    return own.select("__title", F.explode(pieces(F.col("__title"), tuple(range(1, PIECE + 1)))).alias("piece"))


def keyword_index(keywords: DataFrame, titles: DataFrame, title: str = "job_title") -> DataFrame:
    """(piece, keyword): every keyword, filed under its rarest piece."""
    distinct = keywords.select("keyword").filter(F.col("keyword") != "").distinct()
    size = F.least(F.length("keyword"), F.lit(PIECE))
    own = F.when(size < PIECE, F.array("keyword")).otherwise(pieces(F.col("keyword"), (PIECE,)))
    filed = distinct.select("keyword", F.explode(own).alias("piece"))
    # Pieces are counted where they are made: what is moved is a number per piece, never a piece of a title.
    counts = title_pieces(titles, title).groupBy("piece").agg(F.count("*").alias("n"))
    rarest = F.min_by("piece", F.struct(F.coalesce("n", F.lit(0)), "piece"))
    return filed.join(counts, "piece", "left").groupBy("keyword").agg(rarest.alias("piece"))


def hit_titles(df: DataFrame, index: DataFrame, title: str = "job_title") -> DataFrame:
    """(__title, __hit): the distinct normalized titles that hold a keyword. ``index`` is a ``keyword_index``."""
    met = title_pieces(df, title).join(index, "piece")
    return met.filter(F.contains("__title", F.col("keyword"))).select("__title").distinct().withColumn("__hit", F.lit(True))


def with_keyword_hit(df: DataFrame, index: DataFrame, title: str = "job_title", ids: tuple[str, ...] = ()) -> DataFrame:
    """Add ``has_keyword``. ``ids`` tell rows without a title apart, so that they do not meet in one task."""
    return with_title_hit(df, hit_titles(df, index, title), title, ids)


def with_title_hit(df: DataFrame, hits: DataFrame, title: str = "job_title", ids: tuple[str, ...] = ()) -> DataFrame:
    """The same by ``hit_titles`` of the rows."""
    out = df.withColumn("__title", own_key(normalize_text(F.col(title)), *(ids or (title,)))).join(hits, "__title", "left")
    return out.withColumn("has_keyword", F.coalesce("__hit", F.lit(False))).drop("__title", "__hit")
