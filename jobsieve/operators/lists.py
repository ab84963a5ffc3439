"""Company lists: J1-J3, S4's key table and its counts (A2)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsieve.functions.text import normalize_text, own_key
from jobsieve.functions.urls import normalize_domain, normalize_url
from jobsieve.operators.keywords import hit_titles, with_title_hit

LISTS = ("blacklist", "customers", "churned", "active")
# Churned wins over active.
LIST_LABEL = "case when on_churned then 'churned' when on_active then 'active' else 'inactive' end"


def list_keys(rows: DataFrame) -> DataFrame:
    """Raw list rows (list_name, company_website, company_name, external_url) -> distinct non-empty keys."""
    pairs = F.array(
        F.struct(F.lit("domain").alias("key_kind"), normalize_domain(F.col("company_website")).alias("key")),
        F.struct(F.lit("name").alias("key_kind"), normalize_text(F.col("company_name")).alias("key")),
        F.struct(F.lit("url").alias("key_kind"), normalize_url(F.col("external_url")).alias("key")),
    )
    return rows.select("list_name", F.inline(pairs)).filter(F.col("key") != "").distinct()


def key_counts(keys: DataFrame) -> DataFrame:
    """A2: keys per list and kind."""
    return keys.groupBy("list_name", "key_kind").agg(F.count("*").alias("n_keys"))


def key_flags(keys: DataFrame) -> DataFrame:
    """One row per key with a flag for each list it is on: one join per kind instead of one per list."""
    flags = [F.bool_or(F.col("list_name") == name).alias(f"on_{name}") for name in LISTS]
    return keys.groupBy("key_kind", "key").agg(*flags)


def row_keys(domain: str, name: str, url: str | None) -> dict[str, Column]:
    """The keys of a row by kind."""
    keys = {"domain": normalize_domain(F.col(domain)), "name": normalize_text(F.col(name))}
    return keys | {"url": normalize_url(F.col(url))} if url else keys


def flags_met(df: DataFrame, flags: DataFrame, domain: str = "company_domain", name: str = "company_name", url: str | None = None) -> DataFrame:
    """Those of the flags whose key some row has: keys are looked up once each, without their rows."""
    kinds = [F.struct(F.lit(kind).alias("key_kind"), key.alias("key")) for kind, key in row_keys(domain, name, url).items()]
    own = df.select(F.inline(F.array(*kinds))).filter(F.col("key") != "").distinct()
    return flags.join(own, ["key_kind", "key"], "left_semi")


def with_list_flags(
    df: DataFrame, flags: DataFrame, ids: tuple[str, ...], domain: str = "company_domain", name: str = "company_name", url: str | None = None
) -> DataFrame:
    """Add ``on_<list>`` for every list, true when the company's domain or its name is on it; with ``url``, also ``on_active_url``, true when the
    URL is listed as a current job (case counts).

    One equi-join per kind of key; one condition with OR would compare every row with every key. No broadcast is forced: Spark broadcasts the keys while they
    stay under its size limit and shuffles beyond it. Rows without a key get one of their own from ``ids``, short columns that tell rows apart.
    """
    keys = row_keys(domain, name, url)
    out = df.withColumns({f"__{kind}": own_key(key, *ids) for kind, key in keys.items()})
    for kind in keys:
        side = flags.filter(F.col("key_kind") == kind).select(F.col("key").alias(f"__{kind}"), *[F.col(f"on_{n}").alias(f"__{kind}_{n}") for n in LISTS])
        out = out.join(side, f"__{kind}", "left")
    either = [f"coalesce(__domain_{n}, false) or coalesce(__name_{n}, false) as on_{n}" for n in LISTS]
    listed = ["coalesce(__url_active, false) as on_active_url"] if url else []
    return out.selectExpr(*[f"`{c}`" for c in df.columns], *either, *listed)


def with_screening(
    df: DataFrame, flags: DataFrame, index: DataFrame, ids: tuple[str, ...], keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """Add ``is_removed`` and ``list_label``. ``flags`` is ``key_flags`` of the list keys, ``index`` a ``keyword_index``.

    ``keep`` writes a table under a name: list keys and titles that rows meet are then found first and written, so that joins know how few they are and
    need not move the rows for each kind of key."""
    hits = hit_titles(df, index)
    if keep:
        flags, hits = keep(flags_met(df, flags, url="job_url"), "listed"), keep(hits, "titled")
    flagged = with_title_hit(with_list_flags(df, flags, ids, url="job_url"), hits, ids=ids)
    return flagged.selectExpr(
        *[f"`{c}`" for c in df.columns],
        "on_blacklist or on_customers or has_keyword or on_active_url as is_removed",
        f"{LIST_LABEL} as list_label",
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
