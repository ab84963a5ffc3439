"""Scalar URL columns (N2-N5, N8-N10) and the URL predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsieve import constants as C
from jobsieve.functions.text import any_of, normalize_text, strip, text

NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
LEADING_CONTROL = "".join(chr(c) for c in range(0x21))


def normalize_domain(x: Column) -> Column:
    """N2."""
    bare = normalize_text(x)
    for part in ("https://", "http://", "www."):
        bare = F.replace(bare, F.lit(part), F.lit(""))
    return F.trim(F.substring_index(bare, "/", 1))


def normalize_url(x: Column) -> Column:
    """N3."""
    return F.rtrim(strip(x), F.lit("/"))


def company_website(domain: Column) -> Column:
    """N4."""
    return F.concat(F.lit("https://"), normalize_domain(domain))


def url_host(url: Column) -> Column:
    """N5. ``parse_url`` raises or returns null on hosts that must be kept, hence the pattern.

    Tabs and line breaks inside a URL do not count, and a host with an unpaired bracket is no host.
    """
    plain = F.ltrim(F.regexp_replace(text(url), r"[\t\r\n]", ""), F.lit(LEADING_CONTROL))
    netloc = F.regexp_extract(plain, NETLOC, 1)
    paired = F.contains(netloc, F.lit("[")) == F.contains(netloc, F.lit("]"))
    return F.when(paired, normalize_domain(netloc)).otherwise(F.lit(""))


def with_scheme(url: Column) -> Column:
    """N10."""
    return F.when(F.startswith(text(url), F.lit("http")), text(url)).otherwise(F.concat(F.lit("https://"), text(url)))


def host_within(host: Column, domain: Column) -> Column:
    return (host == domain) | F.endswith(host, F.concat(F.lit("."), domain))


def same_or_subdomain(url: Column, company_domain: Column) -> Column:
    """P1."""
    return host_within(url_host(url), normalize_domain(company_domain))


def is_attachment(url: Column) -> Column:
    """P2."""
    return F.rlike(normalize_text(url), F.lit(f"(?:{any_of(C.ATTACHMENT_EXTENSIONS)})(?:\\?|\\z)"))


def is_ats(url: Column) -> Column:
    """P3."""
    return F.rlike(normalize_text(url), F.lit(any_of(C.ATS_PATTERNS)))


def host_is_blocked(host: Column) -> Column:
    return F.rlike(host, F.lit(rf"(?:\A|\.)(?:{any_of(C.BLOCKED_BOARDS)})\z"))


def is_blocked_board(url: Column) -> Column:
    """P4."""
    return host_is_blocked(url_host(url))


def is_bad_url(url: Column) -> Column:
    """P5."""
    return F.rlike(normalize_text(url), F.lit(any_of(C.BAD_URL_FRAGMENTS)))


def is_profile_url(url: Column) -> Column:
    """P6."""
    return F.rlike(normalize_text(url), F.lit(any_of(C.PROFILE_URL_FRAGMENTS)))


def is_career_link(url: Column) -> Column:
    """P15."""
    return F.rlike(normalize_text(url), F.lit(any_of(C.CAREER_LINK_KEYWORDS + C.ATS_PATTERNS)))
