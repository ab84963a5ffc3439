"""Scalar text columns (N1, N3, N6, N7, N11-N17) and the predicates on page text and titles.

Missing and empty are one value, so every function maps null to ``''`` and returns no nulls. "Whitespace"
is the Unicode set below; Java's ``\\s`` is ASCII only and would miss most of it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsieve import constants as C

# Inside a regex character class; the same 29 code points spelled out for trim().
SPACE_CLASS = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
SPACES = "".join(
    chr(c)
    for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
LINE_BREAKS = r"\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
WORD_CHAR = r"[\p{L}\p{N}_]"
# What collapsing changes: a run of whitespace that is not one blank. Texts consist of words between single blanks, which need no replacement each.
SPACE_RUN = rf"(?: (?={SPACE_CLASS})|[{SPACE_CLASS}&&[^ ]]){SPACE_CLASS}*+"
# Every noise pattern begins with fixed words. These letters match i and s whatever their case, but lower() keeps them apart.
NOISE_STARTS = [p.split(".*?")[0] for p in C.NOISE_PATTERNS]
CASE_ODDITIES = ["ſ", "ı", "İ"]


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed exactly once per row.

    A filter over an ordinary derived column is pushed below the projection and re-evaluates the
    expression for every reference to it. A one-element generator stops that: the costly text
    expressions stay below it, and everything above reads their result.
    """
    values = F.struct(*[expr.alias(name) for name, expr in columns.items()])
    return df.select("*", F.inline(F.array(values)))


def text(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit(""))


def strip(x: Column) -> Column:
    return F.trim(text(x), F.lit(SPACES))


def collapse(x: Column) -> Column:
    """Whitespace runs become one blank; none at the ends."""
    return F.trim(F.regexp_replace(text(x), SPACE_RUN, " "))


def normalize_text(x: Column) -> Column:
    """N1."""
    return F.trim(F.regexp_replace(F.lower(text(x)), SPACE_RUN, " "))


def cut(x: Column, max_chars: int | None) -> Column:
    """The first characters where a limit is asked for, else all."""
    return x if max_chars is None else F.left(x, F.lit(max_chars))


def clean_page_text(x: Column, max_chars: int | None = None) -> Column:
    """N6."""
    return cut(collapse(x), max_chars)


def any_of(phrases: list[str]) -> str:
    """One pattern for "contains any of these", for short strings: the string is prepared once, not once per phrase."""
    return "|".join(re.sub(r"([.()?+*])", r"\\\1", p) for p in phrases)


def phrase_list(phrases: list[str]) -> Column:
    """A constant array; folded by the optimizer."""
    return F.split(F.lit("\n".join(phrases)), "\n")


def contains_any(x: Column, phrases: list[str]) -> Column:
    """For long texts: plain substring search, phrase by phrase. ``x`` should be a stored column."""
    return F.exists(phrase_list(phrases), lambda p: F.contains(x, p))


def contains_count(x: Column, phrases: list[str]) -> Column:
    """How many of the phrases occur. A lambda over the list keeps the generated code small."""
    return F.size(F.filter(phrase_list(phrases), lambda p: F.contains(x, p)))


def _noise_regex(pattern: str) -> str:
    """The pattern whatever its case. Its first letter is spelled out, so that a text is passed by a test per character; ſ is an s."""
    first = pattern[0]
    return f"[{first}{first.upper()}{'ſ' if first == 's' else ''}](?ius:{pattern[1:]})"


def _remove_noise(flat: Column, max_chars: int | None) -> Column:
    cleaned = flat
    for pattern in C.NOISE_PATTERNS:
        cleaned = F.regexp_replace(cleaned, _noise_regex(pattern), " ")
    return cut(collapse(cleaned), max_chars)


def present(a: Column) -> Column:
    """``''`` becomes null, so that ``coalesce`` picks the first non-empty value."""
    return F.nullif(text(a), F.lit(""))


def own_key(key: Column, *parts: str) -> Column:
    """A join key for rows that may have none: blank keys become distinct values that match nothing.

    Left as blanks or nulls they would all meet in one task.
    """
    alone = F.concat(F.lit(" "), F.xxhash64(*parts).cast("string"))
    return F.coalesce(present(key), alone)


def first_present(*options: Column | str) -> Column:
    """First value that is non-empty before trimming, then trimmed."""
    picks = [present(o) if isinstance(o, Column) else F.lit(o) for o in options]
    return strip(F.coalesce(*picks, F.lit("")))


def location_from_text(x: Column) -> Column:
    """N11. Word boundaries are spelled out: what counts as a letter for ``\\b`` depends on the JVM."""
    pairs = [C.LOCATION_WORDS, C.LOCATION_PAIR, C.LOCATION_COUNTRY, C.LOCATION_COUNTRY_SHORT]
    found = []
    for pattern in pairs:
        body = pattern.replace("{ws}", SPACE_CLASS)
        regex = f"(?iu)(?<!{WORD_CHAR}){body}(?!{WORD_CHAR})"
        found.append(present(strip(F.regexp_extract(text(x), regex, 0))))
    return F.coalesce(*found, F.lit(""))


def headings(x: Column, n: int | None = None) -> Column:
    """The lines of a text that could be headings."""
    lines = F.transform(F.split(text(x), LINE_BREAKS), collapse)
    found = F.filter(lines, lambda s: F.rlike(s, F.lit(rf"\A{C.HEADING_CHARS}\z")))
    return found if n is None else F.slice(found, 1, n)


def looks_like_title(x: Column) -> Column:
    """P7."""
    value = normalize_text(x)
    return (
        F.length(value).between(C.TITLE_MIN_CHARS, C.TITLE_MAX_CHARS)
        & ~F.rlike(value, F.lit(any_of(C.TITLE_REFUSED)))
        & F.rlike(value, F.lit(any_of(C.TITLE_HINTS)))
    )


def best_title(card_title: Column, link_text: Column, nearby_text: Column) -> Column:
    """First of card title, link text and headings that looks like a title.

    Headings are only looked at when the first two fail.
    """
    return title_or(card_title, link_text, heading_title(nearby_text))


def heading_title(nearby_text: Column) -> Column:
    """The first heading of a text that looks like a title."""
    return F.coalesce(F.try_element_at(F.filter(headings(nearby_text), looks_like_title), F.lit(1)), F.lit(""))


def title_or(card_title: Column, link_text: Column, otherwise: Column) -> Column:
    title, link = strip(card_title), strip(link_text)
    return F.when(looks_like_title(title), title).when(looks_like_title(link), link).otherwise(otherwise)


# --- predicates on page text. ``nt`` is the N1 form of the text, computed once by the caller. -----


def description_signals(nt: Column) -> Column:
    """N14."""
    return contains_count(nt, C.DESCRIPTION_SIGNALS)


def apply_signals(nt: Column) -> Column:
    """N15."""
    return contains_count(nt, C.APPLY_SIGNALS)


def is_closed(nt: Column) -> Column:
    """P8."""
    return (nt == "") | contains_any(nt, C.CLOSED_SIGNALS)


def is_apply_only(nt: Column) -> Column:
    """P9."""
    return apply_verdict(nt, apply_signals(nt), description_signals(nt))


def apply_verdict(nt: Column, applies: Column, describes: Column) -> Column:
    return (nt == "") | ((applies >= 7) & (describes <= 1)) | ((applies >= 9) & (describes <= 2))


def has_retry_signal(nt: Column) -> Column:
    """P11."""
    return contains_any(nt, C.RETRY_SIGNALS)


def has_board_signal(nt: Column) -> Column:
    return contains_any(nt, C.BOARD_SIGNALS)


def attachment_reason(reason: Column) -> Column:
    """P14."""
    return F.rlike(normalize_text(reason), F.lit(any_of(C.ATTACHMENT_REASON_WORDS)))


def with_description(
    df: DataFrame,
    source: str,
    min_chars: int = C.MIN_DESCRIPTION_CHARS,
    max_chars: int | None = None,
    collapsed: bool = False,
    lowered: str | None = None,
) -> DataFrame:
    """Add N7 and the verdicts P9 and P10 on it: ``description``, ``apply_only``, ``real_description``.

    The text is searched for noise by its lower-cased form, which the verdicts need anyway; texts without noise skip all
    replacement passes. P10 cleans its argument again, and the second pass can find noise that the first one
    uncovered, so only noisy texts take it; for the others it would only remove a blank left at the end by the cut.
    ``collapsed`` says that the source has no whitespace runs; ``lowered`` names a column that has it in lower case.
    """
    if not collapsed:
        df = once(df, __flat=collapse(F.col(source)))
        source = "__flat"
    flat = F.col(source)
    if lowered is None:
        df, lowered = once(df, __all=F.lower(text(flat))), "__all"
    full = F.col(lowered)
    df = once(df, __noisy=contains_any(full, NOISE_STARTS) | contains_any(text(flat), CASE_ODDITIES))
    noisy, desc = F.col("__noisy"), F.col("description")
    df = once(df, description=F.when(noisy, _remove_noise(text(flat), max_chars)).otherwise(cut(text(flat), max_chars)))
    df = once(df, __low=F.trim(F.when(noisy, F.lower(desc)).otherwise(cut(full, max_chars))))
    # What was cleaned is rarely noisy still.
    still = noisy & (contains_any(F.col("__low"), NOISE_STARTS) | contains_any(desc, CASE_ODDITIES))
    df = once(df, __again=F.when(still, _remove_noise(desc, max_chars)))
    low, again = F.col("__low"), F.trim(F.lower("__again"))
    df = once(df, __describes=description_signals(low))
    describes = F.col("__describes")
    # Three signals of a description settle P9 whatever the others are, and fewer than two settle P10: such texts are not searched any further.
    df = once(df, __applies=F.when(describes <= 2, apply_signals(low)).otherwise(0), __closed=F.when(describes >= 2, is_closed(low)).otherwise(True))
    df = once(df, apply_only=apply_verdict(low, F.col("__applies"), describes))
    same = ~F.col("__closed") & ~F.col("apply_only") & (describes >= 2)
    changed = ~is_closed(again) & ~is_apply_only(again) & (description_signals(again) >= 2)
    real = F.when(F.coalesce(F.col("__again") == desc, F.lit(True)), (F.length(F.trim(desc)) >= min_chars) & same).otherwise(
        (F.length("__again") >= min_chars) & changed
    )
    df = once(df, real_description=real)
    return df.drop("__flat", "__all", "__noisy", "__low", "__again", "__applies", "__describes", "__closed")
