"""Identifiers, dates, addresses and figures as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamarack.functions.text import WORD, WS, strip

# Titles of procedural studies by beginning, then by content, in order of precedence.
PROCEDURAL_PREFIXES = (
    "Committee Business",
    "Election of ",
    "Meeting Requested Pursuant to Standing Order",
    "Meeting Requested by ",
    "Briefing on ",
    "Briefing by ",
    "Subject Matter of ",
    "Main Estimates ",
    "Supplementary Estimates",
    "Departmental Plan ",
)
PROCEDURAL_FRAGMENTS = ("Bill C-", "Bill S-")


# English names of months.
MONTH_NAME = "january|february|march|april|may|june|july|august|september|october|november|december|jan|feb|mar|apr|jun|jul|aug|sept|sep|oct|nov|dec"


def _months() -> Column:
    names = MONTH_NAME.split("|")[:12]
    return F.create_map(*[F.lit(x) for k, n in enumerate(names) for x in (n[:3], str(k + 1))])


def slugify(c: Column, longest: int = 28) -> Column:
    kept = F.regexp_replace(F.lower(c), rf"[^{WORD}{WS}]", "")
    joined = F.regexp_replace(F.regexp_replace(strip(kept), rf"[{WS}]+", "_"), "_+", "_")
    return F.regexp_replace(F.substring(joined, 1, longest), "_+$", "")


def session_slug(c: Column) -> Column:
    return F.replace(c, F.lit("-"), F.lit(""))


def absolute_url(c: Column, base: str = "https://www.ourcommons.ca") -> Column:
    return F.when(c.startswith("//"), F.concat(F.lit("https:"), c)).when(c.startswith("/"), F.concat(F.lit(base), c)).otherwise(c)


def procedural_reason(title: Column) -> Column:
    """Why a study is procedural, by the first rule that holds; null where none does."""
    out = F.lit(None).cast("string")
    for rule, kind, words in reversed([*((title.startswith(p), "starts_with", p) for p in PROCEDURAL_PREFIXES), *((title.contains(p), "contains", p) for p in PROCEDURAL_FRAGMENTS)]):
        out = F.when(rule, F.lit(f"{kind}:{words.strip()}")).otherwise(out)
    return out


def published_date(c: Column) -> Column:
    """ISO date of 'Published on: Monday, May 9, 2022 at 8:05 a.m. (EDT)' and other texts with one whole date; null where none stands.

    Taken are month day year and day month year with the month's English name or its first three letters, and year month day
    with hyphens, slashes or points. Dates that do not exist, and months without a day, are null: nothing is filled in.
    """
    bare = strip(F.replace(c, F.lit("Published on:"), F.lit("")))

    def parts(pattern: str, year: int, month: int, day: int) -> Column:
        at = lambda k: F.regexp_extract(bare, pattern, k)
        number = F.lpad(F.coalesce(F.try_element_at(_months(), F.left(F.lower(at(month)), F.lit(3))), at(month)), 2, "0")
        return F.when(F.length(at(day)) > 0, F.concat_ws("-", at(year), number, F.lpad(at(day), 2, "0")))

    named = rf"(?i)(?<![A-Za-z])({MONTH_NAME})[.,]?\s+([0-9]{{1,2}})(?:st|nd|rd|th)?,?\s+([0-9]{{4}})(?![0-9])"
    turned = rf"(?i)(?<![0-9])([0-9]{{1,2}})(?:st|nd|rd|th)?\s+({MONTH_NAME})[.,]?,?\s+([0-9]{{4}})(?![0-9])"
    numbered = r"^([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})(?![0-9])"
    found = F.coalesce(parts(named, 3, 1, 2), parts(turned, 3, 2, 1), parts(numbered, 1, 2, 3))
    return F.date_format(F.try_to_timestamp(found, F.lit("yyyy-MM-dd")), "yyyy-MM-dd")


def status_tag(dropped: Column, mangled: Column) -> Column:
    return F.when(dropped, "DROP").when(mangled, "MANG").otherwise("OK")


def bar(n: Column, total: Column, width: int = 20) -> Column:
    return F.when(total > 0, F.repeat(F.lit("█"), F.bround(F.lit(width) * n / total).cast("int"))).otherwise("")


def percent(n: Column, total: Column) -> Column:
    return F.when(total > 0, F.format_string("%.1f%%", F.lit(100.0) * n / total)).otherwise("—")


def exclusive_quantile(sorted_values: Column, i: int, n: int) -> Column:
    """Cut point i of n of a sorted array, by the exclusive method with extrapolation."""
    m = F.size(sorted_values)
    j = F.least(F.greatest(F.floor(F.lit(i) * (m + 1) / n), F.lit(1)), m - 1).cast("int")
    delta = F.lit(i) * (m + 1) - j * n
    at = lambda k: F.element_at(sorted_values, k).cast("double")
    return F.when(m >= 2, (at(j) * (n - delta) + at(j + 1) * delta) / n)
