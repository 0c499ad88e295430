"""Scalar column functions for raw catalogue text and nested payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.schemas import NA_TOKENS, NO, STATUS_NOMINEE, STATUS_NONE, STATUS_WINNER, YES

_EDGE_SPACE = r"(?U)^\s+|\s+$"


def strip(c: Column) -> Column:
    """Trim every kind of white space, not blanks only."""
    return F.regexp_replace(c, _EDGE_SPACE, "")


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(NA_TOKENS), c)


def parse_money(c: Column) -> Column:
    """Digits and points of the text as an amount; the currency is dropped and not converted."""
    digits = F.regexp_replace(c, "[^0-9.]", "")
    return F.nullif(digits, F.lit("")).try_cast("decimal(18,2)")


def money_currency(c: Column) -> Column:
    """Leading currency letters, kept next to the amount."""
    return F.nullif(F.regexp_extract(c, r"^\s*([A-Za-z]{3})\b", 1), F.lit(""))


def whole_number(c: Column) -> Column:
    """Integer part of a numeric text; null when it is not a number."""
    return c.try_cast("double").try_cast("int")


def score_to_int(c: Column) -> Column:
    """Truncates towards zero."""
    return c.cast("double").try_cast("int")


def is_affirmative(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c)) == YES.lower(), F.lit(False))


def tokens(c: Column, null_token: str | None = None) -> Column:
    """Comma list to trimmed, non-empty tokens in order; a null list has none unless `null_token` names one."""
    source = c if null_token is None else F.coalesce(c, F.lit(null_token))
    parts = F.transform(F.split(source, ",", -1), strip)
    return F.coalesce(F.filter(parts, lambda t: t != ""), F.array().cast("array<string>"))


def yes_no(flag: Column) -> Column:
    return F.when(flag, YES).otherwise(NO)


def award_status(nominated: Column, winner: Column) -> Column:
    return F.when(nominated & winner, STATUS_WINNER).when(nominated, STATUS_NOMINEE).otherwise(STATUS_NONE)


def group_thousands(amount: Column) -> Column:
    """Commas between each three digits of the amount's text."""
    return F.regexp_replace(amount.cast("string"), r"(\d)(?=(\d{3})+(?!\d))", "$1,")


def format_money(amount: Column, currency: Column) -> Column:
    """`CUR n,nnn`; null without an amount, an unknown currency leaves the blank before the amount."""
    return F.when(amount.isNotNull(), F.concat(F.coalesce(currency, F.lit("")), F.lit(" "), group_thousands(amount)))


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """`yyyy-mm-dd` text when all parts are there; the calendar is not checked."""
    known = year.isNotNull() & month.isNotNull() & day.isNotNull()
    return F.when(known, F.format_string("%04d-%02d-%02d", year, month, day))


def joined_names(objects: Column) -> Column:
    """Names of an array of objects; a missing name leaves an empty entry, a null array stays null."""
    names = F.transform(objects, lambda o: F.coalesce(o["name"], F.lit("")))
    return F.array_join(names, ", ")


def absolute_url(base: Column, href: Column) -> Column:
    """Link against the page it stands on: absolute, host-relative or path-relative."""
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)", 1)
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"(://[^/]*/?(?:.*/)?)[^/]*$", "$1")
    return (
        F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .otherwise(F.concat(folder, href))
    )


def without_query(url: Column) -> Column:
    return F.split_part(url, F.lit("?"), F.lit(1))


def slug_after(url: Column, marker: str) -> Column:
    """Text after the marker in the URL without its query; null when the marker is absent."""
    plain = without_query(url)
    return F.when(plain.contains(marker), F.split_part(plain, F.lit(marker), F.lit(2)))


def role_position(role: Column, roles: list[str]) -> Column:
    """Sort key that follows the declared role order."""
    return F.array_position(F.array(*[F.lit(r) for r in roles]), role)
