"""Dates and times from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, found, let, strip

# Accepted date formats, in order.
DATE_FORMATS = ["d MMMM yyyy", "d MMM yyyy", "d/M/yyyy", "d-M-yyyy", "MMMM d, yyyy", "MMM d, yyyy"]
SHORT_YEAR_FORMATS = ["d MMMM yy", "d MMM yy"]


def parse_date(c) -> Column:
    """ISO, then DATE_FORMATS, then two-digit years (69-99 are 19xx); null if none fits. `Sept` counts as `Sep`."""
    return let(F.regexp_replace(F.regexp_replace(strip(c), r"\s+", " "), r"(?i)\bsept\b", "Sep"), _clean_date)


def _clean_date(clean: Column) -> Column:
    iso = F.when(clean.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(clean, "yyyy-MM-dd"))
    whole = [F.when(clean.rlike(r"\d{4}"), F.try_to_date(clean, f)) for f in DATE_FORMATS]
    short = []
    for f in SHORT_YEAR_FORMATS:
        d = F.when(~clean.rlike(r"\d{4}"), F.try_to_date(clean, f))
        short.append(let(d, lambda x: F.when(F.year(x) >= 2069, F.add_months(x, -1200)).otherwise(x)))
    return F.coalesce(iso, *whole, *short)


def safe_date(c) -> Column:
    """The date as ISO text."""
    return F.date_format(parse_date(c), "yyyy-MM-dd")


def title_date(c) -> Column:
    """The date in the brackets that end a title."""
    return parse_date(found(strip(c), r"\(([^()]+)\)[\s.;]*$"))


def document_date(data, as_of: Column, keys: tuple[str, ...] = ("document_date", "judgment_date", "date_published", "date")) -> Column:
    """The first of four payload keys that holds a date in its first 10 characters, else 1 January of `year`, else as_of."""
    data = _c(data)
    days = [F.try_to_date(F.left(F.get_json_object(data, f"$.{k}"), F.lit(10)), "yyyy-MM-dd") for k in keys]
    year = F.get_json_object(data, "$.year")
    return F.coalesce(*days, F.when(year.rlike(r"^\d{4}$"), F.try_to_date(F.concat(year, F.lit("-01-01")), "yyyy-MM-dd")), as_of)


def case_year(c) -> Column:
    """Year of a case number: a year of this century that ends the part ahead of the slash, else the 2 or 4 digits after the last slash."""
    c = _c(c)
    lead, tail = found(c, r"(?:^|\D)(20\d{2})(?:/|$)"), found(c, r"/(\d{4}|\d{2})$")
    return F.coalesce(lead.cast("int"), F.when(F.length(tail) == 2, tail.cast("int") + 2000).otherwise(tail.cast("int")))


def duration_years(number, decided) -> Column:
    """Whole years from the case's year to the decision, 0 at least."""
    return let(case_year(number), lambda y: F.when(y.isNotNull(), F.greatest(F.lit(0), F.year(_c(decided)) - y)))


def parse_iso(c, naive_tz: str = "UTC") -> Column:
    """ISO time; a text without offset is in naive_tz."""
    c = _c(c)
    aware = c.rlike(r"(?:[zZ]|[+-]\d{2}:?\d{2})$")
    return F.when(aware, F.try_to_timestamp(c)).otherwise(F.to_utc_timestamp(F.try_to_timestamp(c), naive_tz))
