"""Text columns: scrubbing, cleaning, case numbers, titles, small formats."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and replacements of the personal-data scrub, in order.
SCRUB_RULES = [(r"\b\d{13}\b", "[RSA ID]"), (r"\b[A-Za-z]\d{8}\b", "[PASSPORT]"), (r"\b\d{10,16}\b", "[BANK/TAX NUMBER]")]
# The navigation marker and the noise lines of landed pages.
NAVIGATION_MARKER = "LawCite"
NOISE_LINES = [r"Download\s+original\s+files", r"PDF\s+format", r"RTF\s+format", r"Links\s+to\s+summary", r"Heads\s+of\s+arguments?"]
# Words that mark a title's bracket as something other than a case number.
NOT_CASE_WORDS = ["judgment", "appeal", "heard", "delivered", "unreported", "coram"]
HEADER_STOPS = r"[\r\n\t]|(?:date of|before:|heard on|in the matter|judgment)"
# Signs of blocked and missing pages.
BLOCKED_TITLE = ["just a moment", "cloudflare", "security verification", "forbidden", "what happened?", "502 bad gateway", "504 gateway time-out"]
BLOCKED_H1 = ["forbidden"]
BLOCKED_BODY = ["verify you are human", "turnstile", "you don't have permission to access this resource", "ssl handshake failed", "error code 525", "error code 520", "error code 521", "error code 522", "error code 523", "error code 524", "cloudflare ray id"]
MISSING_TITLE = ["not found", "page not found", "404 not found", "404 - not found", "404 error", "error 404", "http 404", "404"]
MISSING_H1 = ["not found", "page not found", "404 not found", "404 - not found", "404 error", "404"]
MISSING_IN_TITLE = ["404 not found", "404 error", "page not found"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, make) -> Column:
    """make(value), with value evaluated once however often make uses it."""
    return F.transform(F.array(value), make)[0]


def strip(c, chars: str | None = None) -> Column:
    """Trim white space, or the characters of a regular-expression set."""
    inside = chars or r"\s"
    return F.regexp_replace(_c(c), rf"^[{inside}]+|[{inside}]+$", "")


def found(c, pattern: str, group: int = 1) -> Column:
    """The group of the first match; null if there is none or it is empty."""
    return F.nullif(F.regexp_extract(_c(c), pattern, group), F.lit(""))


def scrub(c) -> Column:
    """Replace identity, passport and account numbers; null stays null."""
    out = _c(c)
    for pattern, label in SCRUB_RULES:
        out = F.regexp_replace(out, pattern, label)
    return out


def _trim(c: Column) -> Column:
    """White space off both ends, without a pattern."""
    return F.btrim(c, F.lit(" \t\n\x0b\f\r"))


def clean_text(c, single: bool = False) -> Column:
    """Drop everything up to the navigation marker, noise lines, and runs of blank lines. Null gives ''.

    The text is cut where the marker stands, and a noise line's pattern runs only
    on texts that hold its first word.
    """
    text = _trim(F.coalesce(_c(c), F.lit("")))
    out = let(F.split(text, rf"(?i)\b{NAVIGATION_MARKER}\b", 2), lambda parts: _trim(F.element_at(parts, -1)))
    for line in NOISE_LINES:
        out = _without_line(out, line.partition("\\")[0], line)
    return _trim(F.regexp_replace(out, r"\n\s*\n+", "\n" if single else "\n\n"))


def _without_line(text: Column, word: str, line: str) -> Column:
    return let(text, lambda t: F.when(F.contains(t, F.lit(word)), F.regexp_replace(t, rf"(?m)^[ \t]*{line}[ \t]*$", "")).otherwise(t))


def is_neutral(c) -> Column:
    """Starts like a medium-neutral citation."""
    return F.coalesce(_c(c).rlike(r"(?i)^\[?\d{4}\]?\s*ZA"), F.lit(False))


def case_no_title(c) -> Column:
    """The bracket before `[year] ZA`, if it has a digit, none of the excluded words, and under 100 characters."""

    def checked(got):
        named = F.lower(got).rlike("|".join(NOT_CASE_WORDS))
        return F.when(got.rlike(r"\d") & ~named & ~is_neutral(got) & (F.length(got) < 100), got)

    return let(strip(F.regexp_extract(_c(c), r"(?i)\(([^()]+)\)\s*\[\d{4}\]\s*ZA", 1), r" ;,()"), checked)


def case_no_header(c) -> Column:
    """What follows `case no` on its line, up to a stop phrase."""
    line = strip(F.regexp_extract(_c(c), r"(?i)case\s*(?:nos|number|no|reference|nr)?[:.\s]+([^\n\r]+)", 1))
    return let(strip(F.split(line, f"(?i){HEADER_STOPS}", 2)[0], r" ;,.:()"), lambda got: F.when(got.rlike(r"\d") & F.length(got).between(2, 59) & ~is_neutral(got), got))


def case_no_text(c) -> Column:
    """The first of four patterns that occurs."""
    return F.coalesce(
        strip(found(c, r"(?i)(?:Case|Application|Matter|Dataset|Gazette|Gaz)\s+(?:No|Number|Ref)\s*:\s*([A-Za-z0-9/ -]+)")),
        strip(found(c, r"\((?:\w+\s+)?(\w+/\d+)\)")),
        strip(found(c, r"\[\d{4}\]\s+\w+\s+\d+", 0)),
        strip(found(c, r"\b\w+/\d+\b", 0)),
    )


def category_metadata(category, title, text) -> Column:
    """X11: struct of the fields that the document's category has (others null)."""
    category, title, text = _c(category), _c(title), _c(text)
    source = F.when(F.coalesce(text, F.lit("")) != "", text).otherwise(title)

    def only(kind, value):
        return F.when(category == kind, value)

    return F.struct(
        only("cases", case_no_text(text)).alias("case_number"),
        only("cases", found(source, r"\[\d{4}\]\s+[A-Z]+\s+\d+", 0)).alias("neutral_citation"),
        only("gaz", F.coalesce(strip(found(text, r"(?i)(?:Gazette|Gaz)\s+(?:No|Number)\s*:\s*([A-Za-z0-9/ -]+)")), found(text, r"(?i)(?:Government\s+)?Gazette\s+.*?\b(?:No\.?|Number)\s*(\d+)"))).alias("gazette_number"),
        only("journals", found(text, r"(?i)\b(?:Vol\.?|Volume)\s*(\d+)")).alias("volume"),
        only("journals", found(text, r"(?i)\b(?:No\.?|Issue)\s*(\d+)")).alias("issue"),
    )


def dataset_number(meta) -> Column:
    """The record's number from category metadata: case, gazette, or `Vol v No i`."""
    meta = _c(meta)
    vol = F.when(meta["volume"].isNotNull(), F.concat(F.lit("Vol "), meta["volume"]))
    issue = F.when(meta["issue"].isNotNull(), F.concat(F.lit("No "), meta["issue"]))
    return F.coalesce(meta["case_number"], meta["neutral_citation"], meta["gazette_number"], F.nullif(F.concat_ws(" ", vol, issue), F.lit("")))


def page_state(title, h1, body) -> Column:
    """BLOCKED, NOT_FOUND or OK."""

    def any_in(c, words):
        return c.rlike("|".join(re.sub(r"([.?*+()\[\]])", r"\\\1", w) for w in words))

    def state(x):
        blocked = any_in(x["t"], BLOCKED_TITLE) | any_in(x["h"], BLOCKED_H1) | any_in(x["b"], BLOCKED_BODY)
        missing = x["t"].isin(MISSING_TITLE) | x["h"].isin(MISSING_H1) | any_in(x["t"], MISSING_IN_TITLE)
        return F.when(blocked, "BLOCKED").when(missing, "NOT_FOUND").otherwise("OK")

    return let(F.struct(*[F.lower(strip(F.coalesce(_c(x), F.lit("")))).alias(n) for n, x in (("t", title), ("h", h1), ("b", body))]), state)


def norm_id(c) -> Column:
    """Lower case, spaces and hyphens as underscores."""
    return F.lower(F.translate(_c(c), " -", "__"))


def to_bool(c, accepted: tuple[str, ...] = ("true", "1", "yes", "y", "t")) -> Column:
    """True for an accepted word; null is false."""
    return F.coalesce(F.lower(strip(c)).isin(*accepted), F.lit(False))


def rand_price(cents) -> Column:
    """`R 12.34`; null stays null."""
    return F.when(_c(cents).isNotNull(), F.format_string("R %.2f", _c(cents) / 100))


def price_tiers(tiers) -> Column:
    """Tiers whose quantity is a range."""
    return F.filter(tiers, lambda r: F.contains(F.lower(r["qty"]), F.lit("to")))


def edge_text(c, n: int, bottom: bool = False) -> Column:
    """First or last n characters."""
    return F.right(_c(c), F.lit(n)) if bottom else F.left(_c(c), F.lit(n))


def safe_name(c) -> Column:
    """Only letters, digits, spaces and dots."""
    return F.rtrim(F.regexp_replace(_c(c), r"[^\p{L}\p{N} .]", ""))


def type_label(c) -> Column:
    """Underscores as spaces, words capitalised."""
    return F.initcap(F.replace(_c(c), F.lit("_"), F.lit(" ")))


def title_parties(c) -> Column:
    """Struct of the two sides of `A v B (...)`."""
    body = strip(F.regexp_replace(_c(c), r"[\(\[].*$", ""))
    pattern = r"(?i)^(.+?)\s+v(?:s|ersus)?\.?\s+(.+)$"
    return F.struct(strip(found(body, pattern, 1)).alias("applicant"), strip(found(body, pattern, 2)).alias("respondent"))


def flat(c) -> Column:
    """Newlines as spaces, trimmed."""
    return F.trim(F.translate(_c(c), "\n\r", "  "))
