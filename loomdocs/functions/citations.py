"""Citations: a raw string's name, numbers, reports and date.

The date in the last bracket is read by expressions; the rest is one pass over
the string's tokens, in Arrow batches.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dates import parse_date
from .text import _c, strip

# Law report series, words that name a case number, and words that mark a bracket as a party's capacity.
SERIES = ["All SA", "BCLR", "BLLR", "ILJ", "SA", "SACR", "CPLR", "JOL", "CLD", "SALLR", "BPLR", "LAC", "LCC", "SCA", "CC"]
NUMBER_WORDS = ["case", "application", "matter", "ref"]
CAPACITY_WORDS = ["pty", "ltd", "others", "capacity", "acting", "executor", "trustee"]
# What may stand right before a report, around a name, and at the end of a citation.
LEADS, NAME_EDGES, END_EDGES = "\n\t ;,([", ";,. \t\n", " .;\n\t\r"

_SERIES = {tuple(x.upper().split()) for x in SERIES}
_TOKEN = re.compile(r"\w+|[^\w\s]")
#: A bracket's words that may be a case number.
_NUMBER_CHARS = re.compile(r"[A-Za-z0-9\s;/:.-]+")


class Tokens:
    """The words and signs of a citation, with what stands between them."""

    def __init__(self, text: str):
        self.text = text
        found = list(_TOKEN.finditer(text))
        self.words, self.starts, self.ends = [m.group() for m in found], [m.start() for m in found], [m.end() for m in found]
        self.years = [i for i, w in enumerate(self.words) if w == "[" or len(w) == 4 and w.isdecimal()]

    def word(self, i: int) -> str:
        return self.words[i] if i < len(self.words) else ""

    def apart(self, i: int) -> bool:
        """Whether white space stands before token i."""
        return 0 < i < len(self.words) and self.starts[i] > self.ends[i - 1]

    def digits(self, i: int, n: int | None = None) -> bool:
        w = self.word(i)
        return w.isdecimal() and (n is None or len(w) == n)

    def enclosed(self, i: int, n: int | None = None, signs: str = "[]") -> int:
        """The token after a number between two signs, 0 if there is none at i."""
        return i + 3 if self.word(i) == signs[0] and self.digits(i + 1, n) and self.word(i + 2) == signs[1] else 0

    def neutral(self, i: int) -> int:
        """The token after year, court letters and number: `[2026] ZACC 2`; 0 if there are none at i."""
        at = self.enclosed(i, 4)
        court = self.word(at)
        return at + 2 if at and self.apart(at) and court.isascii() and court.isalpha() and court.isupper() and self.apart(at + 1) and self.digits(at + 1) else 0

    def report(self, i: int) -> int:
        """The token after year, volume (or none), series, page and court (or none): `2026 (3) SA 1 (CC)`; 0 if there are none at i."""
        if i and not self.apart(i) and self.text[self.starts[i] - 1] not in LEADS:
            return 0
        at = self.enclosed(i, 4) or (i + 1 if self.digits(i, 4) else 0)
        if not at:
            return 0
        volume = self.enclosed(at, signs="()") or (self.apart(at) and (self.enclosed(at) or (self.digits(at) and at + 1)))
        for series in filter(None, (volume, at)):
            size = next((n for n in (2, 1) if tuple(w.upper() for w in self.words[series : series + n]) in _SERIES), 0)
            page = series + size
            if size and self.apart(series) and self.apart(page) and self.digits(page):
                return self._court(page + 1) or page + 1
        return 0

    def _court(self, i: int) -> int:
        """The token after letters and digits in a bracket."""
        end = i + 1
        while self.word(end).isalnum() and self.word(end).isascii():
            end += 1
        return end + 1 if self.word(i) == "(" and end > i + 1 and self.word(end) == ")" else 0

    def all(self, kind) -> list[tuple[int, int]]:
        """Spans of a kind, which begins with a year, from left to right, without overlaps."""
        out, taken = [], 0
        for i in self.years:
            end = kind(i) if i >= taken else 0
            if end:
                out.append((self.starts[i], self.ends[end - 1]))
                taken = end
        return out

    def brackets(self) -> list[tuple[int, int]]:
        """Spans of round brackets without others inside."""
        out, opened = [], None
        for w, start, end in zip(self.words, self.starts, self.ends, strict=True):
            if w == "(":
                opened = start
            elif w == ")" and opened is not None:
                out.append((opened, end))
                opened = None
        return out


def _number_rank(inside: str) -> int | None:
    """0 for a number with a year, 1 for a word that names a number, None for other brackets."""
    if not _NUMBER_CHARS.fullmatch(inside):
        return None
    if not set(":.") & set(inside) and any(a[-1:].isdecimal() and b[:2].isdecimal() and len(b) > 1 for a, b in _around_slashes(inside)):
        return 0
    return 1 if inside.lower().startswith(tuple(NUMBER_WORDS)) else None


def _around_slashes(text: str) -> list[tuple[str, str]]:
    parts = text.split("/")
    return list(zip(parts, parts[1:], strict=False))


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    """text with spans (apart and in order) replaced by a space each, and brackets that are left empty."""
    out, at = [], 0
    for start, end in spans:
        out.append(text[at:start])
        at = end
    return re.sub(r"\(\s*\)", " ", " ".join([*out, text[at:]]))


def citation_parts(text: str) -> tuple[str | None, str | None, str | None, list[str]]:
    """Name, case number, neutral citation and reports of a citation without its date.

    Name and number are looked for ahead of the neutral citation. The number is
    the first bracket with a number and year, else the first that names a number;
    a bracket of a party's capacity is part of the name.
    """
    tokens = Tokens(text)
    neutrals = tokens.all(tokens.neutral)
    neutral, limit = (text[slice(*neutrals[0])], neutrals[0][0]) if neutrals else (None, len(text))
    spans = [s for s in tokens.all(tokens.report) if text[slice(*s)] != neutral]
    reports = list(dict.fromkeys(text[slice(*s)] for s in spans))
    gone = [s for s in spans if s[0] < limit]
    free = [(a, b) for a, b in tokens.brackets() if b <= limit and not any(a < y and x < b for x, y in gone)]
    ranked = min(((rank, a, b) for a, b in free if (rank := _number_rank(text[a + 1 : b - 1])) is not None), default=None)
    number = None
    if ranked:
        inside = text[ranked[1] + 1 : ranked[2] - 1].strip()
        if not any(w in inside.lower() for w in CAPACITY_WORDS):
            number = inside
            gone = sorted([*gone, ranked[1:]])
    name = _without(text[:limit], gone).strip(NAME_EDGES) or re.split(r"[;\[(]", text, maxsplit=1)[0]
    name = " ".join(name.split()).strip(NAME_EDGES)
    return None if not name or name.isdecimal() or name == neutral or name in reports else name, number, neutral, reports


_PARTS = T.StructType([T.StructField(n, T.StringType()) for n in ("case_name", "case_number", "neutral_citation")] + [T.StructField("commercial_citations", T.ArrayType(T.StringType()))])


@F.pandas_udf(_PARTS)
def _parts(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([citation_parts(t or "") for t in texts], columns=_PARTS.names)


@F.pandas_udf(T.ArrayType(_PARTS))
def _all_parts(lists: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else [dict(zip(_PARTS.names, citation_parts(t or ""), strict=True)) for t in x] for x in lists])


#: Name and making of each step ahead of the tokens; a step sees those before it.
STEPS: list[tuple[str, Callable[[Callable[[str], Column]], Column]]] = [
    ("raw", lambda s: strip(F.coalesce(s("given"), F.lit("")))),
    ("closed", lambda s: F.rtrim(s("raw"), F.lit(END_EDGES))),
    ("inner", lambda s: F.substring_index(F.left(s("closed"), F.length(s("closed")) - 1), "(", -1)),  # of the last bracket, if one ends the string
    ("date", lambda s: F.when(s("closed").endswith(")") & F.contains(s("closed"), F.lit("(")) & ~F.contains(s("inner"), F.lit(")")), parse_date(s("inner")))),
    ("work", lambda s: F.when(s("date").isNotNull(), strip(F.left(s("closed"), F.length(s("closed")) - F.length(s("inner")) - 2))).otherwise(s("raw"))),
]


def _read(c) -> Column:
    """raw: the trimmed string; date: that in its last bracket, null if it isn't one; work: the string without that bracket."""
    done = {"given": _c(c)}
    for name, make in STEPS:
        done[name] = make(done.__getitem__)
    return F.struct(*[done[n].alias(n) for n in ("raw", "date", "work")])


def _citation(read, parts: Column) -> Column:
    return F.struct(read["raw"].alias("raw_citation"), *[parts[n].alias(n) for n in _PARTS.names], F.date_format(read["date"], "yyyy-MM-dd").alias("decision_date"))


def parse_citation(c) -> Column:
    """Struct of raw_citation, case_name, case_number, neutral_citation, commercial_citations, decision_date (ISO text).

    Null and empty strings give an empty raw_citation and no parts. A last
    bracket that isn't a date stays with the rest. Very long strings are read
    in one pass. For a whole column of a table citation_column is the faster form.
    """
    read = _read(c)
    return _citation(read, _parts(read["work"]))


def parse_citations(c) -> Column:
    """parse_citation of every string of an array; null arrays stay null."""
    read = F.transform(_c(c), _read)
    return F.zip_with(read, _all_parts(F.transform(read, lambda x: x["work"])), _citation)


def citation_column(df: DataFrame, column: str, name: str) -> DataFrame:
    """df with parse_citation of a column, one projection a step, so that each is compiled and evaluated once."""
    hidden = lambda n: f"{name} {n}"
    out = df.withColumn(hidden("given"), F.col(column))
    for n, make in STEPS:
        out = out.withColumn(hidden(n), make(lambda x: F.col(f"`{hidden(x)}`")))
    read = {n: F.col(f"`{hidden(n)}`") for n in ("raw", "date", "work")}
    return out.withColumn(name, _citation(read, _parts(read["work"]))).drop(*[hidden(n) for n in ("given", *[x for x, _ in STEPS])])
