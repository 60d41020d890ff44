"""Parts of document URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, found, let

# Document categories in URL paths, and the country part before them.
CATEGORIES = ["cases", "gaz", "journals", "other"]
COUNTRY = "za"
UNKNOWN = "unknown"


def url_path(c) -> Column:
    return F.coalesce(F.try_parse_url(_c(c), F.lit("PATH")), F.lit(""))


def path_parts(c) -> Column:
    return F.filter(F.split(url_path(c), "/"), lambda p: p != "")


def _in_path(c, more: str = "") -> Column:
    return found(url_path(c), rf"(?:^|/){COUNTRY}/+({'|'.join(CATEGORIES)})(?=/|$){more}")


def record_category(data, url) -> Column:
    """The payload's category, else the URL's, else null."""
    return F.coalesce(F.nullif(F.get_json_object(_c(data), "$.category"), F.lit("")), _in_path(url))


def url_category(c) -> Column:
    """The URL's category, `other` by default."""
    return F.coalesce(_in_path(c), F.lit("other"))


def url_dataset(c) -> Column:
    """The path part after the category."""
    return found(url_path(c), rf"(?:^|/){COUNTRY}/+(?:{'|'.join(CATEGORIES)})/+([^/]+)")


def url_parts(c, default: str = "") -> Column:
    """Struct of code, year and document id, around the right-most 4-digit path part that has both neighbours."""

    def around(parts):
        places = F.filter(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(parts) - 2)), lambda i: F.get(parts, i).rlike(r"^\d{4}$"))

        def named(at):
            return F.struct(
                F.when(at.isNotNull(), F.get(parts, at - 1)).otherwise(default).alias("code"),
                F.when(at.isNotNull(), F.get(parts, at)).otherwise(UNKNOWN).alias("year"),
                F.when(at.isNotNull(), F.regexp_replace(F.get(parts, at + 1), r"(?<=.)\.[^.]*$", "")).otherwise(UNKNOWN).alias("document_id"),
            )

        return let(F.when(F.size(parts) >= 3, F.array_max(places)), named)

    return let(path_parts(c), around)


def abs_url(base, href) -> Column:
    """Href against the page's URL: whole URLs stay; `//`, `/` and relative ones are completed; null stays null."""
    base, href = _c(base), _c(href)
    scheme, site = found(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)"), found(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)")
    folder = F.when(base.rlike(r"^[^?#]*://[^/?#]*/"), found(base, r"^([^?#]*/)")).otherwise(F.concat(site, F.lit("/")))
    return F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href).when(href.startswith("//"), F.concat(scheme, href)).when(href.startswith("/"), F.concat(site, href)).when(href.startswith("#"), F.concat(F.regexp_replace(base, "#.*$", ""), href)).otherwise(F.concat(folder, href))
