"""Selections over record tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.payload import has_key
from ..functions.text import norm_id, strip
from .substrings import candidates

# Path parts of cases and of other categories.
CASES_PATH, OTHER_PATHS = "/cases/", ["/gaz/", "/journals/", "/other/"]
PARSING_FAILED = "Document parsing failed"


def active_blueprints(cfg: DataFrame) -> DataFrame:
    """active pipelines with a normalised id."""
    return cfg.where("is_active").select(norm_id("name").alias("pipeline_id"), "name", F.struct("scraper_type", "document_type").alias("blueprint"))


def not_empty(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != "")


def existing_urls(rec: DataFrame, record_type: str, status: str | None = None) -> DataFrame:
    """stored URLs of a record type, and of a status."""
    rec = rec.where((F.col("record_type") == record_type) & not_empty("source_url"))
    return (rec.where(F.col("status") == status) if status else rec).select("source_url")


def existing_dataset_numbers(rec: DataFrame, record_type: str, status: str | None = None) -> DataFrame:
    """stored dataset numbers."""
    rec = rec.where(F.col("record_type") == record_type)
    rec = rec.where(F.col("status") == status) if status else rec
    return rec.select(F.get_json_object("data", "$.dataset_number").alias("dataset_number")).where(not_empty("dataset_number"))


def needs_detail() -> Column:
    """F6's predicate: a URL, and indexed or (no status and no details yet)."""
    return not_empty("source_url") & ((F.col("status") == "indexed") | (F.col("status").isNull() & F.get_json_object("data", "$.details_scraped_at").isNull()))


def needing_detail(rec: DataFrame, record_type: str, desc: bool = False, limit: int | None = None, exclude: DataFrame | None = None, include_data: bool = False) -> DataFrame:
    """Records whose details are missing, by scrape time (then id), without the excluded ids."""
    rec = rec.where((F.col("record_type") == record_type) & needs_detail())
    if exclude is not None:
        rec = rec.join(exclude.select("id"), "id", "left_anti")
    order = F.desc if desc else F.asc
    rec = rec.orderBy(order("scraped_at"), order("id")).select("id", "source_url", "scraped_at", *(["data"] if include_data else []))
    return rec if limit is None else rec.limit(limit)


def count_needing_detail(rec: DataFrame, record_type: str) -> DataFrame:
    """F6."""
    return rec.where((F.col("record_type") == record_type) & needs_detail()).agg(F.count("*").alias("pending"))


def complete_flags(keys: DataFrame, rec: DataFrame) -> DataFrame:
    """for (source_url, dataset_number) whether a detailed record has either; null keys match nothing."""
    done = rec.where((F.col("status") == "detailed") | F.get_json_object("data", "$.details_scraped_at").isNotNull())
    by_url = done.where(not_empty("source_url")).select(F.col("source_url").alias("u")).distinct()
    by_number = done.select(F.get_json_object("data", "$.dataset_number").alias("n")).where(not_empty("n")).distinct()
    out = keys.join(by_url, keys.source_url == by_url.u, "left").join(by_number, keys.dataset_number == by_number.n, "left")
    return out.select(*keys.columns, (F.col("u").isNotNull() | F.col("n").isNotNull()).alias("is_complete"))


def is_case_record(url: str = "source_url", data: str = "data") -> Column:
    """F8: a cases URL, or no URL and the payload's category."""
    return F.coalesce(F.contains(url, F.lit(CASES_PATH)), F.get_json_object(data, "$.category") == "cases", F.lit(False))


def is_repairable_case(url: str = "source_url", data: str = "data") -> Column:
    """has extracted data, category cases or a cases URL; never other categories' URLs. A null URL is never repaired."""
    some = has_key(data, "extracted_data") | F.coalesce(F.get_json_object(data, "$.category") == "cases", F.lit(False)) | F.contains(url, F.lit(CASES_PATH))
    return F.coalesce(reduce(lambda a, p: a & ~F.contains(url, F.lit(p)), OTHER_PATHS, some), F.lit(False))


def not_in_review(flag: str = "requires_human_review", data: str | None = None) -> Column:
    """neither flagged nor flagged inside the payload."""
    out = ~F.coalesce(F.col(flag), F.lit(False))
    return out if data is None else out & ~F.coalesce(F.get_json_object(data, "$.data_quality_flags.requires_human_review") == "true", F.lit(False))


def failed_parses(rec: DataFrame, limit: int | None = None) -> DataFrame:
    """records flagged because parsing failed."""
    rec = rec.where(F.coalesce("requires_human_review", F.lit(False)) & (F.col("review_reason") == PARSING_FAILED))
    return rec if limit is None else rec.orderBy("id").limit(limit)


def for_target(df: DataFrame, name: str | None) -> DataFrame:
    """rows of one target, or all."""
    return df if name is None else df.where(F.col("target_name") == name)


def filter_datasets(df: DataFrame, codes: list[str], column: str = "code") -> tuple[DataFrame, DataFrame]:
    """kept and skipped rows by an allow-list, whatever the case. An empty list keeps all."""
    kept = F.coalesce(F.upper(column).isin([c.upper() for c in codes]), F.lit(False)) if codes else F.lit(True)
    return df.where(kept), df.where(~kept)


def pdf_cases(rec: DataFrame) -> DataFrame:
    """case records that are PDF files."""
    return rec.where(F.lower("source_url").endswith(".pdf") & F.contains("source_url", F.lit("/za/cases/")))


def search_records(rec: DataFrame, q: str | None, columns: tuple[str, ...] = ("target_name", "entity_name", "record_type"), **filters) -> DataFrame:
    """substring in any column whatever the case, and equal values of filters."""
    if q:
        rec = rec.where(reduce(lambda a, b: a | b, [F.coalesce(F.contains(F.lower(c), F.lit(q.lower())), F.lit(False)) for c in columns]))
    for name, value in filters.items():
        rec = rec.where(F.col(name) == value)
    return rec


def search_by_index(rec: DataFrame, index: DataFrame, q: str | None, columns: tuple[str, ...] = ("target_name", "entity_name", "record_type"), key: str = "id", **filters) -> DataFrame:
    """F15 on a gram index of these columns (substrings.write_gram_index): only records with the question's rarest gram are compared. Same rows as search_records; short questions scan."""
    found = candidates(index, q) if q else None
    if found is not None:
        rec = rec.join(found.select(F.col("id").alias(key)), key, "left_semi")
    return search_records(rec, q, columns, **filters)


def exclude_rolls(target: str = "target_name") -> Column:
    """not a court-rolls target; null targets stay out, as in SQL."""
    return ~F.col(target).like("%Rolls%")


def parse_sample(rec: DataFrame, limit: int) -> DataFrame:
    """detailed records with more than 50 characters of text, by id."""
    return rec.where((F.col("status") == "detailed") & exclude_rolls() & (F.length(strip("full_text")) > 50)).orderBy("id").limit(limit)


def pick(df: DataFrame, keys: list[str], order: list[Column | str], which: str = "first") -> DataFrame:
    """The first or last row of each key."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    columns = [c.desc() for c in columns] if which == "last" else columns
    return df.withColumn("pick_place", F.row_number().over(Window.partitionBy(*keys).orderBy(*columns))).where("pick_place = 1").drop("pick_place")


def merge_worklist(new: DataFrame, pending: DataFrame) -> DataFrame:
    """(source_url, place) of both lists, new ones first, each URL once."""
    both = new.select("source_url", F.lit(0).alias("list"), "place").unionAll(pending.select("source_url", F.lit(1).alias("list"), "place"))
    return pick(both, ["source_url"], ["list", "place"])


def all_types(*frames: DataFrame) -> DataFrame:
    """Distinct names of several sources."""
    return reduce(lambda a, b: a.unionAll(b), frames).distinct()


def stale_keys(existing: DataFrame, active: DataFrame) -> DataFrame:
    """Keys that are no longer active."""
    return existing.select("key").distinct().join(active.select("key"), "key", "left_anti")


def distinct_urls(df: DataFrame) -> DataFrame:
    """U3."""
    return df.dropDuplicates(["url"])
