"""Upserts, resets, repairs and two-store sync as pure functions of old state and changes.

Every function returns the whole new state, or a table of changes; writing it
to a new version is the caller's step, so a plan can be looked at first (M19).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, names, payload, text
from ..functions.citations import parse_citations
from .filters import not_empty, pick
from .joins import companion_titles, match_by_url

CORRUPT_LENGTH = 80


def upsert_targets(dims: DataFrame, new: DataFrame) -> DataFrame:
    """M1: targets by (entity_name, target_name); location and type take the new value unless null; ids are hashes of the key."""
    keys = ["entity_name", "target_name"]
    n = pick(new, keys, ["place"], "last").select(*keys, F.col("location").alias("n_location"), F.col("target_type").alias("n_type"))
    both = dims.select(*keys, "location", "target_type").join(n, keys, "full_outer")
    return both.select(F.md5(F.concat_ws("|", *keys)).alias("id"), *keys, F.coalesce("n_location", "location").alias("location"), F.coalesce("n_type", "target_type").alias("target_type"))


def upsert_records(old: DataFrame, batch: DataFrame, now: Column) -> DataFrame:
    """M2: records by URL. Payload, type and status are replaced, date and target stay; detailed_at is set only by detailed rows.

    Of repeated URLs in the batch the last (`place`) counts, but a detailed one
    anywhere sets detailed_at. Rows without URL are skipped.
    """
    batch = batch.where(not_empty("source_url"))
    ever = batch.groupBy("source_url").agg(F.bool_or(F.coalesce(F.col("status") == "detailed", F.lit(False))).alias("b_detailed"))
    b = pick(batch, ["source_url"], ["place"], "last").select("source_url", *[F.col(c).alias(f"b_{c}") for c in ("document_date", "target_id", "record_type", "status", "data")]).join(ever, "source_url")
    both = old.join(b, "source_url", "full_outer").withColumn("is_new", F.col("id").isNull())
    changed = F.col("b_status").isNotNull() | F.col("b_data").isNotNull()
    return both.select(
        F.coalesce("id", F.md5("source_url")).alias("id"),
        "source_url",
        F.when(F.col("is_new"), F.col("b_document_date")).otherwise(F.col("document_date")).alias("document_date"),
        F.when(F.col("is_new"), F.col("b_target_id")).otherwise(F.col("target_id")).alias("target_id"),
        *[F.when(changed, F.col(f"b_{c}")).otherwise(F.col(c)).alias(c) for c in ("record_type", "status", "data")],
        F.when(F.col("is_new"), now).otherwise(F.col("scraped_at")).alias("scraped_at"),
        F.when(F.coalesce("b_detailed", F.lit(False)), now).otherwise(F.col("detailed_at")).alias("detailed_at"),
    )


def update_data(old: DataFrame, changes: DataFrame, now: Column) -> DataFrame:
    """M3: new payloads by id, and statuses where given."""
    c = changes.select("id", F.col("data").alias("c_data"), F.col("status").alias("c_status"), F.lit(True).alias("hit"))
    out = old.join(c, "id", "left")
    new = {"data": F.when(F.col("hit"), F.col("c_data")).otherwise(F.col("data")), "status": F.coalesce("c_status", "status"), "updated_at": F.when(F.col("hit"), now).otherwise(F.col("updated_at"))}
    return out.select(*[new[c].alias(c) if c in new else F.col(c) for c in old.columns])


def upsert_child(old: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """M4: 1:1 child rows; created_at is kept."""
    n = new.select("extracted_record_id", F.col("data").alias("n_data"), F.lit(True).alias("hit"))
    both = old.join(n, "extracted_record_id", "full_outer")
    return both.select("extracted_record_id", F.when(F.col("hit"), F.col("n_data")).otherwise(F.col("data")).alias("data"), F.coalesce("created_at", now).alias("created_at"), F.when(F.col("hit"), now).otherwise(F.col("updated_at")).alias("updated_at"))


def merge_detail(old: DataFrame, changes: DataFrame, now: Column) -> DataFrame:
    """M5: detail payloads merged into the records' payloads; those records become detailed."""
    c = changes.select("id", F.col("data").alias("c_data"))
    hit = F.col("c_data").isNotNull()
    new = {"data": F.when(hit, payload.json_merge("data", "c_data")).otherwise(F.col("data")), "status": F.when(hit, F.lit("detailed")).otherwise(F.col("status")), "detailed_at": F.when(hit, now).otherwise(F.col("detailed_at"))}
    return old.join(c, "id", "left").select(*[new[x].alias(x) if x in new else F.col(x) for x in old.columns])


def sync_state(cfg: DataFrame, state: DataFrame, extra: DataFrame) -> DataFrame:
    """M6: pipeline state as JSON: stored, then computed, then extra; later ones win. All keyed by name."""
    s, e = state.select("name", F.col("state").alias("computed")), extra.select("name", F.col("state").alias("more"))
    return cfg.join(s, "name", "left").join(e, "name", "left").select("name", payload.json_merge("state", "computed", "more").alias("state"))


def reset_cases(rec: DataFrame, child: DataFrame, reset: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """M7: records of the reset set lose review flag and lifecycle times; their child rows go."""
    ids = reset.select("id").distinct()
    marked = rec.join(ids.withColumn("hit", F.lit(True)), "id", "left")
    hit = F.coalesce("hit", F.lit(False))
    new = {"requires_human_review": F.lit(False), "review_reason": F.lit(None).cast("string"), "parsed_at": F.lit(None).cast("timestamp"), "scrubbed_at": F.lit(None).cast("timestamp"), "updated_at": now}
    records = marked.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in rec.columns])
    return records, child.join(ids.select(F.col("id").alias("extracted_record_id")), "extracted_record_id", "left_anti")


def recovered(sections: DataFrame) -> DataFrame:
    """M8: reprocessed parses (id, sections) with a flag whether an order was found."""
    return sections.withColumn("recovered", F.coalesce(F.length(text.strip(F.col("sections.order"))) > 0, F.lit(False)))


def reprocess_failed(rec: DataFrame, parsed: DataFrame, sections: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """M8: records and parsed rows after another parse of failed records (sections: id and sections of those).

    Where an order was found the record's review flag and reason are cleared and
    its parsed row takes the new sections; a record without a parsed row gets none.
    All other rows stay as they are.
    """
    good = recovered(sections).where("recovered").select("id", F.to_json("sections").alias("n_data"), F.lit(True).alias("hit"))
    hit = F.coalesce("hit", F.lit(False))
    new = {"requires_human_review": F.lit(False), "review_reason": F.lit(None), "updated_at": now}
    records = rec.join(good.drop("n_data"), "id", "left").select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in rec.columns])
    new = {"data": F.col("n_data"), "updated_at": now}
    children = parsed.join(good.withColumnRenamed("id", "extracted_record_id"), "extracted_record_id", "left")
    return records, children.select(*[F.when(hit, new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in parsed.columns])


def repair_order(changes: DataFrame, time: str = "created_at") -> DataFrame:
    """Changes by target, then time, then id."""
    return changes.orderBy("target_name", time, "id")


def preview(changes: DataFrame, n: int) -> DataFrame:
    """T4: the first n changes in their order, with their values before and after."""
    return changes.limit(n)


def fix_case_numbers(rows: DataFrame) -> DataFrame:
    """M9: changes of case numbers. Input: id, target_name, title, header, extracted_number, record_number.

    The title's number, else the header's, is right. Kinds: missing_populated,
    neutral_replaced, case_number_corrected, corrupt_cleared (neutral or longer
    than CORRUPT_LENGTH, and nothing better). record_changes tells whether the
    record's own value differs, even from null.
    """
    old, new = F.col("extracted_number"), F.col("case_number")
    empty = ~F.coalesce(not_empty(old), F.lit(False))
    kind = (
        F.when(new.isNotNull() & empty, "missing_populated")
        .when(new.isNotNull() & text.is_neutral(old), "neutral_replaced")
        .when(new.isNotNull() & (new != old), "case_number_corrected")
        .when(new.isNull() & ~empty & (text.is_neutral(old) | (F.length(old) > CORRUPT_LENGTH)), "corrupt_cleared")
    )
    found = rows.withColumn("case_number", F.coalesce(text.case_no_title("title"), text.case_no_header("header")))
    out = found.select("id", "target_name", old.alias("before"), new.alias("after"), kind.alias("fix_type"), (~new.eqNullSafe(F.col("record_number"))).alias("record_changes"))
    return out.where("fix_type is not null or record_changes")


def fix_dates(rows: DataFrame, sentinel: str) -> DataFrame:
    """Changes of dates from titles. Input: id, target_name, title, document_date, judgment_date, hearing_date (dates).

    The hearing date is replaced only when it equals the sentinel or the old judgment date.
    """
    d = rows.withColumn("title_date", dates.title_date("title")).where("title_date is not null")
    hearing = F.when((F.col("hearing_date") == F.lit(sentinel).cast("date")) | (F.col("hearing_date") == F.col("judgment_date")), F.col("title_date")).otherwise(F.col("hearing_date"))
    out = d.select("id", "target_name", F.col("title_date").alias("document_date"), F.col("title_date").alias("judgment_date"), hearing.alias("hearing_date"), *[F.col(c).alias(f"old_{c}") for c in ("document_date", "judgment_date", "hearing_date")])
    same = F.lit(True)
    for c in ("document_date", "judgment_date", "hearing_date"):
        same = same & F.col(c).eqNullSafe(F.col(f"old_{c}"))
    return out.where(~same)


def fix_courts(rows: DataFrame) -> DataFrame:
    """Rows (id, target_name, court, judges) whose canonical court or judges differ."""
    out = rows.select("id", "target_name", F.col("court").alias("old_court"), F.col("judges").alias("old_judges"), names.court_name("court", "target_name").alias("court"), names.judges("judges").alias("judges"))
    return out.where(~F.col("court").eqNullSafe(F.col("old_court")) | ~F.col("judges").eqNullSafe(F.col("old_judges")))


def fix_journals(rows: DataFrame) -> DataFrame:
    """Rows (id, formatted_text) that cleaning changes."""
    return rows.select("id", F.col("formatted_text").alias("before"), text.clean_text("formatted_text").alias("after")).where(~F.col("before").eqNullSafe(F.col("after")))


def migrate_footnotes(parsed: DataFrame) -> DataFrame:
    """Child rows whose payload has `citations`, renamed to `footnotes` (an existing one stays)."""
    return parsed.where(payload.has_key("data", "citations")).withColumn("data", payload.json_rename("data", "citations", "footnotes"))


# Names under which older payloads hold a citation's raw text, in order.
LEGACY_CITATION_KEYS = ["raw_citation", "citation", "full_citation", "case_citation", "precedent", "name"]


def migrate_precedents(rows: DataFrame) -> DataFrame:
    """Precedents as maps of older key names, parsed to the five parts; treatment, reasoning and url stay."""

    raws = F.transform("precedents", lambda p: F.coalesce(*[F.nullif(p[k], F.lit("")) for k in LEGACY_CITATION_KEYS], F.lit("")))
    both = F.zip_with("precedents", parse_citations(raws), lambda p, c: F.struct(c.alias("citation"), p["treatment"].alias("treatment"), p["reasoning"].alias("reasoning"), p["url"].alias("url")))
    return rows.withColumn("precedents", both)


def fix_pdf_titles(rec: DataFrame, pages: DataFrame) -> DataFrame:
    """PDF cases (id, source_url, title, document_date) whose companion page has another title, with its date."""
    found = companion_titles(rec, pages).where(not_empty("companion_title") & ~F.col("companion_title").eqNullSafe(F.col("title")))
    return found.select("id", F.col("title").alias("before"), F.col("companion_title").alias("after"), F.coalesce(dates.title_date("companion_title"), F.col("document_date")).alias("document_date"))


TIMES = ["detailed_at", "parsed_at", "scrubbed_at"]


def _synced(a: Column, b: Column, columns: list[str], data: Column) -> Column:
    """b's struct, updated from a's."""
    new = {c: F.coalesce(a[c], b[c]) for c in [*TIMES, "requires_human_review"]}
    new |= {"status": a["status"], "data": data, "review_reason": F.coalesce(F.nullif(a["review_reason"], F.lit("")), b["review_reason"])}
    return F.struct(*[new.get(c, b[c]).alias(c) for c in columns])


def _sync(src: DataFrame, dst: DataFrame, update: Column, updated: Column, inserted: Column) -> DataFrame:
    """The destination's whole new state, with the action for each row."""
    both = match_by_url(src, dst)
    action = F.when(F.col("b").isNull(), "inserted").when(F.col("a").isNotNull() & F.coalesce(update, F.lit(False)), "updated").otherwise("kept")
    row = F.when(F.col("action") == "inserted", inserted).when(F.col("action") == "updated", updated).otherwise(F.col("b"))
    out = both.withColumn("action", action).select("action", row.alias("r")).select("action", "r.*")
    rest = dst.where(~F.coalesce(not_empty("source_url"), F.lit(False))).withColumn("action", F.lit("kept"))
    return out.unionByName(rest)


def sync_to_master(secondary: DataFrame, master: DataFrame) -> DataFrame:
    """Missing rows are inserted; a master row takes payload, status and times when only the secondary is detailed or has detailed_at."""
    a, b = F.col("a"), F.col("b")
    update = (~b["status"].eqNullSafe("detailed") & a["status"].eqNullSafe("detailed")) | (b["detailed_at"].isNull() & a["detailed_at"].isNotNull())
    return _sync(secondary, master, update, _synced(a, b, master.columns, a["data"]), F.struct(*[a[c].alias(c) for c in master.columns]))


def sync_to_secondary(master: DataFrame, secondary: DataFrame) -> DataFrame:
    """State only; missing rows become stubs with an empty payload; payloads are never copied."""
    a, b = F.col("a"), F.col("b")
    update = ~a["status"].eqNullSafe(b["status"])
    for c in TIMES:
        update = update | (a[c].isNotNull() & b[c].isNull())
    stub = F.struct(*[(F.lit("{}") if c == "data" else a[c]).alias(c) for c in secondary.columns])
    return _sync(master, secondary, update, _synced(a, b, secondary.columns, b["data"]), stub)


def sync(secondary: DataFrame, master: DataFrame) -> tuple[DataFrame, DataFrame]:
    """To the master, then the new master to the secondary."""
    new_master = sync_to_master(secondary, master)
    return new_master, sync_to_secondary(new_master.drop("action"), secondary)


def backfill_dims(cfg: DataFrame, dims: DataFrame, column: str, default: str) -> DataFrame:
    """(name) dimension rows for every text value of a column, the default for missing ones, plus those that exist."""
    named = cfg.select(F.coalesce(F.nullif(text.strip(column), F.lit("")), F.lit(default)).alias("name")).distinct()
    return dims.select("name").unionAll(named).distinct()
