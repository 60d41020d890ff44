"""Joins of record tables (J1-J16). Dimensions are small by nature, but Spark's own statistics decide whether to broadcast them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import norm_id, strip
from .filters import not_empty, pick
from .substrings import substring_pairs


def with_metadata(rec: DataFrame, tgt: DataFrame, ent: DataFrame) -> DataFrame:
    """Target and entity names of every record; missing ones are null."""
    t = tgt.select(F.col("id").alias("target_id"), "target_name", "entity_id")
    e = ent.select(F.col("id").alias("entity_id"), F.col("name").alias("entity_name"))
    return rec.join(t, "target_id", "left").join(e, "entity_id", "left")


def with_target(rec: DataFrame, tgt: DataFrame) -> DataFrame:
    """Records that have a target."""
    return rec.join(tgt.select(F.col("id").alias("target_id"), "target_name"), "target_id")


def repair_input(scr: DataFrame, rec: DataFrame, tgt: DataFrame) -> DataFrame:
    """Scrubbed rows with their record, and the target's name or `Unknown`."""
    s = scr.select(F.col("extracted_record_id").alias("id"), F.col("data").alias("scrubbed_data"))
    t = tgt.select(F.col("id").alias("target_id"), "target_name")
    return s.join(rec, "id").join(t, "target_id", "left").withColumn("target_name", F.coalesce("target_name", F.lit("Unknown")))


def without_child(rec: DataFrame, child: DataFrame) -> DataFrame:
    """Records with no child row yet."""
    return rec.join(child.select(F.col("extracted_record_id").alias("id")), "id", "left_anti")


def unscrubbed(rec: DataFrame, parsed: DataFrame, scrubbed: DataFrame, tgt: DataFrame, ent: DataFrame) -> DataFrame:
    """Detailed records without scrubbed row, with metadata and the parsed payload."""
    p = parsed.select(F.col("extracted_record_id").alias("id"), F.col("data").alias("parsed_data"))
    return with_metadata(without_child(rec.where("status = 'detailed'"), scrubbed).join(p, "id", "left"), tgt, ent)


def new_candidates(items: DataFrame, known: DataFrame) -> DataFrame:
    """Items (place, source_url, dataset_number) whose URL and number are both unknown; each URL, then each number, once."""
    fresh = items.join(known.where(not_empty("source_url")).select("source_url"), "source_url", "left_anti")
    fresh = fresh.join(known.where(not_empty("dataset_number")).select("dataset_number"), "dataset_number", "left_anti")
    fresh = pick(fresh, ["source_url"], ["place"])
    numbered = pick(fresh.where(not_empty("dataset_number")), ["dataset_number"], ["place"])
    return numbered.unionByName(fresh.where(~F.coalesce(not_empty("dataset_number"), F.lit(False))))


def match_by_url(a: DataFrame, b: DataFrame, how: str = "full_outer") -> DataFrame:
    """Rows of two stores by URL, as structs a and b; rows without URL take no part."""
    left, right = (x.where(not_empty("source_url")).select("source_url", F.struct(*x.columns).alias(n)) for x, n in ((a, "a"), (b, "b")))
    return left.join(right, "source_url", how)


def remap_targets(rec: DataFrame, src: DataFrame, dst: DataFrame) -> DataFrame:
    """Target ids of another store by (entity name, target name); dimensions as (id, entity_name, target_name)."""
    s = src.select(F.col("id").alias("target_id"), "entity_name", "target_name")
    d = dst.select(F.col("id").alias("new_target_id"), "entity_name", "target_name")
    return rec.join(s, "target_id", "left").join(d, ["entity_name", "target_name"], "left").drop("entity_name", "target_name")


def match_catalog(master: DataFrame, other: DataFrame) -> DataFrame:
    """Products by stock code = part number; of repeated part numbers the last counts (`place`)."""
    last = pick(other.where(not_empty("part_number")), ["part_number"], ["place"], "last")
    last = last.select(F.col("part_number").alias("stock_code"), F.struct(*other.columns).alias("other"))
    return master.join(last, "stock_code", "left")


def reset_set(rec: DataFrame, parsed: DataFrame, scrubbed: DataFrame) -> DataFrame:
    """Records with scrubbed rows; if there are none at all, those with parsed rows."""
    by_scrubbed = rec.join(scrubbed.select(F.col("extracted_record_id").alias("id")), "id", "left_semi")
    return by_scrubbed if not by_scrubbed.isEmpty() else rec.join(parsed.select(F.col("extracted_record_id").alias("id")), "id", "left_semi")


def resolve_scraper_type(rec: DataFrame, lookup: DataFrame) -> DataFrame:
    """scraper_type of (record_type, target_name, entity_name), by lookup (place, key, scraper_type).

    Candidates in that order; for each an exact key, its normalised form, then
    the first key that holds it or is held by it. Each distinct value is resolved
    once; keys and values meet by equal strings and by their rarest grams
    (substring_pairs), so any number of keys will do.
    """
    triple = ["record_type", "target_name", "entity_name"]
    low = lambda c: F.lower(strip(F.col(c)))
    named = rec.select(*triple).distinct()
    values = reduce(DataFrame.unionAll, [named.where(not_empty(c)).select(low(c).alias("value")) for c in triple]).distinct()
    keys = lookup.where("key is not null").groupBy("key").agg(F.min(F.struct("place", "key", "scraper_type")).alias("k"))
    inside = substring_pairs(keys.select(F.col("key").alias("needle")), values.select(F.col("value").alias("hay"))).select(F.col("hay").alias("value"), F.col("needle").alias("key"))
    around = substring_pairs(values.select(F.col("value").alias("needle")), keys.select(F.col("key").alias("hay"))).select(F.col("needle").alias("value"), F.col("hay").alias("key"))
    held = inside.unionAll(around).join(keys, "key").select("value", "k")
    # a blank value is held by every key: one row, and the first key
    blank = values.where("value = ''").crossJoin(keys.where("key <> ''").agg(F.min("k").alias("k")))
    held = held.unionAll(blank).groupBy("value").agg(F.min("k").alias("k_held"))
    exact, normal = (keys.select(F.col("key").alias(n), F.col("k").alias(f"k_{n}")) for n in ("exact", "normal"))
    known = values.join(exact, F.col("value") == F.col("exact"), "left").join(normal, norm_id("value") == F.col("normal"), "left").join(held, "value", "left")
    known = known.select("value", F.coalesce("k_exact.scraper_type", "k_normal.scraper_type", "k_held.scraper_type").alias("type"))
    for c in triple:
        named = named.join(known.select(F.col("value").alias(f"value_{c}"), F.col("type").alias(f"type_{c}")), F.when(not_empty(c), low(c)) == F.col(f"value_{c}"), "left")
    resolved = F.coalesce(*[F.col(f"type_{c}") for c in triple], F.nullif("entity_name", F.lit("")), F.nullif("record_type", F.lit("")), F.lit("Unknown"))
    named = named.select(*[F.col(c).alias(f"_{c}") for c in triple], resolved.alias("scraper_type"))
    same = [rec[c].eqNullSafe(named[f"_{c}"]) for c in triple]
    return rec.join(named, same).drop(*[f"_{c}" for c in triple])


def attach_url(citation: Column, targets: Column) -> Column:
    """URL of the first link target whose text holds the citation or is held by it."""
    low = F.lower(citation)
    hits = F.filter(targets, lambda t: F.contains(F.lower(t["text"]), low) | F.contains(low, F.lower(t["text"])))
    return F.when(not_empty(citation), F.get(hits, 0)["url"])


def append_uncovered(names: Column, urls: Column, targets: Column) -> Column:
    """Link targets that no citation covers: URL unknown, and text in no known name. Appended ones count for later targets."""
    start = F.struct(F.coalesce(names, F.array().cast("array<string>")).alias("names"), F.coalesce(urls, F.array().cast("array<string>")).alias("urls"), F.array().cast("array<struct<text:string,url:string>>").alias("added"))

    def step(state: Column, t: Column) -> Column:
        covered = F.array_contains(state["urls"], t["url"]) | F.exists(state["names"], lambda n: F.contains(F.lower(n), F.lower(t["text"])))
        return F.when(F.coalesce(covered, F.lit(False)), state).otherwise(
            F.struct(F.concat(state["names"], F.array(t["text"])).alias("names"), F.concat(state["urls"], F.array(t["url"])).alias("urls"), F.concat(state["added"], F.array(F.struct(t["text"].alias("text"), t["url"].alias("url")))).alias("added"))
        )

    return F.aggregate(F.coalesce(targets, F.array().cast("array<struct<text:string,url:string>>")), start, step, lambda s: s["added"])


def companion_titles(pdf: DataFrame, pages: DataFrame) -> DataFrame:
    """PDF records with the title of the HTML page of the same name; pages as (url, title)."""
    p = pages.select(F.col("url").alias("companion_url"), F.col("title").alias("companion_title"))
    url = F.regexp_replace("source_url", r"(?i)\.pdf$", ".html")
    return pdf.withColumn("companion_url", url).join(p, "companion_url", "left")


def match_pipeline(names: DataFrame, cfg: DataFrame) -> DataFrame:
    """Pipeline of a name, by exact name, else by normalised name (least id)."""
    exact = cfg.groupBy(F.col("name").alias("exact_name")).agg(F.min("id").alias("exact_id"))
    normal = cfg.groupBy(norm_id("name").alias("normal_name")).agg(F.min("id").alias("normal_id"))
    out = names.join(exact, names.name == exact.exact_name, "left").join(normal, norm_id(names.name) == normal.normal_name, "left")
    return out.select(*names.columns, F.coalesce("exact_id", "normal_id").alias("pipeline_id"))


def pipeline_for_type(types: DataFrame, cfg: DataFrame) -> DataFrame:
    """Pipeline of a record type, by id or shared record type (first config wins), else the type itself."""
    ways = cfg.select("place", norm_id("name").alias("record_type"), norm_id("name").alias("pipeline_id")).unionAll(cfg.where(not_empty("shared_record_type")).select("place", "shared_record_type", norm_id("name")))
    first = pick(ways, ["record_type"], ["place"]).drop("place")
    return types.join(first, "record_type", "left").withColumn("pipeline_id", F.coalesce("pipeline_id", "record_type"))
