"""Registered queries of the library: operator id and name -> (query, SQL)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, names, payload, text, urls
from ..operators import aggregates as agg
from ..operators import catalogs, documents, filters, joins, merge, quality
from .adapters import ENTITIES, JUDGMENTS, MASTER, OTHER, PAYLOADS, RECORDS, SECONDARY, STORE_MASTER, TARGETS, Tables

#: The fixed clock of queries that need one.
NOW = dt.datetime(2024, 1, 15, 12, 7)
NOW_S = int(NOW.replace(tzinfo=dt.UTC).timestamp())

_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(make: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
            return make(Tables(spark, sf_dir))

        _queries[name] = run
        if sql:
            _sql[name] = sql
        return make

    return add


def queries():
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _queries["A6_uptime_and_rate"](spark, sf_dir)


DOC = f"WITH rec AS ({PAYLOADS})"
REC = f"WITH rec AS ({RECORDS}), tgt AS ({TARGETS}), ent AS ({ENTITIES})"
JUD = f"WITH j AS ({JUDGMENTS})"
CAT = f"WITH m AS ({MASTER}), o AS ({OTHER})"
NUMBER = "json_extract_string(data, '$.dataset_number')"
DONE = "json_extract_string(data, '$.details_scraped_at')"

# --- sources ---------------------------------------------------------------


@query("S5_read_pages", "SELECT page_id, url, length(html) AS n_chars FROM pages")
def _(t):
    from ..sources.io import read_pages

    return read_pages(t.spark, f"{t.dir}/pages.parquet").select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


def _round_trip(t, name: str, df, write, read):
    from ..streaming.tables import shared_folder

    path = shared_folder(t.spark, name)
    write(df, path)
    return read(path)


@query("S1_read_jdbc", "SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders WHERE o_totalprice > 50000 AND o_orderstatus = 'F'")
def _(t):
    """The orders landed in a database and read back in partitions, the conditions pushed down. Derby comes with Spark; it serves one process, as in local mode."""
    from ..sources.io import read_jdbc_tables, write_jdbc_table
    from ..streaming.tables import shared_folder

    folder = shared_folder(t.spark, "derby").removeprefix("file://")
    t.spark._jvm.System.setProperty("derby.stream.error.file", f"{folder}.log")
    url, driver = f"jdbc:derby:{folder};create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    orders = t["orders"].select("o_orderkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate"), F.col("o_totalprice").cast("double").alias("o_totalprice"))
    write_jdbc_table(orders, url, "orders", "o_orderstatus VARCHAR(20)", **driver)
    high = orders.agg(F.max("o_orderkey")).first()[0] or 0
    read = read_jdbc_tables(t.spark, url, {"orders": ("o_orderkey", 0, high + 1)}, 4, **driver)["orders"]
    return read.where("o_totalprice > 50000 AND o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus", "o_orderdate")


@query("S3_read_catalog", "SELECT p_partkey AS place, p_name AS description, CAST(p_retailprice AS VARCHAR) AS price, p_partkey % 3 = 0 AS tiered, p_partkey // 1000 AS catalog FROM part")
def _(t):
    from ..sources.io import read_catalog, write_json_arrays

    tiers = F.when(F.col("p_partkey") % 3 == 0, F.array(F.struct(F.lit("1").alias("qty"), F.lit("R 1").alias("price"))))
    parts = t["part"].select(F.col("p_partkey").alias("place"), F.col("p_name").alias("description"), F.col("p_retailprice").cast("string").alias("price"), tiers.alias("pricing"))
    read = _round_trip(t, "catalog", parts, lambda df, path: write_json_arrays(df, path, "place"), lambda path: read_catalog(t.spark, f"{path}/*", "place long, description string, price string, pricing array<struct<qty:string,price:string>>"))
    return read.select("place", "description", "price", (F.coalesce(F.size("pricing"), F.lit(0)) > 0).alias("tiered"), F.regexp_extract("catalog_file", r"group=(\d+)", 1).cast("long").alias("catalog"))


@query("S4_read_judgments", f"WITH j AS ({JUDGMENTS}) SELECT dataset_number, court, judge, reportable, CAST(judgment_date AS VARCHAR) AS judgment_date, outcome AS outcome_type, subject_list FROM j")
def _(t):
    from ..sources.io import read_judgments, write_json_arrays

    raw = t.judgments().select("id", "dataset_number", "court", "judge", "reportable", F.col("judgment_date").cast("string"), F.struct(F.col("outcome").alias("outcome_type")).alias("result"), "subjects")
    read = _round_trip(t, "judgments", raw, lambda df, path: write_json_arrays(df, path, "id", 10_000), lambda path: read_judgments(t.spark, f"{path}/*"))
    return read.select("dataset_number", "court", "judge", "reportable", "judgment_date", "result.outcome_type", F.array_join("subjects", ",").alias("subject_list"))


_EXPORT = "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders"

for _fmt in ("csv", "parquet", "json"):

    @query({"csv": "K1_K4_export_csv", "parquet": "K2_export_parquet", "json": "K3_export_json"}[_fmt], _EXPORT)
    def _(t, fmt=_fmt):
        from ..sources.io import export

        schema = "o_orderkey long, o_orderstatus string, o_orderpriority string"
        return _round_trip(t, "export", t.sql(_EXPORT), lambda df, p: export(df, f"{p}.{fmt}"), lambda p: t.spark.read.schema(schema).load(f"{p}.{fmt}", format=fmt, header=True))


@query("K5_S6_draws", "SELECT CAST(year(o_orderdate) AS VARCHAR) AS year, o_orderpriority AS numbers, count(*) AS n FROM orders GROUP BY 1, 2")
def _(t):
    from ..sources.io import read_draws, write_draws

    df = t["orders"].select(F.col("o_orderpriority").alias("Winning Numbers"), F.year("o_orderdate").cast("string").alias("Year"), F.lit("1 May").alias("Date"), F.lit("R 1").alias("Jackpot"), F.lit("Won").alias("Outcome"))
    read = _round_trip(t, "draws", df, write_draws, lambda p: read_draws(t.spark, p))
    return read.groupBy(F.col("Year").alias("year"), F.col("Winning Numbers").alias("numbers")).agg(F.count("*").alias("n"))


@query("K6_write_metrics", "SELECT event_type AS name, count(*) AS total FROM events GROUP BY 1")
def _(t):
    from ..sources.io import read_metrics, write_metrics

    def write(df, path):
        write_metrics(df.unionAll(df.select(F.lit("obsolete"), "total")), path)
        write_metrics(df, path)

    df = t["events"].groupBy(F.col("event_type").alias("name")).agg(F.count("*").alias("total"))
    return _round_trip(t, "metrics", df, write, lambda p: read_metrics(t.spark, p, "name string, total long"))


@query("S2_read_table", f"WITH tgt AS ({TARGETS}) SELECT id, entity_id, target_name FROM tgt")
def _(t):
    from ..sources.io import read_table

    df = t.targets().select("id", "entity_id", "target_name", "location", "target_type", F.lit(None).cast("timestamp").alias("created_at"))
    return _round_trip(t, "lake", df, lambda x, p: x.write.parquet(f"{p}/targets"), lambda p: read_table(t.spark, p, "targets").select("id", "entity_id", "target_name"))


@query("K8_publish_pages", f"{DOC} SELECT coalesce(target_name, 'Unknown') AS book, coalesce(CAST(rec_year AS VARCHAR), 'Undated') AS chapter, substr(coalesce(full_text, 'Untitled'), 1, 250) AS page_name, md5(full_text) AS body FROM rec")
def _(t):
    from ..sources.io import publish_pages

    rows = t.payloads().select(F.col("target_name").alias("court"), F.make_date("rec_year", F.lit(1), F.lit(1)).alias("document_date"), F.col("full_text").alias("title"), F.md5("full_text").alias("body"))
    return publish_pages(rows)


# --- filters ---------------------------------------------------------------


@query("F1_active_blueprints", "SELECT replace(lower(n_name), '-', '_') AS pipeline_id, concat('scraper ', CAST(n_regionkey AS VARCHAR)) AS scraper_type FROM nation WHERE n_nationkey % 2 = 0")
def _(t):
    cfg = t["nation"].select(F.col("n_name").alias("name"), F.concat(F.lit("scraper "), "n_regionkey").alias("scraper_type"), F.lit("judgment").alias("document_type"), (F.col("n_nationkey") % 2 == 0).alias("is_active"))
    return filters.active_blueprints(cfg).select("pipeline_id", "blueprint.scraper_type")


@query("F2_existing_urls", f"{DOC} SELECT source_url FROM rec WHERE record_type = 'en' AND source_url <> ''")
def _(t):
    return filters.existing_urls(t.payloads(), "en")


@query("F3_existing_urls_by_status", f"{DOC} SELECT source_url FROM rec WHERE record_type = 'en' AND status = 'detailed' AND source_url <> ''")
def _(t):
    return filters.existing_urls(t.payloads(), "en", "detailed")


@query("F4_existing_dataset_numbers", f"{DOC} SELECT {NUMBER} AS dataset_number FROM rec WHERE record_type = 'fr' AND {NUMBER} <> ''")
def _(t):
    return filters.existing_dataset_numbers(t.payloads(), "fr")


@query("F5_needing_detail", f"{DOC} SELECT id, source_url, scraped_s FROM rec WHERE record_type = 'en' AND source_url <> '' AND status = 'indexed' AND id % 10 <> 3 ORDER BY scraped_s DESC, id DESC LIMIT 50")
def _(t):
    rec = t.payloads()
    return filters.needing_detail(rec, "en", desc=True, limit=50, exclude=rec.where("id % 10 = 3")).select("id", "source_url", F.unix_seconds("scraped_at").alias("scraped_s"))


@query("F6_count_needing_detail", f"{DOC} SELECT count(*) AS pending FROM rec WHERE record_type = 'en' AND source_url <> '' AND (status = 'indexed' OR (status IS NULL AND {DONE} IS NULL))")
def _(t):
    return filters.count_needing_detail(t.payloads(), "en")


@query("F7_complete_flags", f"""{DOC}, done AS (SELECT source_url, {NUMBER} AS number FROM rec WHERE status = 'detailed' OR {DONE} IS NOT NULL)
SELECT id, coalesce(source_url IN (SELECT source_url FROM done WHERE source_url <> ''), false) OR coalesce({NUMBER} IN (SELECT number FROM done WHERE number <> ''), false) AS is_complete FROM rec""")
def _(t):
    rec = t.payloads()
    keys = rec.select("id", "source_url", F.get_json_object("data", "$.dataset_number").alias("dataset_number"))
    return filters.complete_flags(keys, rec).select("id", "is_complete")


@query("F8_case_records", f"{DOC} SELECT id FROM rec WHERE coalesce(contains(source_url, '/cases/'), false) OR (source_url IS NULL AND json_extract_string(data, '$.category') = 'cases')")
def _(t):
    return t.payloads().where(filters.is_case_record()).select("id")


@query("F9_repairable_cases", f"{DOC} SELECT id FROM rec WHERE source_url IS NOT NULL AND source_url NOT LIKE '%/gaz/%'")
def _(t):
    return t.payloads().where(filters.is_repairable_case()).select("id")


@query("F10_not_in_review", f"{DOC} SELECT id FROM rec WHERE requires_human_review IS NOT TRUE")
def _(t):
    return t.payloads().where(filters.not_in_review()).select("id")


@query("F11_failed_parses", f"{DOC} SELECT id FROM rec WHERE requires_human_review AND review_reason = 'Document parsing failed'")
def _(t):
    return filters.failed_parses(t.payloads()).select("id")


@query("F12_for_target", f"{DOC} SELECT id FROM rec WHERE target_name = 'src1'")
def _(t):
    return filters.for_target(t.payloads(), "src1").select("id")


@query("F13_filter_datasets", f"{DOC} SELECT id, coalesce(upper(target_name) IN ('SRC1', 'SRC2'), false) AS kept FROM rec")
def _(t):
    kept, skipped = filters.filter_datasets(t.payloads(), ["src1", "Src2"], "target_name")
    return kept.select("id", F.lit(True).alias("kept")).unionAll(skipped.select("id", F.lit(False)))


@query("F14_pdf_cases", f"{DOC} SELECT id FROM rec WHERE lower(source_url) LIKE '%.pdf' AND source_url LIKE '%/za/cases/%'")
def _(t):
    return filters.pdf_cases(t.payloads()).select("id")


@query("F15_search_records", f"{REC} SELECT rec.id FROM rec JOIN tgt ON tgt.id = rec.target_id WHERE (lower(target_name) LIKE '%nation_1%' OR lower(entity_name) LIKE '%nation_1%' OR lower(record_type) LIKE '%nation_1%') AND status = 'indexed'")
def _(t):
    return filters.search_records(joins.with_metadata(t.records(), t.targets().drop("entity_name"), t.entities()), "Nation_1", status="indexed").select("id")


@query("F15_search_by_index", f"{REC} SELECT rec.id FROM rec JOIN tgt ON tgt.id = rec.target_id WHERE (lower(target_name) LIKE '%nation_1%' OR lower(entity_name) LIKE '%nation_1%' OR lower(record_type) LIKE '%nation_1%') AND status = 'indexed'")
def _(t):
    from ..operators.substrings import read_gram_index, write_gram_index

    rec = joins.with_metadata(t.records(), t.targets().drop("entity_name"), t.entities())
    index = _round_trip(t, "grams", rec, lambda df, path: write_gram_index(df, path, ["target_name", "entity_name", "record_type"]), lambda path: read_gram_index(t.spark, path))
    return filters.search_by_index(rec, index, "Nation_1", status="indexed").select("id")


@query("F16_has_key", f"{DOC} SELECT id, contains(data, 'citations') AS has FROM rec")
def _(t):
    return t.payloads().select("id", payload.has_key("data", "citations").alias("has"))


@query("F17_exclude_rolls", f"{DOC} SELECT count(*) AS n FROM rec WHERE target_name NOT LIKE '%Rolls%'")
def _(t):
    return t.payloads().where(filters.exclude_rolls()).agg(F.count("*").alias("n"))


@query("F18_parse_sample", f"{DOC} SELECT id FROM rec WHERE status = 'detailed' AND target_name NOT LIKE '%Rolls%' AND length(trim(full_text)) > 50 ORDER BY id LIMIT 100")
def _(t):
    return filters.parse_sample(t.payloads(), 100).select("id")


# --- joins -----------------------------------------------------------------


@query("J1_with_metadata", f"{REC} SELECT rec.id, record_type, status, target_name, name AS entity_name FROM rec LEFT JOIN tgt ON tgt.id = rec.target_id LEFT JOIN ent ON ent.id = tgt.entity_id")
def _(t):
    return joins.with_metadata(t.records(), t.targets().drop("entity_name"), t.entities()).select("id", "record_type", "status", "target_name", "entity_name")


@query("J2_with_target", f"{REC} SELECT rec.id, target_name FROM rec JOIN tgt ON tgt.id = rec.target_id")
def _(t):
    return joins.with_target(t.records(), t.targets()).select("id", "target_name")


_SCRUBBED = "SELECT doc_id AS id FROM documents WHERE doc_id % 5 = 0"
_PARSED = "SELECT doc_id AS id FROM documents WHERE doc_id % 4 <> 0"


@query("J3_repair_input", f"{DOC} SELECT rec.id, coalesce(s_name, 'Unknown') AS target_name, status FROM rec JOIN ({_SCRUBBED}) s ON s.id = rec.id LEFT JOIN (SELECT s_name FROM supplier WHERE s_name = 'none') x ON x.s_name = rec.target_name")
def _(t):
    none = t["supplier"].where("s_name = 'none'").select(F.col("s_name").alias("id"), F.col("s_name").alias("target_name"))
    return joins.repair_input(t.child("scrubbed"), t.payloads().drop("target_name").withColumn("target_id", F.lit("src")), none).select("id", "target_name", "status")


@query("J4_unparsed", f"{DOC} SELECT rec.id FROM rec LEFT JOIN ({_PARSED}) p ON p.id = rec.id WHERE p.id IS NULL AND status = 'detailed'")
def _(t):
    return joins.without_child(t.payloads().where("status = 'detailed'"), t.child("parsed")).select("id")


@query("J5_unscrubbed", f"{DOC} SELECT rec.id, rec.record_type, p.id IS NOT NULL AS parsed, n_name AS target_name FROM rec LEFT JOIN ({_SCRUBBED}) s ON s.id = rec.id LEFT JOIN ({_PARSED}) p ON p.id = rec.id LEFT JOIN nation ON n_nationkey = rec.id % 30 WHERE s.id IS NULL AND status = 'detailed'")
def _(t):
    dims = t["nation"].select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("target_name"), F.col("n_regionkey").alias("entity_id"))
    ents = t["region"].select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    rec = t.payloads().drop("target_name").withColumn("target_id", F.col("id") % 30)
    return joins.unscrubbed(rec, t.child("parsed"), t.child("scrubbed"), dims, ents).select("id", "record_type", F.col("parsed_data").isNotNull().alias("parsed"), "target_name")


@query("J6_new_candidates", f"""{DOC}, items AS (SELECT id AS place, source_url, {NUMBER} AS number FROM rec WHERE id % 2 = 1 AND source_url IS NOT NULL), known AS (SELECT source_url, {NUMBER} AS number FROM rec WHERE id % 10 = 0),
fresh AS (SELECT * FROM items WHERE source_url NOT IN (SELECT source_url FROM known WHERE source_url <> '') AND (number IS NULL OR number NOT IN (SELECT number FROM known WHERE number IS NOT NULL)))
SELECT place FROM (SELECT place, number, row_number() OVER (PARTITION BY number ORDER BY place) AS k FROM fresh) WHERE number IS NULL OR k = 1""")
def _(t):
    rec = t.payloads().withColumn("dataset_number", F.get_json_object("data", "$.dataset_number"))
    items = rec.where("id % 2 = 1 and source_url is not null").select(F.col("id").alias("place"), "source_url", "dataset_number")
    return joins.new_candidates(items, rec.where("id % 10 = 0")).select("place")


_STORES = f"WITH s AS ({SECONDARY}), m AS ({STORE_MASTER})"


@query("J7_match_by_url", f"{_STORES} SELECT coalesce(s.source_url, m.source_url) AS source_url, s.id AS a_id, m.id AS b_id FROM (SELECT * FROM s WHERE source_url <> '') s FULL OUTER JOIN (SELECT * FROM m WHERE source_url <> '') m ON s.source_url = m.source_url")
def _(t):
    return joins.match_by_url(t.sql(SECONDARY), t.sql(STORE_MASTER)).select("source_url", F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"))


@query("J8_remap_targets", f"{REC} SELECT rec.id, CASE WHEN tgt.target_name <> 'NATION_3' THEN concat('new-', tgt.target_name) END AS new_target_id FROM rec LEFT JOIN tgt ON tgt.id = rec.target_id")
def _(t):
    dst = t.targets().where("target_name <> 'NATION_3'").select(F.concat(F.lit("new-"), "target_name").alias("id"), "entity_name", "target_name")
    return joins.remap_targets(t.records(), t.targets(), dst).select("id", "new_target_id")


_LAST_OTHER = "lo AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY part_number ORDER BY place DESC) AS k FROM o WHERE part_number <> '') WHERE k = 1)"


@query("J9_match_catalog", f"{CAT}, {_LAST_OTHER} SELECT m.place, m.stock_code, lo.image_url FROM m LEFT JOIN lo ON lo.part_number = m.stock_code")
def _(t):
    return joins.match_catalog(t.sql(MASTER), t.sql(OTHER)).select("place", "stock_code", F.col("other.image_url").alias("image_url"))


@query("J10_reset_set", f"{DOC} SELECT id FROM rec WHERE id % 5 = 0 AND json_extract_string(data, '$.category') = 'cases'")
def _(t):
    cases = t.payloads().where(F.get_json_object("data", "$.category") == "cases")
    return joins.reset_set(cases, t.child("parsed"), t.child("scrubbed")).select("id")


_LOOKUP = [(0, "src1", "court scraper"), (1, "en", "english"), (2, "src", "general")]


@query("J11_resolve_scraper_type", f"""{DOC} SELECT id, CASE WHEN record_type = 'en' THEN 'english' WHEN record_type IS NOT NULL AND contains('en', record_type) THEN 'english' WHEN target_name = 'src1' THEN 'court scraper'
WHEN contains(target_name, 'src1') THEN 'court scraper' WHEN contains(target_name, 'src') THEN 'general' ELSE coalesce(record_type, 'Unknown') END AS scraper_type FROM rec""")
def _(t):
    lookup = t.spark.createDataFrame(_LOOKUP, "place int, key string, scraper_type string")
    return joins.resolve_scraper_type(t.payloads().withColumn("entity_name", F.lit(None).cast("string")), lookup).select("id", "scraper_type")


_LINKS = "array(named_struct('text', 'smith v jones', 'url', 'u1'), named_struct('text', o_orderpriority, 'url', 'u2'), named_struct('text', substr(o_orderpriority, 3), 'url', 'u3'), named_struct('text', 'x', 'url', 'u2'))"


@query("J12_J13_link_targets", "SELECT o_orderkey, 'u1' AS url, 'u2' AS added FROM orders")
def _(t):
    targets = F.expr(_LINKS)
    added = joins.append_uncovered(F.array(F.lit("Smith v Jones (1/20)")), F.array(F.lit("u1")), targets)
    return t["orders"].select("o_orderkey", joins.attach_url(F.lit("Smith v Jones (1/20)"), targets).alias("url"), F.array_join(F.transform(added, lambda a: a["url"]), ",").alias("added"))


@query("J14_companion_titles", f"{DOC} SELECT id, replace(source_url, '.pdf', '.html') AS companion_url, CASE WHEN id % 8 = 0 THEN concat('Title of ', CAST(id AS VARCHAR)) END AS companion_title FROM rec WHERE source_url LIKE '%.pdf'")
def _(t):
    rec = t.payloads()
    pages = rec.where("id % 8 = 0").select(F.replace("source_url", F.lit(".pdf"), F.lit(".html")).alias("url"), F.concat(F.lit("Title of "), "id").alias("title"))
    return joins.companion_titles(filters.pdf_cases(rec), pages).select("id", "companion_url", "companion_title")


@query("J15_match_pipeline", "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey END AS pipeline_id FROM nation")
def _(t):
    cfg = t["nation"].where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("id"), F.lower(F.replace("n_name", F.lit("_"), F.lit("-"))).alias("name"))
    named = t["nation"].select("n_nationkey", F.lower("n_name").alias("name"))
    return joins.match_pipeline(named, cfg).select("n_nationkey", "pipeline_id")


@query("J16_pipeline_for_type", "SELECT n_name AS record_type, CASE WHEN n_nationkey % 2 = 0 THEN concat('shared_', CAST(n_nationkey AS VARCHAR)) ELSE n_name END AS pipeline_id FROM nation")
def _(t):
    cfg = t["nation"].where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("place"), F.concat(F.lit("Shared "), "n_nationkey").alias("name"), F.col("n_name").alias("shared_record_type"))
    return joins.pipeline_for_type(t["nation"].select(F.col("n_name").alias("record_type")), cfg)


# --- aggregates and windows --------------------------------------------------


@query("A1_type_status_counts", f"{REC} SELECT record_type, status, count(*) AS n FROM rec GROUP BY 1, 2")
def _(t):
    return agg.type_status_counts(t.records())


@query("A2_top_targets", f"{REC} SELECT entity_name, target_name, record_type, status, count(*) AS n FROM rec JOIN tgt ON tgt.id = rec.target_id GROUP BY 1, 2, 3, 4 ORDER BY n DESC, 1, 2, 3, 4 LIMIT 20")
def _(t):
    return agg.top_targets(joins.with_metadata(t.records(), t.targets().drop("entity_name"), t.entities()))


@query("A3_heading_search", f"""{DOC}, e AS (SELECT left(coalesce(full_text, ''), 400) AS x FROM rec WHERE status = 'detailed')
SELECT count(*) AS total, count(*) FILTER (regexp_matches(x, '\\bThe\\b')) AS as_word, count(*) FILTER (regexp_matches(x, '(?m)^\\s*The')) AS at_line_start, count(*) FILTER (contains(x, 'The')) AS anywhere, count(*) FILTER (contains(lower(x), 'the')) AS any_case FROM e""")
def _(t):
    return agg.heading_search(t.payloads().where("status = 'detailed'"), "The", 400)


@query("A3_heading_search_by_index", f"""{DOC}, e AS (SELECT left(coalesce(full_text, ''), 400) AS x FROM rec WHERE status = 'detailed')
SELECT count(*) AS total, count(*) FILTER (regexp_matches(x, '\\bThe\\b')) AS as_word, count(*) FILTER (regexp_matches(x, '(?m)^\\s*The')) AS at_line_start, count(*) FILTER (contains(x, 'The')) AS anywhere, count(*) FILTER (contains(lower(x), 'the')) AS any_case FROM e""")
def _(t):
    from ..operators.substrings import read_gram_index

    rec = t.payloads().where("status = 'detailed'")
    index = _round_trip(t, "headings", rec, lambda df, path: agg.index_headings(df, path, 400), lambda path: read_gram_index(t.spark, path))
    return agg.heading_search_by_index(rec, index, "The", 400)


_YEARS = f"y AS (SELECT record_type, rec_year, count(*) AS n, count(*) FILTER (status = 'detailed' OR {DONE} IS NOT NULL) AS d FROM rec GROUP BY 1, 2)"


@query("A4_pipeline_state", f"""{DOC}, {_YEARS} SELECT record_type, CAST(sum(n) AS BIGINT) AS total, CAST(sum(d) AS BIGINT) AS total_detailed, CAST(sum(n) - sum(d) AS BIGINT) AS total_indexed,
coalesce(list(rec_year ORDER BY rec_year) FILTER (rec_year IS NOT NULL AND n = d), []) AS complete_years, coalesce(list(rec_year ORDER BY rec_year) FILTER (rec_year IS NOT NULL AND n <> d), []) AS incomplete_years, sum(n) = sum(d) AS fully_complete FROM y GROUP BY 1""")
def _(t):
    return agg.pipeline_state(t.payloads())


@query("A5_overall_totals", f"{DOC} SELECT target_name AS scraper_type, count(*) FILTER (coalesce(status, 'indexed') = 'indexed') AS indexed, count(*) FILTER (status = 'detailed') AS detailed, count(*) AS total FROM rec GROUP BY 1")
def _(t):
    counted = t.payloads().groupBy(F.col("target_name").alias("scraper_type"), "status").agg(F.count("*").alias("n"))
    return agg.overall_totals(counted)


_GAPS = "g AS (SELECT *, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type ORDER BY ts, event_id)) AS gap FROM events)"
_UPTIME = "count(*) AS total, count(*) FILTER (gap <= 120000000) AS active, CAST(coalesce(sum(gap) FILTER (gap <= 120000000), 0) AS BIGINT) AS uptime_us"


@query("A6_uptime_and_rate", f"WITH {_GAPS}, u AS (SELECT event_type, {_UPTIME} FROM g GROUP BY 1) SELECT *, CASE WHEN uptime_us > 0 THEN active * 1e6 / uptime_us ELSE 0 END AS rate, CASE WHEN uptime_us > 0 THEN active * 1e6 / uptime_us * 3600 ELSE 0 END AS rate_per_hour FROM u")
def _(t):
    return agg.uptime_and_rate(t["events"], ["event_type"], ["event_id"])


for _id, _period in (("A7_period_rate_7d", "7d"), ("A8_period_rate_24h", "24h")):
    _s = agg.PERIODS[_period]

    @query(_id, f"SELECT event_type, count(*) FILTER (ts >= make_timestamp({(NOW_S - _s) * 1_000_000})) AS n, count(*) FILTER (ts >= make_timestamp({(NOW_S - _s) * 1_000_000})) / {_s}.0 AS rate FROM events GROUP BY 1")
    def _(t, period=_period):
        return agg.period_rate(t["events"], ["event_type"], F.lit(NOW).cast("timestamp"), period)


@query("A9_is_online", f"SELECT user_id, bool_or(ts >= make_timestamp({(NOW_S - 900) * 1_000_000})) AS online FROM events GROUP BY 1")
def _(t):
    return agg.is_online(t["events"], ["user_id"], F.lit(NOW).cast("timestamp"))


@query("A10_worker_breakdown", "WITH g AS (SELECT *, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id)) AS gap FROM events) SELECT event_type, CAST(user_id AS VARCHAR) AS worker, " + _UPTIME + " FROM g GROUP BY 1, 2")
def _(t):
    out = agg.worker_breakdown(t["events"], "event_type", "user_id", ["event_id"])
    return out.select("event_type", F.explode("workers").alias("worker", "m")).select("event_type", "worker", "m.total", "m.active", "m.uptime_us")


@query("A11_configured_concurrency", "SELECT p_brand AS scraper_type, sum(p_size) FILTER (p_partkey % 3 <> 0) AS concurrency FROM part GROUP BY 1")
def _(t):
    cfg = t["part"].select(F.col("p_brand").alias("scraper_type"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_size").cast("string")).otherwise("many").alias("concurrency"))
    return agg.configured_concurrency(cfg)


_WEEK, _DAY, _QUARTER = (f"count(*) FILTER (ts >= make_timestamp({(NOW_S - s) * 1_000_000}))" for s in (604_800, 86_400, 900))
_HOUR_END = NOW_S // 300 * 300


@query("A12_pipeline_metrics", f"""WITH {_GAPS}, u AS (SELECT event_type, {_UPTIME}, {_WEEK} AS n_7d, {_DAY} AS n_24h, {_QUARTER} > 0 AS online FROM g GROUP BY 1),
b AS (SELECT event_type, s AS start_s, (SELECT count(*) FROM events e WHERE e.event_type = k.event_type AND epoch_us(e.ts) >= s * 1000000 AND epoch_us(e.ts) < (s + 300) * 1000000) AS n FROM (SELECT DISTINCT event_type FROM events) k, (SELECT unnest(range({_HOUR_END - 3600}, {_HOUR_END}, 300)) AS s)),
i AS (SELECT event_type, string_agg(concat(CAST(start_s AS VARCHAR), ':', CAST(n AS VARCHAR)), ',' ORDER BY start_s) AS intervals FROM b GROUP BY 1),
gw AS (SELECT *, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id)) AS gap FROM events),
w AS (SELECT event_type, CAST(user_id AS VARCHAR) AS worker, {_UPTIME} FROM gw GROUP BY 1, 2),
v AS (SELECT event_type, count(*) AS n_workers, CAST(sum(active) AS BIGINT) AS worker_active, CAST(sum(uptime_us) AS BIGINT) AS worker_uptime_us FROM w GROUP BY 1)
SELECT u.*, CASE WHEN uptime_us > 0 THEN active * 1e6 / uptime_us ELSE 0 END AS rate, i.intervals, v.n_workers, v.worker_active, v.worker_uptime_us FROM u JOIN i USING (event_type) JOIN v USING (event_type)""")
def _(t):
    m = agg.pipeline_metrics(t["events"], "event_type", "user_id", ["event_id"], NOW).select("event_type", "metrics.*")
    workers = F.map_values("workers")
    sum_of = lambda c: F.aggregate(workers, F.lit(0).cast("long"), lambda a, w: a + w[c])
    intervals = F.array_join(F.transform("intervals", lambda b: F.concat(b["start_s"], F.lit(":"), b["n"])), ",")
    return m.select(
        "event_type", "total", "active", "uptime_us", "rate", F.col("last_7d.n").alias("n_7d"), F.col("last_24h.n").alias("n_24h"), "online", intervals.alias("intervals"),
        F.size("workers").cast("long").alias("n_workers"), sum_of("active").alias("worker_active"), sum_of("uptime_us").alias("worker_uptime_us"),
    )


CASE_YEAR = "CAST(CASE WHEN regexp_full_match(split_part(dataset_number, '/', 1), '20[0-9][0-9]') THEN split_part(dataset_number, '/', 1) ELSE split_part(dataset_number, '/', 2) END AS INT)"


@query("A13_legal_kpis", f"{JUD}, y AS (SELECT *, greatest(0, year(judgment_date) - {CASE_YEAR}) AS dur FROM j) SELECT count(*) AS total, round_even(avg(dur), 1) AS mean_duration, count(*) FILTER (reportable) / count(reportable) AS reportable_share FROM y")
def _(t):
    return agg.legal_kpis(t.judgments().withColumn("duration_years", dates.duration_years("dataset_number", F.col("judgment_date"))))


for _column in ("court", "division", "outcome", "judge"):

    @query(f"A14_value_counts_{_column}", f"{JUD} SELECT {_column} AS value, count(*) AS n FROM j WHERE {_column} IS NOT NULL GROUP BY 1")
    def _(t, column=_column):
        return agg.value_counts(t.judgments(), column)


@query("A15_top_terms", f"{JUD} SELECT value, count(*) AS n FROM (SELECT unnest(string_split(subject_list, ',')) AS value FROM j) GROUP BY 1 ORDER BY n DESC, value LIMIT 10")
def _(t):
    return agg.top_terms(t.judgments(), "subjects")


@query("A16_judge_outcome", f"""{JUD} SELECT judge, count(*) FILTER (outcome = 'F') AS "F", count(*) FILTER (outcome = 'O') AS "O", count(*) FILTER (outcome = 'P') AS "P" FROM j WHERE outcome IS NOT NULL GROUP BY 1""")
def _(t):
    return agg.judge_outcome(t.judgments(), ["F", "O", "P"])


@query("A18_reset_report", f"{DOC} SELECT count(*) AS total, count(*) FILTER (id % 4 <> 0) AS parsed, count(*) FILTER (id % 5 = 0) AS scrubbed, count(*) FILTER (coalesce(requires_human_review, false)) AS flagged FROM rec")
def _(t):
    return agg.reset_report(t.payloads().withColumns({"is_parsed": F.col("id") % 4 != 0, "is_scrubbed": F.col("id") % 5 == 0}))


@query("A20_pending_types", f"{DOC} SELECT DISTINCT record_type FROM rec WHERE status = 'detailed' AND id % 5 <> 0")
def _(t):
    return agg.pending_types(t.payloads().withColumn("scrubbed_at", F.when(F.col("id") % 5 == 0, F.col("scraped_at"))))


@query("W1_with_gap", f"WITH {_GAPS} SELECT event_id, gap AS gap_us FROM g")
def _(t):
    return agg.with_gap(t["events"], ["event_type"], ["event_id"]).select("event_id", "gap_us")


_END = NOW_S - NOW_S % 300


@query("W2_last_hour_intervals", f"""WITH k AS (SELECT DISTINCT event_type FROM events), b AS (SELECT unnest(range({_END - 3600}, {_END}, 300)) AS start_s)
SELECT k.event_type, b.start_s, count(e.event_id) AS n, CAST(count(e.event_id) * 12 AS DOUBLE) AS rate_per_hour FROM k CROSS JOIN b LEFT JOIN events e ON e.event_type = k.event_type AND epoch_us(e.ts) >= b.start_s * 1000000 AND epoch_us(e.ts) < (b.start_s + 300) * 1000000 GROUP BY 1, 2""")
def _(t):
    return agg.last_hour_intervals(t["events"], ["event_type"], NOW)


@query("W3_pick_last", f"{CAT}, {_LAST_OTHER} SELECT part_number, place FROM lo")
def _(t):
    return filters.pick(t.sql(OTHER).where("part_number <> ''"), ["part_number"], ["place"], "last").select("part_number", "place")


@query("W4_merge_worklist", f"""{DOC}, u AS (SELECT source_url, 0 AS l, id AS place FROM rec WHERE id % 3 = 0 AND source_url IS NOT NULL UNION ALL SELECT source_url, 1, id FROM rec WHERE id % 2 = 0 AND source_url IS NOT NULL)
SELECT source_url, l AS list, place FROM (SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY l, place) AS k FROM u) WHERE k = 1""")
def _(t):
    rec = t.payloads().where("source_url is not null").withColumn("place", F.col("id"))
    return filters.merge_worklist(rec.where("id % 3 = 0"), rec.where("id % 2 = 0"))


@query("W5_month_windows", "WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS year FROM orders), m AS (SELECT year, unnest(range(1, 13)) AS month FROM y) SELECT year, CAST(month AS INT) AS month, make_date(year, month, 1) AS first_day, last_day(make_date(year, month, 1)) AS last_day FROM m WHERE year * 100 + month >= 199603")
def _(t):
    return agg.month_windows(t["orders"].select(F.year("o_orderdate").alias("year")), (1996, 3))


@query("W6_fallback_sample", f"{DOC} SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY target_name ORDER BY scraped_s DESC, id DESC) AS k FROM rec WHERE target_name NOT IN (SELECT target_name FROM rec WHERE id % 50 = 7)) WHERE k <= 20")
def _(t):
    rec = t.payloads()
    return agg.fallback_sample(rec, rec.where("id % 50 = 7"), "target_name", 20).select("id")


@query("W7_both_advanced", "SELECT min(CASE WHEN m > c THEN 1 ELSE 0 END) = 1 AS due FROM (SELECT event_type, max(ts) AS m, max(ts) FILTER (event_id % 2 = 0) AS c FROM events GROUP BY 1)")
def _(t):
    ev = t["events"].withColumn("source", F.col("event_type"))
    return agg.both_advanced(ev, ev.where("event_id % 2 = 0"))


@query("T1_top_k", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 25")
def _(t):
    return agg.top_k(t["orders"].groupBy("o_custkey").agg(F.count("*").alias("n")), "n", 25, ["o_custkey"])


@query("U1_all_types", "SELECT event_type AS name FROM events UNION SELECT lang FROM documents UNION SELECT role FROM conversations")
def _(t):
    return filters.all_types(t["events"].select(F.col("event_type").alias("name")), t["documents"].select("lang"), t["conversations"].select("role"))


@query("U2_stale_keys", "SELECT DISTINCT o_custkey AS key FROM orders WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def _(t):
    keys = t["orders"].withColumnRenamed("o_custkey", "key")
    return filters.stale_keys(keys, keys.where("o_orderstatus = 'F'"))


@query("U3_distinct_urls", "SELECT DISTINCT url FROM pages")
def _(t):
    return filters.distinct_urls(t["pages"].select("url"))


# --- columns ---------------------------------------------------------------

_SCRUB_SQL = "regexp_replace(regexp_replace(regexp_replace({}, '\\b\\d{{13}}\\b', '[RSA ID]', 'g'), '\\b[A-Za-z]\\d{{8}}\\b', '[PASSPORT]', 'g'), '\\b\\d{{10,16}}\\b', '[BANK/TAX NUMBER]', 'g')"
_PII = "concat(text, ' ', CAST(8001015009000 + doc_id AS STRING), ' A', CAST(10000000 + doc_id AS STRING), ' ', CAST(1234567890 + doc_id AS STRING))"


@query("X1_scrub", f"SELECT doc_id, md5({_SCRUB_SQL.format(_PII)}) AS scrubbed FROM documents")
def _(t):
    return t["documents"].select("doc_id", F.md5(text.scrub(F.expr(_PII))).alias("scrubbed"))


@query("X2_scrub_struct", f"SELECT doc_id, {_SCRUB_SQL.format('text')} AS a, {_SCRUB_SQL.format(_PII)} AS b FROM documents")
def _(t):
    df = t["documents"].select("doc_id", F.struct(F.col("text").alias("a"), F.array(F.expr(_PII)).alias("l")).alias("s"))
    return payload.scrub_struct(df).select("doc_id", "s.a", F.col("s.l")[0].alias("b"))


@query("X3_clean_text", r"SELECT doc_id, CASE WHEN text IS NULL THEN md5('') ELSE md5(trim(regexp_replace(trim(concat(text, chr(10), '  ', chr(10), chr(10), text), ' ' || chr(10) || chr(9)), '\n\s*\n+', chr(10) || chr(10), 'g'), ' ' || chr(10) || chr(9))) END AS cleaned FROM documents")
def _(t):
    raw = F.concat(F.lit("nav > LawCite\nPDF format\n"), "text", F.lit("\n  \n\n"), "text")
    return t["documents"].select("doc_id", F.md5(text.clean_text(raw)).alias("cleaned"))


_FORMATS = [("d MMMM yyyy", "%-d %B %Y"), ("d/M/yyyy", "%-d/%-m/%Y"), ("MMMM d, yyyy", "%B %-d, %Y"), ("yyyy-MM-dd", "%Y-%m-%d")]


@query("X4_title_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS title_date FROM orders")
def _(t):
    shown = F.coalesce(*[F.when(F.col("o_orderkey") % 4 == i, F.date_format("o_orderdate", f[0])) for i, f in enumerate(_FORMATS)])
    return t["orders"].select("o_orderkey", dates.title_date(F.concat(F.lit("A v B (1/20) ("), shown, F.lit(")."))).alias("title_date"))


@query("X5_safe_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def _(t):
    return t["orders"].select("o_orderkey", dates.safe_date(F.date_format("o_orderdate", "d MMM yyyy")).alias("day"))


@query("X6_document_date", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN make_date(2000 + doc_id % 20, 2, 3) WHEN doc_id % 3 = 1 THEN make_date(1990 + doc_id % 20, 1, 1) ELSE make_date(1970, 1, 1) END AS day FROM documents")
def _(t):
    data = F.when(F.col("doc_id") % 3 == 0, F.format_string('{"judgment_date":"%d-02-03T10:00"}', 2000 + F.col("doc_id") % 20)).when(F.col("doc_id") % 3 == 1, F.format_string('{"date":"x","year":%d}', 1990 + F.col("doc_id") % 20)).otherwise("{}")
    return t["documents"].select("doc_id", dates.document_date(data, F.lit("1970-01-01").cast("date")).alias("day"))


@query("X7_X10_case_numbers", "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE concat(CAST(doc_id AS VARCHAR), '/20') END AS from_title, concat('CCT ', CAST(doc_id AS VARCHAR), '/21') AS from_header, concat(CAST(doc_id AS VARCHAR), '/22') AS from_text, doc_id % 2 = 0 AS neutral FROM documents")
def _(t):
    n = F.col("doc_id").cast("string")
    title = F.concat(F.lit("A v B ("), F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Judgment "), n)).otherwise(F.concat(n, F.lit("/20"))), F.lit(") [2020] ZACC 1"))
    return t["documents"].select(
        "doc_id", text.case_no_title(title).alias("from_title"), text.case_no_header(F.concat(F.lit("HIGH COURT\nCASE NO: CCT "), n, F.lit("/21 heard on x"))).alias("from_header"),
        text.case_no_text(F.concat(F.lit("Application Number: "), n, F.lit("/22; more"))).alias("from_text"), text.is_neutral(F.when(F.col("doc_id") % 2 == 0, "[2020] ZACC 1").otherwise("CCT 1/20")).alias("neutral"),
    )


@query("X11_X12_category_metadata", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN concat(CAST(doc_id AS VARCHAR), '/22') WHEN 1 THEN CAST(doc_id AS VARCHAR) ELSE concat('Vol ', CAST(doc_id AS VARCHAR), ' No 4') END AS number FROM documents")
def _(t):
    n = F.col("doc_id").cast("string")
    kind = F.when(F.col("doc_id") % 3 == 0, "cases").when(F.col("doc_id") % 3 == 1, "gaz").otherwise("journals")
    body = F.when(kind == "cases", F.concat(F.lit("Case No: "), n, F.lit("/22"))).when(kind == "gaz", F.concat(F.lit("Government Gazette of today No. "), n)).otherwise(F.concat(F.lit("Volume "), n, F.lit(" Issue 4")))
    return t["documents"].select("doc_id", text.dataset_number(text.category_metadata(kind, F.lit("t"), body)).alias("number"))


@query("X13_X16_url_parts", f"""{DOC} SELECT id, CASE WHEN id % 3 = 0 THEN 'cases' ELSE 'gaz' END AS record_category, CASE WHEN source_url IS NULL THEN 'other' ELSE 'cases' END AS url_category, CASE WHEN source_url IS NOT NULL THEN target_name END AS dataset,
CASE WHEN source_url IS NULL THEN '' ELSE target_name END AS code, CASE WHEN source_url IS NULL THEN 'unknown' ELSE CAST(2000 + id % 20 AS VARCHAR) END AS year, CASE WHEN source_url IS NULL THEN 'unknown' ELSE CAST(id AS VARCHAR) END AS document_id FROM rec""")
def _(t):
    return t.payloads().select("id", urls.record_category("data", "source_url").alias("record_category"), urls.url_category("source_url").alias("url_category"), urls.url_dataset("source_url").alias("dataset"), urls.url_parts("source_url").alias("p")).select("id", "record_category", "url_category", "dataset", "p.*")


@query("X17_page_state", "SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'BLOCKED' WHEN 1 THEN 'NOT_FOUND' ELSE 'OK' END AS state FROM pages")
def _(t):
    title = F.when(F.col("page_id") % 3 == 0, "Just a moment...").when(F.col("page_id") % 3 == 1, "404 Not Found").otherwise("Case 404 [2025]")
    return t["pages"].select("page_id", text.page_state(title, F.lit(None).cast("string"), F.lit("text")).alias("state"))


@query("X18_court_name", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'Constitutional Court of South Africa' WHEN 1 THEN 'Labour Court, Durban' WHEN 2 THEN 'Gauteng High Court, Pretoria' ELSE concat('Tribunal ', CAST(o_orderkey AS VARCHAR)) END AS court FROM orders")
def _(t):
    k = F.col("o_orderkey") % 4
    raw = F.when(k == 0, "zacc").when(k == 1, "the LABOUR COURT held at Durban").when(k == 2, "High Court").otherwise(F.concat(F.lit(" Tribunal "), "o_orderkey"))
    return t["orders"].select("o_orderkey", names.court_name(raw, F.lit("ZAGPPHC")).alias("court"))


@query("X19_judges", "SELECT o_orderkey, concat('Van der Merwe', CAST(o_orderkey % 7 AS VARCHAR), ' AJ|Smith-Jones JP') AS judges FROM orders")
def _(t):
    raw = F.array(F.concat(F.lit("VAN DER MERWE"), F.col("o_orderkey") % 7, F.lit(", AJ and SMITH-JONES JP")), F.lit("not stated"))
    return t["orders"].select("o_orderkey", F.array_join(names.judges(raw), "|").alias("judges"))


@query("X20_norm_id", "SELECT p_partkey, lower(translate(p_name, ' -', '__')) AS norm FROM part")
def _(t):
    return t["part"].select("p_partkey", text.norm_id("p_name").alias("norm"))


@query("X21_case_year", f"{JUD}, y AS (SELECT *, {CASE_YEAR} AS case_year FROM j) SELECT id, case_year, greatest(0, CAST(year(judgment_date) AS INT) - case_year) AS duration FROM y")
def _(t):
    number = F.concat(F.when(F.col("id") % 2 == 0, "CCT ").otherwise(""), "dataset_number")
    return t.judgments().select("id", dates.case_year(number).alias("case_year"), dates.duration_years(number, "judgment_date").alias("duration"))


@query("X22_X23_bool_and_time", "SELECT event_id, event_id % 2 = 0 AS flag, epoch_us(ts) AS us FROM events")
def _(t):
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.when(F.col("event_id") % 3 == 0, "Z").otherwise(""))
    return t["events"].select("event_id", text.to_bool(F.when(F.col("event_id") % 2 == 0, " Yes ").otherwise("no")).alias("flag"), F.unix_micros(dates.parse_iso(iso)).alias("us"))


@query("X24_json_first", f"{DOC} SELECT id, coalesce({DONE}, {NUMBER}) AS v FROM rec")
def _(t):
    return t.payloads().select("id", payload.json_first("data", "$.details_scraped_at", "$.dataset_number").alias("v"))


@query("X25_json_set", f"{DOC} SELECT id, CAST(id AS VARCHAR) AS v, json_extract_string(data, '$.category') AS category FROM rec")
def _(t):
    out = t.payloads().select("id", payload.json_set("data", "added", F.col("id").cast("string")).alias("d"))
    return out.select("id", F.get_json_object("d", "$.added").alias("v"), F.get_json_object("d", "$.category").alias("category"))


@query("X26_json_merge", f"{DOC} SELECT id, 'new' AS category, {NUMBER} AS number, 5 AS more FROM rec")
def _(t):
    out = t.payloads().select("id", payload.json_merge("data", F.lit('{"category":"new","more":5}')).alias("d"))
    return out.select("id", F.get_json_object("d", "$.category").alias("category"), F.get_json_object("d", "$.dataset_number").alias("number"), F.get_json_object("d", "$.more").cast("int").alias("more"))


@query("X27_json_rename", f"{DOC} SELECT id, CASE WHEN id % 6 = 0 THEN '[1]' END AS footnotes, CAST(NULL AS VARCHAR) AS citations FROM rec")
def _(t):
    out = t.payloads().select("id", payload.json_rename("data", "citations", "footnotes").alias("d"))
    return out.select("id", F.get_json_object("d", "$.footnotes").alias("footnotes"), F.get_json_object("d", "$.citations").alias("citations"))


@query("X28_tags_to_map", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def _(t):
    m = payload.tags_to_map(F.array(F.concat(F.lit("Cust Name: "), "c_name"), F.concat(F.lit("Mkt-Segment : "), "c_mktsegment"), F.lit("noise")))
    return t["customer"].select("c_custkey", m.alias("m")).select("c_custkey", F.col("m")["cust_name"].alias("c_name"), F.col("m")["mkt_segment"].alias("c_mktsegment"))


@query("X29_X36_small_columns", "SELECT p_partkey, printf('R %.2f', p_partkey / 100.0) AS price, CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS tiers, left(p_name, 5) AS head, right(p_name, 5) AS tail, regexp_replace(p_type, '[^A-Za-z0-9 .]', '', 'g') AS safe, 'A V' AS label, trim(translate(p_name, chr(10), ' ')) AS flat FROM part")
def _(t):
    tiers = F.array(F.struct(F.when(F.col("p_partkey") % 2 == 0, "1 to 10").otherwise("10+").alias("qty"), F.lit("1").alias("price")))
    return t["part"].select(
        "p_partkey", text.rand_price("p_partkey").alias("price"), F.size(text.price_tiers(tiers)).alias("tiers"), text.edge_text("p_name", 5).alias("head"), text.edge_text("p_name", 5, True).alias("tail"),
        text.safe_name("p_type").alias("safe"), text.type_label(F.lit("a_v")).alias("label"), text.flat("p_name").alias("flat"),
    )


@query("X31_abs_url", "SELECT page_id, concat(regexp_extract(url, '^[a-z]+://[^/?#]*', 0), '/x/', CAST(page_id AS VARCHAR)) AS absolute FROM pages")
def _(t):
    return t["pages"].select("page_id", urls.abs_url("url", F.concat(F.lit("/x/"), "page_id")).alias("absolute"))


@query("X35_title_parties", "SELECT c_custkey, c_name AS applicant, concat(c_mktsegment, ' and Others') AS respondent FROM customer")
def _(t):
    title = F.concat("c_name", F.lit(" v "), "c_mktsegment", F.lit(" and Others (12/20) [2020] ZACC 1"))
    return t["customer"].select("c_custkey", text.title_parties(title).alias("p")).select("c_custkey", "p.*")


# --- documents -------------------------------------------------------------

_D1 = "concat('IN THE HIGH COURT', chr(10), 'Case no: ', CAST(doc_id AS STRING), chr(10), 'JUDGMENT', chr(10), '[1] The facts of this matter are common cause between the parties, who have agreed to a statement of them, and need no proof here. ', {}, chr(10), '[2] ', {}, chr(10), 'ORDER', chr(10), 'The claim ', CAST(doc_id AS STRING), ' fails.', chr(10), 'Appearances: N. N.')"
_WORDS = "regexp_replace(coalesce(text, ''), '[^a-z]+', ' ', 'g')"


@query("D1_parse_sections", "SELECT doc_id, concat('IN THE HIGH COURT', chr(10), 'Case no: ', CAST(doc_id AS VARCHAR)) AS header, concat('ORDER', chr(10), 'The claim ', CAST(doc_id AS VARCHAR), ' fails.') AS order_text, 'Appearances: N. N.' AS appearances, 0 AS n_null FROM documents")
def _(t):
    body = "regexp_replace(coalesce(text, ''), '[^a-z]+', ' ')"
    out = documents.parse_sections(t["documents"].select("doc_id", F.expr(_D1.format(body, body)).alias("full_text")))
    return out.select("doc_id", "sections.header", F.col("sections.order").alias("order_text"), "sections.appearances", F.size("sections.null_values").alias("n_null"))


#: Judgment pages made from documents: number paragraphs, one of several rulings by id, signatures, appearances, and footnotes in containers.
_RULINGS = [
    ("In the result, the appeal is upheld.", ""), ("ORDER", "\n1. The claim is struck."), ("I would propose the following order:", "\n(a) x"), ("There is no order as to costs.", ""),
    ("(3) Die saak word van die rol geskrap.", ""), ("Accordingly, the application is dismissed with costs.", ""),
]
_MARKS = ['<div id="ftn{n}">', '<div id="fn{n}">', '<p class="MsoFootnoteText">', "<p>"]


def _judgment_sql(duck: bool) -> str:
    """id, body, ruling, notes, page: the parts of a made judgment and its page; notes begin at [k] after k - 1 paragraphs."""
    s = "VARCHAR" if duck else "STRING"
    words = _WORDS if duck else "regexp_replace(coalesce(text, ''), '[^a-z]+', ' ')"
    nl = "chr(10)"
    i = f"CAST(doc_id AS {s})"
    ruling = "CASE doc_id % 6 " + " ".join(f"WHEN {k} THEN '" + (a + b).replace("\n", f"', {nl}, '") + "'" for k, (a, b) in enumerate(_RULINGS) if "\n" not in b)
    ruling += " " + " ".join(f"WHEN {k} THEN concat('{a}', {nl}, '{b.strip()}')" for k, (a, b) in enumerate(_RULINGS) if "\n" in b) + " END"
    body = f"concat('[1] The facts of matter ', {i}, ' are common cause between all the parties, who agree on a statement of them. ', trim({words}), {nl}, '[2] ', trim({words}), ' and so on.')"
    number = "CASE WHEN doc_id % 4 = 3 THEN 1 ELSE 3 + doc_id % 5 END"
    note = f"concat('[', CAST({number} AS {s}), '] See the case of ', {i}, ' and those it names', {nl}, '[', CAST({number} + 1 AS {s}), '] Ibid at ', {i})"
    opened = "CASE doc_id % 4 " + " ".join(f"WHEN {k} THEN '" + m.replace("{n}", "7") + "'" for k, m in enumerate(_MARKS)) + " END"
    return f"""SELECT doc_id AS id, body, ruling, note, concat('<html><body><div id="center"><p>', body, '</p>', opened, '<a href="#x">[', CAST(number AS {s}), ']</a> See</div></div></body></html>') AS page
      FROM (SELECT doc_id, {body} AS body, {ruling} AS ruling, {note} AS note, {opened} AS opened, {number} AS number FROM documents) m"""


@query("D1_sections_with_notes", f"""SELECT id, md5(trim(concat(body, chr(10), 'The reasons follow.'), ' ')) AS judgment_md5, md5(ruling) AS order_md5, md5(note) AS footnotes_md5, 'Appearances: N. N.' AS appearances FROM ({_judgment_sql(True)})""")
def _(t):
    out = _judgments_cut(t)
    return out.select("id", F.md5("sections.judgment").alias("judgment_md5"), F.md5("sections.order").alias("order_md5"), F.md5("sections.footnotes").alias("footnotes_md5"), "sections.appearances")


def _judgments_cut(t):
    """Sections of the made judgments, with their pages."""
    text_ = F.concat(F.lit("IN THE COURT\nJUDGMENT\n"), "body", F.lit("\nThe reasons follow.\n"), "ruling", F.lit("\nAppearances: N. N.\n"), "note")
    rec = t.spark.sql(_judgment_sql(False).replace("FROM documents", "FROM {documents}").replace("{n}", "7"), documents=t["documents"]).withColumn("full_text", text_)
    return documents.parse_sections(rec, html_col="page")


def _index_pages(t, links: str):
    """Landed index pages made from documents: one page per document with the given links."""
    return t["documents"].select(F.concat(F.lit("https://h/za/index/"), "source", F.lit("/"), "doc_id").alias("url"), F.concat(F.lit("<html><body><p>Index</p>"), F.expr(links), F.lit("</body></html>")).alias("html"))


@query("D2_link_targets", "SELECT concat('https://h/za/index/', source, '/', CAST(doc_id AS VARCHAR)) AS url, concat('Case ', CAST(doc_id AS VARCHAR)) AS text, concat('https://h/za/cases/X/', CAST(doc_id AS VARCHAR), '.html') AS target FROM documents")
def _(t):
    links = "concat('<a href=\"/za/cases/X/', doc_id, '.html\">Case\n ', doc_id, '</a><a href=\"/za/cases/X/', doc_id, '.html\">again</a><a href=\"/za/cases/a.pdf\">pdf</a><a href=\"/about\">x</a>')"
    return documents.link_targets(_index_pages(t, links))


@query("D2_link_kinds", """SELECT concat('https://h/za/index/', source, '/', CAST(doc_id AS VARCHAR)) AS url, x.text AS text, target, kind FROM documents, (VALUES (0), (1), (2)) v(k),
LATERAL (SELECT CASE k WHEN 0 THEN concat('A v B ', CAST(doc_id AS VARCHAR)) WHEN 1 THEN concat('Act ', CAST(doc_id % 9 AS VARCHAR)) ELSE 'C v D' END AS text,
  CASE k WHEN 0 THEN concat('https://h/search?q=', CAST(doc_id AS VARCHAR)) WHEN 1 THEN concat('https://h/za/legis/act', CAST(doc_id % 9 AS VARCHAR), '/') ELSE concat('https://h/za/cases/', source, '/', CAST(doc_id AS VARCHAR), '.html') END AS target,
  CASE k WHEN 0 THEN 'citation' WHEN 1 THEN 'za/legis' ELSE 'za/cases' END AS kind) x""")
def _(t):
    links = """concat('<p><a class="x autolink_findcases" href="/search?q=', doc_id, '">A v B ', doc_id, '</a><a class="autolink_findcases" href="/y.pdf">file</a><a class="autolink_find" href="/none">none</a><a href="/za/legis/act', doc_id % 9, '/">Act ', doc_id % 9, '</a><a href="/za/cases/', source, '/', doc_id, '.html">C v D</a><a href="/za/LawCite?x">LawCite</a></p>')"""
    return documents.link_targets(_index_pages(t, links), kinds=True)


@query("D3_page_content", "SELECT page_id, 'article' AS container, regexp_extract(html, '<html lang=\"([a-z]+)\"', 1) <> '' AS has_lang FROM pages")
def _(t):
    read = documents.page_content(t["pages"]).select("url", "container", F.contains("html", F.lit("<html lang=")).alias("has_lang"))
    return t["pages"].select("page_id", "url").join(read.dropDuplicates(["url"]), "url").select("page_id", "container", "has_lang")


@query("D4_harvest_links", "SELECT concat('https://h/za/cases/', source, '/2020/', CAST(doc_id AS VARCHAR), '.html') AS href FROM documents")
def _(t):
    return documents.harvest_links(_index_pages(t, "concat('<a href=\"/za/cases/', source, '/2020/', doc_id, '.html\">t</a><a href=\"/za/cases/2020/toc.html\">toc</a><a href=\"/x/y.html\">y</a>')"))


@query("D5_discover_datasets", "SELECT DISTINCT concat('https://h/za/cases/', source, '/') AS dataset_url, source AS dataset_name FROM documents")
def _(t):
    return documents.discover_datasets(_index_pages(t, "concat('<h3><a href=\"/za/cases/', source, '/\">', source, '</a></h3><a href=\"/za/cases/other/\">o</a><a href=\"/za/\">up</a>')"), "/za/cases/")


@query("D5_discover_years", "SELECT concat('https://h/za/index/', source, '/', CAST(doc_id AS VARCHAR)) AS url, CAST(2000 + doc_id % 20 AS VARCHAR) AS year, concat('https://h/za/index/', source, '/', CAST(2000 + doc_id % 20 AS VARCHAR), '/') AS href FROM documents")
def _(t):
    return documents.discover_years(_index_pages(t, "concat('<a href=\"', 2000 + doc_id % 20, '/\">', 2000 + doc_id % 20, '/</a><a href=\"a/\">about</a>')"))


@query("D6_build_detail", f"{DOC} SELECT source_url, 'cases' AS category, concat(CAST(id AS VARCHAR), '/22') AS dataset_number, full_text IS NULL AND source_url LIKE '%.pdf' AS requires_human_review FROM rec WHERE source_url IS NOT NULL")
def _(t):
    content = t.payloads().where("source_url is not null").select(F.col("source_url").alias("url"), F.lit("t").alias("title"), F.when(F.col("full_text").isNotNull(), F.concat(F.lit("Case No: "), "id", F.lit("/22; "), F.col("full_text"))).alias("content"))
    return documents.build_detail(content).select("source_url", "category", "dataset_number", "requires_human_review")


_CITE = "concat('Smith v Jones (', CAST(o_orderkey AS STRING), '/20) [', CAST(year(o_orderdate) AS STRING), '] ZACC ', CAST(o_orderkey % 90 + 1 AS STRING), '; ', CAST(year(o_orderdate) AS STRING), ' (3) SA ', CAST(o_orderkey % 70 + 1 AS STRING), ' (CC) (3 May 2020)')"


@query("D7_parse_citations", "SELECT o_orderkey, 'Smith v Jones' AS case_name, concat(CAST(o_orderkey AS VARCHAR), '/20') AS case_number, concat('[', CAST(year(o_orderdate) AS VARCHAR), '] ZACC ', CAST(o_orderkey % 90 + 1 AS VARCHAR)) AS neutral_citation, concat(CAST(year(o_orderdate) AS VARCHAR), ' (3) SA ', CAST(o_orderkey % 70 + 1 AS VARCHAR), ' (CC)') AS report, '2020-05-03' AS decision_date FROM orders")
def _(t):
    out = documents.parse_citations(t["orders"].select("o_orderkey", F.expr(_CITE).alias("raw")), "raw")
    return out.select("o_orderkey", "citation.case_name", "citation.case_number", "citation.neutral_citation", F.array_join("citation.commercial_citations", "|").alias("report"), "citation.decision_date")


@query("D8_precedents", "SELECT o_orderkey AS id, 0 AS place, 'u1' AS url, 'Smith v Jones' AS case_name FROM orders UNION ALL SELECT o_orderkey, 1, 'u2', 'Other v Party' FROM orders")
def _(t):
    targets = F.array(F.struct(F.lit("smith v jones").alias("text"), F.lit("u1").alias("url")), F.struct(F.lit("Other v Party").alias("text"), F.lit("u2").alias("url")), F.struct(F.lit("v party").alias("text"), F.lit("u3").alias("url")))
    rows = t["orders"].select(F.col("o_orderkey").alias("id"), F.array(F.expr(_CITE)).alias("citations"), targets.alias("targets"))
    return documents.precedents(rows).select("id", "place", "url", "citation.case_name")


@query("D9_extract_journals", "SELECT doc_id AS id, source AS title, md5(trim(text, ' ' || chr(10))) AS formatted_text FROM documents WHERE text IS NOT NULL AND length(trim(text, ' ' || chr(10))) > 0")
def _(t):
    done, _ = documents.extract_journals(t["documents"].select(F.col("doc_id").alias("id"), F.col("source").alias("title"), F.col("text").alias("full_text")))
    return done.select("id", "title", F.md5("formatted_text").alias("formatted_text"))


_JOURNAL_TEXT = "concat(coalesce(text, ''), chr(10), chr(10), 'THE HEADING ', CAST(doc_id AS {s}), chr(10), ' first  line [', CAST(doc_id % 1500 AS {s}), ']', chr(10), 'and more', chr(10), chr(10), 'last')"


@query("D10_format_journal", f"""WITH l AS (SELECT doc_id, i, trim(regexp_replace(line, '[\\s\\x0B\\x1C-\\x1F\\x85\\xA0]+', ' ', 'g')) AS line FROM (SELECT doc_id, unnest(x) AS line, unnest(range(len(x))) AS i FROM (SELECT doc_id, string_split({_JOURNAL_TEXT.format(s="VARCHAR")}, chr(10)) AS x FROM documents))),
k AS (SELECT *, upper(line) = line AND regexp_matches(line, '\\p{{L}}') AND length(line) < 120 AS heading FROM l),
g AS (SELECT *, sum(CASE WHEN heading OR line = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS paragraph FROM k),
p AS (SELECT doc_id, min(i) AS i, regexp_replace(string_agg(line, ' ' ORDER BY i), '\\[(\\d{{1,3}})\\]', '[^\\1]', 'g') AS said FROM g WHERE NOT heading AND line <> '' GROUP BY doc_id, paragraph
  UNION ALL SELECT doc_id, i, concat('## ', line) FROM g WHERE heading)
SELECT doc_id, md5(string_agg(said, chr(10) || chr(10) ORDER BY i)) AS formatted_md5 FROM p GROUP BY doc_id""")
def _(t):
    texts = t["documents"].select("doc_id", F.expr(_JOURNAL_TEXT.format(s="STRING")).alias("formatted_text"))
    return documents.format_journal(texts).select("doc_id", F.md5("formatted_text").alias("formatted_md5"))


@query("D11_court_roll_rows", "SELECT o_custkey AS id, CAST(o_orderkey AS INT) AS sequence, concat('A v ', o_orderpriority) AS parties, concat(CAST(o_orderkey AS VARCHAR), '/20') AS case_number FROM orders")
def _(t):
    line = F.concat(F.col("o_orderkey").cast("string"), F.lit(". A v "), "o_orderpriority", F.lit(" "), F.col("o_orderkey").cast("string"), F.lit("/20 settled"))
    return documents.court_roll_rows(t["orders"].select(F.col("o_custkey").alias("id"), F.concat(F.lit("ROLL\n"), line).alias("full_text"))).select("id", "sequence", "parties", "case_number")


def _sections(t):
    body = "regexp_replace(coalesce(text, ''), '[^a-z]+', ' ')"
    return documents.parse_sections(t["documents"].select(F.col("doc_id").alias("id"), F.expr(_D1.format(body, body)).alias("full_text")))


@query("D12_extraction_contexts", f"""WITH p AS (SELECT id, trim(concat(body, chr(10), 'The reasons follow.'), ' ') AS judgment, ruling, note FROM ({_judgment_sql(True)}))
SELECT id, 'header' AS pass, md5(concat('IN THE COURT', chr(10), chr(10), trim(left(judgment, 3000), ' ' || chr(10)), chr(10), chr(10), 'Appearances: N. N.')) AS context_md5 FROM p
UNION ALL SELECT id, 'precedents', md5(note) FROM p UNION ALL SELECT id, 'body', md5(concat(judgment, chr(10), chr(10), ruling)) FROM p""")
def _(t):
    out = documents.extraction_contexts(_judgments_cut(t))
    # the cut of a long judgment may end in white space
    tidy = F.regexp_replace("context", r"\s+\n\nAppearances", "\n\nAppearances")
    return out.select("id", "pass", F.md5(F.when(F.col("pass") == "header", tidy).otherwise(F.col("context"))).alias("context_md5"))


def _first_words(frames):
    for pdf in frames:
        yield pdf.assign(summary=pdf["context"].str.split().str[:3].str.join(" "))[["id", "pass", "summary"]]


@query("D13_apply_extractor", "SELECT doc_id AS id, 'header' AS pass, 'IN THE HIGH' AS summary FROM documents")
def _(t):
    return documents.apply_extractor(documents.extraction_contexts(_sections(t)).where("pass = 'header'"), _first_words, "id long, pass string, summary string")


@query("D14_header_fallback", "SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'Given' ELSE 'Constitutional Court of South Africa' END AS court, c_name AS applicant, false AS requires_human_review FROM customer")
def _(t):
    c = t["customer"]
    res = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.lit("Given").alias("court"), F.lit("").alias("applicant"), F.lit(None).cast("string").alias("respondent"), F.lit("").alias("judgment_date"))
    rec = c.select(F.col("c_custkey").alias("id"), F.concat("c_name", F.lit(" v State [2020] ZACC 1 (3 May 2020)")).alias("title"), F.lit("ZACC").alias("target_name"))
    return documents.header_fallback(res, rec).select("id", "court", "applicant", "requires_human_review")


def _passes(t):
    c = t["customer"]
    header = c.select(F.col("c_custkey").alias("id"), F.lit("zacc").alias("court"), F.array(F.lit("SMITH J")).alias("judges"), F.lit("3 May 2020").alias("judgment_date"))
    body = c.where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("id"), F.lit("Granted").alias("outcome"), F.lit("id 8001015009087").alias("summary"))
    rec = c.select(F.col("c_custkey").alias("id"), F.lit("E").alias("entity_name"), F.lit("ZACC").alias("target_name"), F.lit("2020-05-03").cast("date").alias("document_date"), F.lit("cases").alias("record_type"), F.lit("A v B (CCT 1/20) [2020] ZACC 1").alias("title"), F.lit("").alias("header"))
    return rec, header, body


@query("D15_merge_passes", "SELECT c_custkey AS id, 'Constitutional Court of South Africa' AS court, 'Smith J' AS judge, '2020-05-03' AS judgment_date, CASE WHEN c_custkey % 3 = 0 THEN 'Granted' ELSE 'Unknown' END AS outcome FROM customer")
def _(t):
    _, header, body = _passes(t)
    return documents.merge_passes(header, body).select("id", "court", F.col("judges")[0].alias("judge"), "judgment_date", "outcome")


@query("D16_D17_extract_and_scrub", "SELECT c_custkey AS id, 'CCT 1/20' AS case_number, CASE WHEN c_custkey % 3 = 0 THEN 'id [RSA ID]' ELSE '' END AS summary FROM customer")
def _(t):
    done, _ = documents.extract_and_scrub(*_passes(t))
    return done.select("id", "metadata.case_number", "extracted_data.summary")


def _json_passes(frames):
    """The extractor of the D17 queries: no result for every 7th id, a wrong date for every 11th."""
    import hashlib
    import json

    import pandas as pd

    for pdf in frames:
        rows = []
        for i, name, context in zip(pdf["id"], pdf["pass"], pdf["context"], strict=True):
            if i % 7 and name == "header":
                rows.append((i, name, json.dumps({"court": "", "judges": ["SMITH J"], "judgment_date": "soon" if i % 11 == 0 else "3 May 2020"})))
            elif i % 7 and name == "body":
                rows.append((i, name, json.dumps({"outcome": "Granted", "summary": f"id 8001015009087 {hashlib.md5(context.encode()).hexdigest()}"})))
        yield pd.DataFrame(rows, columns=["id", "pass", "result"])


def _records(docs):
    """Documents as records; every 5th is only indexed, every 13th under review."""
    i = F.col("doc_id")
    title = F.concat(F.lit("A v B (CCT "), i.cast("string"), F.lit("/20) [2020] ZACC 1 (3 May 2020)"))
    return docs.select(
        i.alias("id"), title.alias("title"), F.to_json(F.struct(F.col("text").alias("full_text"))).alias("data"), F.when(i % 5 == 0, "indexed").otherwise("detailed").alias("status"),
        F.lit("cases").alias("record_type"), F.lit("2020-05-03").cast("date").alias("document_date"), (i % 25).alias("target_id"), (i % 13 == 0).alias("requires_human_review"),
    )


def _extraction(t):
    """Sections of even documents, an empty scrubbed table's schema, and dimensions."""
    even = t["documents"].where("doc_id % 2 = 0")
    parsed = even.select(F.col("doc_id").alias("extracted_record_id"), F.to_json(F.struct(F.col("text").alias("judgment"), F.lit("It is so ordered.").alias("order"))).alias("data"))
    dims = t["nation"].select(F.col("n_nationkey").alias("id"), F.lit("ZACC").alias("target_name"), F.col("n_regionkey").alias("entity_id"))
    return parsed, dims, t["region"].select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))


_CHILD_TYPE = "extracted_record_id long, data string, created_at timestamp, updated_at timestamp"
_PENDING = "doc_id % 5 <> 0 AND doc_id % 13 <> 0"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_EXTRACTED = f"""SELECT doc_id AS id, concat('CCT ', CAST(doc_id AS VARCHAR), '/20') AS case_number, r_name AS entity_name, 'Constitutional Court of South Africa' AS court,
CASE WHEN doc_id % 11 <> 0 THEN '2020-05-03' END AS judgment_date, concat('id [RSA ID] ', md5(CASE WHEN doc_id % 2 = 0 THEN concat_ws(chr(10) || chr(10), nullif(trim(text, {_BLANKS}), ''), 'It is so ordered.') ELSE coalesce(text, '') END)) AS summary
FROM documents JOIN nation ON n_nationkey = doc_id % 25 JOIN region ON r_regionkey = n_regionkey WHERE {_PENDING} AND doc_id % 7 <> 0"""


def _payloads_of(child):
    p = lambda c: F.get_json_object("data", f"$.{c}")
    return child.select(F.col("extracted_record_id").alias("id"), p("metadata.case_number").alias("case_number"), p("metadata.entity_name").alias("entity_name"), *[p(f"extracted_data.{c}").alias(c) for c in ("court", "judgment_date", "summary")])


@query("D17_extract_pending", f"SELECT * FROM ({_EXTRACTED}) WHERE id % 3 <> 0")
def _(t):
    had = t["documents"].where("doc_id % 3 = 0").select(F.col("doc_id").alias("extracted_record_id"), F.lit("{}").alias("data"), _now().alias("created_at"), _now().alias("updated_at"))
    child, _ = documents.extract_pending(_records(t["documents"]), _extraction(t)[0], had, *_extraction(t)[1:], _json_passes, _now())
    return _payloads_of(child.where("data <> '{}'"))


@query("D17_Q5_extraction_rejects", f"SELECT doc_id AS id, 'no result' AS reason FROM documents WHERE {_PENDING} AND doc_id % 7 = 0")
def _(t):
    none = t.spark.createDataFrame([], _CHILD_TYPE)
    parsed, dims, ents = _extraction(t)
    return documents.extract_pending(_records(t["documents"]), parsed, none, dims, ents, _json_passes, _now())[1]


_TIER = "array<struct<qty:string,price:string>>"


def _catalogs(t):
    m = t.sql(MASTER).withColumn("pricing", F.array(F.struct(F.lit("1").alias("qty"), F.col("price").alias("price")))).drop("price")
    o = t.sql(OTHER).withColumn("pricing", F.array(F.struct(F.lit("1").alias("qty"), F.col("price").alias("price")))).drop("price")
    return catalogs.combine_catalogs(m, o)


_FIRST_MASTER = "fm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY stock_code ORDER BY place) AS k FROM m WHERE stock_code <> '' AND stock_code NOT LIKE '%-MANTECH-EC') WHERE k = 1)"


@query("D18_combine_catalogs", f"{CAT}, {_LAST_OTHER}, {_FIRST_MASTER} SELECT fm.place, fm.stock_code, lo.image_url AS image_url2, CASE WHEN lo.compare_at_price IS NULL THEN 2 ELSE 3 END AS n_tiers FROM fm JOIN lo ON lo.part_number = fm.stock_code")
def _(t):
    return _catalogs(t)[0].select("place", "stock_code", "image_url2", F.size("pricing").alias("n_tiers"))


@query("K7_catalog_remainder", f"{CAT}, {_LAST_OTHER}, {_FIRST_MASTER} SELECT fm.place FROM fm LEFT JOIN lo ON lo.part_number = fm.stock_code WHERE lo.place IS NULL")
def _(t):
    return _catalogs(t)[1].select("place")


@query("D19_normalise_products", "SELECT p_partkey, concat('https://shop/p/', CAST(p_partkey AS VARCHAR)) AS source_url, printf('R %.2f', p_size / 100.0) AS price FROM part")
def _(t):
    raw = t["part"].select(F.concat(F.lit("/p/"), "p_partkey").alias("url"), F.col("p_name").alias("title"), F.col("p_partkey").alias("part_number"), F.col("p_brand").alias("vendor"), F.lit("/i").alias("image"), F.col("p_size").alias("price"), F.lit(None).cast("int").alias("compare_at_price"))
    return catalogs.normalise_products(raw, "https://shop/").select(F.col("part_number").alias("p_partkey"), "source_url", F.col("pricing")[0]["price"].alias("price"))


@query("D20_flatten_judgments", f"{JUD} SELECT id, court, outcome, year(judgment_date) AS y FROM j")
def _(t):
    raw = t.judgments().select("id", "court", F.col("division").alias("division_location"), "judge", F.col("judgment_date").cast("string"), "reportable", F.struct(F.lit("a").alias("applicant_plaintiff"), F.lit("b").alias("respondent_defendant")).alias("parties"), F.struct("outcome").alias("r"), "subjects", F.col("id").cast("string").alias("dataset_number"))
    raw = raw.withColumn("result", F.struct(F.col("r.outcome").alias("outcome_type"), F.lit("").alias("costs_order")))
    return catalogs.flatten_judgments(raw).select(F.col("dataset_number").cast("long").alias("id"), "court", "outcome", F.year("judgment_date").alias("y"))


# --- merges, repairs, sync ---------------------------------------------------


@query("M1_upsert_targets", f"WITH tgt AS ({TARGETS}) SELECT entity_name, target_name, CASE WHEN target_name = 'NATION_1' THEN 'Pretoria' ELSE location END AS location FROM tgt UNION ALL SELECT 'X', 'NEW', 'Cape'")
def _(t):
    new = t["nation"].where("n_nationkey = 1").join(t["region"], F.expr("n_regionkey = r_regionkey")).select(F.lit(1).alias("place"), F.col("r_name").alias("entity_name"), F.col("n_name").alias("target_name"), F.lit("Pretoria").alias("location"), F.lit(None).cast("string").alias("target_type"))
    new = new.unionByName(t.spark.createDataFrame([(2, "X", "NEW", "Cape", "court")], "place int, entity_name string, target_name string, location string, target_type string"))
    return merge.upsert_targets(t.targets(), new).select("entity_name", "target_name", "location")


def _now():
    return F.lit(NOW).cast("timestamp")


@query("M2_upsert_records", f"""{DOC}, old AS (SELECT * FROM rec WHERE id % 2 = 0 AND source_url IS NOT NULL), b AS (SELECT * FROM rec WHERE id % 3 = 0 AND source_url IS NOT NULL)
SELECT coalesce(o.source_url, b.source_url) AS source_url, coalesce(b.status, o.status) AS status, CASE WHEN b.status = 'detailed' THEN {NOW_S} END AS detailed_s, o.id IS NULL AS is_new FROM old o FULL OUTER JOIN b ON o.source_url = b.source_url""")
def _(t):
    rec = t.payloads().where("source_url is not null").withColumns({"target_id": F.col("target_name"), "document_date": F.lit(None).cast("date"), "detailed_at": F.lit(None).cast("timestamp"), "place": F.col("id")})
    old = rec.where("id % 2 = 0").withColumn("id", F.concat(F.lit("old"), "id"))
    out = merge.upsert_records(old, rec.where("id % 3 = 0"), _now())
    return out.select("source_url", "status", F.unix_seconds("detailed_at").alias("detailed_s"), (~F.col("id").startswith("old")).alias("is_new"))


@query("M3_update_data", f"{DOC} SELECT id, CASE WHEN id % 3 = 0 THEN 'x' ELSE data END AS data, CASE WHEN id % 6 = 0 THEN 'detailed' ELSE status END AS status FROM rec")
def _(t):
    rec = t.payloads().withColumn("updated_at", F.lit(None).cast("timestamp"))
    changes = rec.where("id % 3 = 0").select("id", F.lit("x").alias("data"), F.when(F.col("id") % 6 == 0, "detailed").alias("status"))
    return merge.update_data(rec, changes, _now()).select("id", "data", "status")


@query("M4_upsert_child", f"SELECT doc_id AS extracted_record_id, doc_id % 5 = 0 AS changed, CASE WHEN doc_id % 4 <> 0 THEN 1000 ELSE {NOW_S} END AS created_s FROM documents WHERE doc_id % 4 <> 0 OR doc_id % 5 = 0")
def _(t):
    old = t.child("parsed").withColumns({"created_at": F.timestamp_seconds(F.lit(1000)), "updated_at": F.timestamp_seconds(F.lit(1000))})
    out = merge.upsert_child(old, t.child("scrubbed"), _now())
    return out.select("extracted_record_id", (F.col("updated_at") == _now()).alias("changed"), F.unix_seconds("created_at").alias("created_s"))


@query("M5_merge_detail", f"{DOC} SELECT id, CASE WHEN id % 3 = 0 THEN 'detailed' ELSE status END AS status, CASE WHEN id % 3 = 0 THEN 'm' END AS more, json_extract_string(data, '$.category') AS category FROM rec")
def _(t):
    rec = t.payloads().withColumn("detailed_at", F.lit(None).cast("timestamp"))
    out = merge.merge_detail(rec, rec.where("id % 3 = 0").select("id", F.lit('{"more":"m"}').alias("data")), _now())
    return out.select("id", "status", F.get_json_object("data", "$.more").alias("more"), F.get_json_object("data", "$.category").alias("category"))


@query("M6_sync_state", "SELECT n_name AS name, 2023 AS last_year, CASE WHEN n_nationkey % 2 = 0 THEN 7 END AS last_month FROM nation")
def _(t):
    n = t["nation"]
    out = merge.sync_state(n.select(F.col("n_name").alias("name"), F.lit('{"last_year":2020}').alias("state")), n.select(F.col("n_name").alias("name"), F.lit('{"last_year":2023}').alias("state")), n.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("name"), F.lit('{"last_month":7}').alias("state")))
    return out.select("name", F.get_json_object("state", "$.last_year").cast("int").alias("last_year"), F.get_json_object("state", "$.last_month").cast("int").alias("last_month"))


@query("M7_reset_cases", f"{DOC} SELECT id, CASE WHEN id % 10 = 0 THEN false ELSE requires_human_review END AS requires_human_review, CASE WHEN id % 10 <> 0 THEN review_reason END AS review_reason FROM rec")
def _(t):
    rec = t.payloads()
    records, _ = merge.reset_cases(rec, t.child("parsed"), rec.where("id % 10 = 0"), _now())
    return records.select("id", "requires_human_review", "review_reason")


@query("M7_reset_children", "SELECT doc_id AS extracted_record_id FROM documents WHERE doc_id % 4 <> 0 AND doc_id % 10 <> 0")
def _(t):
    rec = t.payloads()
    return merge.reset_cases(rec, t.child("parsed"), rec.where("id % 10 = 0"), _now())[1].select("extracted_record_id")


_RETRIED = "SELECT doc_id AS id, doc_id % 3 <> 0 AS flagged, doc_id % 3 = 1 AS retried, doc_id % 3 = 1 AND doc_id % 2 = 0 AS recovered, doc_id % 5 <> 0 AS has_child FROM documents"


def _retry(t):
    """Two of three records are flagged, one of them for its parse; even ones have an order in their text."""
    head = "concat('JUDGMENT', chr(10), 'The facts are common cause. ', regexp_replace(coalesce(text, ''), '[^a-z]+', ' '), chr(10)"
    body = F.expr(f"CASE WHEN doc_id % 2 = 0 THEN {head}, 'ORDER', chr(10), 'The claim ', CAST(doc_id AS STRING), ' fails.') ELSE 'zzz' END")
    rec = t["documents"].select(
        F.col("doc_id").alias("id"), F.lit("court").alias("record_type"), (F.col("doc_id") % 3 != 0).alias("requires_human_review"),
        F.when(F.col("doc_id") % 3 == 1, filters.PARSING_FAILED).when(F.col("doc_id") % 3 == 2, "Empty PDF text").alias("review_reason"), F.lit(None).cast("timestamp").alias("updated_at"), body.alias("full_text"),
    )
    parsed = t["documents"].where("doc_id % 5 <> 0").select(F.col("doc_id").alias("extracted_record_id"), F.lit("old").alias("data"), F.lit(None).cast("timestamp").alias("updated_at"))
    sections = documents.parse_sections(filters.failed_parses(rec))
    return sections, merge.reprocess_failed(rec, parsed, sections, _now())


@query("M8_reprocess_records", f"SELECT id, flagged AND NOT recovered AS requires_human_review, CASE WHEN retried AND NOT recovered THEN '{filters.PARSING_FAILED}' WHEN flagged AND NOT retried THEN 'Empty PDF text' END AS review_reason, recovered AS touched FROM ({_RETRIED})")
def _(t):
    return _retry(t)[1][0].select("id", "requires_human_review", "review_reason", F.col("updated_at").isNotNull().alias("touched"))


@query("M8_reprocess_children", f"SELECT id AS extracted_record_id, CASE WHEN recovered THEN concat('ORDER', chr(10), 'The claim ', CAST(id AS VARCHAR), ' fails.') ELSE 'old' END AS value FROM ({_RETRIED}) WHERE has_child")
def _(t):
    child = _retry(t)[1][1]
    return child.select("extracted_record_id", F.coalesce(F.get_json_object("data", "$.order"), "data").alias("value"))


@query("M8_A19_reprocess", f"SELECT count(*) AS reprocessed, count(*) FILTER (recovered) AS recovered, coalesce(avg(CAST(recovered AS DOUBLE)), 0) AS rate FROM ({_RETRIED}) WHERE retried")
def _(t):
    return agg.recovery_report(merge.recovered(_retry(t)[0]))


@query("A22_section_nulls", "SELECT 'order' AS section, count(*) AS n, min(doc_id) AS first_id FROM documents WHERE doc_id % 2 = 0 UNION ALL SELECT 'header', count(*), min(doc_id) FROM documents WHERE doc_id % 4 = 0")
def _(t):
    null = F.concat(F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("order"))).otherwise(F.array().cast("array<string>")), F.when(F.col("doc_id") % 4 == 0, F.array(F.lit("header"))).otherwise(F.array().cast("array<string>")))
    return agg.section_nulls(t["documents"].select(F.col("doc_id").alias("id"), null.alias("null_values")))


def _numbers(t):
    n, k = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 4
    right = F.concat(n, F.lit("/20"))
    old = F.when(k == 0, None).when(k == 1, "[2020] ZACC 1").when(k == 2, "9/99").otherwise(right)
    title = F.concat(F.lit("A v B ("), right, F.lit(") [2020] ZACC 1"))
    return merge.fix_case_numbers(t["orders"].select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("target_name"), title.alias("title"), F.lit("").alias("header"), old.alias("extracted_number"), right.alias("record_number")))


_FIXES = "SELECT o_orderkey AS id, o_orderpriority AS target_name, CASE o_orderkey % 4 WHEN 1 THEN '[2020] ZACC 1' WHEN 2 THEN '9/99' END AS before, concat(CAST(o_orderkey AS VARCHAR), '/20') AS after, CASE o_orderkey % 4 WHEN 0 THEN 'missing_populated' WHEN 1 THEN 'neutral_replaced' ELSE 'case_number_corrected' END AS fix_type FROM orders WHERE o_orderkey % 4 <> 3"


@query("M9_fix_case_numbers", _FIXES)
def _(t):
    return _numbers(t).select("id", "target_name", "before", "after", "fix_type")


@query("A17_repair_report", f"SELECT target_name, fix_type, count(*) AS n FROM ({_FIXES}) GROUP BY 1, 2")
def _(t):
    return agg.repair_report(_numbers(t))


@query("T3_T4_preview", f"SELECT id, target_name, before, after FROM ({_FIXES}) JOIN (SELECT o_orderkey, o_orderdate FROM orders) ON o_orderkey = id ORDER BY target_name, o_orderdate, id LIMIT 10")
def _(t):
    made = t["orders"].select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("created_at"))
    return merge.preview(merge.repair_order(_numbers(t).join(made, "id")), 10).select("id", "target_name", "before", "after")


@query("M10_fix_dates", """SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS document_date, CASE WHEN o_orderkey % 3 = 2 THEN make_date(2001, 1, 1) ELSE CAST(o_orderdate AS DATE) END AS hearing_date, make_date(1999, 1, 1) AS old_judgment_date
FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0""")
def _(t):
    """Hearing dates that are the sentinel, the old judgment date or another; every 5th title without a date, every 7th row right already."""
    k, day = F.col("o_orderkey"), F.to_date("o_orderdate")
    right, d = k % 7 == 0, lambda x: F.to_date(F.lit(x))
    rows = t["orders"].select(
        k.alias("id"), F.lit("t").alias("target_name"), F.concat(F.lit("A v B"), F.when(k % 5 != 0, F.concat(F.lit(" ("), F.date_format("o_orderdate", "d MMMM yyyy"), F.lit(")"))).otherwise("")).alias("title"),
        F.when(right, day).otherwise(d("1990-01-01")).alias("document_date"), F.when(right, day).otherwise(d("1999-01-01")).alias("judgment_date"),
        F.when(right, day).when(k % 3 == 0, d("1900-01-01")).when(k % 3 == 1, d("1999-01-01")).otherwise(d("2001-01-01")).alias("hearing_date"),
    )
    return merge.fix_dates(rows, "1900-01-01").select("id", "document_date", "hearing_date", "old_judgment_date")


@query("M11_fix_courts", "SELECT o_orderkey AS id, 'Constitutional Court of South Africa' AS court, 'Smith J' AS judge FROM orders WHERE o_orderkey % 2 = 0")
def _(t):
    even = F.col("o_orderkey") % 2 == 0
    rows = t["orders"].select(F.col("o_orderkey").alias("id"), F.lit("ZACC").alias("target_name"), F.when(even, "Constitutional Court").otherwise("Constitutional Court of South Africa").alias("court"), F.array(F.lit("Smith J")).alias("judges"))
    return merge.fix_courts(rows).select("id", "court", F.col("judges")[0].alias("judge"))


@query("M12_fix_journals", "SELECT doc_id AS id FROM documents WHERE doc_id % 3 = 0 AND text IS NOT NULL AND trim(text, ' ' || chr(10)) <> ''")
def _(t):
    noisy = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("PDF format\n"), text.clean_text("text"))).otherwise(text.clean_text("text"))
    return merge.fix_journals(t["documents"].where(F.col("text").isNotNull() & (text.strip("text") != "")).select(F.col("doc_id").alias("id"), noisy.alias("formatted_text"))).select("id")


@query("M13_migrate_footnotes", f"{DOC} SELECT id, '[1]' AS footnotes FROM rec WHERE id % 6 = 0")
def _(t):
    return merge.migrate_footnotes(t.payloads()).select("id", F.get_json_object("data", "$.footnotes").alias("footnotes"))


@query("M14_migrate_precedents", "SELECT o_orderkey AS id, concat(CAST(o_orderkey AS VARCHAR), '/20') AS case_number, 'Followed' AS treatment FROM orders")
def _(t):
    rows = t["orders"].select(F.col("o_orderkey").alias("id"), F.array(F.create_map(F.lit("citation"), F.expr(_CITE), F.lit("treatment"), F.lit("Followed"))).alias("precedents"))
    return merge.migrate_precedents(rows).select("id", F.col("precedents")[0]["citation"]["case_number"].alias("case_number"), F.col("precedents")[0]["treatment"].alias("treatment"))


@query("M15_fix_pdf_titles", f"{DOC} SELECT id, 'Right (3 May 2020)' AS after, make_date(2020, 5, 3) AS document_date FROM rec WHERE source_url LIKE '%.pdf' AND id % 8 = 0")
def _(t):
    rec = filters.pdf_cases(t.payloads()).select("id", "source_url", F.lit("Wrong").alias("title"), F.lit(None).cast("date").alias("document_date"))
    pages = rec.where("id % 8 = 0").select(F.regexp_replace("source_url", "pdf$", "html").alias("url"), F.lit("Right (3 May 2020)").alias("title"))
    return merge.fix_pdf_titles(rec, pages).select("id", "after", "document_date")


_TO_MASTER = f"""{_STORES}, x AS (SELECT s.id AS sid, m.id AS mid, CASE WHEN m.id IS NULL THEN 'inserted' WHEN s.id IS NOT NULL AND ((m.status <> 'detailed' AND s.status = 'detailed') OR (m.detailed_at IS NULL AND s.detailed_at IS NOT NULL)) THEN 'updated' ELSE 'kept' END AS action, s.status AS ss, m.status AS ms
FROM (SELECT * FROM s WHERE source_url IS NOT NULL) s FULL OUTER JOIN (SELECT * FROM m WHERE source_url IS NOT NULL) m ON s.source_url = m.source_url UNION ALL SELECT NULL, id, 'kept', NULL, status FROM m WHERE source_url IS NULL)"""


@query("M16_sync_to_master", f"{_TO_MASTER} SELECT coalesce(mid, sid) AS id, action, CASE WHEN action = 'kept' THEN ms ELSE ss END AS status FROM x")
def _(t):
    return merge.sync_to_master(t.sql(SECONDARY), t.sql(STORE_MASTER)).select("id", "action", "status")


@query("A21_sync_report", f"{_TO_MASTER} SELECT action, count(*) AS n FROM x GROUP BY 1")
def _(t):
    return agg.sync_report(merge.sync_to_master(t.sql(SECONDARY), t.sql(STORE_MASTER)))


@query("M17_sync_to_secondary", f"""{_STORES}, x AS (SELECT m.id AS mid, s.id AS sid, CASE WHEN s.id IS NULL THEN 'inserted' WHEN m.id IS NOT NULL AND (s.status <> m.status OR (m.detailed_at IS NOT NULL AND s.detailed_at IS NULL) OR (m.parsed_at IS NOT NULL AND s.parsed_at IS NULL)) THEN 'updated' ELSE 'kept' END AS action, s.data AS sd
FROM (SELECT * FROM m WHERE source_url IS NOT NULL) m FULL OUTER JOIN (SELECT * FROM s WHERE source_url IS NOT NULL) s ON s.source_url = m.source_url UNION ALL SELECT NULL, id, 'kept', data FROM s WHERE source_url IS NULL)
SELECT coalesce(sid, mid) AS id, action, coalesce(sd, '{{}}') AS data FROM x""".replace("'{{}}'", "'{}'"))
def _(t):
    return merge.sync_to_secondary(t.sql(STORE_MASTER), t.sql(SECONDARY)).select("id", "action", "data")


@query("M18_sync_both", f"""{_STORES}, b AS (SELECT s, m, m.id IS NOT NULL AND coalesce((m.status <> 'detailed' AND s.status = 'detailed') OR (m.detailed_at IS NULL AND s.detailed_at IS NOT NULL), false) AS taken
  FROM (SELECT * FROM s WHERE source_url IS NOT NULL) s FULL OUTER JOIN (SELECT * FROM m WHERE source_url IS NOT NULL) m ON s.source_url = m.source_url),
n AS (SELECT s, coalesce(m.id, s.id) AS id, CASE WHEN m.id IS NULL OR taken THEN s.status ELSE m.status END AS status,
  CASE WHEN m.id IS NULL OR taken THEN coalesce(s.detailed_at, m.detailed_at) ELSE m.detailed_at END AS detailed_at, CASE WHEN m.id IS NULL OR taken THEN coalesce(s.parsed_at, m.parsed_at) ELSE m.parsed_at END AS parsed_at FROM b),
x AS (SELECT *, CASE WHEN s.id IS NULL THEN 'inserted' WHEN s.status <> status OR (detailed_at IS NOT NULL AND s.detailed_at IS NULL) OR (parsed_at IS NOT NULL AND s.parsed_at IS NULL) THEN 'updated' ELSE 'kept' END AS action FROM n)
SELECT id, action, CASE WHEN action = 'kept' THEN s.status ELSE status END AS status, CASE WHEN action = 'kept' THEN s.detailed_at ELSE coalesce(detailed_at, s.detailed_at) END AS detailed_at,
  CASE WHEN action = 'kept' THEN s.parsed_at ELSE coalesce(parsed_at, s.parsed_at) END AS parsed_at, coalesce(s.data, '{{}}') AS data FROM x
UNION ALL SELECT id, 'kept', status, detailed_at, parsed_at, data FROM s WHERE source_url IS NULL""")
def _(t):
    return merge.sync(t.sql(SECONDARY), t.sql(STORE_MASTER))[1].select("id", "action", "status", "detailed_at", "parsed_at", "data")


@query("M20_backfill_dims", "SELECT DISTINCT lang AS name FROM documents UNION SELECT 'default' UNION SELECT r_name FROM region")
def _(t):
    cfg = t["documents"].select(F.when(F.col("doc_id") % 10 == 0, " ").otherwise(F.col("lang")).alias("kind"))
    return merge.backfill_dims(cfg, t["region"].select(F.col("r_name").alias("name")), "kind", "default")


# --- quality ---------------------------------------------------------------


@query("Q1_validate", f"{DOC} SELECT id, {NUMBER} IS NOT NULL AS valid FROM rec")
def _(t):
    from pyspark.sql import types as T

    good, bad = quality.validate(t.payloads().withColumnRenamed("data", "payload"), T.StructType.fromDDL("category string, dataset_number string"), ["category", "dataset_number"], ["details_scraped_at"])
    return good.select("id", F.lit(True).alias("valid")).unionAll(bad.select("id", F.lit(False)))


@query("Q2_D13_generic_schema", f"{DOC} SELECT id, {NUMBER} AS dataset_number FROM rec")
def _(t):
    from pyspark.sql import types as T

    whole = T.StructType.fromDDL("metadata struct<a:string>, category string, dataset_number string")
    return t.payloads().select("id", F.from_json("data", quality.extractor_schema(whole)).alias("p")).select("id", "p.dataset_number")


@query("P4_sql_functions", f"SELECT doc_id, md5({_SCRUB_SQL.format('text')}) AS scrubbed, lower(translate(source, ' -', '__')) AS source FROM documents")
def _(t):
    documents.register_sql(t.spark)
    return t["documents"].select("doc_id", F.expr("md5(scrub_text(text))").alias("scrubbed"), F.expr("norm_id(source)").alias("source"))


@query("Q3_validate_config", "SELECT n_nationkey, n_nationkey % 2 = 0 AS cron_ok FROM nation")
def _(t):
    return quality.validate_config(t["nation"].select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, "*/5 0 * * 1-5").otherwise("daily").alias("cron"))).select("n_nationkey", "cron_ok")


@query("Q4_flag_review", f"{DOC} SELECT id, CASE WHEN id % 3 = 0 THEN true ELSE requires_human_review END AS requires_human_review, CASE WHEN id % 3 = 0 THEN 'why' ELSE review_reason END AS review_reason FROM rec")
def _(t):
    rec = t.payloads()
    return quality.flag_review(rec, rec.where("id % 3 = 0").select("id", F.lit("why").alias("reason")), _now()).select("id", "requires_human_review", "review_reason")


@query("Q5_rejects", "SELECT doc_id AS id, 'failed' AS reason FROM documents WHERE doc_id % 4 = 0")
def _(t):
    return quality.rejects(t["documents"].select(F.col("doc_id").alias("id")), t.child("parsed").select(F.col("extracted_record_id").alias("id")), "failed")


@query("Q6_check_keys", "SELECT 'documents' AS table_name, 0::BIGINT AS n_duplicates UNION ALL SELECT 'texts', count(*) FROM (SELECT text FROM documents WHERE text IS NOT NULL GROUP BY 1 HAVING count(*) > 1)")
def _(t):
    return quality.check_keys({"documents": (t["documents"], ["doc_id"]), "texts": (t["documents"], ["text"])})


@query("Q7_check_refs", "SELECT 'order-customer' AS link, count(*) AS n_missing FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) UNION ALL SELECT 'line-order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)")
def _(t):
    return quality.check_refs({"order-customer": (t["orders"], "o_custkey", t["customer"], "c_custkey"), "line-order": (t["lineitem"], "l_orderkey", t["orders"], "o_orderkey")})


@query("Q8_validate_enquiries", "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'name is required' WHEN 1 THEN 'email is invalid' WHEN 2 THEN 'message is required' END AS problem FROM customer")
def _(t):
    k = F.col("c_custkey") % 4
    rows = t["customer"].select("c_custkey", F.when(k == 0, " ").otherwise(F.col("c_name")).alias("name"), F.when(k == 1, "x").otherwise("a@b.co").alias("email"), F.when(k == 2, None).otherwise("hello").alias("message"))
    return quality.validate_enquiries(rows).select("c_custkey", "problem")


# --- streaming -------------------------------------------------------------

_MARK = "(SELECT epoch_us(max(ts)) - 600000000 FROM events)"


@query("ST1_stream_ingest", "SELECT DISTINCT url AS source_url, 'indexed' AS status FROM pages WHERE url <> ''")
def _(t):
    from ..streaming.streams import stream_upsert
    from ..streaming.tables import BucketTables, landed, shared_folder

    folder = shared_folder(t.spark, "ingest")
    tables = BucketTables(t.spark, f"{folder}/tables", {"records": ("id string, source_url string, document_date date, target_id string, record_type string, status string, data string, scraped_at timestamp, detailed_at timestamp", "source_url")}, 8)

    def land(old, batch):
        none = F.lit(None)
        rows = batch.select(F.col("url").alias("source_url"), none.cast("date").alias("document_date"), none.cast("string").alias("target_id"), F.lit("page").alias("record_type"), F.lit("indexed").alias("status"), F.to_json(F.struct("page_id")).alias("data"), F.col("page_id").alias("place"))
        return merge.upsert_records(old, rows, _now())

    stream_upsert(landed(t.spark, f"{t.dir}/pages.parquet"), tables, "records", "url", land, f"{folder}/state").awaitTermination()
    return tables.current("records").select("source_url", "status")


@query("ST2_stream_parse", """SELECT doc_id, md5(concat('ORDER', chr(10), 'The claim ', CAST(doc_id AS VARCHAR), ' fails.')) AS order_md5, 'Appearances: N. N.' AS appearances FROM documents""")
def _(t):
    from ..streaming.streams import stream_upsert
    from ..streaming.tables import BucketTables, landed, shared_folder

    folder = shared_folder(t.spark, "parse")
    tables = BucketTables(t.spark, f"{folder}/tables", {"parsed": (_CHILD_TYPE, "extracted_record_id")}, 8)

    def parse(old, batch):
        body = "regexp_replace(coalesce(text, ''), '[^a-z]+', ' ')"
        cut = documents.parse_sections(batch.select("doc_id", F.expr(_D1.format(body, body)).alias("full_text")))
        return merge.upsert_child(old, cut.select(F.col("doc_id").alias("extracted_record_id"), F.to_json("sections").alias("data")), _now())

    stream_upsert(landed(t.spark, f"{t.dir}/documents.parquet"), tables, "parsed", "doc_id", parse, f"{folder}/state").awaitTermination()
    part = lambda c: F.get_json_object("data", f"$.{c}")
    return tables.current("parsed").select(F.col("extracted_record_id").alias("doc_id"), F.md5(part("order")).alias("order_md5"), part("appearances").alias("appearances"))


def _scrubbed(t):
    """Landed documents in four batches by id, and the last of them again under its number."""
    from ..streaming.streams import SCRUB_TABLES, scrub_batch
    from ..streaming.tables import BucketTables, shared_folder

    tables = BucketTables(t.spark, f"{shared_folder(t.spark, 'scrub')}/tables", SCRUB_TABLES, 8)
    records = _records(t["documents"])
    for number in (0, 1, 2, 3, 3):
        scrub_batch(tables, records.where(F.pmod("id", F.lit(4)) == number), number, *_extraction(t), _json_passes, _now())
    return tables


@query("ST3_stream_scrub", _EXTRACTED)
def _(t):
    from ..streaming.streams import SCRUB_TABLES, stream_scrub
    from ..streaming.tables import BucketTables, landed, shared_folder

    folder = shared_folder(t.spark, "scrub")
    tables = BucketTables(t.spark, f"{folder}/tables", SCRUB_TABLES, 8)
    stream_scrub(_records(landed(t.spark, f"{t.dir}/documents.parquet")), tables, *_extraction(t), _json_passes, _now(), f"{folder}/state").awaitTermination()
    return _payloads_of(tables.current("scrubbed"))


@query("ST3_Q5_scrub_batches", f"""SELECT id, 'scrubbed' AS sink, summary AS said FROM ({_EXTRACTED}) UNION ALL SELECT doc_id, 'rejects', 'no result' FROM documents WHERE {_PENDING} AND doc_id % 7 = 0""")
def _(t):
    tables = _scrubbed(t)
    done = _payloads_of(tables.current("scrubbed")).select("id", F.lit("scrubbed").alias("sink"), F.col("summary").alias("said"))
    return done.unionByName(tables.current("rejects").select("id", F.lit("rejects").alias("sink"), F.col("reason").alias("said")))


@query("ST3_ST8_stream_redact", f"SELECT doc_id, md5({_SCRUB_SQL.format('text')}) AS text FROM documents")
def _(t):
    from ..streaming.streams import stream_redact
    from ..streaming.tables import landed, run_to_table

    return run_to_table(stream_redact(landed(t.spark, f"{t.dir}/documents.parquet")).select("doc_id", F.md5("text").alias("text")), "redact")


@query("ST4_stream_intervals", f"SELECT event_type, epoch_us(ts) // 300000000 * 300 AS start_s, count(*) AS n FROM events GROUP BY 1, 2 HAVING (epoch_us(min(ts)) // 300000000 + 1) * 300000000 <= {_MARK}")
def _(t):
    from ..streaming.streams import stream_intervals
    from ..streaming.tables import landed, run_to_table

    ev = landed(t.spark, f"{t.dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return run_to_table(stream_intervals(ev, "event_type"), "intervals")


@query("ST5_stream_uptime", f"""WITH {_GAPS}, n AS (SELECT *, sum(CASE WHEN gap <= 120000000 THEN 0 ELSE 1 END) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS session FROM g),
s AS (SELECT event_type, session, epoch_us(max(ts)) - epoch_us(min(ts)) AS uptime_us, count(*) - 1 AS active, count(*) AS n, epoch_us(max(ts)) AS last FROM n GROUP BY 1, 2) SELECT event_type, uptime_us, active, n FROM s WHERE last + 120000000 <= {_MARK}""")
def _(t):
    from ..streaming.streams import stream_uptime
    from ..streaming.tables import landed, run_to_table

    ev = landed(t.spark, f"{t.dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return run_to_table(stream_uptime(ev, "event_type"), "uptime")


@query("ST6_stream_online", """WITH m AS (SELECT (epoch_us(max(ts)) // 1000 - 600000) * 1000 AS mark FROM events),
e AS (SELECT DISTINCT CAST(user_id AS VARCHAR) AS key, epoch_us(ts) AS us FROM events, m WHERE epoch_us(ts) <= mark),
g AS (SELECT *, lag(us) OVER w AS before, lead(us) OVER w AS after FROM e WINDOW w AS (PARTITION BY key ORDER BY us))
SELECT key, 'online' AS state, us AS at_us FROM g WHERE before IS NULL OR us - before > 900000000
UNION ALL SELECT key, 'offline', us + 900000000 FROM g, m WHERE after - us > 900000000 OR (after IS NULL AND us + 900000000 <= mark)""")
def _(t):
    from ..streaming.streams import stream_online
    from ..streaming.tables import landed, run_to_table

    t.spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    ev = landed(t.spark, f"{t.dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return run_to_table(stream_online(ev, "user_id"), "online")


@query("ST7_stream_dedupe", "SELECT DISTINCT event_type, user_id FROM events")
def _(t):
    from ..streaming.streams import stream_dedupe
    from ..streaming.tables import landed, run_to_table

    ev = landed(t.spark, f"{t.dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    return run_to_table(stream_dedupe(ev, ["event_type", "user_id"], "3650 days").select("event_type", "user_id"), "dedupe")
