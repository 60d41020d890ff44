"""Whole-table document jobs (D1-D17) and the plug-in points."""

from __future__ import annotations

import re
from collections.abc import Callable
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names, text, urls
from ..functions.citations import citation_column, parse_citation
from ..functions.dates import safe_date, title_date
from ..functions.payload import scrub_struct
from ..functions.sections import split_sections
from ..streaming.tables import Scratch
from .joins import append_uncovered, attach_url, unscrubbed
from .merge import upsert_child
from .quality import rejects, validate

SECTION_TYPE = "null_values array<string>, header string, judgment string, order string, appearances string, footnotes string"
PARSERS: dict[str, Callable[[str | None], dict]] = {"default": split_sections}
SCHEMAS: dict[str, T.StructType] = {"generic": T.StructType().add("title", "string").add("extracted_data", T.MapType(T.StringType(), T.StringType()))}
# File endings of downloads, and path parts of document links.
DOWNLOADS, LINK_PARTS = (".pdf", ".rtf", ".doc"), ["LawCite", "/za/cases/", "/za/legis/"]
# Class of links that a site sets on citations by itself; what ids and classes of footnote containers hold.
CITATION_CLASS, NOTE_IDS, NOTE_CLASSES = "autolink_findcases", ("ftn", "fn"), ("footnote", "ftn")
CONTEXT_CHARS = 3000
#: Rows and bytes of the Arrow batches that Python gets: its memory is that of a batch, so it doesn't grow with a task's rows.
BATCH_ROWS, BATCH_BYTES = 250, 4 << 20


def register_parser(name: str, fn: Callable[[str | None], dict]) -> None:
    """A section parser: full text -> the fields of SECTION_TYPE."""
    PARSERS[name] = fn


def register_schema(name: str, schema: T.StructType) -> None:
    """P2."""
    SCHEMAS[name] = schema


def schema_for(name: str | None) -> T.StructType:
    return SCHEMAS.get(name or "generic", SCHEMAS["generic"])


def register_sql(spark: SparkSession) -> None:
    """X-functions as SQL functions, for ad-hoc queries over named views."""
    scrubbed = "t"
    for pattern, label in text.SCRUB_RULES:
        scrubbed = f"regexp_replace({scrubbed}, r'{pattern}', '{label}')"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION scrub_text(t STRING) RETURNS STRING RETURN {scrubbed}")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION norm_id(t STRING) RETURNS STRING RETURN lower(translate(t, ' -', '__'))")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION rand_price(cents BIGINT) RETURNS STRING RETURN CASE WHEN cents IS NOT NULL THEN format_string('R %.2f', cents / 100) END")


def small_batches(df: DataFrame) -> DataFrame:
    """df, with small Arrow batches from here on in its session: texts make batches of Spark's 10,000 rows large. Every row still goes."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def spread(df: DataFrame) -> DataFrame:
    """df in as many partitions as there are cores, if a small input has fewer: what follows costs far more than a row's way there. Larger inputs stay where they are."""
    df = small_batches(df)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if not df.isStreaming and df.rdd.getNumPartitions() < cores else df


def parse_sections(rec: DataFrame, parser: str = "default", text_col: str = "full_text", html_col: str | None = None) -> DataFrame:
    """`sections` of every record, by a registered parser; headers are cleaned. Null texts have no sections.

    With html_col, the column of the page behind the text, the parser also gets
    first_note: the number in the page's first footnote container, so that the
    notes begin at that number's line in the text. Null pages have no container.
    """
    parse = PARSERS[parser]
    columns = ["null_values", "header", "judgment", "order", "appearances", "footnotes"]

    @F.pandas_udf(SECTION_TYPE)
    def split(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse(t) for t in texts], columns=columns)

    @F.pandas_udf(SECTION_TYPE)
    def split_with_notes(texts: pd.Series, pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse(t, first_note=_read(h).first_note()) for t, h in zip(texts, pages, strict=True)], columns=columns)

    rec = spread(rec)
    return rec.withColumn("sections", split_with_notes(text_col, html_col) if html_col else split(text_col)).withColumn("sections", F.col("sections").withField("header", text.clean_text(F.col("sections.header"), True)))


class _Page(HTMLParser):
    """Title, headings, links, and the text of the main container of one page."""

    BLOCKS = {"p", "div", "br", "li", "h1", "h2", "h3", "tr", "article", "section"}
    HIDDEN = {"script", "style", "head"}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title, self.h1, self.links, self.texts = "", "", [], {"center": [], "judgment": [], "article": [], "body": []}
        self.stack: list[tuple[str, str | None]] = []
        self.link: tuple[str, list[str], list[str]] | None = None
        self.notes: dict[str, list[list[str]]] = {"id": [], "class": []}  # texts of footnote containers, by what marks them
        self.in_notes: list[tuple[int, list[str]]] = []  # open containers, with their places on the stack

    VOID = {"br", "img", "meta", "link", "input", "hr", "area", "base", "col", "embed", "source", "track", "wbr"}

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        kind = "center" if a.get("id") == "center" else "judgment" if "judgment" in (a.get("class") or "").split() else tag if tag in ("article", "body") else None
        if tag in self.BLOCKS:
            self._add("\n")
        if tag == "a" and a.get("href"):
            self.link = (a["href"], [], (a.get("class") or "").split())
        if tag not in self.VOID:
            marked = self._note_mark(tag, a)
            if marked:
                self.notes[marked].append([])
                self.in_notes.append((len(self.stack), self.notes[marked][-1]))
            self.stack.append((tag, kind))

    @staticmethod
    def _note_mark(tag, attrs) -> str | None:
        """Whether an element is a footnote container, by its id or, weaker, by a class."""
        own = attrs.get("id") or ""
        if tag == "div" and (own.startswith(NOTE_IDS) or NOTE_CLASSES[0] in own.lower()):
            return "id"
        if tag in ("div", "p") and any(x in c.lower() for c in (attrs.get("class") or "").split() for x in NOTE_CLASSES):
            return "class"
        return None

    def first_note(self) -> int | None:
        """The number in brackets of the first footnote container, those marked by id first."""
        texts = self.notes["id"] or self.notes["class"]
        number = re.search(r"\[(\d+)\]", "".join(texts[0])) if texts else None
        return int(number[1]) if number else None

    def handle_endtag(self, tag):
        if tag == "a" and self.link:
            in_h3 = any(t == "h3" for t, _ in self.stack)
            self.links.append((self.link[0], " ".join("".join(self.link[1]).split()), in_h3, self.link[2]))
            self.link = None
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                while self.in_notes and self.in_notes[-1][0] >= i:
                    self.in_notes.pop()
                break
        if tag in self.BLOCKS:
            self._add("\n")

    def _add(self, data: str) -> None:
        for _, kind in self.stack:
            if kind:
                self.texts[kind].append(data)

    def handle_data(self, data):
        tags = [t for t, _ in self.stack]
        if "title" in tags and "svg" not in tags:
            self.title += data
        if any(t in self.HIDDEN for t in tags):
            return
        if "h1" in tags:
            self.h1 += data
        if self.link:
            self.link[1].append(data)
        for _, words in self.in_notes:
            words.append(data)
        self._add(data)

    def content(self) -> tuple[str | None, str]:
        for kind, parts in self.texts.items():
            lines = [" ".join(x.split()) for x in "".join(parts).split("\n")]
            if any(lines):
                return kind, "\n".join(x for x in lines if x)
        return None, ""


def _read(html: str | None) -> _Page:
    page = _Page()
    page.feed(html or "")
    page.close()
    return page


def page_content(pages: DataFrame) -> DataFrame:
    """D3: url, title, h1, container, content and raw html of landed pages. Null pages have empty content."""

    def run(batches):
        for pdf in batches:
            read = [_read(h) for h in pdf["html"]]
            content = [p.content() for p in read]
            yield pd.DataFrame({"url": pdf["url"], "title": [" ".join(p.title.split()) for p in read], "h1": [" ".join(p.h1.split()) for p in read], "container": [c[0] for c in content], "content": [c[1] for c in content], "html": pdf["html"]})

    return small_batches(pages).select("url", "html").mapInPandas(run, "url string, title string, h1 string, container string, content string, html string")


def page_links(pages: DataFrame) -> DataFrame:
    """url, place, href (absolute), label, in_h3 and classes of every link of landed pages."""

    def run(batches):
        for pdf in batches:
            rows = [(u, i, *link) for u, h in zip(pdf["url"], pdf["html"], strict=True) for i, link in enumerate(_read(h).links)]
            yield pd.DataFrame(rows, columns=["url", "place", "href", "label", "in_h3", "classes"])

    return small_batches(pages).select("url", "html").mapInPandas(run, "url string, place int, href string, label string, in_h3 boolean, classes array<string>").withColumn("href", urls.abs_url("url", "href"))


def link_kind(parts: list[str] | None = None) -> Column:
    """What a link of page_links leads to: null for downloads and links of no interest, `citation` for those that the site set on a citation, else the part of the path that tells."""
    kind = F.when(F.array_contains("classes", CITATION_CLASS), "citation")
    for p in parts or LINK_PARTS:
        kind = kind.when(F.contains("href", F.lit(p)), p.strip("/"))
    download = F.lit(False)
    for e in DOWNLOADS:
        download = download | F.col("href").endswith(e)
    return F.when(~download, kind)


def link_targets(pages: DataFrame, parts: list[str] | None = None, kinds: bool = False) -> DataFrame:
    """(url, text, target) of document links and citations, not downloads, with a label; each target of a page once, the first. `kinds` adds link_kind."""
    links = page_links(pages).withColumn("kind", link_kind(parts)).where("kind is not null")
    first = links.groupBy("url", "href").agg(F.min(F.struct("place", "label", "kind")).alias("first"))
    out = first.select("url", F.col("first.label").alias("text"), F.col("href").alias("target"), F.col("first.kind").alias("kind")).where((F.col("text") != "") & (F.lower("text") != "lawcite"))
    return out if kinds else out.drop("kind")


def harvest_links(pages: DataFrame) -> DataFrame:
    """Candidate document URLs of index pages: html or pdf files in a 4-digit folder, no tables of contents."""
    path = urls.url_path("href")
    ok = path.rlike(r"/\d{4}/[^/]+\.(?:html?|pdf)$") & ~path.rlike(r"(?i)/(?:toc[^/]*|index)\.html?$")
    return page_links(pages).where(ok).select("href").distinct()


def discover_datasets(pages: DataFrame, prefix: str) -> DataFrame:
    """Links right below a path prefix; those in headings if there are any, else all."""
    found = page_links(pages).where(urls.url_path("href").startswith(prefix) & (F.length(urls.url_path("href")) > len(prefix)))
    heads = found.groupBy("url").agg(F.max("in_h3").alias("some_h3"))
    return found.join(heads, "url").where(~F.col("some_h3") | F.col("in_h3")).select(F.col("href").alias("dataset_url"), F.col("label").alias("dataset_name")).distinct()


def discover_years(pages: DataFrame) -> DataFrame:
    """Year folders of index pages."""
    year = F.regexp_extract(F.trim("label"), r"^(\d{4})/?$", 1)
    return page_links(pages).select("url", year.alias("year"), "href").where("year <> ''").distinct()


def build_detail(content: DataFrame) -> DataFrame:
    """Detail rows of read pages: category, URL parts, category metadata, dataset number, review flag for empty PDF texts."""
    meta = text.category_metadata(urls.url_category("url"), F.col("title"), F.col("content"))
    empty_pdf = F.lower("url").endswith(".pdf") & (F.length(text.strip(F.coalesce("content", F.lit("")))) == 0)
    out = content.withColumn("category", urls.url_category("url")).withColumn("meta", meta).withColumn("parts", urls.url_parts("url"))
    return out.select(F.col("url").alias("source_url"), "category", "parts", "meta", text.dataset_number("meta").alias("dataset_number"), "title", F.col("content").alias("full_text"), empty_pdf.alias("requires_human_review"), F.when(empty_pdf, "Empty PDF text").alias("review_reason"))


def parse_citations(df: DataFrame, column: str) -> DataFrame:
    """The five parts of every citation."""
    return citation_column(spread(df), column, "citation")


def precedents(rec: DataFrame) -> DataFrame:
    """One row per precedent. Input: id, citations array<string>, targets array<struct<text,url>>.

    URLs come from matching link targets; targets that no citation covers are
    appended as citations of their own.
    """
    given = F.transform(F.coalesce("citations", F.array().cast("array<string>")), lambda c: F.struct(c.alias("raw"), attach_url(c, F.col("targets")).alias("url")))
    more = append_uncovered(F.col("citations"), F.transform(F.filter(F.col("given"), lambda g: g["url"].isNotNull()), lambda g: g["url"]), F.col("targets"))
    rows = rec.withColumn("given", given).withColumn("every", F.concat("given", F.transform(more, lambda t: F.struct(t["text"].alias("raw"), t["url"].alias("url")))))
    one = rows.select("id", F.posexplode("every").alias("place", "p"))
    return one.select("id", "place", parse_citation(F.col("p.raw")).alias("citation"), F.lit("Cited").alias("treatment"), F.col("p.url").alias("url"))


def extract_journals(rec: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cleaned text and title of journals and gazettes; rows without text are rejected. Input: id, title, full_text."""
    out = rec.select("id", F.coalesce(F.nullif(text.strip("title"), F.lit("")), F.lit("Untitled")).alias("title"), text.clean_text("full_text").alias("formatted_text"))
    return out.where("formatted_text <> ''"), out.where("formatted_text = ''").select("id", F.lit("empty text").alias("reason"))


def format_text(value: str | None) -> str:
    """D10's line rule: joined paragraphs, headings (capitals only) on their own with `## `, footnote numbers as `[^n]`."""
    out, paragraph = [], []
    for line in [*(value or "").split("\n"), ""]:
        line = " ".join(line.split())
        heading = bool(line) and line.upper() == line and any(c.isalpha() for c in line) and len(line) < 120
        if (not line or heading) and paragraph:
            out.append(re.sub(r"\[(\d{1,3})\]", r"[^\1]", " ".join(paragraph)))
            paragraph = []
        if heading:
            out.append(f"## {line}")
        elif line:
            paragraph.append(line)
    return "\n\n".join(out)


def format_journal(rec: DataFrame) -> DataFrame:
    """D10."""

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(format_text)

    return small_batches(rec).withColumn("formatted_text", run("formatted_text"))


def court_roll_rows(rec: DataFrame) -> DataFrame:
    """One row per listed case. Input: id, full_text with lines `[n.] A v B case-number [status]`."""
    lines = rec.select("id", F.posexplode(F.split(F.coalesce("full_text", F.lit("")), "\n")).alias("line", "row"))
    pattern = r"(?i)^\s*(?:(\d+)[.)]?\s+)?(.+?)\s+v(?:s|\.)?\s+(.+?)\s+((?:[A-Z]{0,5}\s?)?\d+/\d{2,4})\s*(.*)$"
    part = lambda i: F.nullif(F.trim(F.regexp_extract("row", pattern, i)), F.lit(""))
    return lines.where(F.col("row").rlike(pattern)).select("id", "line", part(1).cast("int").alias("sequence"), F.concat_ws(" v ", part(2), part(3)).alias("parties"), part(4).alias("case_number"), part(5).alias("status"))


def extraction_contexts(parsed: DataFrame) -> DataFrame:
    """(id, pass, context): header pass with the judgment's start and appearances, precedents pass (footnotes), body pass; the whole text where sections are missing. Input: id, full_text, sections."""
    s = lambda c: F.nullif(text.strip(F.coalesce(F.col(f"sections.{c}"), F.lit(""))), F.lit(""))
    whole = F.coalesce("full_text", F.lit(""))
    header = F.coalesce(F.nullif(F.concat_ws("\n\n", s("header"), F.left(s("judgment"), F.lit(CONTEXT_CHARS)), s("appearances")), F.lit("")), whole)
    body = F.coalesce(F.nullif(F.concat_ws("\n\n", s("judgment"), s("order")), F.lit("")), whole)
    passes = F.array(F.struct(F.lit("header").alias("pass"), header.alias("context")), F.struct(F.lit("precedents").alias("pass"), s("footnotes").alias("context")), F.struct(F.lit("body").alias("pass"), body.alias("context")))
    return parsed.select("id", F.explode(passes).alias("p")).select("id", "p.pass", "p.context").where("context is not null")


def apply_extractor(contexts: DataFrame, fn, schema: str) -> DataFrame:
    """A user's function over iterators of pandas frames (id, pass, context), which hold BATCH_ROWS rows at most."""
    return small_batches(contexts).mapInPandas(fn, schema)


def header_fallback(res: DataFrame, rec: DataFrame) -> DataFrame:
    """Empty header results filled from the record: court by target, parties and date from the title; else review.

    res: id, court, applicant, respondent, judgment_date (text). rec: id, title, target_name.
    """
    r = rec.select("id", "title", "target_name", text.title_parties("title").alias("parties"), F.date_format(title_date("title"), "yyyy-MM-dd").alias("title_date"))
    out = r.join(res, "id", "left")
    fill = lambda c, other: F.coalesce(F.nullif(F.col(c), F.lit("")), other).alias(c)
    out = out.select("id", fill("court", names.court_name(F.lit(None).cast("string"), "target_name")), fill("applicant", F.col("parties.applicant")), fill("respondent", F.col("parties.respondent")), fill("judgment_date", F.col("title_date")))
    return out.withColumn("requires_human_review", F.col("applicant").isNull() & F.col("judgment_date").isNull())


def merge_passes(header: DataFrame, body: DataFrame) -> DataFrame:
    """Fields of both passes by id, with canonical court and judges. header: id, court, judges, judgment_date; body: id, outcome, summary."""
    out = header.join(body, "id", "left")
    return out.select("id", names.court_name("court").alias("court"), names.judges("judges").alias("judges"), safe_date("judgment_date").alias("judgment_date"), F.coalesce("outcome", F.lit("Unknown")).alias("outcome"), F.coalesce("summary", F.lit("")).alias("summary"))


def wrap_metadata(res: DataFrame, rec: DataFrame) -> DataFrame:
    """Results under authoritative metadata of the record. rec: id, entity_name, target_name, document_date, record_type, title, header."""
    number = F.coalesce(text.case_no_title("title"), text.case_no_header("header"))
    meta = rec.select("id", "title", F.struct("entity_name", "target_name", "document_date", "record_type", F.when(~text.is_neutral(number), number).alias("case_number")).alias("metadata"))
    return meta.join(res.select("id", F.struct(*[c for c in res.columns if c != "id"]).alias("extracted_data")), "id")


def extract_and_scrub(rec: DataFrame, header: DataFrame, body: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merged passes, wrapped and scrubbed; and the ids without a result."""
    wrapped = wrap_metadata(merge_passes(header, body), rec)
    done = scrub_struct(wrapped, ["title", "extracted_data"])
    return done, rec.select("id").join(wrapped.select("id"), "id", "left_anti").withColumn("reason", F.lit("no result"))


#: What an extractor's JSON may hold by pass, and what the wrapped payload must.
HEADER_RESULT = "court string, judges array<string>, applicant string, respondent string, judgment_date string"
BODY_RESULT = "outcome string, summary string"
PAYLOAD_REQUIRED, PAYLOAD_DATES = ["title", "extracted_data.court"], ["extracted_data.judgment_date"]


def pass_results(results: DataFrame, name: str, schema: str) -> DataFrame:
    """One pass's results (id, pass, result as JSON) as columns; of repeated ones the first in text order, none if it isn't JSON."""
    own = results.where(F.col("pass") == name).withColumn("r", F.from_json("result", schema)).where(F.try_parse_json("result").isNotNull())
    return own.groupBy("id").agg(F.min_by("r", "result").alias("r")).select("id", "r.*")


def extract_pending(rec: DataFrame, parsed: DataFrame, scrubbed: DataFrame, tgt: DataFrame, ent: DataFrame, extractor, now, scratch: Scratch | None = None) -> tuple[DataFrame, DataFrame]:
    """D17 as one job: the scrubbed table's new state, and the ids that gave no row with their reasons (Q5).

    Reads detailed records without scrubbed row that aren't under review (J5),
    builds contexts (D12), applies `extractor` (D13: iterators of pandas frames
    of id, pass, context to id, pass, result as JSON), fills headers from the
    record (D14), merges (D15), wraps (D16) and scrubs (X2), checks the payload
    (Q1) and upserts the children (M4). A record needs a result of any pass.
    rec: id, title, data (with full_text), status, record_type, document_date,
    target_id, requires_human_review. Null and empty texts give an empty context.

    Pending records, the extractor's results and the payloads are written to
    `scratch` once each: the records are joined once, the extractor sees every
    context once, and both outputs come from the same rows. A caller that passes
    its scratch removes it when both are written.
    """
    scratch = scratch or Scratch(rec.sparkSession)
    own = unscrubbed(rec.where(~F.coalesce("requires_human_review", F.lit(False))), parsed, scrubbed, tgt, ent)
    own = own.withColumns({"full_text": F.get_json_object("data", "$.full_text"), "sections": F.from_json("parsed_data", SECTION_TYPE)})
    own = own.withColumn("header", F.coalesce("sections.header", F.lit("")))
    own = scratch.written(own.select("id", "title", "entity_name", "target_name", "document_date", "record_type", "header", "full_text", "sections"), "pending")
    kind = rec.schema["id"].dataType.simpleString()
    results = scratch.written(apply_extractor(extraction_contexts(own), extractor, f"id {kind}, pass string, result string"), "extracted")
    header, body = pass_results(results, "header", HEADER_RESULT), pass_results(results, "body", BODY_RESULT)
    reached = header.select("id").union(body.select("id")).distinct()
    filled = header_fallback(header.drop("judges"), own.join(reached, "id", "left_semi"))
    done, _ = extract_and_scrub(own, filled.join(header.select("id", "judges"), "id", "left"), body)
    payloads = scratch.written(done.select("id", F.to_json(F.struct("title", "metadata", "extracted_data")).alias("payload")), "payloads")
    good, bad = validate(payloads, T.StructType().add("title", "string"), PAYLOAD_REQUIRED, PAYLOAD_DATES)
    without = rejects(own, payloads, "no result").unionByName(bad.select("id", F.array_join("reasons", "; ").alias("reason")))
    return upsert_child(scrubbed, good.select(F.col("id").alias("extracted_record_id"), F.col("payload").alias("data")), now), without
