import datetime as dt

import pytest
from pyspark.sql import functions as F

from loomdocs.functions.sections import split_sections
from loomdocs.operators import aggregates as agg
from loomdocs.operators import documents, filters, joins, merge, quality
from loomdocs.sources import io


def utc(h, m, s=0, day=26):
    return dt.datetime(2026, 7, day, h, m, s)


def events(spark, *times):
    return spark.createDataFrame([(i, "a", t) for i, t in enumerate(times)], "event_id int, kind string, ts timestamp")


def test_uptime(spark):
    r = agg.uptime_and_rate(events(spark, utc(8, 0), utc(8, 2), utc(8, 1)), ["kind"], ["event_id"]).first()
    assert (r["total"], r["active"], r["uptime_us"], r["rate"]) == (3, 2, 120_000_000, 2 / 120)
    assert agg.uptime_and_rate(events(spark), ["kind"], ["event_id"]).collect() == []


def test_last_hour(spark):
    now = utc(15, 7)
    got = agg.last_hour_intervals(events(spark, utc(14, 56), utc(14, 58, 30), utc(15, 2), utc(15, 6)), ["kind"], now).orderBy("start_s").collect()
    assert len(got) == 12
    assert [(r["n"], r["rate_per_hour"]) for r in got[-2:]] == [(2, 24.0), (1, 12.0)]
    assert sum(r["n"] for r in got) == 3


def test_pipeline_state(spark):
    rows = [("t", y, s, "{}") for y, s, n in ((2024, "detailed", 10), (2024, "indexed", 5), (2025, "indexed", 3)) for _ in range(n)] + [("u", 2020, "indexed", '{"details_scraped_at":"x"}'), ("u", None, "detailed", "{}")]
    got = {r["record_type"]: r for r in agg.pipeline_state(spark.createDataFrame(rows, "record_type string, rec_year int, status string, data string")).collect()}
    t, u = got["t"], got["u"]
    assert (t["total"], t["total_detailed"], t["total_indexed"], t["complete_years"], t["incomplete_years"], t["fully_complete"]) == (18, 10, 8, [], [2024, 2025], False)
    assert (u["total"], u["complete_years"], u["fully_complete"]) == (2, [2020], True)


STORE = "source_url string, status string, data string, detailed_at int, parsed_at int, scrubbed_at int, requires_human_review boolean, review_reason string"


def store(spark, *rows):
    return spark.createDataFrame([(u, s, d, t, None, None, None, None) for u, s, d, t in rows], STORE)


def test_sync(spark):
    secondary = store(spark, ("only", "detailed", '{"a":1}', 5), ("up", "detailed", '{"b":1}', 6), ("down", "indexed", '{"keep":1}', None), (None, "indexed", "{}", None))
    master = store(spark, ("up", "indexed", "{}", None), ("down", "detailed", '{"c":1}', 7), ("stub", "indexed", '{"d":1}', None))
    new_master, new_secondary = merge.sync(secondary, master)
    m = {r["source_url"]: (r["action"], r["status"], r["data"], r["detailed_at"]) for r in new_master.collect()}
    s = {r["source_url"]: (r["action"], r["status"], r["data"], r["detailed_at"]) for r in new_secondary.collect()}
    assert m["only"] == ("inserted", "detailed", '{"a":1}', 5)
    assert m["up"] == ("updated", "detailed", '{"b":1}', 6)
    assert m["down"] == ("kept", "detailed", '{"c":1}', 7)
    assert s["down"] == ("updated", "detailed", '{"keep":1}', 7)
    assert s["stub"] == ("inserted", "indexed", "{}", None)
    assert s[None] == ("kept", "indexed", "{}", None)


def test_record_upsert(spark):
    now = F.lit(dt.datetime(2026, 1, 1))
    old = spark.createDataFrame([("1", "u1", dt.date(2020, 1, 1), "t1", "a", "detailed", "{}", dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2))], "id string, source_url string, document_date date, target_id string, record_type string, status string, data string, scraped_at timestamp, detailed_at timestamp")
    batch = spark.createDataFrame([(1, "u1", dt.date(2021, 1, 1), "t2", "b", "indexed", "one"), (2, "u2", None, "t3", "c", "detailed", "x"), (3, "u2", None, "t3", "c", "indexed", "y"), (4, None, None, "t", "c", "indexed", "z")], "place int, source_url string, document_date date, target_id string, record_type string, status string, data string")
    got = {r["source_url"]: r for r in merge.upsert_records(old, batch, now).collect()}
    assert set(got) == {"u1", "u2"}
    assert (got["u1"]["target_id"], got["u1"]["document_date"], got["u1"]["data"], got["u1"]["status"], got["u1"]["detailed_at"]) == ("t1", dt.date(2020, 1, 1), "one", "indexed", dt.datetime(2025, 1, 2))
    assert (got["u2"]["data"], got["u2"]["detailed_at"]) == ("y", dt.datetime(2026, 1, 1))


def test_complete_flags(spark):
    rec = spark.createDataFrame([("u1", '{"dataset_number":"n1"}', "detailed"), ("u2", '{"dataset_number":"n2"}', "indexed"), (None, None, "detailed")], "source_url string, data string, status string")
    keys = spark.createDataFrame([("u1", None), (None, "n1"), ("u1", "n1"), ("u2", "n2"), (None, None)], "source_url string, dataset_number string")
    got = {(r[0], r[1]): r[2] for r in filters.complete_flags(keys, rec).collect()}
    assert got == {("u1", None): True, (None, "n1"): True, ("u1", "n1"): True, ("u2", "n2"): False, (None, None): False}


def test_append_uncovered(spark):
    df = spark.range(1).select(joins.append_uncovered(F.array(F.lit("A v B [2020]")), F.array(F.lit("u1")), F.expr("array(named_struct('text','a v b','url','u9'), named_struct('text','C v D','url','u2'), named_struct('text','v d','url','u3'), named_struct('text','E','url','u1'))")).alias("x"))
    assert [r["url"] for r in df.first()["x"]] == ["u2"]


BODY = "\n".join(f"[{i}] A paragraph about the facts of the matter, number {i}, with some more words." for i in range(1, 12))


@pytest.mark.parametrize(
    ("tail", "order", "appearances"),
    [
        ("ORDER\n1. The claim fails.\nAppearances\nFor the Applicant: X", "ORDER\n1. The claim fails.", "Appearances\nFor the Applicant: X"),
        ("The following orders are made:\n1. x", "The following orders are made:\n1. x", ""),
        ("I would propose the following order:\n(a) x", "I would propose the following order:\n(a) x", ""),
        ("The application is dismissed with costs.", "The application is dismissed with costs.", ""),
        ("Die aansoek word van die hand gewys met koste.", "Die aansoek word van die hand gewys met koste.", ""),
    ],
)
def test_sections(tail, order, appearances):
    got = split_sections(f"HIGH COURT\nCase no 1/20\nJUDGMENT\n{BODY}\n{tail}")
    assert (got["header"], got["order"], got["appearances"], got["null_values"]) == ("HIGH COURT\nCase no 1/20", order, appearances, [])
    assert got["judgment"] == BODY


def test_sections_of_nothing():
    assert split_sections("zzz") == {"null_values": ["judgment", "order"], "header": "zzz", "judgment": "", "order": "", "appearances": "", "footnotes": ""}
    assert split_sections(None)["null_values"] == ["header", "judgment", "order"]
    assert split_sections("JUDGMENT\n" + BODY)["null_values"] == ["header", "order"]
    assert split_sections("H\nJUDGMENT\nThe matter was struck off the roll by agreement of the parties")["order"] == "Struck from the roll"


def test_footnotes():
    got = split_sections(f"H\nJUDGMENT\n{BODY}\nORDER\nThe claim fails.\n" + "filler words here\n" * 5 + "[1] See A v B\n[2] See C v D")
    assert got["footnotes"] == "[1] See A v B\n[2] See C v D"


def test_plug_ins(spark):
    documents.register_parser("first_line", lambda t: {"null_values": [], "header": (t or "").split("\n")[0], "judgment": "", "order": "", "appearances": "", "footnotes": ""})
    df = spark.createDataFrame([("a\nb",), (None,)], "full_text string")
    assert [r[0] for r in documents.parse_sections(df, "first_line").select("sections.header").collect()] == ["a", ""]
    assert documents.schema_for("nothing").fieldNames() == ["title", "extracted_data"]


def test_page_content(spark):
    html = '<html><head><title>T</title><script>var x="<p>no</p>"</script></head><body><nav>menu</nav><div id="center"><h1>Head</h1><p>One &amp; two</p></div></body></html>'
    got = documents.page_content(spark.createDataFrame([("u", html), ("n", None)], "url string, html string")).orderBy("url").collect()
    assert (got[1]["title"], got[1]["h1"], got[1]["container"], got[1]["content"]) == ("T", "Head", "center", "Head\nOne & two")
    assert (got[0]["container"], got[0]["content"]) == (None, "")


def test_format_text():
    assert documents.format_text("SUMMARY\nfirst line\nsecond [1]\n\nnext") == "## SUMMARY\n\nfirst line second [^1]\n\nnext"


def test_validate_reports_every_reason(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([('{"a":"x","d":"2020-01-01"}',), ('{"d":"soon"}',), ("oops",)], "payload string")
    good, bad = quality.validate(df, T.StructType.fromDDL("a string, d string"), ["a"], ["d"])
    assert good.count() == 1
    assert sorted(map(sorted, (r["reasons"] for r in bad.collect()))) == [["missing a", "not JSON"], ["missing a", "not a date: d"]]


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    assert [io.export(df, f"{tmp_path}/x.{e}") for e in ("csv", "parquet", "json", "other")] == ["csv", "parquet", "json", "csv"]
    assert spark.read.option("header", True).csv(f"{tmp_path}/x.csv").first()["s"] == "a"
    assert not io.write_draws(spark.createDataFrame([], "Year string, Date string, `Winning Numbers` string, Jackpot string, Outcome string"), f"{tmp_path}/none")


def test_json_sources(spark, tmp_path):
    (tmp_path / "c.json").write_text('[{"stock_code": "P1", "pricing": [{"qty": "1", "price": "R 2"}]}, {"stock_code": "P2", "pricing": []}]')
    (tmp_path / "j.json").write_text('[{"dataset_number": "1/20", "court": "C", "parties": {"applicant_plaintiff": "A"}, "subjects": ["x"]}]')
    assert [r["stock_code"] for r in io.read_catalog(spark, str(tmp_path / "c.json")).collect()] == ["P1", "P2"]
    assert io.read_judgments(spark, str(tmp_path / "j.json")).select("parties.applicant_plaintiff").first()[0] == "A"


def test_versions(spark, tmp_path):
    from loomdocs.streaming.tables import Versions

    table = Versions(spark, f"{tmp_path}/t", "n int")
    assert table.current().count() == 0
    table.put(spark.createDataFrame([(1,)], "n int"))
    table.put(table.current().selectExpr("n + 1 as n"))
    assert [r["n"] for r in table.current().collect()] == [2]


@pytest.mark.parametrize("order", ["In the result, the appeal is upheld.", "There is no order as to costs.", "The application must succeed.", "(3) Die saak word van die rol geskrap.", "12. The claim was refused.", "Accordingly, the application is dismissed with costs."])
def test_rulings_are_whole(order):
    got = split_sections(f"H\nJUDGMENT\n{BODY}\n{order}")
    assert (got["judgment"], got["order"]) == (BODY, order)


def test_signature_under_a_ruled_line():
    got = split_sections(f"H\nJUDGMENT\n{BODY}\n\nThe claim has no basis.\n\n_____\nA B SMITH R /")
    assert (got["judgment"], got["order"]) == (BODY, "The claim has no basis.\n\n_____\nA B SMITH R /")
    assert split_sections(f"H\nJUDGMENT\n{BODY}\n_____\nsome other line")["order"] == ""


def test_first_footnote_container(spark):
    pages = [
        '<p class="x">[4]</p><div class="footnoteText">[9] late</div><div id="ftn1"><a>[3]</a> one</div><div id="ftn2">[4]</div>',
        '<p class="MsoFootnoteText"><b>[5]</b> note</p>', '<div id="MyFootnotes">none</div><p class="ftn">[6]</p>', "<p>[7]</p>", None,
    ]
    assert [documents._read(p).first_note() for p in pages] == [3, 5, None, None, None]
    text = f"H\nJUDGMENT\n{BODY}\nThe claim was refused.\n[5] See A v B\n[6] See C v D"
    rows = documents.parse_sections(spark.createDataFrame([(text, p) for p in pages], "full_text string, page string"), html_col="page").select("sections.order", "sections.footnotes").collect()
    assert tuple(rows[1]) == ("The claim was refused.", "[5] See A v B\n[6] See C v D")
    assert all(tuple(r) == ("The claim was refused.\n[5] See A v B\n[6] See C v D", "") for i, r in enumerate(rows) if i != 1)


def test_link_kinds(spark):
    page = '<a class="autolink_findcases" href="/find?x">A v B</a><a class="autolink_findcases" href="/f.pdf">file</a><a href="/za/cases/1.html">C</a><a class="autolink_findcases" href="/za/cases/1.html">D</a><a class="other" href="/q">E</a>'
    got = documents.link_targets(spark.createDataFrame([("https://h/i", page)], "url string, html string"), kinds=True).collect()
    assert sorted(tuple(r)[1:] for r in got) == [("A v B", "https://h/find?x", "citation"), ("C", "https://h/za/cases/1.html", "za/cases")]


def test_python_gets_small_batches(spark):
    """An extractor's frames are small however many rows a task has, and no row is lost; the section parser has the same limit."""
    from loomdocs.operators.documents import BATCH_ROWS, apply_extractor, parse_sections

    def sizes(frames):
        for pdf in frames:
            yield pdf.assign(n=len(pdf))[["id", "n"]]

    rows = spark.range(3000).coalesce(1).selectExpr("id", "'header' AS pass", "'some words' AS context")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    got = apply_extractor(rows, sizes, "id long, n long").collect()
    assert sorted(r["id"] for r in got) == list(range(3000)) and max(r["n"] for r in got) <= BATCH_ROWS
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    parse_sections(rows.withColumnRenamed("context", "full_text"))
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == str(BATCH_ROWS)
