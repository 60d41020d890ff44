import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from loomdocs.functions import citations, dates, names, payload, text, urls


def run(spark, make, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in df.select("i", make(F.col("v")).alias("o")).orderBy("i").collect()]


def test_scrub(spark):
    got = run(spark, text.scrub, "id 8001015009087 and A12345678", "acc 1234567890 or 123456789012", "1234/2023 on 2025-08-08", None)
    assert got == ["id [RSA ID] and [PASSPORT]", "acc [BANK/TAX NUMBER] or [BANK/TAX NUMBER]", "1234/2023 on 2025-08-08", None]


def test_clean_text(spark):
    raw = "Home >> Databases >> LawCite\n\nHIGH COURT OF SOUTH AFRICA\nDownload original files\nPDF format\n\n\nCASE NO: 1234/2023"
    assert run(spark, lambda c: text.clean_text(c, True), raw, None) == ["HIGH COURT OF SOUTH AFRICA\nCASE NO: 1234/2023", ""]
    assert run(spark, text.clean_text, "a\n \n\n\nb") == ["a\n\nb"]


def test_case_numbers(spark):
    titles = ["A v B (CCT202/24) [2026] ZACC 2", "A v B (Judgment 1) [2026] ZACC 2", "A v B ([2020] ZASCA 1) [2021] ZASCA 3", None]
    assert run(spark, text.case_no_title, *titles) == ["CCT202/24", None, None, None]
    assert run(spark, text.case_no_header, "CASE NO: 123/2020 Date of hearing", "case number 77/21\nx", "none here", None) == ["123/2020", "77/21", None, None]
    assert run(spark, text.case_no_text, "Case No: 12/2020, x", "(case 44/19)", "see [2020] ZACC 4", "at 5/99 end", "") == ["12/2020", "44/19", "[2020] ZACC 4", "5/99", None]


def test_dates(spark):
    d = dt.date
    got = run(spark, dates.title_date, "x (13 April 2004)", "x (3 Sep 2020)", "x (1 Sept 2020).", "x (05/06/2021)", "x (May 7, 2019)", "x (1 May 70)", "x (1 May 05)", "x (31 February 2020)", "x", None)
    assert got == [d(2004, 4, 13), d(2020, 9, 3), d(2020, 9, 1), d(2021, 6, 5), d(2019, 5, 7), d(1970, 5, 1), d(2005, 5, 1), None, None, None]
    assert run(spark, dates.safe_date, "2020-02-29", "21 January 2026", "x") == ["2020-02-29", "2026-01-21", None]
    assert run(spark, dates.case_year, "2026/061774", "J1044/25", "120456/25", "abc", "CCT 2019/05", "CCT12019/05", "1/2019", None) == [2026, 2025, 2025, None, 2019, 2005, 2019, None]
    assert run(spark, lambda c: dates.document_date(c, F.lit("2000-01-01").cast("date")), '{"date":"2020-05-06T00"}', '{"year":"1999"}', "{}") == [d(2020, 5, 6), d(1999, 1, 1), d(2000, 1, 1)]


def test_urls(spark):
    u = ["https://h.org/za/cases/ZACC/2026/2.html", "https://h.org/za/gaz/ZAGov/x.pdf", "https://h.org/x", None]
    assert run(spark, urls.url_category, *u) == ["cases", "gaz", "other", "other"]
    assert run(spark, urls.url_dataset, *u) == ["ZACC", "ZAGov", None, None]
    assert [tuple(x) for x in run(spark, urls.url_parts, *u)] == [("ZACC", "2026", "2"), ("", "unknown", "unknown"), ("", "unknown", "unknown"), ("", "unknown", "unknown")]
    base = F.lit("https://h.org/a/b.html")
    assert run(spark, lambda c: urls.abs_url(base, c), "c.html", "/d", "//x.org/e", "http://y/z", None) == ["https://h.org/a/c.html", "https://h.org/d", "https://x.org/e", "http://y/z", None]


def test_page_state(spark):
    got = run(spark, lambda c: text.page_state(c, F.lit(""), F.lit("")), "Just a moment...", "404 Not Found", "ZALCJHB 404 [2025]", None)
    assert got == ["BLOCKED", "NOT_FOUND", "OK", "OK"]


@pytest.mark.parametrize(("raw", "wanted"), [("MAHLANGA AJ", "Mahlanga AJ"), ("DAMBUZA, AJA", "Dambuza AJA"), ("VAN DER WESTHUIZEN J", "Van der Westhuizen J"), ("Justice O'REGAN J (unanimous)", "O'Regan J"), ("AJA", ""), ("C.K. smith-JONES", "C.K. Smith-Jones"), ("", "")])
def test_judge_name(spark, raw, wanted):
    assert run(spark, names.judge_name, raw) == [wanted]


def test_judges(spark):
    df = spark.createDataFrame([(["DAVIS JP, DAMBUZA AJA and PATEL JA", "[not stated]", "Davis JP"],), (None,)], "v array<string>")
    assert [r[0] for r in df.select(names.judges("v")).collect()] == [["Davis JP", "Dambuza AJA", "Patel JA"], []]


def test_court_name(spark):
    df = spark.createDataFrame([("zacc", None), ("Constitutional Court", None), ("High Court", "ZAGPJHC"), ("COURT OF SOUTH AFRICA", None), (None, "ZALCD"), ("Labour Court, Gqeberha", None), ("Village Tribunal", None), (None, None)], "c string, t string")
    got = [r[0] for r in df.select(names.court_name("c", "t")).collect()]
    assert got == ["Constitutional Court of South Africa", "Constitutional Court of South Africa", "Gauteng High Court, Johannesburg", "Constitutional Court of South Africa", "Labour Court, Durban", "Labour Court, Port Elizabeth", "Village Tribunal", "High Court"]


def test_citations(spark):
    got = run(spark, citations.parse_citation, "VVC v JRM and Others (CCT202/24) [2026] ZACC 2; 2026 (3) BCLR 234 (CC); 2026 (3) SA 1 (CC) (21 January 2026)", "2020 (1) SA 5 (CC)", "", None)
    assert got[0].asDict() == {"raw_citation": "VVC v JRM and Others (CCT202/24) [2026] ZACC 2; 2026 (3) BCLR 234 (CC); 2026 (3) SA 1 (CC) (21 January 2026)", "case_name": "VVC v JRM and Others", "case_number": "CCT202/24", "neutral_citation": "[2026] ZACC 2", "commercial_citations": ["2026 (3) BCLR 234 (CC)", "2026 (3) SA 1 (CC)"], "decision_date": "2026-01-21"}
    assert (got[1]["case_name"], got[1]["commercial_citations"]) == (None, ["2020 (1) SA 5 (CC)"])
    assert got[2]["raw_citation"] == got[3]["raw_citation"] == ""


def test_payload(spark):
    one = lambda make, v: json.loads(run(spark, make, v)[0])
    assert one(lambda c: payload.json_merge(c, F.lit('{"b":2,"c":{"d":1}}')), '{"a":1,"b":1}') == {"a": 1, "b": 2, "c": {"d": 1}}
    assert one(lambda c: payload.json_rename(c, "a", "b"), '{"a":1,"x":2}') == {"b": 1, "x": 2}
    assert one(lambda c: payload.json_rename(c, "a", "b"), '{"a":1,"b":2}') == {"b": 2}
    assert one(lambda c: payload.json_set(c, "m.n", F.lit("v")), '{"m":{"o":1}}') == {"m": {"o": 1, "n": "v"}}
    assert one(lambda c: payload.json_set(c, "k", F.lit(None).cast("string")), '{"m":1}') == {"m": 1, "k": None}
    assert run(spark, lambda c: payload.has_key(c, "a"), '{"a":null}', "{}", None) == [True, False, False]
    df = spark.createDataFrame([(["Case No: 5", "Judge : X", "Case No: 6", "bad"],)], "v array<string>")
    assert df.select(payload.tags_to_map("v")).first()[0] == {"case_no": "6", "judge": "X"}


def test_scrub_struct(spark):
    df = spark.createDataFrame([(("8001015009087", ["1234567890", None]), 5)], "s struct<a:string,l:array<string>>, n int")
    assert tuple(payload.scrub_struct(df).first()) == (("[RSA ID]", ["[BANK/TAX NUMBER]", None]), 5)


def test_small_formats(spark):
    assert run(spark, text.norm_id, "Ab-C d") == ["ab_c_d"]
    assert run(spark, text.to_bool, " TRUE", "no", None) == [True, False, False]
    assert run(spark, text.safe_name, "a/b:c? d.txt") == ["abc d.txt"]
    assert run(spark, lambda c: text.rand_price(c.cast("int")), "1234", None) == ["R 12.34", None]
    assert tuple(run(spark, text.title_parties, "Smith v Jones and Others (12/20) [2020] ZACC 1")[0]) == ("Smith", "Jones and Others")


@pytest.mark.parametrize(
    ("raw", "name", "number", "neutral", "reports"),
    [
        ("Minister of Police v Kunjana (CCT 25/24; CCT 27/24) [2026] ZACC 23", "Minister of Police v Kunjana", "CCT 25/24; CCT 27/24", "[2026] ZACC 23", []),
        ("S v Makwanyane and Another [1995] ZACC 3; 1995 (3) SA 391; 1995 (6) BCLR 665 (CC)", "S v Makwanyane and Another", None, "[1995] ZACC 3", ["1995 (3) SA 391", "1995 (6) BCLR 665 (CC)"]),
        ("2011 (3) SA 164", None, None, None, ["2011 (3) SA 164"]),
        ("[2005] 2 CPLR 303", None, None, None, ["[2005] 2 CPLR 303"]),
        ("X v Y ([2020] 3 SA 5 (CC))", "X v Y", None, None, ["[2020] 3 SA 5 (CC)"]),
        ("X (Pty) Ltd v Y (Case No: 12) [2020] ZASCA 1", "X (Pty) Ltd v Y", "Case No: 12", "[2020] ZASCA 1", []),
        ("X v Y [2020] ZASCA 1 (12/19)", "X v Y", None, "[2020] ZASCA 1", []),
        ("X v Y (in his capacity as trustee 1/20) [2020] ZASCA 1", "X v Y (in his capacity as trustee 1/20)", None, "[2020] ZASCA 1", []),
        ("X v Y 1999 [2] all sa 5 (a), 1999 [2] all sa 5 (a)", "X v Y , " .strip(" ,"), None, None, ["1999 [2] all sa 5 (a)"]),
        ("X v Y12020 (3) SA 1", "X v Y12020 (3) SA 1", None, None, []),
        ("X v Y (16/FN/Mar04) [2004] ZACT 9", "X v Y (16/FN/Mar04)", None, "[2004] ZACT 9", []),
    ],
)
def test_citation_parts(raw, name, number, neutral, reports):
    assert citations.citation_parts(raw) == (name, number, neutral, reports)


def test_citation_dates(spark):
    got = run(spark, citations.parse_citation, "A v B (1/20) (3 May 2020).", "A v B (not a date)", "A (x) (2020-01-31) ; ", "(3 May 2020)", "A v B )", "()")
    assert [(r["case_name"], r["case_number"], r["decision_date"]) for r in got] == [
        ("A v B", "1/20", "2020-05-03"), ("A v B (not a date)", None, None), ("A (x)", None, "2020-01-31"), (None, None, "2020-05-03"), ("A v B )", None, None), (None, None, None),
    ]


def test_clean_text_by_position(spark):
    got = run(spark, text.clean_text, "a lawcite b LawCite c", "LawCites x", "x\n PDF format \ny", "PDF formats", "Heads\nof argument\n\n \n z", "\x0b a \f", None)
    assert got == ["b LawCite c", "LawCites x", "x\n\ny", "PDF formats", "z", "a", ""]
