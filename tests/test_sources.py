"""External databases, JSON arrays, and the gram index."""

import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from loomdocs.operators import aggregates, filters, joins
from loomdocs.operators.substrings import candidates, read_gram_index, substring_pairs, write_gram_index
from loomdocs.sources import io


def test_jdbc_reads_in_partitions_and_pushes_filters(spark, tmp_path):
    spark._jvm.System.setProperty("derby.stream.error.file", f"{tmp_path}/derby.log")
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    rows = spark.range(100).select("id", (F.col("id") % 7).alias("kind"), F.concat(F.lit("name "), "id").alias("name"))
    io.write_jdbc_table(rows.coalesce(2), url, "things", "name VARCHAR(40)", **driver)
    read = io.read_jdbc_tables(spark, url, {"things": ("id", 0, 100)}, 5, **driver)["things"]
    assert read.rdd.getNumPartitions() == 5
    assert [len(p) for p in read.select("id").rdd.glom().collect()] == [20] * 5
    some = read.where("kind = 3 AND id < 50").select("name")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(kind,3)" in plan and "LessThan(id,50)" in plan and "ReadSchema: struct<name:string>" in plan
    assert {r["name"] for r in some.collect()} == {f"name {i}" for i in range(3, 50, 7)}


def test_json_arrays(spark, tmp_path):
    rows = spark.createDataFrame([(i, None if i == 3 else f"v{i}") for i in range(25)], "place long, v string")
    io.write_json_arrays(rows, f"{tmp_path}/a", "place", 10)
    read = io.read_catalog(spark, f"{tmp_path}/a/*", "place long, v string")
    assert sorted((r["place"], r["v"] or "") for r in read.collect()) == [(i, "" if i == 3 else f"v{i}") for i in range(25)]
    assert read.select("catalog_file").distinct().count() == 3


def test_substring_pairs_equal_a_comparison_of_all(spark):
    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("abé ") for _ in range(rng.randint(0, n)))
    needles, hays = [word(4) for _ in range(60)] + [None], [word(12) for _ in range(60)] + [None, "abc"]
    got = substring_pairs(spark.createDataFrame([(x,) for x in needles], "needle string"), spark.createDataFrame([(x,) for x in hays], "hay string")).collect()
    wanted = {(n, h) for n, h in product(needles, hays) if n and h is not None and n in h}
    assert len(got) == len(wanted) and {tuple(r) for r in got} == wanted


def old_types(triple, lookup):
    keys = sorted(lookup)
    for value in triple:
        if not value:
            continue
        low = value.strip().lower()
        norm = low.replace(" ", "_").replace("-", "_")
        for test in (lambda k: k == low, lambda k, norm=norm: k == norm, lambda k: k != "" and (k in low or low in k)):
            hit = next((t for _, k, t in keys if k is not None and test(k)), None)
            if hit is not None:
                return hit
    return triple[2] or triple[0] or "Unknown"


def test_scraper_types_of_many_keys(spark):
    rng = random.Random(8)
    name = lambda: "".join(rng.choice("abcdefg_") for _ in range(rng.randint(3, 9)))
    lookup = [(i, name(), f"t{i}") for i in range(10_000)] + [(10_000, "", "empty"), (10_001, None, "null")]
    value = lambda: rng.choice([None, "", "  ", name(), name().upper(), f" x {name()} y ", name()[:3], rng.choice(lookup)[1] or "q", "zzz-QQ"])
    triples = [(value(), value(), value()) for _ in range(150)]
    rec = spark.createDataFrame([(i, *t) for i, t in enumerate(triples)], "id int, record_type string, target_name string, entity_name string")
    got = joins.resolve_scraper_type(rec, spark.createDataFrame(lookup, "place int, key string, scraper_type string")).select("id", "scraper_type").collect()
    assert {r["id"]: r["scraper_type"] for r in got} == {i: old_types(t, lookup) for i, t in enumerate(triples)}
    assert len(got) == len(triples)


@pytest.fixture(scope="module")
def records(spark, tmp_path_factory):
    rng = random.Random(4)
    word = lambda: rng.choice(["Court", "appeal", "Éire", "oF", "zz", "xyz", "", None])
    rows = [(i, word(), word(), rng.choice("ab"), f"{word()} {word()}\n{word()} order {i}") for i in range(300)]
    rec = spark.createDataFrame(rows, "id int, target_name string, entity_name string, record_type string, full_text string")
    path = str(tmp_path_factory.mktemp("index"))
    write_gram_index(rec, f"{path}/names", ["target_name", "entity_name", "record_type"])
    aggregates.index_headings(rec, f"{path}/edges", 12)
    return rec, read_gram_index(spark, f"{path}/names"), read_gram_index(spark, f"{path}/edges")


@pytest.mark.parametrize("q", ["court", "OURT", "éire", "xyz", "appeals", "of", "z", "", None, "nothing"])
def test_search_by_index_equals_the_scan(records, q):
    rec, names, _ = records
    assert sorted(filters.search_by_index(rec, names, q, record_type="a").collect()) == sorted(filters.search_records(rec, q, record_type="a").collect())


def test_index_names_few_candidates(records):
    rec, names, _ = records
    assert candidates(names, "co") is None
    found = candidates(names, "xyzcourt")  # no record has all its grams
    assert found.count() == 0
    assert candidates(names, "xyz").count() == rec.where("target_name = 'xyz' or entity_name = 'xyz'").count() < 150


@pytest.mark.parametrize("heading", ["Court", "appeal", "order", "Éire", "zz", "oF a", "x+z"])
def test_heading_search_by_index_equals_the_scan(records, heading):
    rec, _, edges = records
    assert tuple(aggregates.heading_search_by_index(rec, edges, heading, 12).first()) == tuple(aggregates.heading_search(rec, heading, 12).first())
