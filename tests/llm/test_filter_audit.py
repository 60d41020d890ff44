import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import pytest

from loomdocs.llm import queries
from loomdocs.llm.filter_audit import audit_orders, filter_audit, removal_intervals

DOCS = "doc_id long, text string, lang string, part string, words string, n string, good string"
LABELS = "doc_id long, quality int, toxic int, good string"


def brute(docs, labels):
    """Every order walked filter by filter, document by document."""
    good = {d for d, q, _ in labels if q == 1} - {None}
    toxic = {d for d, _, t in labels if t == 1} - {None}
    rows = []
    for d, text, lang in docs:
        text = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", text)
        same = [x for x, t, _ in docs if (t or "") == text and x is not None]
        copy = bool(same) and (d is None or d > min(same))
        fails = {
            "A": len(ws) < 100,
            "B": 100 * len(set(ws)) < 80 * len(ws),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": copy,
        }
        rows.append((lang or "", d, {x for x in fails if fails[x]}))
    out, shapley = [], Counter()
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            alive, gone = [r for r in rows if r[0] == part], []
            for step, x in enumerate(order, 1):
                hit = [r for r in alive if x in r[2]]
                alive = [r for r in alive if x not in r[2]]
                alone = sum(r[2] == {x} for r in rows if r[0] == part)
                out.append([part, "".join(order), step, len(alive), len(hit), sum(x in r[2] for r in gone), alone, sum(r[1] in good for r in hit), sum(r[1] in toxic for r in hit)])
                gone += hit
                shapley[part, x] += len(hit)
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def audited(spark, docs, labels):
    frame = spark.createDataFrame([(*d, "x", "y", "z", "w") for d in docs], DOCS)
    got = filter_audit(frame, spark.createDataFrame([(*x, "g") for x in labels], LABELS))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return sorted(tuple(r) for r in got.collect())


def test_odd_documents_equal_a_walk_through_all_orders(spark):
    words = " ".join(f"w{i}" for i in range(120))
    docs = [
        (1, words, "en"), (2, words, "en"), (3, words, None), (4, words.upper(), "en"), (5, "a " * 150, "de"), (6, "a # b", "de"), (7, None, "de"), (8, "", ""), (9, "", "en"),
        (None, words, "en"), (None, None, None), (None, "only without an id", "fr"), (10, "É" * 9 + "A", "fr"), (10, "É" * 8 + "A", "fr"), (11, words, "en"), (11, words, "en"), (1, words, "en"),
        (12, "\x0b".join(f"x{i}" for i in range(100)), "en"), (13, "long word " * 20_000 + "|", "en"),
    ]
    labels = [(1, 1, 0), (2, None, 1), (2, 1, None), (4, 1, 1), (None, 1, 1), (6, 0, 1), (11, 1, 0), (99, 1, 1)]
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_random_documents_equal_a_walk_through_all_orders(spark):
    rng = random.Random(11)
    docs = [(i, " ".join(rng.choice(["A", "b", "cc", "D#", "e"]) for _ in range(rng.choice([0, 2, 120]))), rng.choice(["x", "y"])) for i in range(60)]
    docs += [(i + 100, docs[i % 7][1], rng.choice(["x", "y"])) for i in range(30)]
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 130, 2)]
    assert audited(spark, docs, labels) == brute(docs, labels)


def test_nothing_to_audit(spark):
    assert audited(spark, [], [(1, 1, 1)]) == []
    assert len(audited(spark, [(1, "a", None)], [])) == 600


@pytest.mark.parametrize("k", [1, 3, 5])
def test_intervals_hold_exactly_the_orders_of_a_mask(k):
    orders = list(permutations(range(k)))
    wanted = set()
    for mask in range(1, 1 << k):
        for rank, order in enumerate(orders):
            step = next(i for i, x in enumerate(order) if mask >> x & 1)
            wanted.add((mask, step + 1, order[step], rank))
    got = [(mask, step, x, rank) for mask, step, x, first, end in removal_intervals(k) for rank in range(first, end)]
    assert len(got) == len(set(got)) and set(got) == wanted


def test_other_numbers_of_filters(spark):
    cells = spark.createDataFrame([("p", 0, 3, 1, 0), ("p", 3, 5, 2, 1), ("p", 3, 1, 0, 0), ("q", 2, 4, 4, 0)], "part string, mask int, n long, good long, toxic long")
    rows = {tuple(r)[:3]: tuple(r)[3:] for r in audit_orders(cells, "XY").collect()}
    assert rows["p", "XY", 1] == (3, 6, 0, 0, 2, 1, 6) and rows["p", "XY", 2] == (3, 0, 6, 0, 0, 0, 6)
    assert rows["q", "YX", 1] == (0, 4, 0, 4, 4, 0, 8) and rows["q", "YX", 2] == (0, 0, 0, 0, 0, 0, 0)
    with pytest.raises(ValueError):
        audit_orders(cells, "YX")


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    result = con.execute(queries.oracle_sql()["op11_filter_audit"])
    got = queries.op11_filter_audit(spark, sf_dir)
    assert sorted(tuple(r) for r in got.select([d[0] for d in result.description]).collect()) == sorted(result.fetchall())
