import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from loomdocs.llm import queries
from loomdocs.llm.prefix_trie import conversation_trie, ends_digests, subtree_sums

ROWS = "conv_id long, turn long, role string, text string, node string, depth string, part string, pos string"


def brute(rows):
    """Rebuilt conversations as plain tuples, every prefix with its members."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    def subtree(path):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        leaves, saved = int(not children[path]), (len(members[path]) - 1) * words
        for child in list(children[path]):
            a, b = totals[child]
            leaves, saved = leaves + a, saved + b
        return leaves, saved

    totals = {}
    for path in sorted(members, key=len, reverse=True):
        totals[path] = subtree(path)
    out = []
    for path, own_ids in members.items():
        ends = ",".join(str(c) for c in own_ids if built[c] == path)
        parent = min(members[path[:-1]]) if path else None
        out.append((min(own_ids), len(path), parent, len(own_ids), len(children[path]), *totals[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], ROWS)
    got = conversation_trie(frame, **more)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_odd_conversations_equal_brute_force(spark):
    rows = [
        (0, 1, "user", "hello you"), (0, 0, "system", "be kind"), (0, None, None, None), (1, 0, "user", "a b c"), (1, 0, "user", "a b c"), (1, 0, None, "z"), (2, 5, "user", ""), (2, 6, "user", None),
        (-7, 0, "user", "x"), (-7, 1, "bot", "y"), (-20, 0, "user", "negative base"), (-25, 3, "u", "v"), (45, 0, "user", "no base here"), (None, 0, "user", "nobody's"), (None, None, None, None),
        (20, 0, "us", "erx"), (21, 0, "use", "rx"), (22, 0, "us", "erx"), (2**62, 0, "user", "large id"), (23, 0, "user", "word \t" * 40_000),
    ]
    assert trie(spark, rows) == brute(rows)


@pytest.mark.parametrize("band", [2, 3, 8])
def test_random_conversations_equal_brute_force(spark, band):
    rng = random.Random(band)
    rows = [(c, t, rng.choice(["u", "b"]), rng.choice(["x", "y z", ""])) for c in rng.sample(range(-30, 300), 90) for t in range(rng.choice([1, 2, 3, 9, 30]))]
    deep = [(t, rng.choice(["u", "b"]), rng.choice(["x", "y"])) for t in range(150)]
    rows += [(c, *turn) for c in (400, 401, 402, 403) for turn in deep[: 150 - c % 3 * 40]]
    rows += [(c, 0, "u", "the same") for c in range(1000, 1100)]
    assert trie(spark, rows, band=band) == brute(rows)


def test_no_conversations(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 0, "a", "b")]) == []


def test_bands_bound_the_rows_of_a_long_path(spark):
    """A path of 600 nodes: every node's sum is what stands below it."""
    n = 600
    path = spark.range(n).select(F.lit("c").alias("conv"), F.col("id").alias("depth"), F.col("id").cast("string").alias("node"))
    nodes = path.select("node", "depth", F.col("conv").alias("rep"), F.lit(1).cast("long").alias("one"))
    got = {int(r["node"]): r["one"] for r in subtree_sums(nodes, path, ["one"], 4).collect()}
    assert got == {i: n - i for i in range(n)}


def test_ends_of_a_frequent_node(spark):
    ids = list(range(5000, 0, -1))
    frame = spark.createDataFrame([(b"n", i) for i in ids] + [(b"m", -3), (b"m", 12), (b"m", 2)], "node binary, conv_id long")
    got = {bytes(r["node"]): r["ends_sha256"] for r in ends_digests(frame).collect()}
    assert got == {b"n": hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest(), b"m": hashlib.sha256(b"-3,2,12").hexdigest()}


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{sf_dir}/conversations.parquet')")
    result = con.execute(queries.oracle_sql()["op12_prefix_trie"])
    got = queries.op12_prefix_trie(spark, sf_dir)
    assert sorted((tuple(r) for r in got.select([d[0] for d in result.description]).collect()), key=str) == sorted(result.fetchall(), key=str)
