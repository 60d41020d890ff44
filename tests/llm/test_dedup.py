import hashlib
import random
import re

from loomdocs.llm.components import connected_components
from loomdocs.llm.jaccard_join import shingle_components
from loomdocs.llm.substring_dedup import remove_repeated_windows

DOCS = "doc_id long, text string, size long, label string, anchor string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["The", "the", "É"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([0, 2, 4, 5, 12, 13, 14, 40, 120]))) for _ in range(n)]
    passage = " ".join(rng.choices(vocabulary, k=30))
    for i in range(0, n, 3):
        near = words(texts[i])
        if len(near) > 20:
            near[rng.randrange(len(near))] = "changed"
        texts.append("\n ".join(near))
        texts.append(texts[i] + "\t" + passage + " end " + str(i))
    texts += [None, "", "   ", "a a a a a a a a a a a a a a a a", texts[5], texts[5], "x " * 3000, "x " * 2990]
    return [(i, t, 0, "l", "a") for i, t in enumerate(texts)] + [(3, texts[3], 0, "l", "a"), (None, texts[7], 0, "l", "a")]


def test_windows_equal_brute_force(spark):
    rows = corpus(1)
    first = {}
    for d, t, *_ in rows:
        w = words(t)
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    wanted = []
    for d, t, *_ in rows:
        w = words(t)
        gone = set()
        for i in range(len(w) - 12):
            if d is not None and first[tuple(w[i : i + 13])] < d:
                gone |= set(range(i, i + 13))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        wanted.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    got = [tuple(r) for r in remove_repeated_windows(spark.createDataFrame(rows, DOCS)).collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)


def test_hot_anchors_give_the_same(spark, monkeypatch):
    from loomdocs.llm import substring_dedup

    rows = corpus(2)
    df = spark.createDataFrame(rows, DOCS)
    wanted = sorted((tuple(r) for r in remove_repeated_windows(df).collect()), key=str)
    monkeypatch.setattr(substring_dedup, "HOT_ANCHOR", 3)
    monkeypatch.setattr(substring_dedup, "SHARD_BYTES", 500)
    assert sorted((tuple(r) for r in remove_repeated_windows(df).collect()), key=str) == wanted


def test_nothing_to_dedup(spark):
    empty = spark.createDataFrame([], DOCS)
    assert remove_repeated_windows(empty).collect() == []
    assert shingle_components(empty).collect() == []


def shingle_set(text):
    w = words((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else (tuple(w[i : i + 5]) for i in range(len(w) - 4)))


def test_components_equal_brute_force(spark):
    rows = [r for r in corpus(3) if r[0] is not None]
    base = words(rows[20][1] or "") or [f"q{i}" for i in range(100)]
    rng = random.Random(5)
    for i in range(40):  # a group of near copies, some only linked through others
        copy = [f"q{j}" for j in range(100)]
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(100)] = f"z{i}"
        rows.append((1000 + i, " ".join(copy), 0, "", ""))
    sets = {}
    for d, t, *_ in rows:
        sets[d] = shingle_set(t)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = list(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    got = {tuple(r) for r in shingle_components(spark.createDataFrame(rows, DOCS)).collect()}
    assert got == {(d, len(s), root(d)) for d, s in sets.items()}
    assert base


def test_null_ids(spark):
    rows = [(None, "a b c d e f", 0, "", ""), (4, "a b c d e f", 0, "", ""), (None, "alone in the whole wide world", 0, "", "")]
    got = sorted((tuple(r) for r in shingle_components(spark.createDataFrame(rows, DOCS)).collect()), key=str)
    assert got == [(4, 2, 4), (None, 2, 4), (None, 2, None)]


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, x) for x in range(101, 140)] + [(5, 5), (200, 150)]
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 31)} | {i: 100 for i in range(100, 140)} | {150: 150, 200: 150}
