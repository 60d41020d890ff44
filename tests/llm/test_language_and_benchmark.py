import random
import zlib

import numpy as np

from loomdocs.llm.decontamination import Items, common_subsequence, contaminated_documents, item_parts, latent_space
from loomdocs.llm.language_id import ContextTrees, _node_counts, fit_languages, identify_languages, predict_languages

STEMS = {"aa": ["mola", "tirra", "vano", "sule"], "bb": ["krcht", "schtz", "grmpf", "wlk"], "cc": ["uoiea", "aeiou", "ouoi", "iaeu"]}


def texts(n, seed=0):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(STEMS))
        rows.append((i, " ".join(rng.choice(STEMS[lang]) + rng.choice("abcde") for _ in range(30)), lang, "src", 1.0))
    return rows


DOCS = "doc_id long, text string, lang string, source string, score double"


def test_held_out_accuracy(spark):
    rows = texts(300) + [(1000, None, "aa", "s", 0.0), (1001, "123 ... 99", "aa", "s", 0.0), (1002, "mola tirra", None, None, 0.0), (1003, "", "bb", "s", 0.0), (None, "krchta", "bb", "s", 0.0)]
    got = {r["doc_id"]: r for r in identify_languages(spark.createDataFrame(rows, DOCS)).collect()}
    assert len(got) == len(rows)
    own = [(got[d], lang) for d, _, lang, *_ in rows if d is not None and d < 300 and got[d]["held_out"]]
    assert len(own) > 30 and np.mean([r["lang_pred"] == lang for r, lang in own]) > 0.98
    assert [(got[d]["lang_pred"], got[d]["score"]) for d in (1000, 1001, 1003)] == [("und", 0.0)] * 3
    assert got[1002]["lang_pred"] == "aa" and 0 <= got[1002]["score"] <= 1


def test_no_labels_and_no_rows(spark):
    rows = [(1, "mola", None, "s", 0.0)]
    assert [r["lang_pred"] for r in identify_languages(spark.createDataFrame(rows, DOCS)).collect()] == ["und"]
    assert identify_languages(spark.createDataFrame([], DOCS)).collect() == []


def test_code_lengths_are_those_of_the_tree(spark):
    """word_bits against a plain walk down the contexts."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"lang": ["x", "y"], "text": ["abra cadabra abracadabra", "xyz abx"]})
    counts = {}
    for part in _node_counts(batch):
        for lang, k, key, n in zip(*[c.to_pylist() for c in part.columns], strict=True):
            counts.setdefault(k, {}).setdefault(key, {})[lang] = n
    table = {k: (np.array(sorted(v), np.uint64), np.array([[v[x].get(lang, 0) for lang in "xy"] for x in sorted(v)], float)) for k, v in counts.items()}
    trees = ContextTrees.fit(["x", "y"], table)

    def plain(word, lang):
        total, padded = 0.0, b" " + word + b" "
        for i in range(1, len(padded)):
            for size in range(min(i, 4), -1, -1):
                context = padded[i - size : i]
                children = {}
                for key, n in counts.get(size + 1, {}).items():
                    raw = key.to_bytes(size + 1, "big")
                    if raw[:-1] == context and n.get(lang):
                        children[raw[-1]] = n[lang]
                if not children:
                    continue
                n, kinds = sum(children.values()), len(children)
                if padded[i] in children:
                    total -= np.log2(children[padded[i]] / (n + kinds))
                    break
                total -= np.log2(kinds / (n + kinds))
            else:
                total += 8
        return total

    words = [b"abra", b"zebra", b"q", b"abx"]
    assert np.allclose(trees.word_bits(words), [[plain(w, lang) for lang in "xy"] for w in words], atol=1e-3)


def test_every_language_keeps_nodes_of_every_length(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(40)), "big", "s", 1.0) for i in range(400)]
    rows += [(1000 + i, "quorxy vintzop zypolm", "small", "s", 1.0) for i in range(4)]
    trees = fit_languages(spark.createDataFrame(rows, DOCS), most_nodes=200)
    small = trees.langs.index("small")
    assert [int(np.isfinite(x[:, small]).sum()) >= 10 for x in trees.symbol_bits] == [True] * 5
    assert sum(len(k) for k in trees.keys) == 200


def plain_bits(word, counts, kept):
    """Code length of one word by walking down the contexts; counts: of all strings of a language, kept: those the tree has."""
    total, padded = 0.0, b" " + word + b" "
    for i in range(1, len(padded)):
        for size in range(min(i, 4), -1, -1):
            context = padded[i - size : i]
            children = {c: n for c, n in ((x[-1:], n) for x, n in counts.items() if x[:-1] == context)}
            own = {c: n for c, n in children.items() if context + c in kept}
            if not own:
                continue
            n, kinds = sum(children.values()), len(children)
            symbol = padded[i : i + 1]
            if symbol in own:
                total -= np.log2(own[symbol] / (n + kinds))
                break
            total -= np.log2((kinds + n - sum(own.values())) / (n + kinds))
        else:
            total += 8
    return total


def plain_counts(rows):
    counts = {}
    for _, text, lang, *_ in rows:
        for w in text.lower().encode().split():
            padded = b" " + w + b" "
            for i in range(1, len(padded)):
                for size in range(1, min(i + 1, 5) + 1):
                    x = padded[i - size + 1 : i + 1]
                    counts.setdefault(lang, {})[x] = counts.setdefault(lang, {}).get(x, 0) + 1
    return counts


def test_predictions_equal_brute_force(spark):
    rows = texts(40, seed=3) + [(2000, "mola krchta uoieab", "aa", "s", 0.0), (2001, "q Zz mol\u00e9", "bb", "s", 0.0)]
    df = spark.createDataFrame(rows, DOCS)
    trained = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5]
    counts = plain_counts(trained)
    memory = {}
    for d, lang_pred, score in [(r["doc_id"], r["lang_pred"], r["score"]) for r in identify_languages(df).collect()]:
        text = next(r[1] for r in rows if r[0] == d)
        bits = {}
        for lang, own in counts.items():
            for w in text.lower().encode().split():
                if (w, lang) not in memory:
                    memory[w, lang] = plain_bits(w, own, own)
                bits[lang] = bits.get(lang, 0) + memory[w, lang]
        least = min(bits.values())
        assert bits[lang_pred] - least < 1e-3
        assert abs(score - 1 / sum(2 ** max(-1000, least - b) for b in bits.values())) < 1e-3


def test_pruned_nodes_stay_in_their_contexts_counts(spark):
    rows = texts(30, seed=4)
    counts = plain_counts(rows)
    trees = fit_languages(spark.createDataFrame(rows, DOCS), most_nodes=90)
    kept = {int(key).to_bytes(k + 1, "big") for k, keys in enumerate(trees.keys) for key in keys}
    assert len(kept) == 90 and all(x[:-1] in kept for x in kept if len(x) > 1)
    words = [b"molaa", b"krchtz", b"uoi", b"zebra", b"tirrae"]
    wanted = [[plain_bits(w, counts[lang], kept) for lang in trees.langs] for w in words]
    assert np.allclose(trees.word_bits(words), wanted, atol=1e-3)


def test_many_languages_all_are_learned(spark):
    rows = [(i, f"w{i}x{i * 7}y " * 3, f"l{i:03}", "s", 1.0) for i in range(400)]
    trees = fit_languages(spark.createDataFrame(rows, DOCS))
    assert trees.langs == sorted(r[2] for r in rows)
    long = [(0, rows[7][1] * 20_000, "l007", "s", 1.0)]
    assert [r["lang_pred"] for r in predict_languages(spark.createDataFrame(long, DOCS), trees, ["doc_id"]).collect()] == ["l007"]


def test_null_ids_are_sampled_like_others(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(None, f"{a}{b} QQQQQ", "aa", "s", 1.0) for a in letters for b in letters]
    trees = fit_languages(spark.createDataFrame(rows, DOCS), train_docs=100)
    assert 80 < len(trees.keys[1]) < 250  # pairs of letters, and 52 of a letter and a space


def test_prediction_keeps_columns(spark):
    df = spark.createDataFrame(texts(30), DOCS)
    assert predict_languages(df, fit_languages(df), ["doc_id", "text"]).columns == ["doc_id", "text", "lang_pred", "score"]


def test_common_subsequence():
    def plain(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randrange(1, 6) for _ in range(rng.randrange(1, 20))] for _ in range(2))
        masks = {}
        for i, x in enumerate(a):
            masks[x] = masks.get(x, 0) | 1 << i
        assert common_subsequence(masks, len(a), b) == plain(a, b)


def test_contaminated_documents(spark):
    rng = random.Random(8)
    vocabulary = [f"term{i}" for i in range(3000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=30))) for i in range(20)] + [(20, None), (21, ""), (22, "..")]
    docs = [(i, " ".join(rng.choices(vocabulary, k=200)), 1.0) for i in range(200)]
    wanted = set()
    for i in range(20):
        w = docs[i][1].split()
        item = items[i][1].split()
        if i % 2:
            item[3], item[9] = "other", "words"  # a light paraphrase
        docs[i] = (i, " ".join(w[: i * 8] + item + w[i * 8 :]), 1.0)
        wanted.add((i, i))
    docs += [(300, None, 0.0), (301, "", 0.0), (302, items[4][1].upper(), 0.0), (302, items[4][1].upper(), 0.0)]
    wanted.add((302, 4))
    got = contaminated_documents(spark.createDataFrame(docs, "doc_id long, text string, cosine double"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == wanted
    assert contaminated_documents(spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect() == []
    assert contaminated_documents(spark.createDataFrame(docs, "doc_id long, text string, cosine double"), spark.createDataFrame([], "item_id long, text string")).collect() == []


def test_copies_of_short_and_long_items(spark):
    rng = random.Random(4)
    weights = [1 / (i + 3) for i in range(6000)]
    vocabulary = [f"term{i}" for i in range(6000)]
    sizes = [1000, 300, 250, 65, 48, 15, 12, 10, 8, 5] * 4
    items = [(i, " ".join(rng.choices(vocabulary, weights, k=n))) for i, n in enumerate(sizes)]
    docs = [(i, " ".join(rng.choices(vocabulary, weights, k=500))) for i in range(120)]
    for i in range(len(sizes)):
        w = docs[i][1].split()
        docs[i] = (i, " ".join([*w[: i * 7], items[i][1], *w[i * 7 :]]))
    got = contaminated_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    shares = {(r["doc_id"], r["item_id"]): r["lcs_share"] for r in got.collect()}
    assert [(i, sizes[i]) for i in range(len(sizes)) if shares.get((i, i)) != 1.0] == []
    assert [pair for pair in shares if pair[0] != pair[1] and sizes[pair[1]] > 24] == []


def test_changed_copies_of_every_length_are_found(spark):
    """All pairs by brute force: what is found has the share, and every planted copy with share and answer is found."""

    def lcs(a, b):
        masks = {}
        for i, x in enumerate(a):
            masks[x] = masks.get(x, 0) | 1 << i
        return common_subsequence(masks, len(a), b) / len(a)

    rng = random.Random(12)
    vocabulary = [f"term{i}" for i in range(2500)]
    weights = [1 / (i + 3) for i in range(2500)]
    draw = lambda n: rng.choices(vocabulary, weights, k=n)
    cases = [(n, changed) for n in (8, 14, 20, 26, 30, 34, 38, 48, 60, 64, 65, 80, 130, 200, 600) for changed in (0.0, 0.18, 0.3, 0.38)]
    items = [draw(n) for n, _ in cases]
    docs, planted = [], set()
    for i, (n, changed) in enumerate(cases):
        copy = list(items[i])
        for at in rng.sample(range(n - 5), min(n - 5, int(changed * n))):
            copy[at] = draw(1)[0] if at % 2 else f"{copy[at]} {draw(1)[0]}"  # another word, or one more
        copy = " ".join(copy).split()
        if lcs(items[i], copy) >= 0.6:
            planted.add((i, i))
        docs.append([*draw(i * 3), *copy, *draw(150)])
    docs += [draw(300) for _ in range(60)]
    table = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string").repartition(3)
    got = {(r["doc_id"], r["item_id"]) for r in contaminated_documents(table, spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")).collect()}
    assert len(planted) > 55 and planted - got == set()
    assert {(d, i) for d, i in got if lcs(items[i], docs[d]) < 0.6} == set()
    assert {(d, i) for d, i in got - planted if len(items[i]) > 20} == set()


def test_parts_of_items_cover_them():
    for n in range(1, 400):
        parts = item_parts(n)
        assert [a for a, _ in parts[1:]] == [b for _, b in parts[:-1]] and parts[0][0] == 0 and parts[-1][1] == n and all(0 < b - a <= 64 for a, b in parts)


def test_latent_space_is_that_of_all_passages(spark):
    """The leading direction against the whole cross product, on more documents than any sample had."""
    rng = np.random.default_rng(3)
    rows = rng.choice(6, (25_000, 5), p=[0.3, 0.25, 0.2, 0.12, 0.08, 0.05]).astype("<u4") + 1
    idf = np.array([0, 1.0, 1.2, 1.4, 1.7, 2.0, 2.4])
    items = Items([1], np.arange(1, 7, dtype=np.uint64), [np.arange(1, 7, dtype=np.uint32)])
    table = spark.createDataFrame([(i, bytearray(r.tobytes())) for i, r in enumerate(rows)], "doc_id long, terms binary")
    a = np.stack([(rows == t).sum(1) for t in range(7)], axis=1) * idf
    item = np.array([0, 1, 1, 1, 1, 1, 1]) * idf
    first = np.linalg.eigh(a.T @ a + len(rows) * np.outer(item, item))[1][:, -1]
    got = latent_space(table, items, idf)[:, 0]
    assert np.allclose(got * np.sign(got @ first), first, atol=2e-5)


def test_remembered_words_are_bounded_and_go_with_the_trees(monkeypatch):
    import gc
    import weakref

    from loomdocs.llm import language_id

    rows = [f"{a}{b} {b}{a}" for a in STEMS["aa"] for b in STEMS["cc"]]
    trees = ContextTrees.fit(["x"], {k: (np.unique(v), np.ones((len(np.unique(v)), 1))) for k, v in ((k, language_id._strings(*language_id._padded([r.encode() for r in rows]), k)) for k in range(1, 6))})
    whole = language_id.text_bits(trees, rows)
    monkeypatch.setattr(language_id, "CACHE_CELLS", 5)
    assert np.array_equal(np.concatenate([language_id.text_bits(trees, [r]) for r in rows]), whole)
    assert len(trees.places) <= 5 + 2
    held = weakref.ref(trees.bits)
    del trees
    gc.collect()
    assert held() is None
