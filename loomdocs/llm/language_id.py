"""Language identification by prediction by partial matching (operator 9)."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import discard, map_texts, materialize

#: Longest context in bytes.
DEPTH = 4
#: Labelled documents per language that the context trees are fitted on, about; a bounded sample by a hash of the id.
TRAIN_DOCS = 2000
#: Contexts-with-symbol that the trees keep at most: each language's most frequent ones by turns.
MOST_NODES = 750_000
#: Nodes times languages at most, so that the tables of many languages take no more memory than those of 16.
MOST_CELLS = 16 * MOST_NODES
#: Distinct words times languages whose code lengths a worker remembers at most, about; looked up again beyond.
CACHE_CELLS = 800_000
#: Words whose code lengths are computed at once.
NEW_WORDS = 10_000
#: Languages up to which their sampling shares are broadcast; beyond, they are joined by shuffling.
BROADCAST_LANGUAGES = 100_000
UNKNOWN = "und"


def _padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of ' word ' for each word, and where each begins."""
    data = np.frombuffer(b" " + b"  ".join(words) + b" ", np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    return data, np.concatenate([[0], np.cumsum(sizes)])


def _strings(data: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """For each byte the last k bytes up to it as one number; 0 where the word has fewer."""
    place = np.arange(len(data)) - np.repeat(starts[:-1], np.diff(starts))
    key = np.zeros(len(data), np.uint64)
    for back in range(k):
        key[back:] |= data[: len(data) - back].astype(np.uint64) << np.uint64(8 * back)
    key[place < k - 1] = 0
    return key


@dataclass
class ContextTrees:
    """Frozen statistics of all languages' context trees.

    A node is a byte string inside ' word ': its last byte is the symbol, the
    bytes before are the context. symbol_bits has the code length of the symbol
    in that context (infinite if the language never showed it), escape_bits
    that of leaving the node as a context for a shorter one (escape method C).
    Counts of nodes that aren't kept stay in their contexts' totals and kinds:
    such a symbol is coded by an escape, so its count is added to the escape's.
    """

    langs: list[str]
    keys: list[np.ndarray] = field(default_factory=list)
    symbol_bits: list[np.ndarray] = field(default_factory=list)
    escape_bits: list[np.ndarray] = field(default_factory=list)
    root_escape: np.ndarray | None = None
    #: Words that a worker has looked up, and their code lengths: they go when the worker lets go of the trees.
    places: dict[str, int] = field(default_factory=dict)
    bits: np.ndarray | None = None

    @classmethod
    def fit(cls, langs: list[str], counts: dict[int, tuple[np.ndarray, np.ndarray]], whole: dict[int, tuple[np.ndarray, np.ndarray]] | None = None) -> ContextTrees:
        """counts: per string length the sorted keys and a count for each key and language.

        whole: per string length, for each key and language that has it, the
        total and the kinds of symbols of its context among all nodes, kept or not.
        """
        out = cls(langs)
        parents_total: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for k in range(1, DEPTH + 2):
            keys, n = counts.get(k, (np.zeros(0, np.uint64), np.zeros((0, len(langs)))))
            context = keys >> np.uint64(8)
            new = np.ones(len(keys), bool)
            new[1:] = context[1:] != context[:-1]
            at = np.flatnonzero(new)
            totals = np.add.reduceat(n, at, axis=0) if len(at) else np.zeros((0, len(langs)))
            kinds = np.add.reduceat((n > 0).astype(float), at, axis=0) if len(at) else totals
            lost = np.zeros_like(totals)
            if whole and len(at):
                kept = totals
                totals, kinds = (np.maximum.reduceat(x, at, axis=0) for x in whole[k])
                lost = totals - kept
            group = np.cumsum(new) - 1
            with np.errstate(divide="ignore", invalid="ignore"):
                bits = -np.log2(n / (totals + kinds)[group]) if len(keys) else n
                escape = np.where(totals > 0, -np.log2((kinds + lost) / (totals + kinds)), 0.0)
            bits[~np.isfinite(bits)] = np.inf
            out.keys.append(keys)
            out.symbol_bits.append(bits.astype(np.float32))
            parents_total.append((context[at], escape, totals))
        out.root_escape = parents_total[0][1][0] if len(parents_total[0][1]) else np.zeros(len(langs))
        for k in range(1, DEPTH + 2):  # a node of length k is the context of nodes of length k + 1
            escape = np.zeros((len(out.keys[k - 1]), len(langs)), np.float32)
            if k <= DEPTH:
                context, bits, _ = parents_total[k]
                at = np.searchsorted(out.keys[k - 1], context)
                fits = (at < len(out.keys[k - 1])) & (out.keys[k - 1][np.minimum(at, max(0, len(out.keys[k - 1]) - 1))] == context) if len(out.keys[k - 1]) else np.zeros(len(context), bool)
                escape[at[fits]] = bits[fits]
            out.escape_bits.append(escape)
        return out

    def word_bits(self, words: list[bytes]) -> np.ndarray:
        """Code length in bits of each word, per language: from the longest context down, escaping where the symbol is new."""
        data, starts = _padded(words)
        n = len(self.langs)
        found = []
        for k in range(1, DEPTH + 2):
            key, table = _strings(data, starts, k), self.keys[k - 1]
            at = np.searchsorted(table, key)
            at[at == len(table)] = 0
            found.append(np.where(table[at] == key, at, -1) if len(table) else np.full(len(key), -1))
            if k > 1:
                found[-1][key == 0] = -1
        bits, open_ = np.zeros((len(data), n), np.float32), np.ones((len(data), n), bool)
        for k in range(DEPTH + 1, 0, -1):
            at = found[k - 1]
            known = at >= 0
            symbol = np.full((len(data), n), np.inf, np.float32)
            symbol[known] = self.symbol_bits[k - 1][at[known]]
            hit = open_ & np.isfinite(symbol)
            bits[hit] += symbol[hit]
            open_ &= ~hit
            if k > 1:  # the context is the node of length k - 1 that ends one byte earlier
                before = np.concatenate([[-1], found[k - 2][:-1]])
                escape = np.zeros((len(data), n), np.float32)
                known = before >= 0
                escape[known] = self.escape_bits[k - 2][before[known]]
            else:
                escape = np.broadcast_to(self.root_escape.astype(np.float32), (len(data), n))
            bits += np.where(open_, escape, 0)
        bits += np.where(open_, 8, 0)  # never seen at all: one of 256
        first = starts[:-1]
        bits[first] = 0  # the leading space is known
        return np.add.reduceat(bits, first, axis=0) if len(first) else np.zeros((0, n))


def text_bits(trees: ContextTrees, texts: list[str]) -> np.ndarray:
    """Code length of each whole text per language: the sum over its words."""
    if not trees.places or len(trees.places) * len(trees.langs) > CACHE_CELLS:
        trees.places, trees.bits = {}, np.zeros((1, len(trees.langs)))
    memory = trees.places
    split = [t.lower().split() for t in texts]
    new = [w for w in {w for words in split for w in words} if w not in memory]
    tables = [trees.bits]
    for at in range(0, len(new), NEW_WORDS):
        some = new[at : at + NEW_WORDS]
        memory.update(zip(some, range(len(memory) + 1, len(memory) + 1 + len(some)), strict=True))
        tables.append(trees.word_bits([w.encode("utf-8", "surrogatepass") for w in some]))
    table = trees.bits = np.concatenate(tables) if len(tables) > 1 else tables[0]
    out = np.zeros((len(texts), len(trees.langs)))
    for i, words in enumerate(split):
        if words:
            out[i] = table[np.fromiter(map(memory.__getitem__, words), np.int64, len(words))].sum(0)
    return out


def _node_counts(batch: pa.RecordBatch):
    """Count of each node in a batch of labelled texts."""
    by_lang: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
        by_lang.setdefault(lang, []).extend(w.encode("utf-8", "surrogatepass") for w in (text or "").lower().split())
    for lang, words in by_lang.items():
        if not words:
            continue
        data, starts = _padded(words)
        scored = np.ones(len(data), bool)
        scored[starts[:-1]] = False
        for k in range(1, DEPTH + 2):
            key = _strings(data, starts, k)
            keys, n = np.unique(key[scored & (key != 0)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(np.full(len(keys), k, np.int32)), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "k", "key", "n"])


def node_table(labelled: DataFrame, train_docs: int) -> DataFrame:
    """k, key, lang and count n of every node of the sample, and the total and kinds of symbols of its context.

    The sample has about train_docs rows of each language, taken by a hash of the
    id (of the text, if the id is null) against the language's number of rows.
    """
    shares = materialize(labelled.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(train_docs) / F.count("*")).alias("share")), "shares")
    if shares.count() <= BROADCAST_LANGUAGES:  # texts stay where they are read
        shares = F.broadcast(shares)
    place = F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(1_000_000))
    sample = labelled.join(shares, "lang").where(place < F.col("share") * 1_000_000).select("lang", "text")
    nodes = map_texts(sample, _node_counts, "lang string, k int, key long, n long").groupBy("k", "key", "lang").agg(F.sum("n").alias("n"))
    siblings = Window.partitionBy("k", "lang", F.shiftright("key", 8))  # a symbol is a byte: 256 rows at most
    return nodes.withColumns({"total": F.sum("n").over(siblings), "kinds": F.count("*").over(siblings)})


def fit_languages(labelled: DataFrame, train_docs: int = TRAIN_DOCS, most_nodes: int = MOST_NODES) -> ContextTrees:
    """Fit context trees on rows with text and lang, about train_docs of each language.

    Nodes are counted on the cluster; the driver gets most_nodes of them at most
    (MOST_CELLS over the number of languages, if that is less). They are taken by
    their place in their language, most frequent first and contexts before what
    they hold, so a kept node's context is kept. A node that isn't kept still
    counts in its context: see ContextTrees. Every language of a row with text is
    learned.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    nodes = node_table(rows, train_docs)
    # bounded by the sample: train_docs texts of a language
    nodes = nodes.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "k", "key")))
    nodes = materialize(nodes, "nodes")
    langs = sorted(r["lang"] for r in nodes.where(F.col("place") == 1).select("lang").collect())
    if not langs:
        discard(nodes)
        return ContextTrees.fit([], {})
    of_key = nodes.groupBy("k", "key").agg(F.min("place").alias("place"), F.collect_list(F.struct("lang", "n", "total", "kinds")).alias("own"))
    first = of_key.orderBy("place", "k", "key").limit(max(1, min(most_nodes, MOST_CELLS // len(langs))))
    got = first.select("k", "key", F.explode("own").alias("o")).select("k", "key", "o.*").toArrow()
    discard(nodes)
    number = {x: i for i, x in enumerate(langs)}
    lang = np.fromiter((number[x] for x in got["lang"].to_pylist()), np.int64, got.num_rows)
    ks, keys = got["k"].to_numpy(), got["key"].to_numpy().astype(np.uint64)
    counts, whole = {}, {}
    for k in range(1, DEPTH + 2):
        at = np.flatnonzero(ks == k)
        own, row = np.unique(keys[at], return_inverse=True)
        tables = []
        for name in ("n", "total", "kinds"):
            table = np.zeros((len(own), len(langs)))
            table[row, lang[at]] = got[name].to_numpy()[at]
            tables.append(table)
        counts[k], whole[k] = (own, tables[0]), (tables[1], tables[2])
    return ContextTrees.fit(langs, counts, whole)


def predict_languages(docs: DataFrame, trees: ContextTrees, keep: list[str], names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Add the predicted language and its probability (all equally likely beforehand), under `names`, to `keep` columns."""
    source = docs.select(*keep, *(["text"] if "text" not in keep else []))
    shared = docs.sparkSession.sparkContext.broadcast(trees)  # bounded by MOST_NODES and MOST_CELLS

    def score(batch):
        model = shared.value
        texts = batch.column("text").to_pylist()
        n = len(texts)
        pred, best = [UNKNOWN] * n, np.zeros(n)
        asked = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        if asked and model.langs:
            bits = text_bits(model, [texts[i] for i in asked])
            first = bits.argmin(1)
            odds = np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
            for i, lang, s in zip(asked, first, 1 / odds, strict=True):
                pred[i], best[i] = model.langs[lang], s
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(pred, pa.string()), pa.array(best)], [*keep, *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema)
    return map_texts(source, score, f"{fields}, `{names[0]}` string, `{names[1]}` double")


def held_out(id_col: str = "doc_id", folds: int = 5):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == 0, F.lit(False))


def identify_languages(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document.

    Per language a variable-order tree of byte contexts (up to DEPTH bytes,
    inside one lower-cased word with a space before and after it) with escape
    probabilities (method C, without exclusion) gives each word's exact code
    length under frozen statistics. A text's code length is the sum over all its
    words, whatever its length; the shortest wins, ties by name. The trees learn only from documents
    that aren't held out (crc32 of the id as text, modulo 5, is 0) and have a
    lang; text is the only input of a prediction.

    Null, empty and letterless texts get `und` with score 0, and so does every
    text if no row is labelled. Null ids aren't held out. Repeated rows and ids
    keep a row each; an empty table gives no rows; other columns are ignored.
    """
    own = docs.select("doc_id", "text", "lang")
    trees = fit_languages(own.where(~held_out()), train_docs)
    predicted = predict_languages(own, trees, ["doc_id"])
    return predicted.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
