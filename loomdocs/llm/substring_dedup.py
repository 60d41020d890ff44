"""Removal of repeated word windows by compressed FM-indexes (operator 2)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import chunks, discard, map_texts, materialize, small_batches, tasks_for
from ._words import gram_hashes, mix, whole_grams, words_of

#: Words of an anchor: a window's anchor is its anchor-sized gram with the least hash.
ANCHOR = 5
#: Windows of a segment at most.
SEGMENT = 64
#: Bytes of text of an index shard, about.
SHARD_BYTES = 1_500_000
#: An anchor in more documents than this has its windows dealt out one by one.
HOT_ANCHOR = 20_000
#: Segments that a task remembers at most.
SEEN_SEGMENTS = 500_000


def _window_anchors(hashes: np.ndarray, row_offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Start of each whole window, and its anchor: equal windows have equal anchors."""
    grams = gram_hashes(hashes, ANCHOR)
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    least, span = grams, 1
    wanted = width - ANCHOR + 1
    while span < wanted:
        step = min(span, wanted - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    starts = np.flatnonzero(whole_grams(row_offsets, width, len(hashes)))
    return starts, least[starts]


def _emit_anchors(batch: pa.RecordBatch, width: int):
    words = words_of(batch.column("text"))
    starts, anchors = _window_anchors(words.hashes(), words.row_offsets, width)
    rows = np.searchsorted(words.row_offsets, starts, side="right") - 1
    new = np.ones(len(starts), bool)  # neighbours mostly share an anchor
    new[1:] = (anchors[1:] != anchors[:-1]) | (rows[1:] != rows[:-1])
    yield pa.RecordBatch.from_arrays([pa.array(anchors[new].astype(np.int64)), batch.column("doc_id").take(pa.array(rows[new]))], ["anchor", "doc_id"])


def shared_anchors(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, anchors and hot_anchors: those of the document that other documents have too."""
    emitted = map_texts(docs.where("doc_id is not null").select("doc_id", "text"), lambda b: _emit_anchors(b, width), "anchor long, doc_id long")
    same = Window.partitionBy("anchor")
    seen = emitted.withColumns({"low": F.min("doc_id").over(same), "high": F.max("doc_id").over(same), "n": F.count("*").over(same)}).where("low < high")
    hot = F.col("n") > HOT_ANCHOR
    return seen.groupBy("doc_id").agg(F.collect_set(F.when(~hot, F.col("anchor"))).alias("anchors"), F.collect_set(F.when(hot, F.col("anchor"))).alias("hot_anchors"))


def _emit_segments(batch: pa.RecordBatch, width: int, seen: dict[int, int]):
    """Runs of windows under one shared anchor; hot anchors' windows one by one.

    A segment's text comes along only where this task hasn't had it under an
    id as small (`seen`), so frequent segments are moved once per task.
    """
    words = words_of(batch.column("text"))
    hashes = words.hashes()
    starts, anchors = _window_anchors(hashes, words.row_offsets, width)
    rows = np.searchsorted(words.row_offsets, starts, side="right") - 1
    wanted, is_hot = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    bounds = np.searchsorted(rows, np.arange(batch.num_rows + 1))
    for column, flag in (("anchors", wanted), ("hot_anchors", is_hot)):
        lists = batch.column(column)
        for i in range(batch.num_rows):
            own = lists[i].values
            if own is not None and len(own):
                a, b = bounds[i], bounds[i + 1]
                flag[a:b] = np.isin(anchors[a:b], own.to_numpy(zero_copy_only=False).astype(np.uint64))
    at = np.flatnonzero(wanted | is_hot)
    if not len(at):
        return
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (anchors[at[1:]] != anchors[at[:-1]]) | (rows[at[1:]] != rows[at[:-1]]) | is_hot[at[1:]]
    heads = np.flatnonzero(new)
    place = np.arange(len(at)) - np.repeat(heads, np.diff(np.append(heads, len(at))))
    new |= place % SEGMENT == 0
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(at)))
    first = at[heads]
    begin = starts[first]
    raw = hashes.tobytes()
    last = begin + sizes + width - 2
    ids = np.array([int.from_bytes(hashlib.blake2b(raw[a * 8 : (b + 1) * 8], digest_size=8).digest(), "little", signed=True) for a, b in zip(begin.tolist(), last.tolist(), strict=True)], np.int64)
    key = np.where(is_hot[first], ids.view(np.uint64), anchors[first])
    row = rows[first]
    documents = batch.column("doc_id").to_numpy()[row]
    text = words.data.tobytes()
    content: list[bytes | None] = []
    if len(seen) > SEEN_SEGMENTS:
        seen.clear()
    for segment, document, a, b in zip(ids.tolist(), documents.tolist(), words.starts[begin].tolist(), words.ends[last].tolist(), strict=True):
        known = seen.get(segment)
        if known is not None and known <= document:
            content.append(None)
        else:
            seen[segment] = document
            content.append(text[a:b])
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids), pa.array(mix(key).astype(np.int64)), pa.array(documents), batch.column("row_key").take(pa.array(row)), pa.array((begin - words.row_offsets[row]).astype(np.int32)), pa.array(content, pa.binary())],
        ["segment", "key", "doc_id", "row_key", "start", "words"],
    )


class WaveletMatrix:
    """Rank queries over a sequence of symbols: one packed bit vector per bit of a symbol."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.n = len(symbols)
        self.depth = max(1, int(n_symbols - 1).bit_length())
        self.bits, self.ranks, self.zeros = [], [], []
        now = symbols
        for level in range(self.depth - 1, -1, -1):
            bit = (now >> level) & 1
            packed = np.packbits(np.append(bit.astype(np.uint8), np.zeros(64 - self.n % 64, np.uint8)), bitorder="little").view(np.uint64)
            self.bits.append(packed)
            self.ranks.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed))]).astype(np.int32))
            self.zeros.append(int(self.n - bit.sum()))
            now = np.concatenate([now[bit == 0], now[bit == 1]])
        self.starts = self._down(np.arange(n_symbols), np.zeros(n_symbols, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (bits, ranks, zeros) in enumerate(zip(self.bits, self.ranks, self.zeros, strict=True)):
            word, inside = at >> 6, (at & 63).astype(np.uint64)
            ones = ranks[word] + np.bitwise_count(bits[word] & ((np.uint64(1) << inside) - np.uint64(1)))
            at = np.where((symbols >> (self.depth - 1 - level)) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each place."""
        return self._down(symbols, at) - self.starts[symbols]


class FMIndex:
    """FM-index of a text of symbols, for patterns of up to `width` symbols.

    Suffixes are sorted by their first `width` symbols at least, which is all
    that backward search for such patterns relies on.
    """

    def __init__(self, text: np.ndarray, n_symbols: int, width: int):
        self.text, n = text, len(text)
        rank, span = text.astype(np.int64), 1
        while span < width:
            ahead = np.concatenate([rank[span:] + 1, np.zeros(min(span, n), np.int64)])
            _, rank = np.unique(rank * (n + n_symbols + 2) + ahead, return_inverse=True)
            span *= 2
        self.order = np.argsort(rank, kind="stable")
        self.bwt = WaveletMatrix(text[self.order - 1], n_symbols)
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n_symbols))])[:-1]

    def intervals(self, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Suffix interval of text[s : s + width] for each s, by backward search from its last symbol."""
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(self.text), np.int64)
        for back in range(width - 1, -1, -1):
            symbol = self.text[starts + back]
            ends = self.bwt.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
            low, high = self.before[symbol] + ends[: len(starts)], self.before[symbol] + ends[len(starts) :]
        return low, high


def _least(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Least value in each interval, by a table of powers of two."""
    out = np.empty(len(low), values.dtype)
    power = np.frexp((high - low).astype(float))[1] - 1
    table, span = values, 1
    for p in range(int(power.max(initial=0)) + 1):
        at = power == p
        out[at] = np.minimum(table[low[at]], table[high[at] - span])
        if len(table) > span:
            table = np.minimum(table[:-span], table[span:])
        span *= 2
    return out


def first_documents(segments: pa.Array, documents: np.ndarray, width: int) -> list[np.ndarray]:
    """For each window of each segment (text) the least document in which its words start.

    Segments are joined with separators and indexed; each
    window's words are searched backwards, so that its matching statistic
    reaches `width` in the interval found, which holds all its occurrences.
    """
    words = words_of(segments)
    sizes, hashes = words.counts, words.hashes()
    kinds, symbols = np.unique(hashes, return_inverse=True)
    ends = np.cumsum(sizes)
    own = np.repeat(np.arange(len(segments)), sizes)
    text = np.zeros(len(hashes) + len(segments), np.int64)  # 0: separator
    place = np.arange(len(hashes)) + own
    text[place] = symbols + 1
    document = np.empty(len(text), np.int64)
    document[place] = documents[own]
    document[ends + np.arange(len(segments))] = np.iinfo(np.int64).max
    index = FMIndex(text, len(kinds) + 1, width)
    windows = place[np.arange(len(hashes)) <= ends[own] - width]
    low, high = index.intervals(windows, width)
    found = _least(document[index.order], low, high)
    return np.split(found, np.cumsum(sizes - width + 1)[:-1])


def repeated_windows(docs: DataFrame, width: int) -> DataFrame:
    """row_key and the starts of the document's windows that start in a document with a smaller id."""
    spark = docs.sparkSession
    marked = docs.where("doc_id is not null").join(shared_anchors(docs, width), "doc_id")

    def cut(batches):
        seen: dict[int, int] = {}
        for batch in batches:
            for part in chunks(batch):
                yield from _emit_segments(part, width, seen)

    schema = "segment long, key long, doc_id long, row_key long, start int, words binary"
    found = small_batches(marked.select("doc_id", "row_key", "text", "anchors", "hot_anchors")).mapInArrow(cut, schema)
    found = materialize(found, "segments")
    texts = found.where("words is not null")
    n_bytes = texts.agg(F.sum(F.length("words"))).first()[0] or 0
    shards = max(4 * tasks_for(spark), int(n_bytes // SHARD_BYTES) + 1)
    sharded = texts.select(F.pmod("key", F.lit(shards)).cast("int").alias("shard"), "segment", "doc_id", "words")

    def index(key, table):
        # equal segments of different tasks count once, with the least document
        order = np.lexsort((table.column("doc_id").to_numpy(), table.column("segment").to_numpy()))
        segment = table.column("segment").to_numpy()[order]
        order = order[np.concatenate([[True], segment[1:] != segment[:-1]])]
        table = table.take(pa.array(order)).combine_chunks()
        firsts = first_documents(table.column("words").combine_chunks(), table.column("doc_id").to_numpy(), width)
        return pa.table({"segment": table.column("segment"), "firsts": pa.array(firsts, pa.list_(pa.int64()))})

    firsts = sharded.groupBy("shard").applyInArrow(index, "segment long, firsts array<long>")
    hits = found.select("segment", "doc_id", "row_key", "start").join(firsts, "segment")
    hits = hits.select("row_key", F.expr("transform(filter(sequence(0, size(firsts) - 1), i -> firsts[i] < doc_id), i -> i + start)").alias("starts")).where("size(starts) > 0")
    # at most a text's windows for each text
    removed = materialize(hits.groupBy("row_key").agg(F.flatten(F.collect_set("starts")).alias("starts")), "removed")
    discard(found)
    return removed


def remove_repeated_windows(docs: DataFrame, width: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document.

    A word goes if it is covered by a window of `width` consecutive words whose
    sequence also starts in a document with a smaller doc_id, judged on the
    input. Windows are dealt out by their anchor, their 5-gram with the least
    hash, so equal windows meet. Windows whose anchor only one document has
    can't repeat. For the others, runs of windows under one anchor are reduced to
    distinct ones and gathered in shards; each shard's FM-index finds, for the
    windows streamed through it, all occurrences and the least document.

    Null and empty texts have no words (the hash of nothing). Null doc_ids
    neither remove nor lose words. Rows with one doc_id never remove each
    other's words; repeated rows keep a row each. An empty table gives no rows;
    other columns are ignored.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("row_key", F.xxhash64("doc_id", "text"))
    removed = repeated_windows(own, width)
    joined = own.join(removed, "row_key", "left").select("doc_id", "text", "starts")

    def digest(batch):
        n_words, n_removed, sums = [], [], []
        for text, starts in zip(batch.column("text").to_pylist(), batch.column("starts"), strict=True):
            words = (text or "").encode("utf-8", "surrogatepass").split()  # the six ASCII white-space bytes
            kept = words
            if starts.values is not None and len(starts.values):
                cover = np.zeros(len(words) + 1, np.int64)
                at = np.unique(starts.values.to_numpy(zero_copy_only=False))
                np.add.at(cover, at, 1)
                np.add.at(cover, at + width, -1)
                gone = np.cumsum(cover)[:-1] > 0
                kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            n_words.append(len(words))
            n_removed.append(len(words) - len(kept))
            sums.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sums, pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return map_texts(joined, digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")
