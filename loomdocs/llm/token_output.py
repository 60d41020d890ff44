"""Token ids in ORC files (operator 3)."""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.column import Column

from ._spark import chunks, scratch, small_batches, tasks_for

#: Pieces in the young half of a worker's cache; at that size it becomes the old half. Longer pieces aren't kept.
CACHE_PIECES, CACHE_CHARS = 500_000, 64
#: A run of Latin letters and what may follow it in a piece of its own: ASCII signs other than the apostrophe.
_PLAIN = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is printable, else the next one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class PieceEncoder:
    """Encodes texts with a byte-level BPE tokenizer, each distinct piece once.

    The tokenizer's pre-tokenizer starts a new token at a space that has no
    white space beside it, and makes a token of such a newline. Texts whose
    white space stands alone are cut there, the distinct pieces of a batch are
    looked up, and their ids are put together by position; the result equals
    that of the whole text. Other texts are encoded whole, as are those that
    hold a token added to the vocabulary (a special token gets its own id, as
    by the plain library call).

    A piece is what stands after a space, or a newline and what stands after
    it. Pieces of letters and signs go to the tokenizer's model directly, as the
    pre-tokenizer would cut them in these two; others to the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.newline = self._ids("\n")
        if len(self.newline) != 1:
            raise ValueError("the tokenizer has no token of its own for a newline")
        self.letters = _byte_letters()
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.stems: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _stem(self, token: str) -> bytes:
        """Ids of one pre-token."""
        if token.isascii():
            mapped = "\u0120" + token[1:] if token[0] == " " else token
        else:
            mapped = token.encode().decode("latin-1").translate(self.letters)
        ids = array("I", [t.id for t in self.tokenizer.model.tokenize(mapped)]).tobytes()
        if len(token) <= CACHE_CHARS:
            self.stems[token] = ids
        return ids

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of unseen pieces; nothing (b"") for those that need their neighbours."""
        newline, found, others = self.newline.tobytes(), {}, {"": [], " ": []}
        if len(self.stems) > CACHE_PIECES:
            self.stems = {"": b""}
        stems, learn, match = self.stems, self._stem, _PLAIN.fullmatch
        for piece in pieces:
            bare = piece[:1] == "\n"
            body = piece[1:] if bare else piece
            plain = match(body)
            if plain:
                stem, tail = plain.groups()
                if not bare:
                    stem = " " + stem
                ids = (stems.get(stem) or learn(stem)) + (tail and (stems.get(tail) or learn(tail)) or b"")
                found[piece] = newline + ids if bare else ids
            elif piece == "\n":  # a newline and nothing else: right at a text's end, see encode_column
                found[piece] = newline
            elif not body or body[0].isspace() or body[-1].isspace() or "\u180e" in (body[0], body[-1]):
                found[piece] = b""
            else:
                others["" if bare else " "].append(body)
        for lead, bodies in others.items():  # many at a time with newlines between, cut there
            for at in range(0, len(bodies), 20_000):
                some = bodies[at : at + 20_000]
                ids = self._ids("\n".join([lead + x for x in some]))
                raw, start = ids.tobytes(), 0
                for body, end in zip(some, [*(np.flatnonzero(ids == self.newline[0]) * 4).tolist(), len(raw)], strict=True):
                    found[body if lead else "\n" + body] = raw[start:end] if lead else newline + raw[start:end]
                    start = end + 4
        return found

    def _lookup(self, pieces: list[str]) -> list[bytes]:
        if len(self.young) > CACHE_PIECES:
            self.old, self.young = self.young, {}
        ids = list(map(self.young.get, pieces))
        missing = [i for i, x in enumerate(ids) if x is None]
        if missing:
            new = [pieces[i] for i in missing]
            learned = {x: self.old[x] for x in new if x in self.old} if self.old else {}
            learned |= self._learn([x for x in new if x not in learned] if learned else new)
            for i, x in zip(missing, new, strict=True):
                ids[i] = learned[x]
            self.young.update(learned if all(len(x) <= CACHE_CHARS for x in learned) else {x: v for x, v in learned.items() if len(x) <= CACHE_CHARS})
        return ids

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of strings without nulls, one text after the other, and each text's number of ids."""
        n = len(texts)
        if n == 0:
            return np.zeros(0, "<u4"), np.zeros(0, np.int64)
        # every newline starts a piece; so does a text, by a newline that is taken off again
        lines = pc.replace_substring(texts, "\n", " \n")
        cut = pc.split_pattern(pc.binary_join_element_wise(pa.scalar("\n", texts.type), lines, pa.scalar("", texts.type)), " ")
        words = np.asarray(pc.list_value_length(cut), np.int64)
        coded = pc.list_flatten(cut).dictionary_encode()
        codes = np.asarray(coded.indices)
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = self._lookup(pieces)
        whole = np.zeros(n, bool)  # encoded by the plain call
        for token in self.added:
            whole |= np.asarray(pc.match_substring(texts, token).cast(pa.uint8())).astype(bool)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        if not sizes.all():
            whole[np.repeat(np.arange(n), words)[sizes[codes] == 0]] = True
        if "\n" in pieces:  # a text may end with a newline; one before more white space needs its neighbours
            inside = codes == pieces.index("\n")
            inside[np.cumsum(words) - 1] = False
            whole[np.repeat(np.arange(n), words)[inside]] = True
        pool = np.frombuffer(b"".join(ids), "<u4")
        begins = np.cumsum(sizes) - sizes
        counts = sizes[codes]
        ends = np.cumsum(counts)
        flat = pool[np.arange(ends[-1]) + np.repeat(begins[codes] - (ends - counts), counts)]
        edges = np.concatenate([[0], ends[np.cumsum(words) - 1]])
        if not whole.any():
            keep = np.ones(len(flat), bool)
            keep[edges[:-1]] = False
            return flat[keep], np.diff(edges) - 1
        parts = [self._ids(texts[i].as_py()) if whole[i] else flat[edges[i] + 1 : edges[i + 1]] for i in range(n)]
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        ids, lengths = self.encode_column(pa.array(texts, pa.string()))
        ends = np.cumsum(lengths)
        return [ids[a:b].tobytes() for a, b in zip(ends - lengths, ends, strict=True)]


class SharedEncoder:
    """Broadcast in place of a PieceEncoder: each worker makes its own, once, from the path.

    A worker lets go of a broadcast, and so of the encoder and what it remembers,
    when its next task is one of another job.
    """

    def __init__(self, path: str):
        self.path = path
        self.own: PieceEncoder | None = None

    def get(self) -> PieceEncoder:
        if self.own is None:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            os.environ["RAYON_NUM_THREADS"] = "1"
            self.own = PieceEncoder(self.path)
        return self.own


def share_encoder(spark: SparkSession, path: str) -> Broadcast[SharedEncoder]:
    return spark.sparkContext.broadcast(SharedEncoder(path))


def with_end_ids(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' ids with end_id after each text, and the new lengths."""
    return np.insert(ids, np.cumsum(lengths), np.uint32(end_id)), lengths + 1


def tokenize(docs: DataFrame, tokenizer: str, end_id: int, keep: list[str]) -> DataFrame:
    """Add ids (array<int>) and n_tokens to the `keep` columns; null text counts as empty."""
    source = docs.select(*keep, "text")
    kept = source.drop("text").schema
    shared = share_encoder(docs.sparkSession, tokenizer)

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                flat, lengths = with_end_ids(*shared.value.get().encode_column(pc.fill_null(part.column("text"), "")), end_id)
                offsets = np.zeros(len(lengths) + 1, np.int32)
                np.cumsum(lengths, out=offsets[1:])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in keep] + [pa.array(lengths), ids], [*keep, "n_tokens", "ids"])
        pa.default_memory_pool().release_unused()  # not for the worker's next job

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", n_tokens long, ids array<int>"
    return small_batches(source).mapInArrow(run, schema)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, order: list[str] | None = None, stripe_bytes: int = 64 << 20, index_rows: int = 1000) -> None:
    """Encode every text and write it to ORC files in ascending `order` (doc_id unless given).

    Files hold doc_id, part, place, n_tokens and ids. Files follow each other by
    `part`, rows by `place`. Integer columns use ORC's run-length encoding
    (version 2); every stripe has row indexes (each `index_rows` rows) and a
    Bloom filter on doc_id, so that a lookup prunes stripes by metadata, and a
    scan splits at stripes.

    Null texts are empty: they hold the end id only. Null ids sort first;
    repeated ids and rows are all written. An empty table writes no rows.
    """
    spark = docs.sparkSession
    order = order or ["doc_id"]
    keys = [f"order_{i}" for i in range(len(order))]
    keyed = docs.select("doc_id", "text", *[F.col(c).alias(k) for c, k in zip(order, keys, strict=True)])
    placed = keyed.repartitionByRange(tasks_for(spark), *keys).sortWithinPartitions(*keys, F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")))
    located = placed.select("doc_id", "text", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    (
        tokenize(located, tokenizer, end_id, ["doc_id", "part", "place"])
        .write.option("orc.stripe.size", stripe_bytes)
        .option("orc.row.index.stride", index_rows)
        .option("orc.create.index", "true")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.compress", "zstd")
        .orc(path)
    )


def read_token_files(spark, path: str, doc_ids: list[int] | None = None) -> DataFrame:
    """Rows of the files; doc_ids narrows the read by row indexes and Bloom filters."""
    rows = spark.read.schema("doc_id long, part int, place long, n_tokens long, ids array<int>").orc(path)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(doc_ids))


def token_digests(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of files' rows.

    start is the number of ids ahead, over all files: the totals per file part
    give each part's base. Only digests are shuffled, never ids.
    """

    def digest(batches):
        for batch in batches:
            ids = batch.column("ids")
            flat = np.asarray(ids.flatten(), np.int32).astype("<u4")
            at = np.concatenate([[0], np.cumsum(np.asarray(ids.value_lengths().fill_null(0), np.int64))])
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("doc_id", "part", "place")] + [pa.array(np.diff(at)), pa.array(crc, pa.int64())], ["doc_id", "part", "place", "n_tokens", "ids_crc32"])

    digests = rows.select("doc_id", "part", "place", "ids").mapInArrow(digest, "doc_id long, part int, place long, n_tokens long, ids_crc32 long")
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    base = totals.select("part", _ahead("total", Window.orderBy("part")).alias("base"))
    own = _ahead("n_tokens", Window.partitionBy("part").orderBy("place"))
    # One row per file part: as many as shuffle partitions.
    return digests.withColumn("own", own).join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("own")).alias("start"), "n_tokens", "ids_crc32")


def _ahead(column: str, window) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def token_output(docs: DataFrame, tokenizer: str, end_id: int = 2, order: list[str] | None = None, path: str | None = None) -> DataFrame:
    """Write the token files, read them back, and return their digests."""
    spark = docs.sparkSession
    path = path or scratch(spark, "tokens")
    write_token_files(docs, path, tokenizer, end_id, order)
    return token_digests(read_token_files(spark, path))
