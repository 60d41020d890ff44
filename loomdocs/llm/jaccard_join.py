"""Components of the n-gram Jaccard join, with set-relation skipping (operator 6)."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import chunks, discard, map_texts, materialize, small_batches
from ._words import gram_hashes, mix, whole_grams, words_of
from .components import connected_components

#: Counters of the frequency sketch (fixed: the sketch doesn't grow with the corpus), and of one of its rows.
SLOTS, SLOT_BLOCK = 1 << 22, 1 << 16
#: Bytes of text whose shingles are made at once: the arrays behind them take many times as much.
STEP_BYTES = 512 << 10
#: Longs of a set's parity bitmap.
BITMAP = 8
#: Rounds in which index lists are compared with one leader set before the rest is compared pair by pair.
LEADER_ROUNDS = 2


def shingles(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every k-word shingle; a row with fewer words has its whole sequence as one."""
    words = words_of(column, lower=True)
    hashes = words.hashes()
    at = np.flatnonzero(whole_grams(words.row_offsets, k, len(hashes)))
    grams = [gram_hashes(hashes, k)[at]]
    rows = [np.searchsorted(words.row_offsets, at, side="right") - 1]
    for n in range(1, k):
        short = np.flatnonzero(words.counts == n)
        if len(short):
            first = words.row_offsets[short]
            grams.append(mix(gram_hashes(hashes, n)[first] + np.uint64(n)))
            rows.append(short)
    return np.concatenate(grams), np.concatenate(rows)


def _slots(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(42)).astype(np.int64)  # 22 bits, as SLOTS


def frequency_sketch(docs: DataFrame, k: int) -> np.ndarray:
    """log2 of the number of shingles in each slot of a hash, over all documents."""

    def count(batches):
        total = np.zeros(SLOTS, np.uint32)
        for batch in batches:
            for part in chunks(batch, limit=STEP_BYTES):
                np.add.at(total, _slots(shingles(part.column("text"), k)[0]), 1)
        small = np.minimum(total, 255).astype(np.uint8)
        for n, a in enumerate(range(0, SLOTS, SLOT_BLOCK)):
            part = small[a : a + SLOT_BLOCK]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([part.tobytes()], pa.binary())], ["block", "counts"])

    def add(key, table):
        total = np.zeros(SLOT_BLOCK, np.int64)
        for x in table.column("counts"):
            total += np.frombuffer(x.as_buffer(), np.uint8)
        levels = np.log2(np.maximum(total, 1)).astype(np.uint8)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([levels.tobytes()], pa.binary())})

    rows = small_batches(docs.select("text")).mapInArrow(count, "block int, counts binary")
    sketch = np.zeros(SLOTS, np.uint8)
    for row in rows.groupBy("block").applyInArrow(add, "block int, counts binary").collect():  # SLOTS bytes
        sketch[row["block"] * SLOT_BLOCK :][:SLOT_BLOCK] = np.frombuffer(row["counts"], np.uint8)
    return sketch


def ordered_sets(column: pa.Array, k: int, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct shingles, in the global order (rarer slots first, then by hash), and row offsets."""
    grams, rows = shingles(column, k)
    level = sketch[_slots(grams)].astype(np.uint64)
    order = None
    if len(column) < 1 << 14:
        packed = (rows.astype(np.uint64) << np.uint64(50)) | (level << np.uint64(44)) | (grams >> np.uint64(20))
        order = np.argsort(packed, kind="stable")
        ordered, g = packed[order], grams[order]
        if ((ordered[1:] == ordered[:-1]) & (g[1:] != g[:-1])).any():
            order = None
    if order is None:
        order = np.lexsort((grams, level, rows))
    g, r = grams[order], rows[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (r[1:] != r[:-1])
    g, r = g[new], r[new]
    return g, np.searchsorted(r, np.arange(len(column) + 1))


def signatures(grams: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit signature of each set; 0 for empty ones."""
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams), dtype=np.uint64)])
    sizes = np.diff(offsets)
    out = mix((sums[offsets[1:]] - sums[offsets[:-1]]) ^ mix(sizes.astype(np.uint64) + np.uint64(77)))
    out[sizes == 0] = 0
    return out


def _set_rows(batch: pa.RecordBatch, k: int, percent: int, sketch: np.ndarray):
    grams, offsets = ordered_sets(batch.column("text"), k, sketch)
    sizes = np.diff(offsets)
    prefix = np.where(sizes > 0, sizes + (-percent * sizes) // 100 + 1, 0)
    keep = np.arange(len(grams)) - np.repeat(offsets[:-1], sizes) < np.repeat(prefix, sizes)
    ends = np.concatenate([[0], np.cumsum(prefix)]).astype(np.int32)
    parity = np.zeros((len(sizes), BITMAP * 64), np.uint8)
    row = np.repeat(np.arange(len(sizes)), sizes)
    np.bitwise_xor.at(parity, (row, (grams >> np.uint64(11)).astype(np.int64) & (BITMAP * 64 - 1)), 1)
    bits = np.packbits(parity, axis=1, bitorder="little").view(np.int64)
    bit_ends = np.arange(0, bits.size + 1, BITMAP, dtype=np.int32)
    yield pa.RecordBatch.from_arrays(
        [
            batch.column("doc_id"), batch.column("row_key"), pa.array(sizes.astype(np.int32)), pa.array(signatures(grams, offsets).astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(bit_ends), pa.array(bits.ravel())), pa.ListArray.from_arrays(pa.array(ends), pa.array(grams[keep].astype(np.int64))),
        ],
        ["doc_id", "row_key", "size", "sig", "bits", "prefix"],
    )


def _gram_rows(batch: pa.RecordBatch, k: int, sketch: np.ndarray):
    grams, offsets = ordered_sets(batch.column("text"), k, sketch)
    yield pa.RecordBatch.from_arrays([pa.array(signatures(grams, offsets).astype(np.int64)), pa.array([np.sort(x).tobytes() for x in np.split(grams, offsets[1:-1])], pa.binary())], ["sig", "grams"])


def verified_links(pairs: DataFrame, light: DataFrame, grams_of: Callable[[DataFrame], DataFrame], percent: int) -> DataFrame:
    """Those pairs (a, b) of signatures whose sets reach the similarity.

    First the parity bitmaps in `light`: the number of differing bits is a lower
    bound of the sets' difference, so a pair beyond the largest difference
    allowed can't link. For the rest the sets are made again and intersected.
    """
    left, right = (light.select(F.col("sig").alias(x), F.col("size").alias(f"size_{x}"), F.col("bits").alias(f"bits_{x}")) for x in "ab")
    differ = sum((F.bit_count(F.col("bits_a")[i].bitwiseXOR(F.col("bits_b")[i])) for i in range(BITMAP)), F.lit(0))
    # |A ^ B| <= (1 - t) / (1 + t) * (|A| + |B|)
    near = pairs.join(left, "a").join(right, "b").where(differ * (100 + percent) <= (F.col("size_a") + F.col("size_b")) * (100 - percent)).select("a", "b")
    near = materialize(near.distinct(), "near")
    full = grams_of(near.select(F.col("a").alias("sig")).unionAll(near.select(F.col("b").alias("sig"))).distinct())
    left, right = (full.select(F.col("sig").alias(x), F.col("grams").alias(f"grams_{x}")) for x in "ab")

    def intersect(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("grams_a"), batch.column("grams_b"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                at = np.searchsorted(x, y)
                at[at == len(x)] = 0
                both = int((x[at] == y).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    found = near.join(left, "a").join(right, "b").select("a", "b", "grams_a", "grams_b").mapInArrow(intersect, "a long, b long")
    links = materialize(found.distinct(), "links")
    discard(full)
    discard(near)
    return links


def shingle_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id of every document.

    Documents are sets of distinct k-word shingles of their lower-cased (A-Z)
    words; two link when 100 * intersection >= percent * union. component_id is
    the least doc_id that links reach.

    1. Equal sets are one set. A fixed-size sketch of all shingles' frequencies
       orders shingles, rarer first, so frequent ones stay out of prefixes.
    2. Index lists: each set's prefix (size - ceil(t size) + 1 shingles) is
       indexed; linked sets share a shingle there. Entries have their position
       and the set's size; blocks of a list by size are skipped whole where the
       sizes, or the places left after the position, rule a link out.
    3. Answers from similar sets: each list's members are compared with one
       leader (that with the most shared shingles); those that link with it take
       over its component, and pairs inside a component are never compared.
       What is left in a list with several components is compared pair by pair.
       No link between components is lost.

    Null and empty texts have no shingles and link with nothing. Null doc_ids
    link like others but can't name a component unless alone in it (then null).
    Repeated ids and rows keep a row each. An empty table gives no rows; other
    columns are ignored.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("row_key", F.xxhash64("doc_id", "text"))
    sketch = spark.sparkContext.broadcast(frequency_sketch(own, k))  # SLOTS bytes
    sets = map_texts(own.select("doc_id", "row_key", "text"), lambda b: _set_rows(b, k, percent, sketch.value), "doc_id long, row_key long, size int, sig long, bits array<long>, prefix array<long>", limit=STEP_BYTES)
    sets = materialize(sets, "sets")

    # one set of each signature; its prefix once
    chosen = sets.where("size > 0").groupBy("sig", "size").agg(F.min("row_key").alias("row_key"))
    unique = sets.join(chosen, ["sig", "size", "row_key"], "left_semi")
    entries = unique.select("sig", "size", F.posexplode("prefix").alias("pos", "token"))
    same = Window.partitionBy("token")
    entries = entries.withColumns({"low": F.min("sig").over(same), "high": F.max("sig").over(same), "n": F.count("*").over(same)}).where("low <> high")
    entries = materialize(entries.select("token", "sig", "size", "pos", "n"), "entries")

    light = unique.select("sig", "size", "bits")

    def grams_of(sigs: DataFrame) -> DataFrame:
        needed = unique.join(sigs, "sig", "left_semi").select("row_key")
        return materialize(map_texts(own.join(needed, "row_key", "left_semi").select("text"), lambda b: _gram_rows(b, k, sketch.value), "sig long, grams binary", limit=STEP_BYTES), "grams")

    weight = materialize(entries.groupBy("sig").agg(F.sum("n").alias("weight")), "weights")

    sizes_fit = (F.col("size") * 100 >= F.col("l_size") * percent) & (F.col("l_size") * 100 >= F.col("size") * percent)
    links, labels = None, None
    live = entries.join(weight, "sig").withColumn("label", F.col("sig"))
    for turn in range(LEADER_ROUNDS):
        # blocks of sizes that can link; in later rounds whole lists
        block = F.floor(F.log(F.col("size")) / F.log(F.lit(100 / percent))) if turn == 0 else F.lit(0)
        live = live.withColumn("block", block)
        rank = F.col("weight") if turn == 0 else F.xxhash64("label", F.lit(turn))
        leaders = live.groupBy("token", "block").agg(F.max(F.struct(rank.alias("rank"), "sig", "size", "label")).alias("l")).select("token", "block", F.col("l.sig").alias("l_sig"), F.col("l.size").alias("l_size"), F.col("l.label").alias("l_label"))
        pairs = live.join(leaders, ["token", "block"]).where((F.col("label") != F.col("l_label")) & sizes_fit)
        found = verified_links(_as_pairs(pairs, "sig", "l_sig"), light, grams_of, percent)
        links = found if links is None else links.unionAll(found)
        labels = connected_components(links)
        live = _still_apart(entries, labels).join(weight, "sig")
        live = materialize(live, "live")
        if live.isEmpty():
            break
    else:
        other = live.select("token", *[F.col(c).alias(f"l_{c}") for c in ("sig", "size", "pos", "label")])
        # at the first shared shingle, what is left of both sets bounds the overlap
        both = F.least(F.col("size") - F.col("pos"), F.col("l_size") - F.col("l_pos"))
        can = both * (100 + percent) >= (F.col("size") + F.col("l_size")) * percent
        rest = live.join(other, "token").where((F.col("sig") < F.col("l_sig")) & (F.col("label") != F.col("l_label")) & sizes_fit & can)
        links = links.unionAll(verified_links(_as_pairs(rest, "sig", "l_sig"), light, grams_of, percent))
        labels = connected_components(links)

    named = sets.select("doc_id", "size", "sig").join(labels, sets.sig == labels.node, "left").withColumn("group", F.coalesce("label", "sig"))
    least = named.where("size > 0").groupBy("group").agg(F.min("doc_id").alias("least"))
    return named.join(least, "group", "left").select("doc_id", F.col("size").cast("long").alias("n_shingles"), F.when(F.col("size") > 0, F.coalesce("least", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _as_pairs(rows: DataFrame, x: str, y: str) -> DataFrame:
    return rows.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()


def _still_apart(entries: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries of lists with more than one component, with their labels."""
    named = entries.join(labels, entries.sig == labels.node, "left").select("token", "sig", "size", "pos", F.coalesce("label", "sig").alias("label"))
    mixed = named.groupBy("token").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("token")
    return named.join(mixed, "token", "left_semi")
