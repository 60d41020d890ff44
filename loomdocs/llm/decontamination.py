"""Benchmark decontamination by latent semantic retrieval (operator 10)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import chunks, map_texts, materialize
from ._words import flat_bytes, words_of

#: A passage is WIDE blocks of STEP words; one begins at every block.
STEP, WIDE = 16, 3
#: Latent dimensions, and further ones that the random projection starts with.
RANK, MORE = 128, 16
#: Least cosine of a candidate passage and a piece of a benchmark item.
COSINE = 0.5
#: Items of more words are cut into pieces of a passage's length, and into parts of at most LONG words that are looked up by rare words.
LONG = 64
#: Pieces whose cosines are computed together, and places of rare words, about, that are looked at together.
PIECES, NEAR_PLACES = 512, 500_000
#: Terms of a larger share of the documents weigh nothing, unless an item has fewer than LEAST_TERMS others.
COMMON, LEAST_TERMS = 0.05, 4
#: Share of the item's words that the longest common subsequence must have; the lower one if the answer is there too.
LCS_ALONE, LCS_WITH_ANSWER = 0.8, 0.6
#: An item's answer is its last words.
ANSWER_WORDS = 5
#: Benchmark items, counted by their pieces, that are searched for at once; more go in further blocks.
BLOCK_ITEMS = 400
#: Tasks per core that the latent space is fitted in at most: each gives terms x (RANK + MORE) sums, however much it has read.
FIT_TASKS = 2
#: Words of a row of the term table at most: longer documents have several rows, overlapping by twice the longest item at least.
ROW_WORDS, OVERLAP_WORDS = 100_000, 1_000


@dataclass
class Items:
    """A block of benchmark items as term numbers (1 and up; 0: no term of the block)."""

    item_ids: list
    terms: np.ndarray
    words: list[np.ndarray]

    @classmethod
    def of(cls, rows) -> Items:
        words = words_of(pa.array([r["text"] for r in rows], pa.string()), lower=True)
        hashes = words.hashes()
        terms = np.unique(hashes)
        numbers = np.searchsorted(terms, hashes) + 1
        return cls([r["item_id"] for r in rows], terms, [x.astype(np.uint32) for x in np.split(numbers, words.row_offsets[1:-1])])


def piece_starts(n: int) -> list[int]:
    """Where the pieces of an item of n words begin: one piece up to LONG words, else WIDE * STEP words each, the last at the end."""
    wide = WIDE * STEP
    return [0] if n <= LONG else [*range(0, n - wide, wide), n - wide]


def term_table(docs: DataFrame, terms: np.ndarray, overlap: int = OVERLAP_WORDS) -> DataFrame:
    """doc_id and the term number of every word of the text, as little-endian 32-bit integers.

    Documents without any term are left out.
    """

    def number(batch):
        words = words_of(batch.column("text"), lower=True)
        hashes = words.hashes()
        at = np.searchsorted(terms, hashes)
        at[at == len(terms)] = 0
        numbers = np.where(terms[at] == hashes, at + 1, 0).astype("<u4")
        ids, rows = batch.column("doc_id").to_pylist(), []
        for i, (a, b) in enumerate(zip(words.row_offsets[:-1], words.row_offsets[1:], strict=True)):
            for start in range(a, b, ROW_WORDS):
                part = numbers[start : min(b, start + ROW_WORDS + overlap)]
                if part.any():
                    rows.append((ids[i], part.tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], ["doc_id", "terms"])

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), number, "doc_id long, terms binary")


def _numbers(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat_bytes(batch.column("terms"))
    return np.frombuffer(data.tobytes(), "<u4"), offsets // 4


def document_frequencies(table: DataFrame, n_terms: int) -> tuple[np.ndarray, int]:
    """Rows that hold each term, over all rows of the table, and the number of rows."""

    def count(batches):
        total = np.zeros(n_terms + 1, np.int64)
        rows = 0
        for batch in batches:
            for part in chunks(batch, "terms"):
                numbers, offsets = _numbers(part)
                row = np.repeat(np.arange(part.num_rows, dtype=np.int64), np.diff(offsets))
                there = numbers > 0
                both = np.unique(row[there] * (n_terms + 1) + numbers[there])
                total += np.bincount(both % (n_terms + 1), minlength=n_terms + 1)
                rows += part.num_rows
        total[0] = rows
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["term", "n"])

    got = table.select("terms").mapInArrow(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(n_terms + 1, np.int64)
    out[got["term"].to_numpy()] = got["n"].to_numpy()
    return out, int(out[0])


def passage_sums(numbers: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum of the terms' vectors for the passage that begins at each block; the blocks' rows and places."""
    weighs = vectors.any(axis=1)
    per_row = -(-np.diff(offsets) // STEP)
    first = np.concatenate([[0], np.cumsum(per_row)])
    block_row = np.repeat(np.arange(len(per_row)), per_row)
    at = np.flatnonzero(weighs[numbers])
    row = np.searchsorted(offsets, at, side="right") - 1
    block = first[row] + (at - offsets[row]) // STEP
    sums = np.zeros((first[-1], vectors.shape[1]), np.float32)
    if len(at):
        new = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        sums[block[new]] = np.add.reduceat(vectors[numbers[at]], new, axis=0)
    out = sums.copy()
    for ahead in range(1, WIDE):
        if len(sums) > ahead:
            same = block_row[ahead:] == block_row[:-ahead]
            out[:-ahead][same] += sums[ahead:][same]
    return out, block_row, np.arange(first[-1]) - first[block_row]


def latent_space(table: DataFrame, items: Items, idf: np.ndarray) -> np.ndarray:
    """Terms x RANK: leading right singular vectors of the TF-IDF passages, by a randomised SVD.

    Each task multiplies its passages A by a fixed random matrix O and back,
    A' (A O); the sums of all tasks give Y = (A'A) O, of terms x (RANK + MORE).
    The driver gets Y alone and finishes: A'A = Y (O'Y)^-1 Y', so the singular
    vectors are those of the small core. Passages are those of all documents, and
    the items themselves.
    """
    n_terms = len(items.terms)
    rank = min(RANK + MORE, n_terms)
    random = np.random.default_rng(7).standard_normal((n_terms + 1, rank))
    random[0] = 0
    weighted = (random * idf[:, None]).astype(np.float32)
    # a number of tasks, and so of sums to shuffle, that doesn't grow with the corpus
    every = table.select("terms").coalesce(FIT_TASKS * table.sparkSession.sparkContext.defaultParallelism)

    def multiply(batches):
        y, passages = np.zeros((n_terms + 1, rank)), 0
        for batch in batches:
            for part in chunks(batch, "terms"):
                numbers, offsets = _numbers(part)
                _back(y, numbers, offsets, weighted)
                passages += int((-(-np.diff(offsets) // STEP)).sum())
        for a in range(0, n_terms + 1, 512):
            yield pa.RecordBatch.from_arrays([pa.array([a], pa.int32()), pa.array([y[a : a + 512].tobytes()], pa.binary()), pa.array([passages], pa.int64())], ["first", "y", "passages"])

    def add(key, group):
        total = sum(np.frombuffer(x, np.float64) for x in group.column("y").to_pylist())
        n = sum(group.column("passages").to_pylist())
        return pa.table({"first": pa.array([key[0].as_py()], pa.int32()), "y": pa.array([total.tobytes()], pa.binary()), "passages": pa.array([n], pa.int64())})

    schema = "first int, y binary, passages long"
    got = every.mapInArrow(multiply, schema).groupBy("first").applyInArrow(add, schema).collect()
    y = np.zeros((n_terms + 1, rank))
    for r in got:
        part = np.frombuffer(r["y"], np.float64).reshape(-1, rank)
        y[r["first"] : r["first"] + len(part)] += part
    # items count as often as all passages together
    n_passages = sum(r["passages"] for r in got if r["first"] == 0)
    more = np.zeros_like(y)
    _back(more, np.concatenate(items.words), np.concatenate([[0], np.cumsum([len(w) for w in items.words])]), weighted)
    y += more * max(1.0, n_passages / len(items.words))
    y *= idf[:, None]
    core = random.T @ y
    q, r = np.linalg.qr(y)
    small = r @ np.linalg.pinv((core + core.T) / 2) @ r.T
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return (q @ vectors[:, np.argsort(-values)[:RANK]]).astype(np.float32)


def _back(y: np.ndarray, numbers: np.ndarray, offsets: np.ndarray, weighted: np.ndarray) -> None:
    """Add A' (A O) of these rows' passages to y (without the left idf)."""
    sums, block_row, _ = passage_sums(numbers, offsets, weighted)
    held = sums.copy()  # for each block the sum over the passages that hold it
    for back in range(1, WIDE):
        if len(sums) > back:
            same = block_row[back:] == block_row[:-back]
            held[back:][same] += sums[:-back][same]
    at = np.flatnonzero(weighted.any(axis=1)[numbers])
    row = np.searchsorted(offsets, at, side="right") - 1
    first = np.concatenate([[0], np.cumsum(-(-np.diff(offsets) // STEP))])
    block = first[row] + (at - offsets[row]) // STEP
    order = np.argsort(numbers[at], kind="stable")
    if len(order):
        terms = numbers[at][order]
        new = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
        y[terms[new]] += np.add.reduceat(held[block[order]].astype(np.float64), new, axis=0)


def common_subsequence(masks: dict[int, int], n: int, words: list[int]) -> int:
    """Length of the longest common subsequence of an item (bit masks of its n words' places) and words."""
    full = state = (1 << n) - 1
    for w in words:
        mask = masks.get(w)
        if mask:
            hit = state & mask
            state = ((state + hit) | (state - hit)) & full
    return n - state.bit_count()


def _contains(words: list[int], part: list[int]) -> bool:
    return any(words[i : i + len(part)] == part for i, w in enumerate(words) if w == part[0])


def item_parts(n: int) -> list[tuple[int, int]]:
    """Begin and end of the parts of an item of n words: as few as have at most LONG words, of nearly equal size."""
    k = -(-n // LONG)
    return [(n * i // k, n * (i + 1) // k) for i in range(k)]


@dataclass
class RareWords:
    """The words by which items are looked up beside the cosines: postings of term numbers to parts of items.

    A common subsequence of LCS_WITH_ANSWER of an item's words holds that share
    of at least one of the item's parts, which don't overlap. There it leaves out
    n - ceil(LCS_WITH_ANSWER n) of the part's n words at most, so it has one of any
    n - ceil(LCS_WITH_ANSWER n) + 1 of them: the rarest are taken. So no item is
    missed for what stands around or between its words.
    """

    first: np.ndarray
    part: np.ndarray
    has: np.ndarray
    sizes: np.ndarray
    #: Item and begin of each part.
    parts: list[tuple[int, int]]

    @classmethod
    def of(cls, words: list[np.ndarray], df: np.ndarray) -> RareWords:
        n_terms = len(df)
        spans = [(i, start, end) for i, w in enumerate(words) for start, end in item_parts(len(w))]
        terms, part = [], []
        has = np.zeros((len(spans), -(-n_terms // 8)), np.uint8)
        for at, (i, start, end) in enumerate(spans):
            own, n = words[i][start:end], end - start
            there = np.zeros(n_terms, bool)
            there[own] = True
            has[at] = np.packbits(there)
            rarest = own[np.argsort(df[own], kind="stable")][: n - math.ceil(LCS_WITH_ANSWER * n) + 1]
            for w in np.unique(rarest).tolist():
                terms.append(w)
                part.append(at)
        order = np.argsort(terms, kind="stable") if terms else np.zeros(0, int)
        first = np.searchsorted(np.array(terms, int)[order], np.arange(n_terms + 1))
        return cls(first, np.array(part, int)[order], has, np.array([end - start for _, start, end in spans]), [(i, start) for i, start, _ in spans])

    def holds(self, part: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Whether each term is one of the part's words."""
        return self.has[part, terms >> 3] >> (7 - (terms & 7)).astype(np.uint8) & 1

    def near(self, numbers: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """Row, place in numbers and part of each place where enough words of an item's part stand around a rare one of it."""
        per = np.diff(self.first)[numbers]
        there = np.flatnonzero(per)
        slices = np.cumsum(per[there]) // NEAR_PLACES
        for part in np.split(there, np.flatnonzero(np.diff(slices)) + 1):
            if len(part):
                yield self._near(numbers, offsets, part, per[part])

    def _near(self, numbers: np.ndarray, offsets: np.ndarray, places: np.ndarray, per: np.ndarray) -> np.ndarray:
        at = np.repeat(places, per)
        begun = np.cumsum(per) - per
        part = self.part[self.first[numbers[at]] + np.arange(len(at)) - np.repeat(begun, per)]
        row = np.searchsorted(offsets, at, side="right") - 1
        reach = self.sizes[part] + self.sizes[part] // 2
        enough, words = np.ceil(LCS_WITH_ANSWER * self.sizes[part]), np.zeros(len(at), int)
        for step in range(-int(reach.max()), int(reach.max()) + 1):
            place = at + step
            there = (np.abs(step) <= reach) & (place >= offsets[row]) & (place < offsets[row + 1])
            words[there] += self.holds(part[there], numbers[place[there]])
        kept = words >= enough
        return np.stack([row[kept], at[kept], part[kept]], axis=1)


def search(table: DataFrame, items: Items, idf: np.ndarray, space: np.ndarray, df: np.ndarray) -> DataFrame:
    """doc_id, item_id, cosine, lcs_share and answer_found of each contaminated document and item."""
    # the last column sums to the square of a passage's length before the projection
    vectors = np.concatenate([space * idf[:, None], idf[:, None] ** 2], axis=1).astype(np.float32)
    vectors[0] = 0
    pieces = [(i, start) for i, words in enumerate(items.words) for start in piece_starts(len(words))]
    asked = np.zeros((len(pieces), space.shape[1]), np.float32)
    for p, (i, start) in enumerate(pieces):
        words = items.words[i] if len(items.words[i]) <= LONG else items.words[i][start : start + WIDE * STEP]
        asked[p] = vectors[words, :-1].sum(0)
        # measured against the piece's own length and what the projection keeps of it
        asked[p] *= np.sqrt(vectors[words, -1].sum()) / max(1e-9, float(asked[p] @ asked[p]))
    masks = []
    for words in items.words:
        own: dict[int, int] = {}
        for place, w in enumerate(words.tolist()):
            own[w] = own.get(w, 0) | 1 << place
        masks.append(own)
    first_piece = {i: p for p, (i, start) in enumerate(pieces) if not start}
    rare = RareWords.of(items.words, df)
    shared = table.sparkSession.sparkContext.broadcast((vectors, asked, pieces, first_piece, rare, masks, [w.tolist() for w in items.words], items.item_ids))  # BLOCK_ITEMS pieces

    def candidates(numbers, offsets):
        """Row, item, begin and end of the words to compare, and cosine."""
        vectors, asked, pieces, first_piece, rare, _, item_words, _ = shared.value
        sums, block_row, place = passage_sums(numbers, offsets, vectors)
        lengths = np.sqrt(np.maximum(sums[:, -1:], 1e-9))
        for p in range(0, len(pieces), PIECES):
            cosine = (sums[:, :-1] @ asked[p : p + PIECES].T) / lengths
            for block, piece in np.argwhere(cosine >= COSINE).tolist():
                item, start = pieces[p + piece]
                n, at = len(item_words[item]), int(offsets[block_row[block]]) + int(place[block]) * STEP
                begin, end = at - n // 2, at + WIDE * STEP + n // 2
                if n > LONG:  # the pieces of one copy share a few windows, each wide enough for the whole item
                    grid = n // 4
                    begin = (at - start - n // 2) // grid * grid
                    end = begin + grid + 2 * n + WIDE * STEP
                yield int(block_row[block]), item, begin, end, float(cosine[block, piece])
        first_block = np.searchsorted(block_row, np.arange(len(offsets) - 1))
        for row, at, part in (x for some in rare.near(numbers, offsets) for x in some.tolist()):
            item, start = rare.parts[part]
            n, size = len(item_words[item]), int(rare.sizes[part])
            begin, end = at - n - n // 2, at + n + n // 2 + 1
            if n > LONG:
                grid = n // 4
                begin = (at - start - size - n // 2) // grid * grid
                end = begin + grid + 2 * (n + size)
            block = first_block[row] + (at - offsets[row]) // STEP
            yield row, item, begin, end, float(sums[block, :-1] @ asked[first_piece[item]] / lengths[block, 0])

    def find(batches):
        _, _, _, _, _, masks, item_words, item_ids = shared.value
        for batch in batches:
            for part in chunks(batch, "terms"):
                numbers, offsets = _numbers(part)
                best: dict[tuple[int, int], tuple[float, float, bool]] = {}
                compared: dict[tuple[int, int, int, int], tuple[float, bool]] = {}
                for row, item, begin, end, cosine in candidates(numbers, offsets):
                    begin, end = max(int(offsets[row]), begin), min(int(offsets[row + 1]), end)
                    window = row, item, begin, end
                    if window not in compared:
                        near, n = numbers[begin:end].tolist(), len(item_words[item])
                        share = common_subsequence(masks[item], n, near) / n
                        compared[window] = share, share >= LCS_WITH_ANSWER and _contains(near, item_words[item][-ANSWER_WORDS:])
                    share, answer = compared[window]
                    if share >= LCS_ALONE or answer:
                        key = row, item
                        best[key] = max(best.get(key, (0.0, -1.0, False)), (share, cosine, answer))
                ids = part.column("doc_id").to_pylist()
                if best:
                    yield pa.RecordBatch.from_pylist([{"doc_id": ids[row], "item_id": item_ids[item], "cosine": c, "lcs_share": s, "answer_found": a} for (row, item), (s, c, a) in best.items()], pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs_share", pa.float64()), ("answer_found", pa.bool_())]))

    return table.mapInArrow(find, "doc_id long, item_id long, cosine double, lcs_share double, answer_found boolean")


def contaminated_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and benchmark item that it holds: doc_id, item_id, cosine, lcs_share, answer_found.

    Passages (WIDE * STEP words, at every STEP words of every whole text) and
    items are TF-IDF vectors over the items' words, with document frequencies
    of all documents. A randomised SVD of all passages gives a latent space; passages with a
    cosine of at least COSINE to an item are its candidates. Items of more than
    LONG words are cut into pieces of a passage's length, and a candidate for any
    piece is one for the item. Parts of items of at most LONG words are also looked
    up by their rarest words, whatever stands around them. Around a candidate,
    the longest common subsequence of words with the item must have LCS_ALONE of
    the item's words, or LCS_WITH_ANSWER if the item's last words (its answer)
    stand there too. Items are searched for in blocks of about BLOCK_ITEMS pieces.

    Words are lower-cased (A-Z). Items without a word, or with a null text, are
    never found, nor are documents with a null or empty text. Repeated items
    are reported under each id; repeated documents with one id give one row. An
    empty benchmark or an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    found = None
    block: list = []
    asked = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").orderBy("item_id")

    def of_block():
        items = Items.of(block)
        with_words = [i for i, w in enumerate(items.words) if len(w)]
        items = Items([items.item_ids[i] for i in with_words], items.terms, [items.words[i] for i in with_words])
        if not items.words:
            return None
        table = materialize(term_table(docs, items.terms, max(OVERLAP_WORDS, 2 * max(map(len, items.words)))), "terms")
        df, n_rows = document_frequencies(table, len(items.terms))
        idf = np.array([math.log((1 + n_rows) / (1 + x)) + 0.01 for x in df])
        common = df > COMMON * n_rows
        for words in items.words:
            kinds = np.unique(words)
            if (~common[kinds]).sum() < LEAST_TERMS:
                common[kinds] = False
        idf[common] = 0
        idf[0] = 0
        return search(table, items, idf, latent_space(table, items, idf), df)

    pieces = 0
    for row in asked.toLocalIterator():
        block.append(row)
        pieces += len(piece_starts(len(row["text"].split())))
        if pieces >= BLOCK_ITEMS:
            part = of_block()
            found = part if found is None else found if part is None else found.unionByName(part)
            block, pieces = [], 0
    if block:
        part = of_block()
        found = part if found is None else found if part is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "doc_id long, item_id long, cosine double, lcs_share double, answer_found boolean")
    best = F.max(F.struct("lcs_share", "cosine", "answer_found")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.cosine", "best.lcs_share", "best.answer_found")
