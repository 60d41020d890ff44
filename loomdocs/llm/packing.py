"""Best-fit packing of token ids into sequences of a fixed length (operator 13)."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import chunks, materialize, small_batches
from .token_output import share_encoder, with_end_ids

#: Open bins of a packer, and pieces that arrive together, the longest first.
OPEN_BINS, ARRIVALS = 512, 1024
#: Tasks whose open bins are packed again by one task of the next round.
MERGED_TASKS = 32
#: Rows of an Arrow batch of packed pieces.
OUT_ROWS = 10_000


class BestFit:
    """Bounded-space best fit: at most `open_bins` bins are open, keyed by free space in a bitset.

    A piece goes to the open bin with the least free space that holds it: the
    lowest set bit from its length on. If none holds it a new bin is opened;
    when that would be one too many, the fullest open bin is closed first. Bins
    without free space close by themselves. Closed bins come out as lists of
    their pieces.
    """

    def __init__(self, capacity: int, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.free = 0  # bit f: some open bin has f tokens free
        self.bins: dict[int, list[list]] = {}  # free space -> bins
        self.n_open = 0

    def _take(self, free: int) -> list:
        bins = self.bins[free]
        bin_ = bins.pop()
        if not bins:
            del self.bins[free]
            self.free ^= 1 << free
        self.n_open -= 1
        return bin_

    def add(self, length: int, piece) -> Iterator[list]:
        """Pack a piece of 1 to `capacity` tokens; yields the bins that this closes."""
        holding = self.free >> length
        if holding:
            free = length + (holding & -holding).bit_length() - 1
            bin_ = self._take(free)
        else:
            if length < self.capacity and self.n_open == self.open_bins:
                yield self._take((self.free & -self.free).bit_length() - 1)
            bin_, free = [], self.capacity
        bin_.append(piece)
        free -= length
        if not free:
            yield bin_
            return
        self.bins.setdefault(free, []).append(bin_)
        self.free |= 1 << free
        self.n_open += 1

    def rest(self) -> Iterator[list]:
        """The bins that are still open, the fullest first."""
        while self.free:
            yield self._take((self.free & -self.free).bit_length() - 1)


def piece_lengths(n: int, capacity: int) -> list[int]:
    """A document of n tokens as it is, or cut so that all pieces but the first are full."""
    full = max(0, -(-n // capacity) - 1)
    return [n - full * capacity, *[capacity] * full]


#: is_open: the piece's bin was still open when its task ended.
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, is_open boolean"
_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("is_open", pa.bool_())])


def _packed(pieces: Iterable[tuple], capacity: int, open_bins: int, arrivals: int, first_id: int) -> Iterator[pa.RecordBatch]:
    """Pack (doc_id, piece, start, length, crc) as they come, `arrivals` at a time; sequences are numbered from first_id on."""
    packer, out, number = BestFit(capacity, open_bins), [], first_id
    waiting: list[tuple] = []

    def emit(bin_, is_open):
        nonlocal number
        offset = 0
        for piece in bin_:
            out.append((*piece, number, offset, is_open))
            offset += piece[3]
        number += 1

    def flush():
        columns = zip(*out, strict=True) if out else [[]] * len(_ARROW)
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)
        out.clear()
        return batch

    def arrive():
        for piece in sorted(waiting, key=lambda p: -p[3]):
            for bin_ in packer.add(piece[3], piece):
                emit(bin_, False)
        waiting.clear()

    for piece in pieces:
        if piece[3] == capacity:
            emit([piece], False)
        else:
            waiting.append(piece)
            if len(waiting) >= arrivals:
                arrive()
        if len(out) >= OUT_ROWS:
            yield flush()
    arrive()
    for bin_ in packer.rest():
        emit(bin_, True)
        if len(out) >= OUT_ROWS:
            yield flush()
    yield flush()


def _first_id(round_no: int, task: int) -> int:
    """Sequence numbers of a round's task: tasks have 2^32 each."""
    return round_no << 56 | task << 32


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, open_bins: int = OPEN_BINS, arrivals: int = ARRIVALS) -> DataFrame:
    """Pieces of all documents with their places in sequences of at most `capacity` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset. A
    document is its text's ids and the end id; only one that is longer than
    capacity is cut, into full pieces behind a first one that may be shorter.

    Texts are encoded and packed where they are read: every task has a bounded-
    space best fit of its own, so texts and ids are never shuffled and a task
    holds the pieces of `open_bins` bins. The bins that are open at a task's end
    are packed once more, those of MERGED_TASKS tasks by one task, round by round
    until one task ends the last ones: each round moves only those few pieces. A
    lost task is run again on the same rows and gives the same sequences; every
    round is a table in the shared folder.

    Null and empty texts are one token, the end id. Repeated ids and rows are
    packed each; null ids are kept. A very long text is encoded whole by its
    task. Pieces of equal length are packed in the order of the table. An empty
    table gives no rows; other columns are ignored.
    """
    shared = share_encoder(docs.sparkSession, tokenizer)

    def encode(batches):
        def pieces():
            for batch in batches:
                for part in chunks(batch):
                    ids, lengths = with_end_ids(*shared.value.get().encode_column(pc.fill_null(part.column("text"), "")), end_id)
                    raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                    begins = np.cumsum(lengths) - lengths
                    for doc_id, begin, n in zip(part.column("doc_id").to_pylist(), begins.tolist(), lengths.tolist(), strict=True):
                        start = 0
                        for piece, length in enumerate(piece_lengths(n, capacity)):
                            at = (begin + start) * 4
                            yield doc_id, piece, start, length, zlib.crc32(raw[at : at + length * 4])
                            start += length

        yield from _packed(pieces(), capacity, open_bins, arrivals, _first_id(0, TaskContext.get().partitionId()))

    def again(round_no):
        def run(batches):
            first = next(batches, None)
            if first is None or not first.num_rows:
                return

            def pieces():
                for batch in chain([first], batches):
                    yield from zip(*[batch.column(c).to_pylist() for c in _ARROW.names[:5]], strict=True)

            yield from _packed(pieces(), capacity, open_bins, arrivals, _first_id(round_no, first.column("next_task")[0].as_py()))

        return run

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rounds = [materialize(small_batches(texts).mapInArrow(encode, _PIECES), "packed")]
    while True:
        left = rounds[-1].where("is_open")
        task = F.shiftright("sequence_id", 32).bitwiseAND(0xFFFFFF)
        last = left.agg(F.max(task)).first()[0]
        if not last:  # nothing is open, or one task's bins alone
            break
        rounds[-1] = rounds[-1].where("NOT is_open")
        dealt = left.withColumn("next_task", F.floor(task / MERGED_TASKS)).repartition(last // MERGED_TASKS + 1, "next_task").sortWithinPartitions("next_task", "sequence_id", "offset")
        rounds.append(materialize(dealt.mapInArrow(again(len(rounds)), _PIECES), "packed"))
    packed = rounds[0]
    for more in rounds[1:]:
        packed = packed.unionAll(more)
    return packed.drop("is_open")
