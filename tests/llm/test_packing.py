import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from loomdocs.llm import packing
from loomdocs.llm.packing import BestFit, pack_documents, piece_lengths
from loomdocs.llm.queries import op13_best_fit_packing, tokenizer_path

DOCS = "doc_id long, text string, piece string, sequence_id string, offset string, is_open string"


def brute_pack(lengths, capacity, open_bins):
    """Open bins as a plain list: the least free space that fits, else a new bin, the fullest closed first."""
    opened, closed = [], []
    for i, n in enumerate(lengths):
        fits = [b for b in opened if b[0] >= n]
        if fits:
            bin_ = min(fits, key=lambda b: (b[0], -b[2]))
        else:
            if n < capacity and len(opened) == open_bins:
                full = min(opened, key=lambda b: (b[0], -b[2]))
                opened.remove(full)
                closed.append(full[1])
            bin_ = [capacity, [], 0]
            opened.append(bin_)
        bin_[0] -= n
        bin_[1].append(i)
        bin_[2] = i  # of bins with equal space the one changed last
        if not bin_[0]:
            opened.remove(bin_)
            closed.append(bin_[1])
    return sorted(closed + [b[1] for b in opened])


@pytest.mark.parametrize("open_bins", [1, 3, 50])
def test_best_fit_equals_a_plain_search(open_bins):
    rng = random.Random(open_bins)
    for _ in range(30):
        lengths = [rng.randint(1, 40) for _ in range(rng.randint(0, 200))]
        packer, bins = BestFit(40, open_bins), []
        for i, n in enumerate(lengths):
            bins += packer.add(n, i)
            assert packer.n_open <= open_bins
        bins += packer.rest()
        assert sorted(bins) == brute_pack(lengths, 40, open_bins)
        assert packer.free == 0 and packer.n_open == 0


def test_pieces():
    assert piece_lengths(1, 10) == [1] and piece_lengths(10, 10) == [10]
    assert piece_lengths(11, 10) == [1, 10] and piece_lengths(30, 10) == [10, 10, 10]


def whole(rows, docs, capacity):
    """Every piece of every row once, right ids, sequences without gaps; returns the number of sequences."""
    plain = Tokenizer.from_file(tokenizer_path())
    wanted = []
    for doc_id, text in docs:
        ids, start = [*plain.encode(text or "", add_special_tokens=False).ids, 2], 0
        for piece, n in enumerate(piece_lengths(len(ids), capacity)):
            wanted.append((doc_id, piece, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())))
            start += n
    assert sorted(tuple(r)[:5] for r in rows if r["doc_id"] is not None) == sorted(w for w in wanted if w[0] is not None)
    assert len(rows) == len(wanted)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= capacity
    return len(sequences), -(-sum(w[3] for w in wanted) // capacity)


def test_odd_documents_are_packed_whole(spark):
    docs = [(1, None), (2, ""), (None, "null id"), (None, None), (3, "word " * 3000), (4, "a  b\n\n c\t"), (5, "x" * 70_000), (6, "same text"), (6, "same text"), (7, "same text"), (8, "<|endoftext|> é")]
    rows = pack_documents(spark.createDataFrame([(*d, "a", "b", "c", "d") for d in docs], DOCS), tokenizer_path(), 64).collect()
    n, least = whole(rows, docs, 64)
    assert n <= least + 2


def test_tasks_bins_are_packed_again(spark, monkeypatch):
    monkeypatch.setattr(packing, "MERGED_TASKS", 3)
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice(["a", "be", "see", "deed", "eager"]) for _ in range(rng.randint(0, 90)))) for i in range(600)]
    frame = spark.createDataFrame([(*d, "", "", "", "") for d in docs], DOCS).repartition(20)
    rows = pack_documents(frame, tokenizer_path(), 100).collect()
    n, least = whole(rows, docs, 100)
    assert n <= 1.05 * least + 1  # 30 short documents a task; best fit of all 600 in one task takes 292 sequences
    assert len({r["sequence_id"] >> 56 for r in rows}) > 2


def test_few_open_bins_still_pack_everything(spark):
    docs = [(i, "t " * (i * 37 % 50)) for i in range(200)]
    rows = pack_documents(spark.createDataFrame([(*d, "", "", "", "") for d in docs], DOCS), tokenizer_path(), 60, open_bins=2, arrivals=1).collect()
    n, least = whole(rows, docs, 60)
    assert n <= 1.5 * least


def test_nothing_to_pack(spark):
    assert pack_documents(spark.createDataFrame([], DOCS), tokenizer_path()).collect() == []


def test_query_packs_the_table_close_to_its_bound(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = op13_best_fit_packing(spark, sf_dir).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    n, least = whole(rows, docs, 1024)
    assert n <= 1.01 * least + 1
