import zlib

import numpy as np
from pyspark.sql import functions as F

from loomdocs.llm.queries import tokenizer_path
from loomdocs.llm.sharding import shard_by_bytes
from loomdocs.llm.token_output import PieceEncoder, read_token_files, token_output, write_token_files

DOCS = "doc_id long, text string, bytes string, before string"
ROWS = [(5, "hello world", "x", "y"), (1, None, None, None), (3, "", "", ""), (2, "é  b\n\n c", "", ""), (None, "null id", "", ""), (9, "word " * 9000, "", ""), (9, "word " * 9000, "", "")]


def brute_shards(rows, n):
    sized = sorted(((d if d is not None else -1, zlib.crc32((t or "").encode()), len((t or "").encode()) + 8) for d, t, *_ in rows))
    total, before, out, slots = sum(x[2] for x in sized), 0, [], {}
    for d, crc, size in sized:
        shard = min(n - 1, (2 * before + size) * n // (2 * total))
        slots[shard] = slots.get(shard, -1) + 1
        out.append((d, size, crc, "bytes", shard, slots[shard], None))
        before += size
    return out


def test_shards_equal_brute_force(spark):
    rows = ROWS + [(100 + i, "t" * (i * 7 % 50), None, None) for i in range(200)]
    got = [tuple(r) for r in shard_by_bytes(spark.createDataFrame(rows, DOCS), 6).select(F.coalesce("doc_id", F.lit(-1)), "size", "text_crc32", "law", "shard", "slot", "grown_shard").collect()]
    assert sorted(got, key=str) == sorted(brute_shards(rows, 6), key=str)


def test_shards_of_nothing(spark):
    assert shard_by_bytes(spark.createDataFrame([], DOCS)).collect() == []


def test_pieces_equal_whole_texts():
    encoder = PieceEncoder(tokenizer_path())
    odd = ["a  b", "a \n b", "  x", " x", "x ", "  ", "", "it's a 'test' \x1c b", "a\n\nb c", "a\tb\nc d", "ñ é\nü 1 2\n3", "<|endoftext|> a<|endoftext|>b", "a᠎ b", "a\xa0 b", "plain words here\nand there"]
    whole = [x.ids for x in encoder.tokenizer.encode_batch(odd, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(odd)] == whole
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(odd)] == whole  # from the cache


def test_special_tokens_in_texts_as_by_the_plain_call(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y\n<|endoftext|> z  w", "a b", "", "<|endoftext| >", "a  <|endoftext|>\n\nb", "a <|endoftext|> b"]
    whole = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert whole[0] == [64, 220, 50256, 275]
    assert [np.frombuffer(x, "<u4").tolist() for x in PieceEncoder(tokenizer_path()).encode(texts)] == whole
    start, wanted = 0, []
    for d, ids in enumerate(whole):
        raw = np.array([*ids, 2], "<u4").tobytes()
        wanted.append((d, start, len(ids) + 1, zlib.crc32(raw)))
        start += len(ids) + 1
    docs = spark.createDataFrame([(d, t, "", "") for d, t in enumerate(texts)], DOCS)
    assert sorted(tuple(r) for r in token_output(docs, tokenizer_path()).collect()) == wanted


def test_token_files_round_trip(spark, tmp_path):
    docs = spark.createDataFrame([r for r in ROWS if r[0] is not None], DOCS)
    encoder = PieceEncoder(tokenizer_path())
    got = sorted(tuple(r) for r in token_output(docs, tokenizer_path()).collect())
    start, wanted = 0, []
    for d, text, *_ in sorted(r for r in ROWS if r[0] is not None for r in [(r[0], r[1] or "")]):
        ids = np.append(np.frombuffer(encoder.encode([text])[0], "<u4"), 2).astype("<u4")
        wanted.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert got == sorted(wanted)
    path = str(tmp_path / "ids")
    write_token_files(docs, path, tokenizer_path())
    assert [r["n_tokens"] for r in read_token_files(spark, path, [3]).collect()] == [1]
    assert sum(r["n_tokens"] for r in read_token_files(spark, path).collect()) == start


def test_token_files_of_nothing(spark):
    assert token_output(spark.createDataFrame([], DOCS), tokenizer_path()).collect() == []


def stripes(spark, file):
    """(rows, kinds of streams) of each stripe, from the file's own footers."""
    jvm = spark._jvm
    reader = jvm.org.apache.orc.OrcFile.createReader(jvm.org.apache.hadoop.fs.Path(file), jvm.org.apache.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration()))
    rows, out = reader.rows(), []
    for stripe in reader.getStripes():
        footer = rows.readStripeFooter(stripe)
        out.append((stripe.getNumberOfRows(), {(x.getColumn(), x.getKind().toString()) for x in footer.getStreamsList()}, {e.getKind().toString() for e in footer.getColumnsList()}))
    rows.close()
    return out


def test_stripes_indexes_and_bloom_filters_are_in_the_files(spark, tmp_path):
    texts = [(i, " ".join(f"w{i}x{k}" for k in range(5)), "", "") for i in range(0, 100_000, 2)]
    path = str(tmp_path / "ids")
    write_token_files(spark.createDataFrame(texts, DOCS), path, tokenizer_path(), stripe_bytes=1 << 17, index_rows=1000)
    files = sorted(str(p) for p in (tmp_path / "ids").glob("part-*.orc"))
    every = [s for f in files for s in stripes(spark, f)]
    assert len(every) > len(files) > 1 and sum(n for n, _, _ in every) == len(texts)
    for _, streams, encodings in every:
        assert (1, "BLOOM_FILTER_UTF8") in streams and {(c, "ROW_INDEX") for c in (1, 4, 5)} <= streams  # doc_id, n_tokens, ids
        assert "DIRECT_V2" in encodings and "DIRECT" in encodings  # run-length integers; the root struct
    # metadata alone rules an id out that lies between two others: no row is read
    assert read_token_files(spark, path, [1001]).count() == 0
    found = read_token_files(spark, path, [1000, 1001])
    assert [r["doc_id"] for r in found.collect()] == [1000]
    assert "In(doc_id, [1000,1001])" in found._jdf.queryExecution().executedPlan().toString().replace("`", "")
    assert read_token_files(spark, path).rdd.getNumPartitions() >= len(files)


def test_workers_let_go_of_the_encoder(spark):
    import gc

    import pyarrow as pa

    from loomdocs.llm.queries import tokenizer_path
    from loomdocs.llm.token_output import PieceEncoder, tokenize

    def left(batches):
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(isinstance(x, PieceEncoder) for x in gc.get_objects())])], ["n"])

    docs = spark.range(40).repartition(4).selectExpr("id AS doc_id", "concat('text ', id) AS text")
    assert tokenize(docs, tokenizer_path(), 2, ["doc_id"]).count() == 40
    found = spark.range(40).repartition(4).mapInArrow(left, "n long").collect()
    assert found and not any(r["n"] for r in found)
