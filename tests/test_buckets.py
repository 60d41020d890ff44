"""Bucketed tables, and the streams that merge into them."""

import datetime as dt
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from loomdocs.operators import documents, merge
from loomdocs.plans import catalog
from loomdocs.streaming.streams import SCRUB_TABLES, scrub_batch, stream_upsert
from loomdocs.streaming.tables import BucketTables, shared_folder

CHILD = "extracted_record_id long, data string, created_at timestamp, updated_at timestamp"
def now():
    return F.lit(dt.datetime(2024, 1, 1)).cast("timestamp")


def files(root):
    return {str(p.relative_to(root)): os.stat(p).st_mtime_ns for p in Path(root).rglob("*.parquet")}


def child(spark, ids, data):
    return spark.createDataFrame([(i, f"{data}{i}") for i in ids], "extracted_record_id long, data string")


def upserted(tables, number, rows):
    buckets = tables.buckets_of(rows, "extracted_record_id")
    return buckets, tables.commit(number, {"t": (buckets, merge.upsert_child(tables.current("t", buckets), rows, now()))})


def test_a_small_batch_leaves_other_buckets_alone(spark, tmp_path):
    tables = BucketTables(spark, str(tmp_path), {"t": (CHILD, "extracted_record_id")}, 16)
    assert tables.current("t").count() == 0 and tables.last_batch() == -1
    upserted(tables, 0, child(spark, range(1000), "a"))
    before = files(tmp_path)
    buckets, done = upserted(tables, 1, child(spark, [*range(0, 1000, 200), 5000], "b"))
    assert done and 0 < len(buckets) < 16
    after = files(tmp_path)
    assert {k: v for k, v in after.items() if k in before} == before  # nothing old was written again
    assert all(int(k.split("bucket=")[1].split("/")[0]) in buckets for k in set(after) - set(before))
    whole = merge.upsert_child(merge.upsert_child(spark.createDataFrame([], CHILD), child(spark, range(1000), "a"), now()), child(spark, [*range(0, 1000, 200), 5000], "b"), now())
    assert sorted(map(tuple, tables.current("t").collect())) == sorted(map(tuple, whole.collect()))


def test_a_batch_number_counts_once(spark, tmp_path):
    tables = BucketTables(spark, str(tmp_path), {"t": (CHILD, "extracted_record_id")}, 4)
    upserted(tables, 3, child(spark, range(20), "a"))
    before = files(tmp_path)
    assert upserted(tables, 3, child(spark, range(20), "other"))[1] is False
    assert upserted(tables, 2, child(spark, range(20), "other"))[1] is False
    assert files(tmp_path) == before and tables.current("t").where("data like 'other%'").count() == 0


def test_a_failed_batch_changes_nothing_and_is_written_again(spark, tmp_path):
    tables = BucketTables(spark, str(tmp_path), {"t": (CHILD, "extracted_record_id"), "u": (CHILD, "extracted_record_id")}, 4)
    upserted(tables, 0, child(spark, range(20), "a"))
    rows = merge.upsert_child(spark.createDataFrame([], CHILD), child(spark, range(20), "b"), now())
    with pytest.raises(Exception, match="outside the batch's buckets"):
        tables.commit(1, {"t": ([0, 1, 2, 3], rows), "u": ([0], rows)})
    assert tables.last_batch() == 0 and tables.current("t").where("data like 'a%'").count() == 20 and tables.current("u").count() == 0
    assert tables.commit(1, {"t": ([0, 1, 2, 3], rows), "u": ([0, 1, 2, 3], rows)})
    assert tables.current("t").where("data like 'b%'").count() == 20 and tables.current("u").count() == 20


def test_emptied_buckets_null_keys_and_old_versions(spark, tmp_path):
    tables = BucketTables(spark, str(tmp_path), {"t": ("k string, n int", "k")}, 4)
    rows = spark.createDataFrame([(None, 1), ("", 2), ("x", 3), ("x", 4)], "k string, n int")
    every = [0, 1, 2, 3]
    tables.commit(0, {"t": (every, rows)})
    assert sorted(r["n"] for r in tables.current("t").collect()) == [1, 2, 3, 4]
    assert [r["n"] for r in tables.current("t", tables.buckets_of(rows.where("k is null"), "k")).where("k is null").collect()] == [1]
    tables.commit(1, {"t": (every, rows.where("n > 2"))})
    tables.commit(2, {"t": (every, rows.where("n > 9"))})
    assert tables.current("t").count() == 0
    tables.commit(3, {"t": ([], rows.where("n > 9"))})
    assert not any("v=0" in k for k in files(tmp_path))
    with pytest.raises(ValueError, match="4 buckets"):
        BucketTables(spark, str(tmp_path), {"t": ("k string, n int", "k")}, 8)


def test_stream_takes_new_files_by_bucket(spark, tmp_path):
    tables = BucketTables(spark, str(tmp_path / "t"), {"t": (CHILD, "extracted_record_id")}, 8)

    def run():
        source = spark.readStream.schema("extracted_record_id long, data string").parquet(str(tmp_path / "in"))
        stream_upsert(source, tables, "t", "extracted_record_id", lambda old, batch: merge.upsert_child(old, batch, now()), str(tmp_path / "state")).awaitTermination()

    child(spark, range(100), "a").coalesce(1).write.parquet(str(tmp_path / "in"))
    run()
    before = files(tmp_path / "t")
    child(spark, [7], "b").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    run()
    assert len({k.split("bucket=")[1].split("/")[0] for k in set(files(tmp_path / "t")) - set(before)}) == 1
    assert {r["data"] for r in tables.current("t").where("extracted_record_id in (7, 8)").collect()} == {"b7", "a8"}
    run()  # nothing new
    assert tables.current("t").count() == 100


class _Tables:
    def __init__(self, spark, docs):
        self.spark, self.docs = spark, docs

    def __getitem__(self, name):
        if name == "documents":
            return self.docs
        return self.spark.createDataFrame([(i, f"n{i}", i % 5) for i in range(25)], "n_nationkey long, n_name string, n_regionkey long") if name == "nation" else self.spark.createDataFrame([(i, f"r{i}") for i in range(5)], "r_regionkey long, r_name string")


def counting(folder):
    def run(frames):
        import uuid

        for pdf in frames:
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write("".join(f"{i},{p}\n" for i, p in zip(pdf["id"], pdf["pass"], strict=True)))
            yield from catalog._json_passes([pdf])

    return run


def calls(folder):
    return sorted(line for f in Path(folder).iterdir() for line in f.read_text().split())


def test_extractor_sees_every_context_once(spark, tmp_path):
    t = _Tables(spark, spark.createDataFrame([(i, f"text {i}") for i in range(60)], "doc_id long, text string"))
    none = spark.createDataFrame([], CHILD)
    parsed, dims, ents = catalog._extraction(t)
    child_rows, rejects = documents.extract_pending(catalog._records(t.docs), parsed, none, dims, ents, counting(tmp_path), now())
    n_child, n_rejects = child_rows.count(), rejects.count()
    rejects.collect(), child_rows.collect()
    seen = calls(tmp_path)
    assert len(seen) == len(set(seen))
    pending = [i for i in range(60) if i % 5 and i % 13]
    assert {int(x.split(",")[0]) for x in seen} == set(pending)
    assert (n_child, n_rejects) == (sum(bool(i % 7) for i in pending), sum(not i % 7 for i in pending))


def test_rejects_are_kept_and_skipped(spark, tmp_path):
    (tmp_path / "calls").mkdir()
    scratch = Path(shared_folder(spark, "x")).parent
    left = set(scratch.glob("*"))
    tables = BucketTables(spark, str(tmp_path / "t"), SCRUB_TABLES, 4)
    t = _Tables(spark, spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string"))
    args = (*catalog._extraction(t), counting(tmp_path / "calls"), now())
    records = catalog._records(t.docs)
    assert scrub_batch(tables, records.where("id < 20"), 0, *args)
    first = calls(tmp_path / "calls")
    rejected = {i for i in range(40) if i % 5 and i % 13 and i % 7 == 0}
    assert {r["id"] for r in tables.current("rejects").collect()} == {i for i in rejected if i < 20}
    assert not scrub_batch(tables, records, 0, *args)  # a replay
    assert calls(tmp_path / "calls") == first
    assert scrub_batch(tables, records, 1, *args)  # all again, with new ones
    later = calls(tmp_path / "calls")
    assert len(later) == len(set(later)) and {int(x.split(",")[0]) for x in later} >= rejected
    assert {r["id"] for r in tables.current("rejects").collect()} == rejected
    assert tables.current("scrubbed").count() == sum(bool(i % 5 and i % 13 and i % 7) for i in range(40))
    assert {x for x in scratch.glob("*") if x.name.startswith(("pending", "extracted", "payloads"))} <= left
