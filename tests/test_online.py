"""The stream of online states against its batch form, however the input is cut."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from loomdocs.operators.aggregates import online_changes
from loomdocs.streaming.streams import stream_online


def test_online_stream_equals_batch(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rng, t0 = random.Random(2), datetime(2024, 1, 1)
    events = sorted((t0 + timedelta(seconds=rng.randint(0, 4 * 3600)), rng.choice("abc")) for _ in range(60))
    events.append((t0 + timedelta(hours=5), "d"))
    cuts = [events[:20], events[20:45], events[45:]]
    moved = cuts[1].pop(0)  # late by less than the watermark's delay or not at all
    cuts[0].append(moved)
    path = str(tmp_path / "in")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for cut in cuts:
        spark.createDataFrame(cut, "ts timestamp, who string").coalesce(1).write.mode("append").parquet(path)
        stream = stream_online(spark.readStream.schema("ts timestamp, who string").parquet(path), "who")
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(out).select("key", "state", "at_us").collect()))
    whole = spark.createDataFrame(events, "ts timestamp, who string")
    mark = F.lit(int((t0 + timedelta(hours=5) - timedelta(minutes=10) - datetime(1970, 1, 1)).total_seconds()) * 1_000_000)
    assert got == sorted(map(tuple, online_changes(whole, "who", mark).select("key", "state", "at_us").collect()))
    assert len(got) > 6


def test_events_of_the_same_instant_as_the_watermark(spark, tmp_path):
    """A key whose silence ends, or whose event lies, exactly at the watermark is settled; a millisecond later it waits. The state is one value per key."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    t0 = datetime(2024, 1, 1)
    at = lambda ms: t0 + timedelta(milliseconds=ms)
    minute = 60_000
    events = [(at(0), "ends"), (at(1), "stays"), (at(15 * minute), "on"), (at(15 * minute + 1), "waits"), (at(25 * minute), "last")]
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame(events, "ts timestamp, who string").coalesce(1).write.parquet(path)
    stream = stream_online(spark.readStream.schema("ts timestamp, who string").parquet(path), "who")
    plan = stream._jdf.queryExecution().analyzed().toString()
    assert "FlatMapGroupsInPandasWithState" in plan  # no call to the state store for each event and timer
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "state")).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    begin = 1704067200_000_000
    got = sorted((r["key"], r["state"], r["at_us"] - begin) for r in spark.read.parquet(out).collect())
    assert got == [("ends", "offline", 900_000_000), ("ends", "online", 0), ("on", "online", 900_000_000), ("stays", "online", 1000)]
