"""Structured Streaming forms (ST1-ST8). Each equals its batch operator on the same input."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import scrub
from ..operators.aggregates import BUCKET_MINUTES, GAP_SECONDS, ONLINE_MINUTES
from ..operators.documents import extract_pending
from .tables import BucketTables, Scratch


def stream_upsert(source: DataFrame, tables: BucketTables, name: str, key: str, merge: Callable[[DataFrame, DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """ST1, ST2: every micro-batch is merged into the buckets of `name` that its keys fall into; all available input, then stop.

    merge(old, batch) is the batch operator, on the rows of those buckets: record
    upsert (M2) for ingestion, section parsing with child upsert (M4). `key` is the
    batch's column with the table's key. A repeated batch number changes nothing.
    """

    def take(batch: DataFrame, number: int) -> None:
        if number > tables.last_batch():
            buckets = tables.buckets_of(batch, key)
            tables.commit(number, {name: (buckets, merge(tables.current(name, buckets), batch))})

    return source.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: Tables of the scrubbing stream.
SCRUB_TABLES = {"scrubbed": ("extracted_record_id long, data string, created_at timestamp, updated_at timestamp", "extracted_record_id"), "rejects": ("id long, reason string", "id")}


def scrub_batch(tables: BucketTables, batch: DataFrame, number: int, parsed: DataFrame, tgt: DataFrame, ent: DataFrame, extractor, now) -> bool:
    """One batch of landed records through extraction and scrubbing (D17), with its rejects (Q5); False if it is in already.

    Records that have a scrubbed row, and those that an earlier batch rejected, are
    left alone. Scrubbed rows and rejects are two tables under one batch number:
    both get the batch, or neither does. Only the batch's buckets are read and written,
    and nothing else stays in the shared folder.
    """
    if number <= tables.last_batch():
        return False
    buckets = tables.buckets_of(batch, "id")
    scrubbed, rejected = tables.current("scrubbed", buckets), tables.current("rejects", buckets)
    fresh = batch.join(rejected.select("id"), "id", "left_anti")
    with Scratch(batch.sparkSession) as scratch:
        child, rejects = extract_pending(fresh, parsed, scrubbed, tgt, ent, extractor, now, scratch)
        return tables.commit(number, {"scrubbed": (buckets, child), "rejects": (buckets, rejected.unionByName(rejects.groupBy("id").agg(F.min("reason").alias("reason"))))})


def stream_scrub(source: DataFrame, tables: BucketTables, parsed: DataFrame, tgt: DataFrame, ent: DataFrame, extractor, now, checkpoint: str) -> StreamingQuery:
    """ST3: scrub_batch for every micro-batch."""

    def take(batch: DataFrame, number: int) -> None:
        scrub_batch(tables, batch, number, parsed, tgt, ent, extractor, now)

    return source.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_intervals(ev: DataFrame, key: str, watermark: str = "10 minutes", minutes: int = BUCKET_MINUTES) -> DataFrame:
    """ST4: counts per completed bucket; empty buckets are filled by the reader."""
    counted = ev.withWatermark("ts", watermark).groupBy(key, F.window("ts", f"{minutes} minutes")).agg(F.count("*").alias("n"))
    return counted.select(key, F.unix_seconds("window.start").alias("start_s"), "n")


def stream_uptime(ev: DataFrame, key: str, watermark: str = "10 minutes", gap: int = GAP_SECONDS) -> DataFrame:
    """ST5: active sessions: consecutive events at most `gap` seconds apart."""
    sessions = ev.withWatermark("ts", watermark).groupBy(key, F.session_window("ts", f"{gap} seconds")).agg(F.min("ts").alias("first"), F.max("ts").alias("last"), F.count("*").alias("n"))
    return sessions.select(key, (F.unix_micros("last") - F.unix_micros("first")).alias("uptime_us"), (F.col("n") - 1).alias("active"), "n")


def online_state(silence: int = ONLINE_MINUTES * 60_000_000):
    """The step of stream_online: `online` at an event after silence, and `offline` once a key has been silent.

    Events wait until the watermark has passed them, and are then taken in time
    order, so what comes out doesn't depend on how the input was cut into batches.
    The state holds a key's events that the watermark hasn't passed, as 64-bit
    integers in one value, and goes with the key's rows: no call to the store for each.
    """

    def settle(key, frames, state):
        mark_ms = state.getCurrentWatermarkMs()
        mark = max(mark_ms, 0) * 1000
        last, waiting = state.get if state.exists else (None, b"")
        parts = [np.frombuffer(waiting, "<i8"), *[f["ts"].dropna().to_numpy().astype("datetime64[us]").astype("<i8") for f in frames]]
        events = np.unique(np.concatenate(parts))
        due, ahead = events[events <= mark], events[events > mark]
        if last is not None:
            due = np.concatenate([[last], due[due > last]])
        breaks = np.flatnonzero(np.diff(due) > silence)
        online, offline = due[breaks + 1], due[breaks] + silence
        if last is None and len(due):
            online = np.concatenate([due[:1], online])
        last = int(due[-1]) if len(due) else None
        if last is not None and last + silence <= mark:
            offline, last = np.append(offline, last + silence), None
        if last is None and not len(ahead):
            if state.exists:
                state.remove()
        else:
            state.update((last, ahead.astype("<i8").tobytes()))
            first = min([*ahead[:1].tolist(), *([last + silence] if last is not None else [])])
            # a timeout comes when the watermark is beyond it: here as soon as it has reached `first`
            state.setTimeoutTimestamp(max(-(-first // 1000) - 1, mark_ms, 1))
        if len(online) or len(offline):
            yield pd.DataFrame({"key": key[0], "state": ["online"] * len(online) + ["offline"] * len(offline), "at_us": np.concatenate([online, offline])})

    return settle


def stream_online(ev: DataFrame, key: str, watermark: str = "10 minutes") -> DataFrame:
    """ST6: changes of each key's online state up to the watermark; the batch form is aggregates.online_changes. The RocksDB state store keeps the state outside the heap."""
    named = ev.where("ts is not null").select(F.col(key).cast("string").alias("key"), "ts").withWatermark("ts", watermark)
    return named.groupBy("key").applyInPandasWithState(online_state(), "key string, state string, at_us long", "last long, waiting binary", "append", "EventTimeTimeout")


def stream_dedupe(ev: DataFrame, keys: list[str], watermark: str = "1 hour") -> DataFrame:
    """ST7: first row of each key within the watermark; for an unbounded history merge with stream_upsert."""
    return ev.withWatermark("ts", watermark).dropDuplicatesWithinWatermark(keys)


def stream_redact(docs: DataFrame, column: str = "text") -> DataFrame:
    """ST8: scrubbed text; no state."""
    return docs.withColumn(column, scrub(column))
