"""Shared helpers: scratch tables in the cluster's shared folder, Arrow text mapping."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one vectorised step handles at once; a longer text is a step of its own.
CHUNK_BYTES = 2 << 20
#: Rows of an Arrow batch.
BATCH_ROWS = 500
#: Spark's setting to remove a query's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir; only a local session may go without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back; this cuts the lineage."""
    spark = df.sparkSession
    path = scratch(spark, name)
    # the table stands for the shuffles behind it: let Spark remove their files when it is written
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(table: DataFrame) -> None:
    """Remove a scratch table that nothing will read again."""
    spark = table.sparkSession
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def tasks_for(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most `limit` bytes of text each, or one row."""
    size = batch.column(text).nbytes
    if size <= limit or batch.num_rows <= 1:
        if batch.num_rows:
            yield batch
        return
    half = batch.num_rows // 2
    yield from chunks(batch.slice(0, half), text, limit)
    yield from chunks(batch.slice(half), text, limit)


def small_batches(df: DataFrame) -> DataFrame:
    """df, with Arrow batches of few rows from here on in its session: texts make batches large."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def map_texts(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str, text: str = "text", limit: int = CHUNK_BYTES) -> DataFrame:
    """Apply fn to small Arrow batches of df (of `limit` bytes of text, or one row), in parallel, without a shuffle."""

    def run(batches):
        for batch in batches:
            for part in chunks(batch, text, limit):
                yield from fn(part)
        pa.default_memory_pool().release_unused()  # not for the worker's next job

    return small_batches(df).mapInArrow(run, schema)
