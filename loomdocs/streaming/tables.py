"""Streams over what has landed, and tables that take their micro-batches."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir; only a local session may go without that setting."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def landed(spark: SparkSession, path: str) -> DataFrame:
    """A stream of a Parquet folder's (or file's) rows."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory():
        return reader.parquet(path)
    folder, _, name = path.rpartition("/")  # file streams read folders
    return reader.option("pathGlobFilter", name).parquet(folder)


def run_to_table(stream: DataFrame, name: str) -> DataFrame:
    """Process all available input into Parquet and read it."""
    spark = stream.sparkSession
    path = shared_folder(spark, name)
    stream.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


class Scratch:
    """Tables in the shared folder that several outputs of a job need: each is computed once.

    `remove` deletes them when the outputs are written; as a context manager it does so at the end.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """df as such a table."""
        self.paths.append(shared_folder(self.spark, name))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def remove(self) -> None:
        for path in self.paths:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self.paths = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *problem) -> None:
        self.remove()


class Versions:
    """A table as numbered Parquet directories under one root; `current` is the last complete one."""

    def __init__(self, spark: SparkSession, root: str, schema: str):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema

    def _numbers(self) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        done = lambda s: fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))
        return sorted(int(s.getPath().getName()[2:]) for s in fs.listStatus(path) if s.getPath().getName().startswith("v=") and done(s))

    def current(self) -> DataFrame:
        numbers = self._numbers()
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/v={numbers[-1]}") if numbers else self.spark.createDataFrame([], self.schema)

    def put(self, df: DataFrame) -> None:
        numbers = self._numbers()
        df.write.mode("overwrite").parquet(f"{self.root}/v={(numbers[-1] if numbers else 0) + 1}")


class BucketTables:
    """Tables cut into buckets by a hash of their key, changed together by numbered batches.

    A batch reads and writes only the buckets that its keys fall into; all other
    buckets keep their files. tables: name -> (schema, key). New buckets are
    written beside the old ones, in `name/v=<batch>/bucket=<b>`; a batch counts once
    its manifest is there, which names the version of every bucket of every table
    and appears by one rename. So readers see a batch whole, in all tables, or not
    at all; a batch that failed is written again; and a batch number that is already
    in is passed over. The last two states stay readable, older buckets go.

    Rows of a null key are a bucket like others. Choose n_buckets so that a bucket
    suits a few tasks (a bucket's rows may be split over several).
    """

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, tuple[str, str]], n_buckets: int = 64):
        self.spark, self.root, self.tables, self.n_buckets = spark, root.rstrip("/"), tables, n_buckets
        path = self._path("_commits")
        self.fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        known = self.manifest()
        if known and known["n_buckets"] != n_buckets:
            raise ValueError(f"{root} has {known['n_buckets']} buckets")

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _commits(self) -> list[int]:
        folder = self._path("_commits")
        names = [x.getPath().getName() for x in self.fs.listStatus(folder)] if self.fs.exists(folder) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def _read(self, number: int) -> dict:
        stream = self.fs.open(self._path("_commits", f"{number}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def manifest(self) -> dict | None:
        """The last batch: {batch, n_buckets, tables: {name: {bucket: version}}}."""
        numbers = self._commits()
        return self._read(numbers[-1]) if numbers else None

    def last_batch(self) -> int:
        numbers = self._commits()
        return numbers[-1] if numbers else -1

    def bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.n_buckets)).cast("int")

    def buckets_of(self, rows: DataFrame, key: str) -> list[int]:
        """Buckets that the rows' keys fall into: n_buckets numbers at most."""
        return sorted(r[0] for r in rows.select(self.bucket(F.col(key)).alias("bucket")).distinct().collect())

    def current(self, name: str, buckets: list[int] | None = None) -> DataFrame:
        """A table's rows, of all buckets or of the given ones."""
        schema, known = self.tables[name][0], self.manifest()
        versions = known["tables"].get(name, {}) if known else {}
        paths = [f"{self.root}/{name}/v={v}/bucket={b}" for b, v in versions.items() if buckets is None or int(b) in set(buckets)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def commit(self, batch: int, changes: dict[str, tuple[list[int], DataFrame]]) -> bool:
        """Replace, for each named table, the given buckets by the given rows; False if the batch is in already."""
        before = self.manifest()
        if before and before["batch"] >= batch:
            return False
        after = {name: dict(before["tables"].get(name, {})) if before else {} for name in self.tables}
        for name, (buckets, rows) in changes.items():
            own = self.bucket(F.col(self.tables[name][1]))
            checked = F.when(own.isin(buckets), own).otherwise(F.raise_error(F.lit(f"{name}: a row outside the batch's buckets"))).cast("int") if buckets else own
            columns = self.spark.createDataFrame([], self.tables[name][0]).columns
            rows.select(*columns, checked.alias("bucket")).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/{name}/v={batch}")
            for b in buckets:
                after[name].pop(str(b), None)
                if self.fs.exists(self._path(name, f"v={batch}", f"bucket={b}")):
                    after[name][str(b)] = batch
        self._publish(batch, {"batch": batch, "n_buckets": self.n_buckets, "tables": after})
        self._remove_old()
        return True

    def _publish(self, batch: int, manifest: dict) -> None:
        draft = self._path("_commits", f".{uuid.uuid4().hex}")
        stream = self.fs.create(draft, True)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        if not self.fs.rename(draft, self._path("_commits", f"{batch}.json")):
            raise OSError(f"batch {batch} of {self.root} could not be published")

    def _remove_old(self, keep: int = 2) -> None:
        numbers = self._commits()
        places = lambda m: {(name, v, b) for name, own in m["tables"].items() for b, v in own.items()}
        kept = set().union(*[places(self._read(n)) for n in numbers[-keep:]])
        for number in numbers[:-keep]:
            for name, v, b in places(self._read(number)) - kept:
                self.fs.delete(self._path(name, f"v={v}", f"bucket={b}"), True)
            self.fs.delete(self._path("_commits", f"{number}.json"), False)
