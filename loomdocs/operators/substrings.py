"""Substring search by an index of character grams: candidates by the rarest gram, and only those are compared.

A string that holds another holds all its grams. Strings shorter than GRAM are
grams of their own length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of a gram.
GRAM = 3


def grams(c: str | Column, sizes: range | list[int]) -> Column:
    """Distinct substrings of these sizes; null and too short strings have none."""
    c = F.col(c) if isinstance(c, str) else c
    none = F.array().cast("array<string>")

    def of(k: int) -> Column:
        return F.when(F.length(c) >= k, F.transform(F.sequence(F.lit(1), F.length(c) - (k - 1)), lambda i: F.substring(c, i, F.lit(k)))).otherwise(none)

    return F.array_distinct(F.concat(*[of(k) for k in sizes]))


def substring_pairs(held: DataFrame, holding: DataFrame) -> DataFrame:
    """(needle, hay) for every needle of `held` that a hay of `holding` contains; both distinct, empty needles have no pairs.

    In place of a comparison of every needle with every hay: a needle meets the
    hays that hold its rarest gram, by an equi-join. Needles of a gram that no hay
    has drop out before that.
    """
    needles, hays = held.select("needle").where("needle <> ''").distinct(), holding.select("hay").where("hay is not null").distinct()
    index = hays.select("hay", F.explode(grams("hay", range(1, GRAM + 1))).alias("gram"))
    size = F.least(F.length("needle"), F.lit(GRAM))
    own = grams("needle", range(1, GRAM + 1))
    asked = needles.select("needle", F.explode(F.filter(own, lambda g: F.length(g) == size)).alias("gram"))
    counts = index.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = asked.join(counts, "gram", "left").groupBy("needle").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("best"))
    rarest = rarest.where("best.n > 0").select("needle", F.col("best.gram").alias("gram"))
    return rarest.join(index, "gram").where(F.contains("hay", F.col("needle"))).select("needle", "hay")


def _bucket(gram: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")


def write_gram_index(rec: DataFrame, path: str, columns: list[str | Column], key: str = "id", buckets: int = 64) -> None:
    """A table of (gram, id) of the columns' lower-cased strings, cut by a hash of the gram and sorted by it, so that a lookup reads some row groups."""
    own = [grams(F.lower(F.col(c) if isinstance(c, str) else c), [GRAM]) for c in columns]
    rows = rec.select(F.col(key).alias("id"), F.explode(F.array_distinct(F.concat(*own))).alias("gram"))
    rows.withColumn("bucket", _bucket(F.col("gram"), buckets)).hint("rebalance", "bucket").sortWithinPartitions("bucket", "gram").write.partitionBy("bucket").parquet(path)


def read_gram_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def candidates(index: DataFrame, question: str, buckets: int = 64) -> DataFrame | None:
    """ids that hold the question's rarest gram; None for questions that are too short for the index.

    The driver sees a number per gram of the question, no ids.
    """
    low = question.lower()
    if len(low) < GRAM:
        return None
    own = sorted({low[i : i + GRAM] for i in range(len(low) - GRAM + 1)})
    spark = index.sparkSession
    places = {r["gram"]: r["bucket"] for r in spark.createDataFrame([(g,) for g in own], "gram string").select("gram", _bucket(F.col("gram"), buckets).alias("bucket")).collect()}
    of = lambda gs: index.where(F.col("bucket").isin([places[g] for g in gs]) & F.col("gram").isin(gs))
    counts = {r["gram"]: r["n"] for r in of(own).groupBy("gram").agg(F.count("*").alias("n")).collect()}
    rarest = min(own, key=lambda g: counts.get(g, 0))
    return of([rarest]).select("id")
