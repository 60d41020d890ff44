"""Contiguous shards of near-equal byte size from global prefix sums (operator 4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._spark import materialize, tasks_for


def with_prefix_sums(rows: DataFrame, order: list[str], size: str) -> DataFrame:
    """Add `before` (sum of size over all rows ahead) and `row` (number of rows ahead).

    Rows are range-partitioned by `order` and written once; each written
    partition gives its total, the totals' prefix sums give its base, and a
    running sum inside the partition gives the rest. Only one row per
    partition meets in one place. Rows that tie in `order` get places of their
    own, in any order. Null sizes count as 0.
    """
    spark = rows.sparkSession
    placed = rows.repartitionByRange(tasks_for(spark), *order).withColumn("part", F.spark_partition_id()).sortWithinPartitions(*order)
    placed = materialize(placed, "ranges")
    totals = placed.groupBy("part").agg(F.sum(F.coalesce(F.col(size), F.lit(0))).alias("part_size"), F.count("*").alias("part_rows"))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("part_size").over(ahead), F.lit(0)).alias("base_size"), F.coalesce(F.sum("part_rows").over(ahead), F.lit(0)).alias("base_rows"))
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counted = placed.withColumn("own_size", F.coalesce(F.sum(F.coalesce(F.col(size), F.lit(0))).over(inside), F.lit(0))).withColumn("own_rows", F.count("*").over(inside))
    # One row per shuffle partition: a bound that doesn't depend on the data.
    return counted.join(F.broadcast(bases), "part").select(*rows.columns, (F.col("base_size") + F.col("own_size")).alias("before"), (F.col("base_rows") + F.col("own_rows")).alias("row"))


def shard_by_bytes(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text", overhead: int = 8) -> DataFrame:
    """Cut the documents, in id order, into n_shards contiguous shards of near-equal size.

    A document's size is the UTF-8 bytes of its text (null: none) plus
    `overhead`. It goes to the shard in which its middle byte falls, so that a
    shard's size differs from total / n_shards by less than one document.
    Returns id, size, text_crc32, law, shard, slot (gapless from 0 in each
    shard) and grown_shard (null: this law isn't by key).

    Null texts have crc32 0 and size `overhead`. Null ids sort first. Repeated
    ids and repeated rows keep a slot each. An empty table gives no rows, and
    other columns of the input are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    summed = with_prefix_sums(sized, ["doc_id", "text_crc32", "size"], "size")
    total = summed.agg(F.max(F.col("before") + F.col("size")).alias("total"))
    # shard = floor((before + size / 2) * n / total), in whole numbers that can't overflow
    middle = (F.col("before") * 2 + F.col("size")).cast("decimal(38,0)")
    # One row: the total of all sizes.
    placed = summed.crossJoin(F.broadcast(total)).withColumn("shard", F.least(F.lit(n_shards - 1), F.floor(middle * n_shards / (F.col("total") * 2).cast("decimal(38,0)")).cast("int")))
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first_row"))
    # n_shards rows at most.
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row") - F.col("first_row")).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )
