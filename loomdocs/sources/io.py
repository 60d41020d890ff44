"""Readers and writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.tables import Versions
from . import schemas

# Columns of draw results, in their order.
DRAW_COLUMNS = ["Year", "Date", "Winning Numbers", "Jackpot", "Outcome"]
PAGE_NAME_LENGTH = 250


def read_jdbc_tables(spark: SparkSession, url: str, tables: dict[str, tuple[str, int, int]], partitions: int = 64, **properties: str) -> dict[str, DataFrame]:
    """Tables of an external database, split by a numeric column: name -> (column, lower, upper). Filters and columns are pushed down."""
    return {name: spark.read.jdbc(url, name, column=column, lowerBound=low, upperBound=high, numPartitions=partitions, properties=properties) for name, (column, low, high) in tables.items()}


def write_jdbc_table(df: DataFrame, url: str, name: str, types: str | None = None, **properties: str) -> None:
    """A table of an external database from a DataFrame, in as many connections as it has partitions; types: DDL of columns whose database type matters."""
    writer = df.write.option("createTableColumnTypes", types) if types else df.write
    writer.jdbc(url, name, mode="errorifexists", properties=properties)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A record table of the lake with its fixed schema."""
    return spark.read.schema(schemas.TABLES[name]).parquet(f"{root}/{name}")


def read_catalog(spark: SparkSession, paths: str | list[str], schema: str | None = None) -> DataFrame:
    """S3: product catalogs (JSON arrays), with the file each product came from."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(paths).withColumn("catalog_file", F.col("_metadata.file_path"))


def write_json_arrays(df: DataFrame, path: str, place: str, rows: int = 1000) -> None:
    """Files of JSON arrays, as vendors deliver them: `rows` consecutive numbers of `place` make one array."""
    group = F.floor(F.col(place) / rows)
    arrays = df.groupBy(group.alias("group")).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(F.col(place).alias("k"), F.to_json(F.struct(*df.columns)).alias("v")))), lambda x: x["v"]), ",\n").alias("v"))
    arrays.select(F.concat(F.lit("["), "v", F.lit("]")).alias("value"), "group").write.partitionBy("group").text(path)


def read_judgments(spark: SparkSession, path: str) -> DataFrame:
    """Judgments (JSON arrays)."""
    return spark.read.schema(schemas.JUDGMENTS).option("multiLine", True).json(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed raw pages."""
    return spark.read.schema(schemas.PAGES).parquet(path)


def read_draws(spark: SparkSession, path: str) -> DataFrame:
    """Draw results."""
    return spark.read.schema(schemas.DRAWS).option("header", True).csv(path)


def export(df: DataFrame, path: str, fmt: str | None = None) -> str:
    """K1-K4: write CSV with header, Parquet or JSON; the format follows the path's extension, CSV for unknown ones."""
    extension = path.rsplit("/", 1)[-1].rpartition(".")[2].lower()
    fmt = fmt or {"parquet": "parquet", "json": "json"}.get(extension, "csv")
    if fmt == "csv":
        df.write.option("header", True).csv(path)
    else:
        df.write.format(fmt).save(path)
    return fmt


def write_draws(df: DataFrame, path: str) -> bool:
    """K5: draw results in fixed column order; nothing is written when there are none."""
    if df.isEmpty():
        return False
    df.select(*[F.col(f"`{c}`") for c in DRAW_COLUMNS]).write.option("header", True).csv(path)
    return True


def write_metrics(metrics: DataFrame, path: str) -> None:
    """K6: the new metrics replace the table, so names no longer present are gone. They are written beside the old ones and take their place when complete; a failed job leaves the old ones."""
    Versions(metrics.sparkSession, path, metrics.schema).put(metrics)


def read_metrics(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """K6: the metrics as last written."""
    return Versions(spark, path, schema).current()


def write_remainder(df: DataFrame, path: str) -> None:
    """K7: products that didn't match, to a new path."""
    df.write.mode("errorifexists").json(path)


def publish_pages(scrubbed: DataFrame) -> DataFrame:
    """K8: book (court), chapter (year of the decision), page name (first 250 characters of the title) and body.

    Input: court, document_date, title, body. Missing courts go to `Unknown`.
    """
    return scrubbed.select(
        F.coalesce("court", F.lit("Unknown")).alias("book"),
        F.coalesce(F.year("document_date").cast("string"), F.lit("Undated")).alias("chapter"),
        F.substring(F.coalesce("title", F.lit("Untitled")), 1, PAGE_NAME_LENGTH).alias("page_name"),
        "body",
    )


def write_pages(pages: DataFrame, path: str) -> None:
    pages.write.partitionBy("book").parquet(path)
