"""Product catalogs and judgments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import case_year, duration_years
from ..functions.text import rand_price
from ..functions.urls import abs_url
from .filters import not_empty, pick
from .joins import match_catalog

# Fixed value: stock codes with this ending are dropped.
DROPPED_SUFFIX = "-MANTECH-EC"


def combine_catalogs(master: DataFrame, other: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Combined products, and what is left of either vendor.

    Both have place and pricing array<struct<qty:string,price:string>>. A stock code
    counts once (the first); blank ones stay in the remainder; DROPPED_SUFFIX ones go.
    Matches get the other vendor's image and its price and compare-at price as tiers.
    """
    coded = pick(master.where(not_empty("stock_code") & ~F.col("stock_code").endswith(DROPPED_SUFFIX)), ["stock_code"], ["place"])
    joined = match_catalog(coded, other)
    hit = F.col("other").isNotNull()
    tier = lambda name, price: F.when(not_empty(price), F.array(F.struct(F.lit(name).alias("qty"), price.alias("price")))).otherwise(F.array().cast("array<struct<qty:string,price:string>>"))
    none = F.array().cast("array<struct<qty:string,price:string>>")
    first = F.get(F.col("other.pricing"), 0)["price"]
    pricing = F.concat(F.coalesce("pricing", none), tier("markup", first), tier("no_discount", F.col("other.compare_at_price")))
    combined = joined.where(hit).withColumn("image_url2", F.col("other.image_url")).withColumn("pricing", pricing).drop("other")
    blank = master.where(~F.coalesce(not_empty("stock_code"), F.lit(False)))
    rest = joined.where(~hit).select(*master.columns).unionByName(blank)
    used = combined.select(F.col("stock_code").alias("part_number"))
    # the other vendor's matched rows are those of the file that the match came from
    files = joined.where(hit).select(F.col("stock_code").alias("part_number"), F.col("other.catalog_file").alias("catalog_file")) if "catalog_file" in other.columns else used
    return combined, rest, other.join(files, files.columns, "left_anti").select(*other.columns)


def normalise_products(raw: DataFrame, site: str) -> DataFrame:
    """Products of vendor JSON: title, part_number, vendor, price (cents), compare_at_price (cents), image, url."""
    return raw.select(
        abs_url(F.lit(site), "url").alias("source_url"), "title", "part_number", F.col("part_number").alias("stock_code"), F.col("vendor").alias("manufacturer"),
        abs_url(F.lit(site), "image").alias("image_url"), F.array(F.struct(F.lit("1").alias("qty"), rand_price("price").alias("price"))).alias("pricing"), rand_price("compare_at_price").alias("compare_at_price"),
    )


def flatten_judgments(raw: DataFrame) -> DataFrame:
    """One flat row per judgment, with the case's year and duration."""
    return raw.select(
        "dataset_number", "court", F.col("division_location").alias("division"), "judge", F.to_date("judgment_date").alias("judgment_date"), "reportable",
        F.col("parties.applicant_plaintiff").alias("applicant"), F.col("parties.respondent_defendant").alias("respondent"), F.col("result.outcome_type").alias("outcome"), "subjects",
        case_year("dataset_number").alias("case_year"), duration_years("dataset_number", F.to_date("judgment_date")).alias("duration_years"),
    )
