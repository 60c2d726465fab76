"""The given Parquet tables, and the reviews and listings derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reviews_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """One review per line item: the order is the guest, the part is the listing.

    Dates are text with blanks, junk, slashes and impossible days mixed in.
    """
    slot = (F.col("l_orderkey") + F.col("l_linenumber")) % 40
    date = (
        F.when(slot == 0, F.lit(None).cast("string"))
        .when(slot == 1, "invalid")
        .when(slot == 2, "2000/01/15")
        .when(slot == 3, "2000-13-45")
        .otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))
    )
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        F.col("l_partkey").cast("string").alias("listing_id"),
        F.col("l_orderkey").alias("reviewer_id"),
        date.alias("date"),
    )


def listings_from_part(part: DataFrame) -> DataFrame:
    """One listing per part, with blank, junk, too low and too high prices and unknown areas."""
    price_slot = F.col("p_partkey") % 20
    price = (
        F.when(price_slot == 0, F.lit(None).cast("string"))
        .when(price_slot == 1, "")
        .when(price_slot == 2, "free")
        .when(price_slot == 3, "$5.00")
        .when(price_slot == 4, "$20,000.00")
        .when(price_slot == 5, "1.2.3")
        .otherwise(F.format_string("$%.2f", "p_retailprice"))
    )
    area_slot = F.col("p_partkey") % 31
    area = (
        F.when(area_slot == 0, F.lit(None).cast("string"))
        .when(area_slot == 1, "")
        .when(area_slot == 2, "Unknown")
        .otherwise(F.col("p_brand"))
    )
    return part.select(
        F.col("p_partkey").cast("string").alias("id"),
        price.alias("price"),
        area.alias("neighbourhood_cleansed"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews_from_lineitem(table(spark, sf_dir, "lineitem"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings_from_part(table(spark, sf_dir, "part"))


def guest_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``reviewer_id, nation, region`` of every guest (order -> customer -> nation -> region)."""
    geography = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, sf_dir, "customer").join(
        geography, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_orderkey").alias("reviewer_id"),
            F.col("n_name").alias("nation"),
            F.col("r_name").alias("region"),
        )
    )
