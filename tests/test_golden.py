"""Totals published in the survey, on its own projection of the tables (one review per order)."""

import pytest
from helpers import TESTDATA
from pyspark.sql import functions as F

from stayvalue.operators import areas, cleaning, segments
from stayvalue.plans import Settings, customer_table, stays_table
from stayvalue.sources import parquet_tables

SETTINGS = Settings(reference_date="2001-01-01")
GOLDEN = {
    "0.001": ((874, 874, 812), (200, 127), 481, 136),
    "0.01": ((8590, 8589, 7983), (2000, 1267), 5072, 1406),
    "0.1": ((85672, 85670, 79156), (20000, 12646), 49978, 14085),
}
SEGMENTS = {
    "0.001": {"Potential": 37, "Lost": 24, "At Risk": 23, "Loyal": 20, "Champions": 16,
              "Hibernating": 16},
    "0.01": {"Potential": 345, "Lost": 248, "Loyal": 239, "At Risk": 233, "Champions": 195,
             "Hibernating": 146},
    "0.1": {"Potential": 3463, "Lost": 2606, "Loyal": 2464, "At Risk": 2174, "Champions": 1794,
            "Hibernating": 1584},
}
TOTALS = {
    "Potential": (3148871.7, 1104, 71624),
    "Lost": (1495998.9, 525, 369866),
    "Loyal": (2675382.0, 938, 13502),
    "At Risk": (2586939.0, 907, 125747),
    "Champions": (3523044.9, 1237, 2679),
    "Hibernating": (1027313.1, 361, 114565),
}


def inputs(spark, sf):
    folder = f"{TESTDATA}/sf{sf}"
    slot = F.col("o_orderkey") % 40
    lines = parquet_tables.table(spark, folder, "lineitem").filter("l_linenumber = 1")
    orders = parquet_tables.table(spark, folder, "orders")
    reviews = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_partkey").cast("string").alias("listing_id"),
        F.col("o_custkey").alias("reviewer_id"),
        F.when(slot == 0, F.lit(None).cast("string"))
        .when(slot == 1, "invalid")
        .when(slot == 2, "2000/01/15")
        .when(slot == 3, "2000-13-45")
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("date"),
    )
    return reviews, parquet_tables.listings(spark, folder)


@pytest.mark.parametrize("sf", GOLDEN)
def test_counts(spark, sf):
    reviews, listings = inputs(spark, sf)
    audit = {
        (r["table_name"], r["step_no"]): r
        for r in cleaning.cleaning_audit(reviews, listings).collect()
    }
    (raw, unique, dated), (raw_listings, valid), stay_rows, people = GOLDEN[sf]
    assert (audit["reviews", 1]["rows_before"], audit["reviews", 1]["rows_after"]) == (raw, unique)
    assert audit["reviews", 2]["rows_after"] == dated
    assert audit["listings", 1]["rows_before"] == raw_listings
    assert audit["listings", 2]["rows_after"] == valid
    assert stays_table(reviews, listings, SETTINGS).count() == stay_rows
    found = segments.segment_counts(customer_table(reviews, listings, SETTINGS)).collect()
    assert {r["segment"]: r["count"] for r in found} == SEGMENTS[sf]
    assert sum(SEGMENTS[sf].values()) == people


def test_totals(spark):
    customers = customer_table(*inputs(spark, "0.01"), SETTINGS)
    found = customers.groupBy("segment").agg(
        F.round(F.sum("monetary"), 2), F.sum("frequency"), F.sum("recency")
    )
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == TOTALS
    top = areas.top_areas(areas.area_metrics(customers), 3).collect()
    assert [
        (r["favourite_neighbourhood"], r["total_revenue"], round(r["avg_customer_value"], 2),
         r["customer_count"])
        for r in top
    ] == [
        ("Brand#11", 1360632.3, 11729.59, 116),
        ("Brand#1", 1310620.8, 11914.73, 110),
        ("Brand#10", 1208190.3, 10787.41, 112),
    ]
