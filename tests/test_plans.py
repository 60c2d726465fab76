"""Shapes of the physical plans: what must hold when the tables are a million times larger."""

import re

import pytest
from helpers import exchanges, final_plan
from pyspark.sql import functions as F

from stayvalue.functions.parsing import DATE_PREFIX
from stayvalue.operators import cleaning, customers, segments, stays
from stayvalue.plans import Settings, customer_table, stays_table
from stayvalue.plans.queries import QUERIES
from stayvalue.sources import parquet_tables

SETTINGS = Settings(reference_date="2001-01-01")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEval")


def table(spark, sf_dir):
    return customer_table(
        parquet_tables.reviews(spark, sf_dir), parquet_tables.listings(spark, sf_dir), SETTINGS
    )


@pytest.fixture(scope="module")
def query_plans(spark, sf_dir):
    return {
        name: query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        for name, query in QUERIES.items()
    }


def test_no_cross_join_and_no_python_per_row(query_plans):
    found = {(name, w) for name, plan in query_plans.items() for w in FORBIDDEN if w in plan}
    assert not found


def test_customer_table_takes_three_shuffles(spark, sf_dir):
    plan = final_plan(table(spark, sf_dir))
    assert exchanges(plan) == 3
    assert plan.count("FileScan") == 2


def test_bad_dates_and_unlisted_ids_are_dropped_before_the_first_shuffle(spark, tmp_path):
    path = str(tmp_path / "reviews")
    spark.createDataFrame(
        [("1", 7, "2023-01-01", "x")],
        "listing_id string, reviewer_id long, date string, comments string",
    ).write.parquet(path)
    listings = spark.createDataFrame(
        [("1", "$50", "A")], "id string, price string, neighbourhood_cleansed string"
    )
    plan = stays_table(spark.read.parquet(path), listings)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    scan = text[: text.index("FileScan")]
    assert scan.rindex("Filter") > scan.rindex("Exchange hashpartitioning(listing_id")
    assert re.search(r"PushedFilters: \[[^\]]*IsNotNull\(listing_id\)", text)
    assert "ReadSchema: struct<listing_id:string,reviewer_id:bigint,date:string>" in text


def test_deduplication_combines_before_the_shuffle(spark, tmp_path):
    """Copies of one review, a third of all rows, reach the shuffle once per task."""
    path = str(tmp_path / "reviews")
    spark.range(0, 30_000, 1, 3).select(
        F.when(F.col("id") % 3 == 0, "1").otherwise(F.col("id").cast("string")).alias("listing_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("reviewer_id"),
        F.lit("2023-01-01").alias("date"),
    ).write.parquet(path)
    df = cleaning.drop_duplicate_reviews(spark.read.parquet(path))
    assert df.count() == 20_000
    plan = df._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(listing_id") :]
    assert "HashAggregate" in below


def test_hot_listing_is_split_in_a_shuffled_join(spark, conf, tmp_path):
    """A third of the reviews on one listing: adaptive execution splits that partition."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20k",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
        spark__sql__shuffle__partitions="8",
    )
    path = str(tmp_path / "reviews")
    spark.range(0, 40_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "1").otherwise(F.col("id").cast("string")).alias("listing_id"),
        F.col("id").alias("reviewer_id"),
        F.date_add(F.lit("2020-01-01"), (F.col("id") % 500).cast("int")).alias("date"),
    ).write.parquet(path)
    listings = spark.range(40_000).select(
        F.col("id").cast("string").alias("listing_id"),
        F.lit(50.0).alias("price_cleaned"),
        F.lit("A").alias("neighbourhood"),
    )
    reviews = spark.read.parquet(path)
    joined = stays.join_stays(reviews, listings).groupBy("reviewer_id").count()
    plan = final_plan(joined)
    assert "SortMergeJoin(skew=true)" in plan
    assert joined.count() == 40_000


def test_top_k_is_not_a_full_sort(spark, sf_dir):
    plan = customers.priority_customers(table(spark, sf_dir))._jdf.queryExecution()
    assert "TakeOrderedAndProject" in plan.executedPlan().toString()
    # Names are repaired for the rows that are shown: the node projects after its limit.
    assert "(?s)(" not in plan.executedPlan().toString()


def test_value_spread_reads_the_tables_once(spark, sf_dir):
    plan = final_plan(segments.value_spread(table(spark, sf_dir)))
    assert plan.count("FileScan") == 2  # lineitem and part
    assert "ReusedExchange" in plan
    assert "percentile" not in plan


def test_quintile_cuts_are_a_scalar(spark, sf_dir):
    df = customers.rfm_quintiles(table(spark, sf_dir))
    plan = final_plan(df)
    assert "Subquery" in plan
    assert plan.count("ReusedExchange") >= 1  # the customers are computed once, for both


@pytest.mark.parametrize("name", ["dq_reviews_report", "dq_uniqueness", "dq_listings_report"])
def test_a_quality_report_takes_one_scan(query_plans, name):
    assert query_plans[name].count("FileScan") == 1


def test_area_pricing_joins_the_stays_once(spark, sf_dir):
    plan = final_plan(QUERIES["area_pricing"](spark, sf_dir))
    assert plan.count("FileScan") == 2  # lineitem and part
    assert len(re.findall(r"Join \[listing_id", plan)) == 1


def test_dates_are_matched_once(query_plans):
    assert query_plans["reviews_clean"].count(DATE_PREFIX) == 1


def test_windows_run_on_reduced_frames_only(query_plans):
    """A window without partition keys may only see per-segment or per-bucket rows."""
    for name, plan in query_plans.items():
        for part in plan.split("Exchange SinglePartition")[1:]:
            below = part.lstrip("\n").split("\n")[1:4]
            assert any("Aggregate" in line or "Scan" in line or "Limit" in line for line in below), (
                name, below,
            )
