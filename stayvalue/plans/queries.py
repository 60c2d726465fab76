"""Every operator as a query over the given tables: name -> function of (spark, table folder).

Each query reads its tables whole. Dates leave as ``yyyy-MM-dd`` text and nested run metrics as
plain columns, so that results can be compared across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayvalue.functions.parsing import parse_price, parse_review_date
from stayvalue.functions.text import misread_text, repair_text
from stayvalue.operators import (
    areas,
    campaign,
    cleaning,
    customers,
    distinct,
    history,
    layout,
    quality,
    rfm,
    runs,
    segments,
)
from stayvalue.plans import deliveries
from stayvalue.plans.customer_value import Settings, customer_table, stays_table
from stayvalue.sources import csv_files, parquet_tables, writers

# The orders run from 1995 to 2001; reviews after this date exercise the floor of recency.
SETTINGS = Settings(reference_date="2001-01-01")
FRESH_AS_OF = "2001-12-01"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parquet_tables.reviews(spark, sf_dir)


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parquet_tables.listings(spark, sf_dir)


def _redelivered_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reviews, and once more those of returned items: copies for the deduplication."""
    lines = parquet_tables.table(spark, sf_dir, "lineitem")
    returned = lines.filter(F.col("l_returnflag") == "R")
    return parquet_tables.reviews_from_lineitem(lines.unionByName(returned))


def _stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stays_table(_reviews(spark, sf_dir), _listings(spark, sf_dir), SETTINGS)


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_table(_reviews(spark, sf_dir), _listings(spark, sf_dir), SETTINGS)


def _customer_query(name: str, report: Callable[[DataFrame], DataFrame]) -> None:
    """Register a report on the segmented customer table."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return report(_customers(spark, sf_dir))

    query.__name__ = name
    QUERIES[name] = query


def _date_text(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd") for c in columns})


# --- sources, cleaning, stays -----------------------------------------------------------------


@_query
def reviews_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews written as CSV to the shared folder and read back by the CSV source."""
    path = writers.scratch_path(spark, "reviews-csv")
    writers.export_csv(_reviews(spark, sf_dir), path)
    return csv_files.read_reviews_csv(spark, path, extra=["id"], multi_line=False)


@_query
def listings_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings written as CSV, read back, and landed as Parquet."""
    path = writers.scratch_path(spark, "listings")
    writers.export_csv(_listings(spark, sf_dir), f"{path}/csv")
    landed = csv_files.read_listings_csv(spark, f"{path}/csv")
    return writers.write_table(landed, f"{path}/parquet", balance=True)


@_query
def reviews_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplication where copies are common: line items by order and line number."""
    lines = parquet_tables.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return cleaning.drop_duplicate_reviews(lines, ("l_orderkey", "l_linenumber"))


@_query
def reviews_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_duplicate_reviews(
        _redelivered_reviews(spark, sf_dir).select(*cleaning.REVIEW_KEY)
    )


@_query
def reviews_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _date_text(cleaning.normalise_dates(_reviews(spark, sf_dir)), "date")


@_query
def reviews_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _date_text(cleaning.clean_reviews(_reviews(spark, sf_dir)), "date")


@_query
def listings_known_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.keep_known_areas(_listings(spark, sf_dir))


@_query
def listings_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_prices(_listings(spark, sf_dir))


@_query
def listings_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_listings(_listings(spark, sf_dir))


@_query
def cleaning_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cleaning_audit(
        _redelivered_reviews(spark, sf_dir), _listings(spark, sf_dir)
    )


@_query
def balanced_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition sizing changes where rows are, not which."""
    return layout.balance_partitions(_reviews(spark, sf_dir))


def _flagged_reviews(spark: SparkSession, sf_dir: str, *flags: str) -> DataFrame:
    """The reviews of line items with one of these return flags."""
    lines = parquet_tables.table(spark, sf_dir, "lineitem")
    return parquet_tables.reviews_from_lineitem(lines.filter(F.col("l_returnflag").isin(*flags)))


@_query
def reviews_new_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delivery without what the history already has: returned items are in both."""
    delivery = cleaning.review_keys(_flagged_reviews(spark, sf_dir, "N", "R"))
    earlier = cleaning.review_keys(_flagged_reviews(spark, sf_dir, "A", "R"))
    return history.new_only(delivery, earlier)


@_query
def stays_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _date_text(_stays(spark, sf_dir), "date")


@_query
def text_repair_always(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = parquet_tables.table(spark, sf_dir, "documents")
    return documents.select("doc_id", repair_text(F.col("text"), "always").alias("text"))


@_query
def text_repair_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts damaged by a wrong decoding, repaired: the originals again."""
    documents = parquet_tables.table(spark, sf_dir, "documents")
    return documents.select("doc_id", repair_text(misread_text(F.col("text"))).alias("text"))


# --- customers --------------------------------------------------------------------------------


@_query
def rfm_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.rfm_metrics(_stays(spark, sf_dir), SETTINGS.reference_date)


@_query
def favourite_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rfm.favourite_area(_stays(spark, sf_dir))


QUERIES["rfm_segments"] = _customers
_customer_query("segment_counts", segments.segment_counts)
_customer_query("segments_present", segments.segments_present)
_customer_query("segment_members", lambda c: segments.segment_members(c, "Champions"))
_customer_query("segment_summary", segments.segment_summary)
_customer_query("revenue_share", segments.revenue_share)
_customer_query("value_spread", segments.value_spread)
_customer_query("segment_by_area", segments.segment_by_area)
_customer_query("area_metrics", areas.area_metrics)
_customer_query("area_top20", lambda c: areas.top_areas(areas.area_metrics(c)))
_customer_query("area_top10", lambda c: areas.displayed_areas(areas.area_metrics(c)))
_customer_query("kpis", customers.kpis)
_customer_query("priority_customers", customers.priority_customers)
_customer_query("high_value_customers", customers.high_value_customers)
_customer_query("customer_sample", customers.customer_sample)
_customer_query("rfm_quintiles", customers.rfm_quintiles)
_customer_query("segment_actions", campaign.segment_actions)
_customer_query("channel_cost", campaign.segment_channel_costs)
_customer_query("campaign_impact", campaign.estimate_campaign_impact)
_customer_query("segment_plan", campaign.segment_plan)
_customer_query("campaign_projection", campaign.campaign_projection)


@_query
def rfm_after_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers after deliveries that overlap, one of them made twice and all put together between."""
    listings = _listings(spark, sf_dir)
    store = deliveries.Deliveries(spark, writers.scratch_path(spark, "deliveries"), SETTINGS)
    for name, flags in (("first", "AR"), ("second", "RN"), ("again", "AN"), ("first", "ARN")):
        store.deliver(name, _flagged_reviews(spark, sf_dir, *flags), listings)
        if name == "second":
            store.compact("both")
    return store.customers()


@_query
def value_by_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.value_by_levels(
        _customers(spark, sf_dir), parquet_tables.guest_regions(spark, sf_dir)
    )


@_query
def guests_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviewers per year from daily sketches, beside the exact count they have to be close to."""
    reviews = cleaning.normalise_dates(_reviews(spark, sf_dir))
    daily = distinct.period_sketches(reviews, F.col("date"), "reviewer_id")
    daily = writers.write_table(daily, writers.scratch_path(spark, "guest-sketches"))
    estimated = distinct.estimates(distinct.united(daily, F.year("period")))
    exact = reviews.groupBy(F.year("date").alias("span")).agg(
        F.count_distinct("reviewer_id").alias("guests")
    )
    off = F.abs(F.col("estimate") - F.col("guests")) / F.col("guests")
    return exact.join(estimated, "span").select(
        F.col("span").alias("year"),
        F.col("row_count").alias("reviews"),
        "guests",
        (off <= 4 * distinct.relative_error()).alias("estimate_close"),
    )


@_query
def segment_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.segment_by_region(
        _customers(spark, sf_dir), parquet_tables.guest_regions(spark, sf_dir)
    )


@_query
def area_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return areas.area_pricing(_stays(spark, sf_dir))


@_query
def high_value_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV export of all high-value customers, best first, read back."""
    path = writers.scratch_path(spark, "high-value-customers")
    rows = customers.high_value_customers(_customers(spark, sf_dir), ranked=True)
    writers.export_csv(rows, path)
    exported = csv_files.read_csv_columns(spark, path, rows.columns, multi_line=False)
    return exported.withColumn("monetary", F.col("monetary").cast("double"))


# --- data quality -----------------------------------------------------------------------------


@_query
def dq_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema rules that pass, fail, and count extra columns, next to one that reads rows."""
    reviews = _reviews(spark, sf_dir)
    checker = (
        quality.QualityChecker()
        .add_schema_check(["listing_id", "date"])
        .add_schema_check(["listing_id", "missing_col"])
        .add_schema_check(["listing_id", "date"], allow_extra=False)
        .add_completeness_check("date")
    )
    return checker.report(reviews)


@_query
def dq_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    checker = quality.QualityChecker()
    for column in ("listing_id", "reviewer_id", "date"):
        checker.add_completeness_check(column, 0.98, quality.ERROR)
    return checker.report(_reviews(spark, sf_dir))


@_query
def dq_uniqueness(spark: SparkSession, sf_dir: str) -> DataFrame:
    checker = quality.QualityChecker()
    for column in ("id", "date"):
        checker.add_uniqueness_check(column, 0.25)
    return checker.report(_reviews(spark, sf_dir))


@_query
def dq_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = parquet_tables.table(spark, sf_dir, "lineitem")
    checker = (
        quality.QualityChecker()
        .add_range_check("l_quantity", 1, 45)
        .add_range_check("l_discount", max_value=0.1)
        .add_range_check("l_extendedprice", min_value=5000, max_outliers_pct=0.01)
        .add_range_check("l_tax")
        .add_range_check("line_text", 2, 20000)
    )
    # Numbers as text, and among them text that is no number.
    text = F.when(F.col("l_quantity") < 30, "few").otherwise(F.col("l_linenumber").cast("string"))
    return checker.report(lines.withColumn("line_text", text))


@_query
def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Freshness of a DATE, a TIMESTAMP, a text and a dirty text column, at a fixed time."""
    reviews = _reviews(spark, sf_dir)
    lines = parquet_tables.table(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").alias("stamp"),
        F.col("l_shipdate").cast("date").alias("day"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("text"),
    )
    checker = quality.QualityChecker()
    for column, days in (("stamp", 30), ("day", 20), ("text", 30)):
        checker.add_rule(quality.freshness_rule(column, days, as_of=FRESH_AS_OF))
    dirty = quality.QualityChecker().add_freshness_check("date", 30, as_of=FRESH_AS_OF)
    return checker.report(lines).unionByName(dirty.report(reviews))


@_query
def dq_custom_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's own rule next to one that names a column the table does not have."""
    returned = quality.Rule(
        name="few_returns",
        description="at most a quarter of the lines returned",
        check=lambda df: F.avg((df["l_returnflag"] == "R").cast("int")) <= 0.25,
        severity=quality.WARNING,
        metric_name="returns",
        metric=lambda df: F.count_if(df["l_returnflag"] == "R"),
    )
    checker = quality.QualityChecker().add_rule(returned).add_completeness_check("nowhere")
    report = checker.report(parquet_tables.table(spark, sf_dir, "lineitem"))
    # What Spark says about the missing column is its own text.
    failed = F.col("message").startswith("Exception: ")
    return report.withColumn("message", F.when(failed, "failed").otherwise(F.col("message")))


@_query
def dq_reviews_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reviews_checker().report(_reviews(spark, sf_dir))


@_query
def dq_listings_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard listing rules on raw listings with the price parsed but not filtered."""
    listings = _listings(spark, sf_dir).withColumn(
        "price_cleaned", parse_price(F.col("price"))
    )
    return quality.listings_checker().report(listings)


@_query
def dq_clean_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules a run applies to its cleaned tables."""
    reviews = cleaning.clean_reviews(_reviews(spark, sf_dir))
    listings = cleaning.clean_listings(_listings(spark, sf_dir))
    return (
        quality.clean_reviews_checker()
        .report(reviews)
        .withColumn("table_name", F.lit("reviews"))
        .unionByName(
            quality.clean_listings_checker()
            .report(listings)
            .withColumn("table_name", F.lit("listings"))
        )
    )


@_query
def dq_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_totals(
        quality.reviews_checker().report(_reviews(spark, sf_dir)),
        quality.listings_checker().report(_listings(spark, sf_dir)),
    )


# --- run metrics ------------------------------------------------------------------------------


def _run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run history derived from the tables: every order year is one run.

    Reading takes a second per 20 reviews and cleaning one per 80; two years count as failed.
    """
    year = F.year("o_orderdate").cast("string")
    orders = parquet_tables.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("reviewer_id"), year.alias("run_id"), "o_orderstatus"
    )
    yearly = (
        _reviews(spark, sf_dir)
        .join(orders, "reviewer_id")
        .groupBy("run_id")
        .agg(
            F.count("*").alias("reviews"),
            F.count(parse_review_date(F.col("date"))).alias("dated"),
            F.count("date").alias("filled"),
            *(F.count_if(F.col("o_orderstatus") == s).alias(s) for s in ("F", "O", "P")),
        )
    )
    n = F.col("reviews")
    dated = F.col("dated")

    def longs(**parts: Column) -> Column:
        return F.create_map(*(x for k, v in parts.items() for x in (F.lit(k), v)))

    failed = F.col("run_id").isin("1997", "2001")
    return yearly.select(
        "run_id",
        F.concat("run_id", F.lit("-12-31T00:00:00")).alias("timestamp"),
        F.when(failed, "FAILED")
        .when(F.pmod(dated, F.lit(3)) != 0, "SUCCESS")
        .otherwise("PARTIAL")
        .alias("status"),
        (n / 16).alias("total_duration_seconds"),
        longs(load_data=n / 20, clean_data=n / 80).alias("stage_durations"),
        longs(reviews=n, filled=F.col("filled")).alias("input_rows"),
        F.when(failed, 0).otherwise(dated).cast("bigint").alias("output_rows"),
        (3 * (n - dated)).alias("rows_filtered"),
        (F.pmod(dated, F.lit(3)) != 0).alias("data_quality_passed"),
        F.lit(1).cast("bigint").alias("data_quality_warnings"),
        F.pmod(dated, F.lit(5)).alias("data_quality_errors"),
        longs(F=F.col("F"), O=F.col("O"), P=F.col("P")).alias("segments"),
        F.when(failed, F.array(F.lit("load_data: no input"), F.lit("no input")))
        .otherwise(F.array().cast("array<string>"))
        .alias("errors"),
    )


@_query
def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history after a round trip through the JSON sink, maps spread into columns."""
    path = writers.scratch_path(spark, "run-metrics")
    runs.append_runs(_run_history(spark, sf_dir), path)
    history = runs.read_runs(spark, path)
    return history.select(
        "run_id",
        "timestamp",
        "status",
        "total_duration_seconds",
        F.col("stage_durations")["load_data"].alias("load_seconds"),
        F.col("stage_durations")["clean_data"].alias("clean_seconds"),
        F.col("input_rows")["reviews"].alias("input_reviews"),
        runs.total_input(F.col("input_rows")).alias("input_total"),
        F.round(runs.filtered_pct(history), 4).alias("filtered_pct"),
        "output_rows",
        "rows_filtered",
        "data_quality_passed",
        "data_quality_warnings",
        "data_quality_errors",
        F.col("segments")["F"].alias("segment_f"),
        F.array_join("errors", "; ").alias("errors"),
    )


@_query
def run_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_alerts(_run_history(spark, sf_dir), slow_seconds=400.0, max_filtered_pct=11.85)


@_query
def run_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_shares(_run_history(spark, sf_dir))


@_query
def run_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_deviations(_run_history(spark, sf_dir), span=3, max_ratio=1.01, max_excess_pct=0.1)
