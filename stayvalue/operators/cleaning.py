"""Cleaning of raw reviews and listings, and the audit of what each step removes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayvalue.functions.parsing import cast_review_date, parse_price, parse_review_date, price_digits

# Accepted nightly prices, names that mean no area, what makes a review unique.
MIN_PRICE = 10.0
MAX_PRICE = 10000.0
UNKNOWN_AREAS = ("", "Unknown")
REVIEW_KEY = ("listing_id", "reviewer_id", "date")


def known_area(area: Column) -> Column:
    """True for a usable neighbourhood name (never NULL)."""
    return area.isNotNull() & ~area.isin(*UNKNOWN_AREAS)


def clean_prices(
    df: DataFrame,
    price_col: str = "price",
    min_price: float = MIN_PRICE,
    max_price: float = MAX_PRICE,
) -> DataFrame:
    """Add ``price_numeric_str`` and ``price_cleaned``; keep prices within the inclusive bounds."""
    return (
        df.withColumn("price_numeric_str", price_digits(F.col(price_col)))
        .withColumn("price_cleaned", parse_price(F.col(price_col)))
        .filter(F.col("price_cleaned").between(min_price, max_price))
    )


def normalise_dates(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Turn ``date_col`` into DATE and drop the rows where that is not possible."""
    date = F.col(date_col)
    # The pattern is matched once, in the filter; what passed it only needs to be cast again.
    return df.filter(parse_review_date(date).isNotNull()).withColumn(date_col, cast_review_date(date))


def keep_known_areas(df: DataFrame, area_col: str = "neighbourhood_cleansed") -> DataFrame:
    """Drop rows whose area is NULL, empty or ``Unknown`` (exact match)."""
    return df.filter(known_area(F.col(area_col)))


def drop_duplicate_reviews(df: DataFrame, keys: tuple[str, ...] = REVIEW_KEY) -> DataFrame:
    """One row per (listing, reviewer, raw date).

    Copies collapse inside each map task before the shuffle, so a review repeated any number of
    times costs one row per task.
    """
    return df.dropDuplicates(list(keys))


def review_keys(reviews: DataFrame) -> DataFrame:
    """The three columns that matter of a review, the listing id as text as in the listings."""
    return reviews.select(F.col("listing_id").cast("string"), "reviewer_id", "date")


def clean_reviews(reviews: DataFrame) -> DataFrame:
    """Raw reviews -> ``listing_id, reviewer_id, date``: deduplicated, with real dates.

    Only the three key columns travel, and since the date test reads key columns only Catalyst
    moves it below the deduplication: bad rows are never shuffled.
    """
    return normalise_dates(drop_duplicate_reviews(review_keys(reviews)))


def clean_listings(
    listings: DataFrame, min_price: float = MIN_PRICE, max_price: float = MAX_PRICE
) -> DataFrame:
    """Raw listings -> ``listing_id, price_cleaned, neighbourhood``."""
    return clean_prices(
        keep_known_areas(listings), min_price=min_price, max_price=max_price
    ).select(
        F.col("id").cast("string").alias("listing_id"),
        "price_cleaned",
        F.col("neighbourhood_cleansed").alias("neighbourhood"),
    )


#: The cleaning steps: name, count before, count after.
REVIEW_STEPS = (("duplicates", "raw", "unique"), ("dates", "unique", "dated"))
LISTING_STEPS = (("areas", "raw", "placed"), ("prices", "placed", "priced"))
AUDIT_SCHEMA = (
    "table_name string, step_no int, step string, rows_before long, rows_after long, rows_removed long"
)


def _audit_rows(table: str, steps: Sequence[tuple[str, str, str]]) -> Column:
    """Array of audit rows; each step is (name, column before, column after)."""
    return F.array(
        *(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(number).alias("step_no"),
                F.lit(name).alias("step"),
                F.col(before).alias("rows_before"),
                F.col(after).alias("rows_after"),
                (F.col(before) - F.col(after)).alias("rows_removed"),
            )
            for number, (name, before, after) in enumerate(steps, start=1)
        )
    )


def unique_reviews(reviews: DataFrame) -> DataFrame:
    """Deduplicated reviews with ``date`` parsed (NULL if impossible) and their ``copies``.

    What :func:`clean_reviews` keeps are the rows with a date; the others and the copies are what
    :func:`unique_reviews_audit` counts, so one shuffle serves cleaning and audit.
    """
    return (
        review_keys(reviews)
        .groupBy(*REVIEW_KEY)
        .agg(F.count("*").alias("copies"))
        .withColumn("date", parse_review_date(F.col("date")))
    )


def unique_reviews_counts() -> dict[str, Column]:
    """Aggregates over :func:`unique_reviews`: the counts its audit is made of."""
    return {
        "raw": F.coalesce(F.sum("copies"), F.lit(0)).cast("bigint"),
        "unique": F.count("*"),
        "dated": F.count("date"),
    }


def unique_reviews_audit(unique: DataFrame) -> DataFrame:
    """Rows before, after and removed per review cleaning step, from :func:`unique_reviews`."""
    totals = unique.agg(*(count.alias(name) for name, count in unique_reviews_counts().items()))
    return totals.select(F.inline(_audit_rows("reviews", REVIEW_STEPS)))


def judged_listings(
    listings: DataFrame, min_price: float = MIN_PRICE, max_price: float = MAX_PRICE
) -> DataFrame:
    """All listings with clean columns, ``area_ok`` and ``price_ok``.

    What :func:`clean_listings` keeps are the rows where both hold (:func:`accepted_listings`), so
    one pass over the raw rows serves cleaning and audit.
    """
    price = parse_price(F.col("price"))
    return listings.select(
        F.col("id").cast("string").alias("listing_id"),
        price.alias("price_cleaned"),
        F.col("neighbourhood_cleansed").alias("neighbourhood"),
        known_area(F.col("neighbourhood_cleansed")).alias("area_ok"),
        F.coalesce(price.between(min_price, max_price), F.lit(False)).alias("price_ok"),
    )


def accepted_listings(judged: DataFrame) -> DataFrame:
    """The clean listings among :func:`judged_listings`."""
    return judged.filter("area_ok and price_ok").select(
        "listing_id", "price_cleaned", "neighbourhood"
    )


def judged_listings_counts() -> dict[str, Column]:
    """Aggregates over :func:`judged_listings`: the counts its audit is made of."""
    return {
        "raw": F.count("*"),
        "placed": F.count_if(F.col("area_ok")),
        "priced": F.count_if(F.col("area_ok") & F.col("price_ok")),
    }


def judged_listings_audit(judged: DataFrame) -> DataFrame:
    """Rows before, after and removed per listing cleaning step, from :func:`judged_listings`."""
    totals = judged.agg(*(count.alias(name) for name, count in judged_listings_counts().items()))
    return totals.select(F.inline(_audit_rows("listings", LISTING_STEPS)))


def cleaning_audit(reviews: DataFrame, listings: DataFrame) -> DataFrame:
    """Both audits: ``table_name, step_no, step, rows_before, rows_after, rows_removed``."""
    return unique_reviews_audit(unique_reviews(reviews)).unionByName(
        judged_listings_audit(judged_listings(listings))
    )
