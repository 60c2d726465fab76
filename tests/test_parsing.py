import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayvalue.operators.cleaning import (
    clean_listings,
    clean_prices,
    clean_reviews,
    cleaning_audit,
    drop_duplicate_reviews,
    keep_known_areas,
    normalise_dates,
    unique_reviews,
)

# The first five are fixed values.
PRICES = [
    ("$1,200.50", 1200.5),
    ("$50.00", 50.0),
    ("$5.00", None),
    ("$20000.00", None),
    (None, None),
    ("", None),
    ("free", None),
    ("1.2.3", None),
    (".", None),
    ("-$50", 50.0),
    ("1.200,50", None),
    ("$10.00", 10.0),
    ("$10000.00", 10000.0),
    ("$9.99", None),
    ("$10000.01", None),
]


def test_clean_prices(spark):
    df = spark.createDataFrame(
        [(i, p) for i, (p, _) in enumerate(PRICES)], "id int, price string"
    )
    kept = {r["id"]: r["price_cleaned"] for r in clean_prices(df).collect()}
    assert kept == {i: v for i, (_, v) in enumerate(PRICES) if v is not None}
    assert clean_prices(df).schema["price_cleaned"].dataType == T.DoubleType()


def test_clean_prices_own_bounds_and_column(spark):
    df = spark.createDataFrame([("5",), ("15",), ("25",)], "cost string")
    assert [r["cost"] for r in clean_prices(df, "cost", 1, 15).orderBy("cost").collect()] == [
        "15",
        "5",
    ]


DATES = [
    ("2023-01-15", dt.date(2023, 1, 15)),
    ("2023/01/15", dt.date(2023, 1, 15)),
    ("2023-1-5", dt.date(2023, 1, 5)),
    ("2023-01-15T10:00:00", dt.date(2023, 1, 15)),
    ("2023-01-15 10:00:00", dt.date(2023, 1, 15)),
    ("2023-13-45", None),
    ("2023-02-30", None),
    ("2023-01-15xyz", None),
    ("invalid", None),
    ("15-01-2023", None),
    ("2023", None),
    ("", None),
    (None, None),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_normalise_dates(spark, conf, ansi):
    conf(spark__sql__ansi__enabled=ansi)
    df = spark.createDataFrame([(i, d) for i, (d, _) in enumerate(DATES)], "id int, date string")
    out = normalise_dates(df)
    assert out.schema["date"].dataType == T.DateType()
    assert {r["id"]: r["date"] for r in out.collect()} == {
        i: d for i, (_, d) in enumerate(DATES) if d is not None
    }


def test_normalise_dates_of_typed_columns(spark):
    df = spark.sql(
        "select date'2023-01-15' as day, timestamp'2023-01-15 22:30:00' as stamp"
    )
    assert normalise_dates(df, "day").first()["day"] == dt.date(2023, 1, 15)
    assert normalise_dates(df, "stamp").first()["stamp"] == dt.date(2023, 1, 15)


def test_known_areas_is_an_exact_match(spark):
    names = ["Biarritz", "", "Unknown", None, "unknown", " "]
    df = spark.createDataFrame([(n,) for n in names], "neighbourhood_cleansed string")
    assert {r[0] for r in keep_known_areas(df).collect()} == {"Biarritz", "unknown", " "}


def test_duplicates_are_judged_on_the_raw_date(spark):
    df = spark.createDataFrame(
        [("1", 7, "2023-1-5"), ("1", 7, "2023-01-05"), ("1", 7, "2023-1-5"), ("1", None, None)]
        + [("1", None, None)],
        "listing_id string, reviewer_id long, date string",
    )
    assert drop_duplicate_reviews(df).count() == 3


def test_audit_equals_step_by_step_counts(spark):
    reviews = spark.createDataFrame(
        [("1", 7, "2023-01-05")] * 3 + [("1", 8, "bad"), ("2", 8, None), ("2", 9, "2023-02-01")],
        "listing_id string, reviewer_id long, date string",
    )
    listings = spark.createDataFrame(
        [("1", "$50", "A"), ("2", "$5", "A"), ("3", "$50", ""), ("4", None, "B"), ("5", "$1", None)],
        "id string, price string, neighbourhood_cleansed string",
    )
    audit = {
        (r["table_name"], r["step"]): (r["rows_before"], r["rows_after"], r["rows_removed"])
        for r in cleaning_audit(reviews, listings).collect()
    }
    assert audit == {
        ("reviews", "duplicates"): (6, 4, 2),
        ("reviews", "dates"): (4, 2, 2),
        ("listings", "areas"): (5, 3, 2),
        ("listings", "prices"): (3, 1, 2),
    }
    assert clean_listings(listings).count() == 1


def test_numeric_listing_ids_become_text(spark):
    reviews = spark.createDataFrame([(1, 7, "2023-01-05")], "listing_id long, reviewer_id long, date string")
    assert clean_reviews(reviews).schema["listing_id"].dataType == T.StringType()
    assert unique_reviews(reviews).first()["copies"] == 1


def test_audit_of_empty_tables(spark):
    reviews = spark.createDataFrame([], "listing_id string, reviewer_id long, date string")
    listings = spark.createDataFrame(
        [], "id string, price string, neighbourhood_cleansed string"
    )
    audit = cleaning_audit(reviews, listings)
    assert audit.count() == 4
    assert audit.filter(F.col("rows_before") + F.col("rows_after") != 0).count() == 0
