"""CSV sources. Every column is read as text and selected by name; the cleaners assign types."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

REVIEW_COLUMNS = ("listing_id", "reviewer_id", "date")
LISTING_COLUMNS = ("id", "price", "neighbourhood_cleansed")


def read_csv_columns(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    *,
    sep: str = ",",
    quote: str = '"',
    escape: str = '"',
    multi_line: bool = True,
    encoding: str = "utf-8",
) -> DataFrame:
    """Named columns of header CSV files (plain or gzip), all as strings.

    No schema inference, hence no extra pass and ids keep their leading zeros. ``escape='"'``
    reads doubled quotes; pass ``escape="\\\\"`` for backslash-escaped files. Files without line
    breaks inside fields should be read with ``multi_line=False``: only then can Spark split
    a large file between tasks.
    """
    raw = (
        spark.read.option("header", True)
        .option("sep", sep)
        .option("quote", quote)
        .option("escape", escape)
        .option("multiLine", multi_line)
        .option("encoding", encoding)
        .csv(path)
    )
    missing = [c for c in columns if c not in raw.columns]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}; the header has {raw.columns}")
    return raw.select(*columns)


def read_reviews_csv(
    spark: SparkSession, path: str | list[str], extra: Sequence[str] = (), **options
) -> DataFrame:
    """Reviews: ``listing_id``, ``reviewer_id``, ``date`` as strings, plus ``extra``."""
    return read_csv_columns(spark, path, [*REVIEW_COLUMNS, *extra], **options)


def read_listings_csv(
    spark: SparkSession, path: str | list[str], extra: Sequence[str] = (), **options
) -> DataFrame:
    """Listings: ``id``, ``price``, ``neighbourhood_cleansed`` as strings, plus ``extra``."""
    return read_csv_columns(spark, path, [*LISTING_COLUMNS, *extra], **options)
