"""Column expressions that turn dirty text into typed values without ever failing a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What is not part of a price, and what a date must start with to be considered.
NOT_IN_PRICE = r"[^0-9.]"
DATE_PREFIX = r"^\d{4}[-/]\d{1,2}[-/]\d{1,2}"


def price_digits(price: Column) -> Column:
    """The digits and dots of a price text (``$1,200.50`` -> ``1200.50``)."""
    return F.regexp_replace(price.cast("string"), NOT_IN_PRICE, "")


def parse_price(price: Column) -> Column:
    """Price text as DOUBLE; NULL when what remains is not a number."""
    return price_digits(price).try_cast("double")


def cast_review_date(date: Column) -> Column:
    """Text that is known to start like a date as DATE; NULL if there is no such day."""
    return F.replace(date.cast("string"), F.lit("/"), F.lit("-")).try_cast("date")


def parse_review_date(date: Column) -> Column:
    """Review date text as DATE; slashes are accepted, impossible dates become NULL.

    Works on DATE and TIMESTAMP input too, since both print as ``yyyy-MM-dd...``.
    """
    return F.when(date.cast("string").rlike(DATE_PREFIX), cast_review_date(date))
