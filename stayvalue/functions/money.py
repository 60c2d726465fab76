"""Exact sums: integers and DECIMAL only, so results do not depend on task order or partitioning."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

AMOUNT_TYPE = "decimal(18,2)"  # one customer's total, already in whole cents
_TOTAL_TYPE = "decimal(20,0)"


def price_parts(price: Column) -> tuple[Column, Column]:
    """A DOUBLE price as (whole units, millionths), two BIGINTs.

    Two BIGINT sums cost half of one DECIMAL sum in the per-row path, and neither can overflow:
    millionths stay below 10^6 each, so a single group may hold 9 * 10^12 stays.
    """
    whole = F.floor(price)
    return whole, F.round((price - whole) * 1e6).cast("bigint")


def amount(whole: Column, millionths: Column, times: int = 1) -> Column:
    """``times`` the money in summed :func:`price_parts`, in whole cents, as DOUBLE."""
    exact = whole.cast(_TOTAL_TYPE) + millionths.cast(_TOTAL_TYPE) * F.lit(Decimal("0.000001"))
    return F.round(exact * times, 2).cast("double")


def exact_sum(amount: Column) -> Column:
    """Sum of a two-decimal DOUBLE column as DOUBLE, added up in DECIMAL."""
    return F.sum(amount.cast(AMOUNT_TYPE)).cast("double")


def exact_avg(amount: Column) -> Column:
    """Mean of a two-decimal DOUBLE column; NULL when there is no value."""
    return F.try_divide(exact_sum(amount), F.count(amount).cast("double"))


def share_pct(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, rounded to 4 places; NULL when whole is 0."""
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), 4)
