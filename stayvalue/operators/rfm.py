"""Recency, frequency and monetary value per reviewer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from stayvalue.functions.money import amount, price_parts

# The day recency counts back from, and the assumed length of a stay.
REFERENCE_DATE = "2025-09-12"
NIGHTS_PER_BOOKING = 3


def rfm_state(stays: DataFrame) -> DataFrame:
    """First level, a reviewer's stays per area: ``reviewer_id, neighbourhood, last_date, stays, whole,
    millionths``.

    Hash aggregation with fixed-width buffers, so map tasks combine before the shuffle and a
    reviewer holding a third of all stays arrives as one row per area and task. The amounts are
    integers, so states of disjoint stays can be merged in any order.
    """
    whole, millionths = price_parts(F.col("price_cleaned"))
    return stays.groupBy("reviewer_id", "neighbourhood").agg(
        F.max("date").alias("last_date"),
        F.count("*").alias("stays"),
        F.sum(whole).alias("whole"),
        F.sum(millionths).alias("millionths"),
    )


def merged_states(states: DataFrame) -> DataFrame:
    """One row per reviewer and area of a union of states."""
    return states.groupBy("reviewer_id", "neighbourhood").agg(
        F.max("last_date").alias("last_date"),
        F.sum("stays").alias("stays"),
        F.sum("whole").alias("whole"),
        F.sum("millionths").alias("millionths"),
    )


def _by_reviewer(per_area: DataFrame) -> GroupedData:
    """Second level: the areas of a reviewer together.

    No more rows per reviewer than there are areas, so combining before this shuffle would
    only add a sort; an explicit repartition leaves it out.
    """
    return per_area.repartition("reviewer_id").groupBy("reviewer_id")


def _best_area() -> Column:
    """Struct (minus stays, area) of the area with the most stays; of equals, the smallest name."""
    return F.min(F.struct((-F.col("stays")).alias("rank"), F.col("neighbourhood").alias("area")))


def rfm_metrics(
    stays: DataFrame,
    reference_date: str | dt.date = REFERENCE_DATE,
    nights_per_booking: int = NIGHTS_PER_BOOKING,
) -> DataFrame:
    """``reviewer_id, recency, frequency, monetary, favourite_neighbourhood``.

    Recency is in days and never negative. Money is added up exactly and given in whole cents,
    so the result is the same for any partitioning. A NULL reviewer is one group.
    """
    return metrics_of_state(rfm_state(stays), reference_date, nights_per_booking)


def metrics_of_state(
    state: DataFrame,
    reference_date: str | dt.date = REFERENCE_DATE,
    nights_per_booking: int = NIGHTS_PER_BOOKING,
    stored_by_reviewer: bool = False,
) -> DataFrame:
    """:func:`rfm_metrics` of the stays that a state stands for.

    A state ``stored_by_reviewer`` (see ``sources.keyed``) is grouped where it lies.
    """
    as_of = F.lit(reference_date).cast("date")
    money = amount(F.sum("whole"), F.sum("millionths"), nights_per_booking)
    return (
        (state.groupBy("reviewer_id") if stored_by_reviewer else _by_reviewer(state))
        .agg(
            F.greatest(F.lit(0), F.datediff(as_of, F.max("last_date"))).alias("recency"),
            F.sum("stays").alias("frequency"),
            money.alias("monetary"),
            _best_area()["area"].alias("favourite_neighbourhood"),
        )
    )


def favourite_area(stays: DataFrame) -> DataFrame:
    """``reviewer_id, favourite_neighbourhood, stays_there`` (most frequent, then by name)."""
    per_area = stays.groupBy("reviewer_id", "neighbourhood").agg(F.count("*").alias("stays"))
    return (
        _by_reviewer(per_area)
        .agg(_best_area().alias("best"))
        .select(
            "reviewer_id",
            F.col("best.area").alias("favourite_neighbourhood"),
            (-F.col("best.rank")).alias("stays_there"),
        )
    )
