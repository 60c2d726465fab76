"""Rule-based customer segments and their roll-ups.

Every roll-up groups by segment (at most one more than there are rules), so map tasks reduce the
customers to a few rows each; windows run on those few rows only.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayvalue.functions.money import AMOUNT_TYPE, exact_avg, exact_sum, share_pct
from stayvalue.operators.quantiles import quantiles_of_counts, value_counts


class SegmentRule(NamedTuple):
    """Inclusive bounds a customer has to meet."""

    segment: str
    max_recency: int
    min_frequency: int
    min_monetary: float


# The default rules, tried in this order.
DEFAULT_RULES = (
    SegmentRule("Champions", 90, 5, 500.0),
    SegmentRule("Loyal", 180, 3, 300.0),
    SegmentRule("Potential", 365, 1, 50.0),
    SegmentRule("At Risk", 730, 2, 100.0),
    SegmentRule("Hibernating", 1000, 1, 10.0),
)
NO_RULE_SEGMENT = "Lost"

# Fixed value: the order in which segments are presented; others follow by name.
DISPLAY_ORDER = ("At Risk", "Champions", "Potential", "Loyal", "Hibernating")


def _over_all(total: Column) -> Column:
    """An aggregate over all rows of an already reduced frame."""
    return total.over(Window.partitionBy())


def segment_label(
    rules: Sequence[SegmentRule] = DEFAULT_RULES, otherwise: str = NO_RULE_SEGMENT
) -> Column:
    """Name of the first rule that recency, frequency and monetary all meet.

    A NULL measure meets no rule.
    """
    met = (
        F.when(
            (F.col("recency") <= rule.max_recency)
            & (F.col("frequency") >= rule.min_frequency)
            & (F.col("monetary") >= rule.min_monetary),
            rule.segment,
        )
        for rule in rules
    )
    return F.coalesce(*met, F.lit(otherwise))


def segment_customers(
    rfm: DataFrame,
    rules: Sequence[SegmentRule] = DEFAULT_RULES,
    otherwise: str = NO_RULE_SEGMENT,
) -> DataFrame:
    """Add ``segment`` to the RFM table."""
    return rfm.withColumn("segment", segment_label(rules, otherwise))


def segment_counts(customers: DataFrame) -> DataFrame:
    """``segment, count``, largest first."""
    return (
        customers.groupBy("segment")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "segment")
    )


def segment_members(customers: DataFrame, segment: str) -> DataFrame:
    """The customers of one segment."""
    return customers.filter(F.col("segment") == segment)


def segments_present(
    customers: DataFrame, display_order: Sequence[str] = DISPLAY_ORDER
) -> DataFrame:
    """``segment, position`` of the segments that occur, in display order."""
    place = F.array_position(F.array(*map(F.lit, display_order)), F.col("segment"))
    known_first = F.when(place > 0, place).otherwise(len(display_order) + 1)
    return (
        customers.select("segment")
        .distinct()
        .withColumn(
            "position", F.row_number().over(Window.orderBy(known_first, "segment"))
        )
        .orderBy("position")
    )


def segment_summary(customers: DataFrame) -> DataFrame:
    """Customers, value, frequency and share per segment, by revenue.

    ``customers`` counts non-NULL ids, unlike :func:`segment_counts`.
    """
    return (
        customers.groupBy("segment")
        .agg(
            F.count("reviewer_id").alias("customers"),
            exact_avg(F.col("monetary")).alias("avg_ltv"),
            exact_sum(F.col("monetary")).alias("total_revenue"),
            F.avg("frequency").alias("avg_frequency"),
        )
        .withColumn(
            "pct_of_total", share_pct(F.col("customers"), _over_all(F.sum("customers")))
        )
        .orderBy(F.desc("total_revenue"), "segment")
    )


def revenue_share(customers: DataFrame) -> DataFrame:
    """``segment, revenue, revenue_pct``, by revenue."""
    by_segment = customers.groupBy("segment").agg(
        F.sum(F.col("monetary").cast(AMOUNT_TYPE)).alias("revenue")
    )
    return by_segment.select(
        "segment",
        F.col("revenue").cast("double").alias("revenue"),
        share_pct(F.col("revenue"), _over_all(F.sum("revenue"))).alias("revenue_pct"),
    ).orderBy(F.desc("revenue"), "segment")


def value_spread(customers: DataFrame) -> DataFrame:
    """Minimum, quartiles, maximum and mean of ``monetary`` per segment, by median.

    Everything comes from the counts of equal values, so the customers are read once.
    """
    counts = value_counts(customers, ["segment"], "monetary")
    total = F.sum(F.col("value").cast(AMOUNT_TYPE) * F.col("n"))
    ends = counts.groupBy("segment").agg(
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        (total.cast("double") / F.sum("n")).alias("mean_value"),
    )
    quartiles = quantiles_of_counts(
        counts, ["segment"], {"q1": 0.25, "median": 0.5, "q3": 0.75}
    )
    return (
        ends.join(quartiles, "segment")
        .select(
            "segment",
            "min_value",
            F.round("q1", 4).alias("q1"),
            F.round("median", 4).alias("median"),
            F.round("q3", 4).alias("q3"),
            "max_value",
            "mean_value",
        )
        .orderBy(F.desc("median"), "segment")
    )


def segment_by_area(customers: DataFrame) -> DataFrame:
    """Customers and revenue per favourite area and segment."""
    return customers.groupBy("favourite_neighbourhood", "segment").agg(
        F.count("*").alias("customers"), exact_sum(F.col("monetary")).alias("revenue")
    )


def segment_by_region(customers: DataFrame, guest_regions: DataFrame) -> DataFrame:
    """Customers and revenue per region, nation and segment.

    ``guest_regions`` has one row per reviewer, and so has ``customers``: no key is hot. Guests
    without a region form a group of their own.
    """
    return (
        customers.join(guest_regions, "reviewer_id", "left")
        .groupBy("region", "nation", "segment")
        .agg(F.count("*").alias("customers"), exact_sum(F.col("monetary")).alias("revenue"))
    )


def value_by_levels(customers: DataFrame, guest_regions: DataFrame) -> DataFrame:
    """Customers and revenue on every level of segment, area and region, in one aggregation.

    ``level`` tells which columns are summed over: 4 for the segment, 2 for the area, 1 for the region,
    added up; a NULL in a column that is not summed over is a value like any other. Map tasks combine
    on every level, so what is shuffled are at most as many rows per task as there are combinations.
    """
    by = ("segment", "area", "region")
    placed = customers.join(guest_regions.select("reviewer_id", "region"), "reviewer_id", "left").select(
        "segment", F.col("favourite_neighbourhood").alias("area"), "region", "monetary"
    )
    return (
        placed.cube(*by)
        .agg(
            F.grouping_id().cast("int").alias("level"),
            F.count("*").alias("customers"),
            exact_sum(F.col("monetary")).alias("revenue"),
        )
        .select("level", *by, "customers", "revenue")
    )
