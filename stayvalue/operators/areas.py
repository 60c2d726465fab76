"""Market view by neighbourhood."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayvalue.functions.money import exact_avg, exact_sum
from stayvalue.functions.text import repair_text
from stayvalue.operators.quantiles import quantiles_of_counts, value_counts


def area_metrics(customers: DataFrame) -> DataFrame:
    """Revenue, mean value and customers of every favourite neighbourhood."""
    return customers.groupBy("favourite_neighbourhood").agg(
        exact_sum(F.col("monetary")).alias("total_revenue"),
        exact_avg(F.col("monetary")).alias("avg_customer_value"),
        F.count("*").alias("customer_count"),
    )


def top_areas(metrics: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` rows of :func:`area_metrics` with most revenue; ties by name."""
    return metrics.orderBy(F.desc("total_revenue"), "favourite_neighbourhood").limit(n)


def displayed_areas(metrics: DataFrame, n: int = 10) -> DataFrame:
    """:func:`top_areas` with names repaired for display."""
    return (
        top_areas(metrics, n)
        .withColumn(
            "favourite_neighbourhood", repair_text(F.col("favourite_neighbourhood"))
        )
        .select("favourite_neighbourhood", "total_revenue", "customer_count")
    )


def area_pricing(stays: DataFrame) -> DataFrame:
    """Demand and accepted nightly prices per neighbourhood.

    Stays are joined and shuffled once, as counts per area, guest and price. Guests and quartiles
    follow from the counts, so a neighbourhood with a third of all stays is still worked on by many
    tasks.
    """
    by = "neighbourhood"
    counts = stays.groupBy(by, "reviewer_id", "price_cleaned").agg(F.count("*").alias("n"))
    demand = (
        counts.groupBy(by, "reviewer_id")
        .agg(F.sum("n").alias("stays"))
        .groupBy(by)
        .agg(F.sum("stays").alias("stays"), F.count("reviewer_id").alias("guests"))
    )
    prices = quantiles_of_counts(
        value_counts(counts, [by], "price_cleaned", weight="n"),
        [by],
        {"price_q1": 0.25, "price_median": 0.5, "price_q3": 0.75},
    )
    return demand.join(prices, "neighbourhood").select(
        "neighbourhood",
        "stays",
        "guests",
        *(F.round(c, 4).alias(c) for c in ("price_q1", "price_median", "price_q3")),
    )
