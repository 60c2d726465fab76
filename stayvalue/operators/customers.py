"""Customer-level reports: key figures, priority list, sample and quintile scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayvalue.functions.money import exact_avg, exact_sum, share_pct
from stayvalue.functions.text import repair_text
from stayvalue.operators.quantiles import exact_quantiles

# The segments worth contacting one by one, and the size and seed of a sample.
PRIORITY_SEGMENTS = ("Champions", "At Risk", "Loyal", "Potential")
SAMPLE_SIZE = 5000
SAMPLE_SEED = 42
# Hex digits of the hash that customers are counted by to find the end of a sample.
SAMPLE_DIGITS = 4


def kpis(customers: DataFrame) -> DataFrame:
    """One row: customers, revenue, mean value, Champions and their share (0 when empty)."""
    champions = F.count_if(F.col("segment") == "Champions")
    return customers.agg(
        F.count("*").alias("total_customers"),
        F.coalesce(exact_sum(F.col("monetary")), F.lit(0.0)).alias("total_revenue"),
        exact_avg(F.col("monetary")).alias("avg_ltv"),
        champions.alias("champions_count"),
        F.coalesce(share_pct(champions, F.count("*")), F.lit(0.0)).alias("champions_pct"),
    )


def _of_segments(customers: DataFrame, segments: Sequence[str]) -> DataFrame:
    wanted = [s for s in PRIORITY_SEGMENTS if s in segments]
    return customers.filter(F.col("segment").isin(wanted))


def _by_value() -> tuple[Column, ...]:
    return F.desc("monetary"), F.asc("reviewer_id")


def _report_columns(customers: DataFrame) -> DataFrame:
    return customers.select(
        "reviewer_id",
        "segment",
        "recency",
        "frequency",
        "monetary",
        repair_text(F.col("favourite_neighbourhood")).alias("favourite_neighbourhood"),
    )


def high_value_customers(
    customers: DataFrame, segments: Sequence[str] = PRIORITY_SEGMENTS, ranked: bool = False
) -> DataFrame:
    """All customers of the priority segments, columns in report order, area names repaired.

    ``segments`` narrows the choice; names outside the priority list are ignored. ``ranked``
    sorts by value for an export: a range sort, whose ranges end inside a run of equal values too.
    """
    chosen = _of_segments(customers, segments)
    if ranked:
        chosen = chosen.orderBy(*_by_value())
    return _report_columns(chosen)


def priority_customers(
    customers: DataFrame, max_rows: int = 50, segments: Sequence[str] = PRIORITY_SEGMENTS
) -> DataFrame:
    """The ``max_rows`` most valuable customers of the priority segments."""
    best = (
        _of_segments(customers, segments)
        .orderBy(*_by_value())
        .limit(max_rows)
    )
    return _report_columns(best)


def customer_sample(
    customers: DataFrame, n: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED
) -> DataFrame:
    """A reproducible sample of exactly ``n`` customers (all of them if there are fewer).

    The customers with the smallest hashes. Counts per range of hashes tell, as a scalar, where the
    first ``n`` end, so about ``n`` rows in all reach the task that orders them, not ``n`` of every
    partition.
    """
    lot = F.md5(F.concat_ws("|", F.col("reviewer_id").cast("string"), F.lit(str(seed))))
    place = F.conv(F.substring(lot, 1, SAMPLE_DIGITS), 16, 10).cast("int")
    counts = customers.groupBy(place.alias("place")).agg(F.count("*").alias("customers"))
    # At most 16 ** SAMPLE_DIGITS rows.
    running = F.sum("customers").over(Window.orderBy("place"))
    last = (
        counts.withColumn("running", running)
        .filter(F.col("running") >= n)
        .agg(F.coalesce(F.min("place"), F.lit(16**SAMPLE_DIGITS)))
        .scalar()
    )
    return customers.filter(place <= last).orderBy(lot, "reviewer_id").limit(n)


def rfm_quintiles(customers: DataFrame) -> DataFrame:
    """Scores 1 to 5 for recency, frequency and monetary, and the three digits together.

    A score is one more than the number of quintile cut points the value lies above (below, for
    recency), so equal values always score the same. The cut points come from one pass over
    the three measures and reach every customer as a single scalar.
    """
    measures = ("recency", "frequency", "monetary")
    long = customers.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")
                    )
                    for m in measures
                )
            )
        )
    )
    cuts = exact_quantiles(
        long, ["measure"], "value", {"p20": 0.2, "p40": 0.4, "p60": 0.6, "p80": 0.8}
    )
    levels = F.array("p20", "p40", "p60", "p80")
    by_measure = cuts.agg(
        F.struct(*(F.max(F.when(F.col("measure") == m, levels)).alias(m) for m in measures))
    ).scalar()
    scored = customers.select(
        "reviewer_id", *measures, by_measure.alias("cuts")
    )

    def score(measure: str, beyond) -> Column:
        passed: Column = F.lit(1)
        for i in range(4):
            passed = passed + F.when(
                beyond(F.col(measure).cast("double"), F.col("cuts")[measure][i]), 1
            ).otherwise(0)
        return passed

    return scored.select(
        "reviewer_id",
        score("recency", lambda v, cut: v < cut).alias("r_score"),
        score("frequency", lambda v, cut: v > cut).alias("f_score"),
        score("monetary", lambda v, cut: v > cut).alias("m_score"),
    ).withColumn("rfm_score", F.concat("r_score", "f_score", "m_score"))
