"""Exact, interpolated quantiles per group that never hold a whole group in one task.

``percentile`` keeps a group's values in one buffer; with a handful of groups that is one task
for a third of the data. Here equal values collapse to counts first, and coarse buckets locate the
wanted ranks. A bucket that holds a wanted rank and too many different values is split again by value,
and only buckets within the row bound are ordered.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets per e-fold: about 0.1 % of the value at any magnitude, so a bucket of whole-cent amounts
# around 10,000 has some 10 distinct cents per unit. The logarithms of all positive doubles lie
# between -745 and 710, so there are fewer than 1.5 million buckets on either side of zero.
BUCKETS_PER_E = 1000
LEAST_LOG, MOST_LOG = -746, 711
# A bucket that is too full is split into SPLIT equal ranges of value. It spans fewer than 2^43 doubles
# to begin with, so after three rounds a range holds a few hundred different values at most, however
# they are spread: within any bound from LEAST_BOUND.
SPLIT = 4096
ROUNDS = 3
LEAST_BOUND = 1024
#: Different values that are ordered in one task for a wanted rank.
ROW_BOUND = 1 << 16


def _bucket(value: Column) -> Column:
    """Order-preserving coarse bucket of a number; 0 for zero, the infinities at the ends."""
    size = F.abs(value)
    log = F.when(size == float("inf"), F.lit(float(MOST_LOG))).otherwise(F.log(size))
    place = F.floor((log - LEAST_LOG) * BUCKETS_PER_E)
    return F.when(value < 0, -place).when(value > 0, place).otherwise(F.lit(0))


def value_counts(
    df: DataFrame, by: Sequence[str], value: str, weight: str | None = None
) -> DataFrame:
    """``by..., value, n``: how often each value occurs in each group; NULL and NaN do not count.

    ``weight`` names a column of counts where the rows are already combined. The group columns must
    not themselves be called ``value``, ``n``, ``bucket``, ``low``, ``high``, ``total`` or ``before``.
    """
    number = F.col(value).cast("double")
    counted = number.isNotNull() & ~F.isnan(number)
    times = F.count_if(counted) if weight is None else F.sum(F.when(counted, F.col(weight)))
    # Tested after counting: a filter on the value would move to the scan and make the plan differ
    # from others over the same rows, whose shuffle it can reuse.
    return (
        df.groupBy(*by, number.alias("value")).agg(times.alias("n")).filter(F.col("n") > 0)
    )


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    row_bound: int = ROW_BOUND,
) -> DataFrame:
    """One row per group: ``by...`` and one DOUBLE column per entry of ``quantiles``."""
    return quantiles_of_counts(value_counts(df, by, value), by, quantiles, row_bound)


def _holding_ranks(
    counted: DataFrame, by: Sequence[str], within: Sequence[str], order: str, ranks: Sequence[Column]
) -> DataFrame:
    """Of the ranges counted in ``in_bucket``, those that hold a wanted rank, and where they begin.

    ``within`` names what the ranges split up; ``before`` and ``total`` are added to the whole table's
    ranges, and carried on for those of a bucket.
    """
    in_order = Window.partitionBy(*within).orderBy(order)
    behind = F.sum("in_bucket").over(in_order) - F.col("in_bucket")
    if "total" in counted.columns:
        located = counted.withColumn("before", F.col("before") + behind)
    else:
        whole = in_order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        located = counted.select("*", F.sum("in_bucket").over(whole).alias("total"), behind.alias("before"))
    wanted = F.exists(
        F.array(*ranks),
        lambda r: (r >= F.col("before")) & (r < F.col("before") + F.col("in_bucket")),
    )
    return located.filter(wanted).select(*by, "bucket", "low", "high", "different", "in_bucket", "before", "total")


def _members(counts: DataFrame, ranges: DataFrame, by: Sequence[str]) -> DataFrame:
    """The counted values that lie in the ranges, with ``low``, ``high``, ``before`` and ``total``."""
    left, right = counts.alias("c"), ranges.alias("w")
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"w.{k}")) for k in (*by, "bucket")]
    inside = F.col("c.value").between(F.col("w.low"), F.col("w.high"))
    return left.join(right, [*same, inside]).select(
        *(F.col(f"c.{k}") for k in (*by, "bucket")), "value", "n", "low", "high", "before", "total"
    )


def _sizes() -> list[Column]:
    return [
        F.sum("n").alias("in_bucket"),
        F.count("*").alias("different"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
    ]


def wanted_ranges(
    counts: DataFrame, by: Sequence[str], quantiles: Mapping[str, float], row_bound: int = ROW_BOUND
) -> DataFrame:
    """The ranges of value to be ordered: each holds a wanted rank and at most ``row_bound`` values.

    ``counts`` has a ``bucket``. Columns: ``by...``, ``bucket``, ``low``, ``high``, ``different``
    (values), ``in_bucket`` (rows), ``before`` (rows below in the group) and ``total``.
    """
    if row_bound < LEAST_BOUND:
        raise ValueError(f"a row bound is at least {LEAST_BOUND}, not {row_bound}")
    ranks = [rank for p in quantiles.values() for rank in _ranks(p)[:2]]
    renamed = {"least": "low", "most": "high"}
    # Counts per bucket are few (see BUCKETS_PER_E), whatever the number of rows.
    buckets = counts.groupBy(*by, "bucket").agg(*_sizes()).withColumnsRenamed(renamed)
    found = _holding_ranks(buckets, by, by, "bucket", ranks)
    done = found.filter(F.col("different") <= row_bound)
    for _ in range(ROUNDS):
        # Usually nothing is too full, and adaptive execution leaves the round out.
        too_full = found.filter(F.col("different") > row_bound)
        width = F.col("high") - F.col("low")
        place = F.least(F.floor((F.col("value") - F.col("low")) / width * SPLIT), F.lit(SPLIT - 1))
        split = ["low", "high", "before", "total"]
        parts = (
            _members(counts, too_full, by)
            .groupBy(*by, "bucket", *split, place.alias("place"))
            .agg(*_sizes())
        )
        found = _holding_ranks(
            parts.withColumn("whole_low", F.col("low"))
            .drop("low", "high")
            .withColumnsRenamed(renamed),
            by,
            [*by, "bucket", "whole_low"],
            "place",
            ranks,
        )
        done = done.unionByName(found.filter(F.col("different") <= row_bound))
    return done


def quantiles_of_counts(
    counts: DataFrame,
    by: Sequence[str],
    quantiles: Mapping[str, float],
    row_bound: int = ROW_BOUND,
) -> DataFrame:
    """:func:`exact_quantiles` of a table made by :func:`value_counts`.

    ``counts`` is read twice, to fill the buckets and to order the wanted ones, and once more for each
    round of splitting that is needed; Spark reuses its shuffle for all of them.
    """
    counts = counts.withColumn("bucket", _bucket(F.col("value")))
    ranks = {name: _ranks(p) for name, p in quantiles.items()}
    in_order = Window.partitionBy(*by, "bucket", "low").orderBy("value")
    ordered = (
        _members(counts, wanted_ranges(counts, by, quantiles, row_bound), by)
        .withColumn("end", F.col("before") + F.sum("n").over(in_order))
        .withColumn("start", F.col("end") - F.col("n"))
    )

    def at(rank: Column) -> Column:
        return F.max(
            F.when((rank >= F.col("start")) & (rank < F.col("end")), F.col("value"))
        )

    ends = ordered.groupBy(*by).agg(
        *(at(low).alias(f"{name}__low") for name, (low, _, _) in ranks.items()),
        *(at(high).alias(f"{name}__high") for name, (_, high, _) in ranks.items()),
        *(F.max(part).alias(f"{name}__part") for name, (_, _, part) in ranks.items()),
    )
    return ends.select(
        *by,
        *(
            F.when(F.col(f"{name}__low") == F.col(f"{name}__high"), F.col(f"{name}__low"))
            .otherwise(
                F.col(f"{name}__low")
                + (F.col(f"{name}__high") - F.col(f"{name}__low")) * F.col(f"{name}__part")
            )
            .alias(name)
            for name in quantiles
        ),
    )


def _ranks(p: float) -> tuple[Column, Column, Column]:
    """Zero-based ranks below and above the quantile position, and the way between them."""
    if not 0.0 <= p <= 1.0:
        raise ValueError(f"a quantile lies between 0 and 1, not {p}")
    position = (F.col("total") - 1) * F.lit(float(p))
    low, high = F.floor(position), F.ceil(position)
    return low, high, position - low
