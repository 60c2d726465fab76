"""Distinct counts over any span of periods, from one mergeable sketch per period.

A sketch has a fixed size whatever its period holds, so a span of years is a union of its periods'
sketches: the rows are read once, when their period is closed. The count is an estimate; exact counts
are what the uniqueness rule and ``count_distinct`` give.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of the number of cells of a sketch; 2^14 cells of a byte err by 0.8 % (one standard error).
LG_CELLS = 14


def relative_error(lg_cells: int = LG_CELLS) -> float:
    """One standard error of the estimate of united sketches, relative to the count."""
    return 1.04 / math.sqrt(1 << lg_cells)


def period_sketches(
    df: DataFrame, period: Column, column: str, lg_cells: int = LG_CELLS
) -> DataFrame:
    """``period, row_count, sketch``: a sketch of the column's values for every period.

    NULL values do not count; rows without a period make up a period NULL. Sketches are combined in
    the map tasks, so a period with a third of all rows is no hot group.
    """
    return df.groupBy(period.alias("period")).agg(
        F.count("*").alias("row_count"), F.hll_sketch_agg(column, lg_cells).alias("sketch")
    )


def united(sketches: DataFrame, span: Column) -> DataFrame:
    """``span, row_count, sketch`` of periods put together; spans can be united once more."""
    return sketches.groupBy(span.alias("span")).agg(
        F.sum("row_count").alias("row_count"), F.hll_union_agg("sketch").alias("sketch")
    )


def estimates(sketches: DataFrame) -> DataFrame:
    """The sketches with ``estimate`` (long), the number of different values, in their place."""
    return sketches.withColumn("estimate", F.hll_sketch_estimate("sketch")).drop("sketch")
