"""Partition layout. Sizes come from Spark's run-time statistics, never from a counting job."""

from __future__ import annotations

from pyspark.sql import DataFrame


def balance_partitions(df: DataFrame, *columns: str) -> DataFrame:
    """Same rows in evenly sized partitions.

    Adaptive execution merges small partitions and splits large ones towards
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``; with ``columns`` rows are clustered by
    them and a hot value is still split.
    """
    return df.hint("rebalance", *columns) if columns else df.hint("rebalance")
