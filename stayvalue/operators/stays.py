"""Estimated stays: every clean review joined with the listing it is about."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# A broadcast relation may take several times its estimate and has to stay below 8 GB.
MAX_BROADCAST_BYTES = 1 << 30


def stored_size(df: DataFrame) -> int | None:
    """Bytes of all files that ``df`` reads, by any kind of session; None if it reads none.

    Their contents are not opened: only names and lengths are listed.
    """
    files = [unquote(name) for name in df.inputFiles()]
    if not files:
        return None
    listed = df.sparkSession.read.format("binaryFile").load(files)
    return listed.agg(F.sum("length")).first()[0]


def estimated_size(df: DataFrame) -> int | None:
    """Catalyst's size estimate in bytes for the optimised plan of ``df``.

    On Spark Connect, which has no plan statistics, :func:`stored_size`.
    """
    if not hasattr(df, "_jdf"):
        return stored_size(df)
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_within(df: DataFrame, max_bytes: int) -> DataFrame:
    """Hint a broadcast only if the estimated size is within ``max_bytes``.

    The estimate counts compressed file bytes before any filter; the relation in memory may take
    several times as much. Spark itself fails beyond 8 GB, so no limit over 1 GB is accepted. Without
    an estimate there is no hint.
    """
    if max_bytes > MAX_BROADCAST_BYTES:
        raise ValueError(f"a broadcast limit of {max_bytes} bytes is too large")
    size = estimated_size(df)
    return F.broadcast(df) if size is not None and size <= max_bytes else df


def join_stays(
    reviews: DataFrame, listings: DataFrame, broadcast_max_bytes: int | None = None
) -> DataFrame:
    """Inner join on ``listing_id``; one row per review and listing.

    By default Catalyst and adaptive execution choose: a broadcast while the listings are under
    ``spark.sql.autoBroadcastJoinThreshold``, else a shuffled join whose hot listings are split
    by the adaptive skew join. ``broadcast_max_bytes`` raises that limit for this join alone.
    Listings are not deduplicated: a repeated id multiplies its stays.
    """
    if broadcast_max_bytes is not None:
        listings = broadcast_within(listings, broadcast_max_bytes)
    return reviews.join(listings, "listing_id", "inner")
