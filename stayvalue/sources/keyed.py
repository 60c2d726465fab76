"""Tables stored by key: rows of one key lie in one bucket, so reading them again needs no shuffle.

A bucket is written and read by one task, with all rows of its keys. Store tables whose rows per key
are bounded, like customers or a reviewer's stays per area; a table in which one key may hold a third of
all rows is better stored by a finer key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_by_key(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` as Parquet in ``buckets`` buckets by ``keys``, sorted, as the table ``name``.

    Rows are dealt to the buckets' tasks first, so there is one file per bucket. An existing table of
    that name and path is replaced. Two tables by the same keys with equally many buckets are joined, and
    each is aggregated by its keys, without an exchange.
    """
    (
        df.repartition(buckets, *keys)
        .write.format("parquet")
        .mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def open_by_key(
    spark: SparkSession, name: str, path: str, schema: str, keys: Sequence[str], buckets: int
) -> DataFrame:
    """A table that :func:`write_by_key` has written, in a session whose catalog does not know it.

    ``schema`` is its DDL, ``keys`` and ``buckets`` are those it was written with: how rows lie in the
    files is only told by the catalog.
    """
    by = ", ".join(f"`{k}`" for k in keys)
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)
