"""Sinks: Parquet tables, CSV exports and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from stayvalue.operators.layout import balance_partitions


def shared_folder(spark: SparkSession, folder: str | None = None) -> str:
    """The folder all executors can reach: the given one, else the session's checkpoint folder.

    The session names it in ``spark.checkpoint.dir`` or by ``SparkContext.setCheckpointDir``. Only
    a session that runs in one local process falls back to a new temporary folder; elsewhere a
    missing folder is an error, since a machine's own disk is seen by that machine alone.
    """
    context = spark.sparkContext
    named = folder or spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("no shared folder: set spark.checkpoint.dir or give a folder")
    return tempfile.mkdtemp(prefix="stayvalue-")


def scratch_path(spark: SparkSession, name: str, folder: str | None = None) -> str:
    """A path under the shared folder that no other run uses; removing it is the caller's part."""
    return f"{shared_folder(spark, folder)}/{name}-{uuid.uuid4().hex}"


def write_table(
    df: DataFrame,
    path: str,
    *,
    mode: str = "errorifexists",
    max_records_per_file: int = 0,
    balance: bool = False,
) -> DataFrame:
    """Write Parquet and return a frame that reads it back, so later work starts from files.

    With ``balance`` the rows are first spread evenly over files of the advisory size; use it
    after reading unsplittable input such as gzip CSV.
    """
    out = balance_partitions(df) if balance else df
    (
        out.write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .parquet(path)
    )
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_csv(df: DataFrame, path: str, *, mode: str = "errorifexists") -> None:
    """Every row as header CSV, written in parallel (a folder of part files)."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )


def export_parts(df: DataFrame, path: str, column: str) -> None:
    """Every row as header CSV in a folder per value of ``column`` (``column=value``).

    Only folders of values that occur in ``df`` are replaced, all others stay as they are: the members
    of one segment are exported anew by a frame of that segment alone. A value without rows keeps its
    old folder. Every task writes its own file per value, so a value with most of the rows is written in
    parallel. An interrupted export leaves the old folders.
    """
    (
        df.write.mode("overwrite")
        .partitionBy(column)
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )
