"""Helpers of the corpus operators: stored intermediate tables and byte words."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayvalue.sources.writers import scratch_path, write_table


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    This cuts the lineage at files that every executor can reach, so a lost executor costs no more
    than the tasks it was running, and gives the planner true sizes for its choice of joins.
    """
    return write_table(df, scratch_path(df.sparkSession, f"llm-{name}"))


def utf8(column: str | Column) -> Column:
    """A text as its UTF-8 bytes; NULL is the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def in_parts(
    batches: Iterable[pa.RecordBatch], text: int, size: int = 1 << 22
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of a text column, a longer text alone.

    A task then holds that much as Python objects at a time, however large Spark's batches are. Batches
    without rows are left out.
    """
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = int(ends[at - 1]) if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, done + size, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def free_name(wanted: str, taken: list[str]) -> str:
    """A column name that none of the given ones clashes with (names compare without case)."""
    used = {name.lower() for name in taken}
    while wanted.lower() in used:
        wanted += "_"
    return wanted


class Tally:
    """Counts in a table of fixed size, summed up a few million at a time."""

    FLUSH = 1 << 21

    def __init__(self, rows: int, buckets: int) -> None:
        self.counts = np.zeros((rows, buckets), dtype=np.int64)
        self.waiting: list[list[np.ndarray]] = [[] for _ in range(rows)]
        self.size = 0

    def add(self, row: int, buckets: np.ndarray) -> None:
        self.waiting[row].append(buckets)
        self.size += len(buckets)
        if self.size > self.FLUSH:
            self.total()

    def total(self) -> np.ndarray:
        for row, waiting in enumerate(self.waiting):
            if waiting:
                self.counts[row] += np.bincount(
                    np.concatenate(waiting), minlength=self.counts.shape[1]
                )
                waiting.clear()
        self.size = 0
        return self.counts
