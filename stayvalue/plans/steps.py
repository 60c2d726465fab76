"""Steps of a run with one commit marker each, so that a run can be continued where it stopped."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FINGERPRINT = "fingerprint"


def rows_fingerprint(*tables: tuple[DataFrame, Sequence[str]], parameters: str = "") -> str:
    """A digest of the given columns of all rows, in any order, and of ``parameters``.

    One pass over each table without a shuffle. Equal rows count as often as they occur; a change of
    one value goes unnoticed with a chance of about 2^-64.
    """
    parts: list[str] = [parameters]
    for df, columns in tables:
        named = [F.col(c) for c in columns]
        # NULL does not change a row's hash, so which values are NULL is hashed as well.
        blanks = [F.col(c).isNull() for c in columns]
        total = F.sum(F.xxhash64(*named, *blanks).cast("decimal(20,0)"))
        row = df.agg(F.count("*"), total).first()
        parts.append(f"{list(columns)} {row[0]} {row[1]}")
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()


class Steps:
    """The steps of one run: seconds of each, the one that ended last, and their markers.

    A marker is a one-row text under ``folder/steps``, written when the step's tables are complete. It
    holds the figures that later steps and the run's record need. With ``keep`` off none are written.
    """

    def __init__(self, spark: SparkSession, folder: str, keep: bool):
        self._spark, self._folder, self._keep = spark, folder, keep
        self.started = time.monotonic()
        self.seconds: dict[str, float] = {}
        self.skipped: list[str] = []
        self.last = "prepare"

    def _marker(self, name: str) -> str:
        return f"{self._folder}/steps/{name}"

    def committed(self, name: str) -> dict | None:
        """The figures of a finished step; None if there is no complete marker."""
        try:
            rows = self._spark.read.text(self._marker(name)).collect()  # one row
        except AnalysisException:
            return None
        return json.loads(rows[0]["value"]) if rows else None

    def commit(self, name: str, figures: dict) -> None:
        row = self._spark.createDataFrame([(json.dumps(figures),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(self._marker(name))

    def step(self, name: str, work: Callable[[], dict]) -> dict:
        """The figures of ``work``, or those of its marker if it is already done."""
        begin = time.monotonic()
        done = self.committed(name) if self._keep else None
        if done is not None:
            self.seconds[name] = done["seconds"]
            self.skipped.append(name)
            return done["figures"]
        try:
            figures = work()
        finally:
            self.seconds[name] = time.monotonic() - begin
            self.last = name
        if self._keep:
            self.commit(name, {"figures": figures, "seconds": self.seconds[name]})
        return figures

    def total(self) -> float:
        return time.monotonic() - self.started
