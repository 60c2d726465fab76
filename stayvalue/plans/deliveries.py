"""Customer values kept up to date delivery by delivery, without going through the history again."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayvalue.operators import cleaning, history, rfm, segments, stays
from stayvalue.plans.customer_value import Settings
from stayvalue.sources.writers import write_table

KEY_SCHEMA = "listing_id string, reviewer_id long, date string"
STATE_SCHEMA = (
    "reviewer_id long, neighbourhood string, last_date date, stays long, whole long, millionths long"
)


class Deliveries:
    """A folder that holds, for every delivery, its new review keys and the state of its new stays.

    A delivery counts once its marker is written, after its tables. One that is interrupted is made
    again under its name and replaces what it had left; one that is repeated under any name has no new
    reviews. So delivering twice changes nothing. Deliveries are made one after the other.

    Stays are valued with the listings given at their delivery.
    """

    def __init__(self, spark: SparkSession, folder: str, settings: Settings = Settings()):
        self._spark, self._folder, self.settings = spark, folder.rstrip("/"), settings

    def _markers(self) -> list[dict]:
        try:
            rows = self._spark.read.text(f"{self._folder}/markers").collect()  # one per delivery
        except AnalysisException:
            return []
        return [json.loads(row["value"]) for row in rows]

    def _commit(self, name: str, replaces: list[str]) -> None:
        marker = json.dumps({"name": name, "replaces": replaces})
        row = self._spark.createDataFrame([(marker,)], "value string")
        row.coalesce(1).write.mode("append").text(f"{self._folder}/markers")

    def names(self) -> list[str]:
        """The deliveries that count, those a compaction has put together as one."""
        markers = self._markers()
        gone = {name for marker in markers for name in marker["replaces"]}
        return sorted({marker["name"] for marker in markers} - gone)

    def _union(self, table: str, schema: str) -> DataFrame:
        paths = [f"{self._folder}/{table}/{name}" for name in self.names()]
        if not paths:
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).parquet(*paths)

    def keys(self) -> DataFrame:
        """The key of every review delivered so far, each once."""
        return self._union("keys", KEY_SCHEMA)

    def state(self) -> DataFrame:
        """All stays so far per reviewer and area."""
        return rfm.merged_states(self._union("state", STATE_SCHEMA))

    def deliver(self, name: str, raw_reviews: DataFrame, raw_listings: DataFrame) -> None:
        """Take in a delivery of reviews, of which any part may have been delivered before.

        The history is scanned for the delivery's keys only, and not shuffled as a whole unless the
        delivery is nearly as large; the work besides grows with the delivery.
        """
        if any(name in (marker["name"], *marker["replaces"]) for marker in self._markers()):
            return
        delivered = cleaning.review_keys(raw_reviews).withColumn(
            "reviewer_id", F.col("reviewer_id").cast("long")
        )
        if self.names():
            new = history.new_only(delivered, self.keys())
        else:
            new = cleaning.drop_duplicate_reviews(delivered)
        new = write_table(new, f"{self._folder}/keys/{name}", mode="overwrite")
        bounds = (self.settings.min_price, self.settings.max_price)
        stay_rows = stays.join_stays(
            cleaning.normalise_dates(new),
            cleaning.clean_listings(raw_listings, *bounds),
            self.settings.broadcast_max_bytes,
        )
        write_table(rfm.rfm_state(stay_rows), f"{self._folder}/state/{name}", mode="overwrite")
        self._commit(name, [])

    def compact(self, name: str) -> None:
        """Put all deliveries so far together under a new name; results stay the same."""
        before = self.names()
        if name in before or len(before) < 2:
            return
        write_table(self.keys(), f"{self._folder}/keys/{name}", mode="overwrite")
        write_table(self.state(), f"{self._folder}/state/{name}", mode="overwrite")
        self._commit(name, before)

    def customers(self) -> DataFrame:
        """The customer table over all deliveries.

        A reviewer has no more stored rows than areas times deliveries, so the states are merged where
        the reviewer's areas are put together: one shuffle for both.
        """
        states = self._union("state", STATE_SCHEMA).repartition("reviewer_id")
        metrics = rfm.metrics_of_state(
            rfm.merged_states(states),
            self.settings.reference_date,
            self.settings.nights_per_booking,
            stored_by_reviewer=True,
        )
        return segments.segment_customers(metrics, self.settings.rules)
