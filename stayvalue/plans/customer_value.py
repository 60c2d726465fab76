"""The whole analysis: raw reviews and listings in, customer value tables out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stayvalue.operators import areas, cleaning, quality, rfm, runs, segments, stays
from stayvalue.plans.steps import FINGERPRINT, Steps, rows_fingerprint
from stayvalue.sources.writers import write_table


@dataclass(frozen=True)
class Settings:
    """Parameters of an analysis, with their defaults."""

    reference_date: str | dt.date = rfm.REFERENCE_DATE
    nights_per_booking: int = rfm.NIGHTS_PER_BOOKING
    min_price: float = cleaning.MIN_PRICE
    max_price: float = cleaning.MAX_PRICE
    rules: Sequence[segments.SegmentRule] = segments.DEFAULT_RULES
    broadcast_max_bytes: int | None = None


def stays_table(
    raw_reviews: DataFrame, raw_listings: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Clean both inputs and join them into estimated stays."""
    return stays.join_stays(
        cleaning.clean_reviews(raw_reviews),
        cleaning.clean_listings(raw_listings, settings.min_price, settings.max_price),
        settings.broadcast_max_bytes,
    )


def customer_table(
    raw_reviews: DataFrame, raw_listings: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """One row per reviewer: recency, frequency, monetary, favourite area and segment."""
    return _customers(stays_table(raw_reviews, raw_listings, settings), settings)


def _customers(stay_rows: DataFrame, settings: Settings) -> DataFrame:
    metrics = rfm.rfm_metrics(stay_rows, settings.reference_date, settings.nights_per_booking)
    return segments.segment_customers(metrics, settings.rules)


def _fingerprint(raw_reviews: DataFrame, raw_listings: DataFrame, settings: Settings) -> str:
    return rows_fingerprint(
        (raw_reviews, cleaning.REVIEW_KEY),
        (raw_listings, ("id", "price", "neighbourhood_cleansed")),
        parameters=repr(settings),
    )


def run(
    raw_reviews: DataFrame,
    raw_listings: DataFrame,
    output_dir: str,
    settings: Settings = Settings(),
    *,
    resumable: bool = False,
    resume: str | None = None,
) -> DataFrame:
    """Perform the analysis, write its tables under ``output_dir`` and return the run's row.

    Tables: ``reviews`` (deduplicated; NULL date if impossible), ``listings`` (with ``area_ok`` and
    ``price_ok``), ``cleaning_audit``, ``customers`` and ``areas`` (all of them); the run itself is
    appended to ``run_metrics``. Each raw table is read once, and
    every later step starts from a written table: a lost executor costs tasks, not the whole
    lineage. Counts and rules are measured by the write of the table they are about, in the stage that
    writes, where Spark counts each task once even if a stage is repeated; only uniqueness is checked on
    the written listings. The status is ``PARTIAL`` if a quality rule of severity ERROR failed.
    A failed run is recorded too, with ``step: message``, and its exception raised even if the
    record cannot be written; the quality outcome of a run that was never checked is NULL.

    A ``resumable`` run leaves a marker of each finished step and a fingerprint of its inputs and
    settings, which takes one more pass over the raw columns. ``resume`` names such a run: if the
    fingerprint is the same, finished steps are not repeated, and the record has that run's id once
    more. If anything has changed, or there is no such run, a new run begins.
    """
    spark = raw_reviews.sparkSession
    started = dt.datetime.now(dt.timezone.utc)
    # Appending to an earlier run's folder would mix results, hence a folder per run.
    run_id = started.strftime("%Y%m%d_%H%M%S_%f")
    output_dir = output_dir.rstrip("/")
    keep = resumable or resume is not None
    fingerprint = _fingerprint(raw_reviews, raw_listings, settings) if keep else None
    if resume is not None:
        begun = Steps(spark, f"{output_dir}/{resume}", keep).committed(FINGERPRINT)
        if begun is not None and begun["inputs"] == fingerprint:
            run_id = resume
    steps = Steps(spark, f"{output_dir}/{run_id}", keep)
    if keep and run_id != resume:
        steps.commit(FINGERPRINT, {"inputs": fingerprint})
    record = {
        "run_id": run_id,
        "timestamp": started.isoformat(),
        "status": "RUNNING",
        "input_rows": {},
        "output_rows": 0,
        "rows_filtered": 0,
        "data_quality_passed": None,
        "data_quality_warnings": None,
        "data_quality_errors": None,
        "segments": {},
        "errors": [],
    }

    def append() -> DataFrame:
        record["stage_durations"] = steps.seconds
        record["total_duration_seconds"] = steps.total()
        row = tuple(record[name] for name in runs.RUN_SCHEMA.names)
        recorded = spark.createDataFrame([row], runs.RUN_SCHEMA)
        runs.append_runs(recorded, f"{output_dir}/run_metrics")
        return recorded

    try:
        _run_steps(raw_reviews, raw_listings, f"{output_dir}/{run_id}", settings, steps, record)
    except Exception as error:
        record["status"] = "FAILED"
        record["errors"] = [f"{steps.last}: {error}"]
        try:
            append()
        except Exception as second:
            error.add_note(f"the run could not be recorded: {second}")
        raise
    record["status"] = "SUCCESS" if record["data_quality_passed"] else "PARTIAL"
    return append()


def _run_steps(
    raw_reviews: DataFrame,
    raw_listings: DataFrame,
    folder: str,
    settings: Settings,
    steps: Steps,
    record: dict,
) -> None:
    # What an interrupted attempt has left of a step is replaced.
    def write(df: DataFrame, name: str) -> DataFrame:
        return write_table(df, f"{folder}/{name}", mode="overwrite")

    def written(df: DataFrame, name: str) -> DataFrame:
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    unique = cleaning.unique_reviews(raw_reviews)

    def clean_reviews() -> dict:
        observed = quality.clean_reviews_checker().observe(unique, F.col("date").isNotNull())
        observed.counting(**cleaning.unique_reviews_counts())
        table = write(observed.df, "reviews")
        return _measured(observed, table.filter("date is not null"), cleaning.REVIEW_STEPS)

    reviews_figures = steps.step("clean_reviews", clean_reviews)
    reviews = written(unique, "reviews").filter(F.col("date").isNotNull()).select(*cleaning.REVIEW_KEY)

    def clean_listings() -> dict:
        judged = cleaning.judged_listings(raw_listings, settings.min_price, settings.max_price)
        observed = quality.clean_listings_checker().observe(judged, F.expr("area_ok and price_ok"))
        observed.counting(**cleaning.judged_listings_counts())
        table = write(observed.df, "listings")
        return _measured(observed, cleaning.accepted_listings(table), cleaning.LISTING_STEPS)

    listings_figures = steps.step("clean_listings", clean_listings)
    judged = cleaning.judged_listings(raw_listings, settings.min_price, settings.max_price)
    listings = cleaning.accepted_listings(written(judged, "listings"))
    figures = {"reviews": reviews_figures, "listings": listings_figures}

    def audit() -> dict:
        rows = [
            (table, number, name, counts[before], counts[after], counts[before] - counts[after])
            for table, audited in (("reviews", cleaning.REVIEW_STEPS), ("listings", cleaning.LISTING_STEPS))
            for counts in (figures[table]["counts"],)
            for number, (name, before, after) in enumerate(audited, start=1)
        ]
        write(raw_reviews.sparkSession.createDataFrame(rows, cleaning.AUDIT_SCHEMA), "cleaning_audit")
        return {
            "input_rows": {row[0]: row[3] for row in rows if row[1] == 1},
            "rows_filtered": sum(row[5] for row in rows),
        }

    record.update(steps.step("audit", audit))

    def check() -> dict:
        failed = [severity for table in figures.values() for severity in table["failed"]]
        return {
            "data_quality_passed": quality.ERROR not in failed,
            "data_quality_warnings": failed.count(quality.WARNING),
            "data_quality_errors": failed.count(quality.ERROR),
        }

    record.update(steps.step("check_quality", check))
    stay_rows = stays.join_stays(reviews, listings, settings.broadcast_max_bytes)
    customers = _customers(stay_rows, settings)

    def segment() -> dict:
        names = dict.fromkeys([*(rule.segment for rule in settings.rules), segments.NO_RULE_SEGMENT])
        observation = Observation()
        members = [F.count_if(F.col("segment") == n).alias(f"segment_{i}") for i, n in enumerate(names)]
        write(customers.observe(observation, F.count("*").alias("customers"), *members), "customers")
        counts = observation.get
        present = {n: counts[f"segment_{i}"] for i, n in enumerate(names) if counts[f"segment_{i}"]}
        return {"segments": present, "output_rows": counts["customers"]}

    record.update(steps.step("segment", segment))

    def roll_up() -> dict:
        write(areas.area_metrics(written(customers, "customers")), "areas")
        return {}

    steps.step("roll_up", roll_up)


def _measured(observed: quality.Observed, rows: DataFrame, audited: Sequence[tuple]) -> dict:
    """Counts of the cleaning steps, and the severities of the rules that failed."""
    names = {name for step in audited for name in step[1:]}
    failed = [result.severity for result in observed.results(rows) if not result.passed]
    return {"counts": {name: observed.counts[name] or 0 for name in names}, "failed": failed}
