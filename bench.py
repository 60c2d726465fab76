"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local threads, BENCH_RUNS how often
each query is timed (the best run counts, after one warm-up), BENCH_OUT the folder for all files it
writes (a new temporary one if unset). The reviews and listings are projected from the tables and
written once before anything is timed, so that the times are those of the operators.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from stayvalue.plans import queries, run
from stayvalue.plans.queries import QUERIES, SETTINGS
from stayvalue.sources import parquet_tables, write_table

HEADLINE = (
    "reviews_clean",
    "reviews_dates",
    "listings_clean",
    "cleaning_audit",
    "stays_join",
    "rfm_metrics",
    "favourite_area",
    "rfm_segments",
    "segment_summary",
    "area_metrics",
    "area_top20",
    "value_spread",
    "rfm_quintiles",
    "segment_by_region",
    "value_by_levels",
    "reviews_new_only",
    "area_pricing",
    "priority_customers",
    "high_value_customers",
    "customer_sample",
    "campaign_impact",
    "dq_reviews_report",
    "dq_uniqueness",
    "dq_listings_report",
    "run_alerts",
    "text_repair_always",
)


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stayvalue-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df: DataFrame) -> None:
    """Compute every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def land(spark: SparkSession, sf_dir: str, out: str) -> None:
    """Write the projected inputs and let the queries read them from there."""
    for name in ("reviews", "listings"):
        project = getattr(parquet_tables, name)
        landed = write_table(project(spark, sf_dir), f"{out}/{name}", mode="overwrite", balance=True)
        setattr(parquet_tables, name, lambda *_, landed=landed: landed)
    # The audit's input holds some reviews twice; it is projected before timing as well.
    again = write_table(
        queries._redelivered_reviews(spark, sf_dir), f"{out}/redelivered", mode="overwrite", balance=True
    )
    queries._redelivered_reviews = lambda *_: again


def whole_run(spark: SparkSession, sf_dir: str, out: str) -> None:
    """The full pipeline: clean, check, segment, roll up, write all tables and the run record."""
    reviews, listings = parquet_tables.reviews(spark, sf_dir), parquet_tables.listings(spark, sf_dir)
    run(reviews, listings, f"{out}/runs", SETTINGS)


def best_time(work, runs: int) -> float:
    work()
    times = []
    for _ in range(runs):
        begin = time.perf_counter()
        work()
        times.append(time.perf_counter() - begin)
    return round(min(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    out = os.environ.get("BENCH_OUT") or tempfile.mkdtemp(prefix="stayvalue-bench-")
    spark = session(cpus)
    land(spark, sf_dir, out)
    timed = {
        name: best_time(lambda name=name: consume(QUERIES[name](spark, sf_dir)), runs)
        for name in HEADLINE
    }
    timed["full_pipeline"] = best_time(lambda: whole_run(spark, sf_dir, out), runs)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", os.path.basename(sf_dir.rstrip("/")))
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(timed.values()), 3),
                "unit": "sec",
                "queries": timed,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )


if __name__ == "__main__":
    main()
