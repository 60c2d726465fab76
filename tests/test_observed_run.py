"""Counts and rules measured by the write, and runs that are continued."""

import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from stayvalue.operators import areas, cleaning, quality, runs, segments
from stayvalue.plans import Settings, run
from stayvalue.plans.steps import rows_fingerprint
from stayvalue.sources import parquet_tables, write_table

SETTINGS = Settings(reference_date="2001-01-01")


def inputs(spark, sf_dir):
    return parquet_tables.reviews(spark, sf_dir), parquet_tables.listings(spark, sf_dir)


def outcome(results):
    return [(r.rule_name, r.passed, r.severity, r.message, r.metric_value, r.metric_name) for r in results]


def test_observed_rules_equal_those_of_a_second_pass(spark, sf_dir, tmp_path):
    judged = cleaning.judged_listings(parquet_tables.listings(spark, sf_dir))
    observed = quality.clean_listings_checker().observe(judged, F.expr("area_ok and price_ok"))
    observed.counting(**cleaning.judged_listings_counts())
    table = write_table(observed.df, str(tmp_path / "listings"))
    accepted = cleaning.accepted_listings(table)
    assert outcome(observed.results(accepted)) == outcome(
        quality.clean_listings_checker().run_checks(accepted)
    )
    counts = table.agg(*(c.alias(n) for n, c in cleaning.judged_listings_counts().items())).first()
    assert {n: observed.counts[n] for n in counts.asDict()} == counts.asDict()


def test_every_kind_of_rule(spark, tmp_path):
    rows = [(1, "2023-01-01", 5.0, True), (1, None, 50.0, True), (2, "x", None, True), (3, None, 7.0, False)]
    df = spark.createDataFrame(rows, "id long, date string, price double, fine boolean")

    def checker():
        own = quality.Rule("own", "few rows", lambda df: F.count("*") < 10, metric=lambda df: F.count("*"))
        return (
            quality.QualityChecker(fail_on_error=False)
            .add_schema_check(["id", "missing"])
            .add_schema_check(["id"], allow_extra=False)
            .add_completeness_check("date", 0.5)
            .add_completeness_check("nowhere")
            .add_uniqueness_check("id", 0.1)
            .add_range_check("price", 1, 10, max_outliers_pct=0.5)
            .add_range_check("price")
            .add_rule(quality.freshness_rule("date", 30, as_of="2023-01-15"))
            .add_rule(own)
        )

    for where in (None, F.col("fine")):
        observed = checker().observe(df, where).counting()
        table = write_table(observed.df, str(tmp_path / f"t{where is None}"))
        chosen = table if where is None else table.filter(where)
        found, expected = outcome(observed.results(chosen)), outcome(checker().run_checks(chosen))
        # What Spark says about a missing column names the table's own columns.
        assert [r[:3] + r[4:] for r in found] == [r[:3] + r[4:] for r in expected]
        assert [r[1] for r in found][:4] == [False, True, True, False]


def test_observed_without_rows(spark, tmp_path):
    df = spark.createDataFrame([], "listing_id string, reviewer_id long, date date")
    observed = quality.clean_reviews_checker().observe(df).counting(n=F.count("*"))
    table = write_table(observed.df, str(tmp_path / "empty"))
    assert observed.counts["n"] == 0
    assert outcome(observed.results(table)) == outcome(quality.clean_reviews_checker().run_checks(table))


def test_rules_that_only_need_the_schema_observe_nothing(spark):
    df = spark.range(3)
    observed = quality.QualityChecker().add_schema_check(["id"]).observe(df).counting()
    assert observed.df is df
    assert [r.passed for r in observed.results(df)] == [True]


def test_run_of_empty_tables(spark, sf_dir, tmp_path):
    reviews, listings = (df.limit(0) for df in inputs(spark, sf_dir))
    recorded = run(reviews, listings, str(tmp_path), SETTINGS).first()
    assert recorded["input_rows"] == {"reviews": 0, "listings": 0}
    assert recorded["output_rows"] == recorded["rows_filtered"] == 0
    assert recorded["segments"] == {}


def stop_at(monkeypatch, module, name):
    def refuse(*_, **__):
        raise RuntimeError("killed")

    monkeypatch.setattr(module, name, refuse)


def files(folder):
    return sorted((str(p), p.stat().st_mtime_ns) for p in Path(folder).rglob("*.parquet"))


def test_killed_run_continues_behind_its_last_step(spark, sf_dir, tmp_path):
    tables = inputs(spark, sf_dir)
    with pytest.MonkeyPatch.context() as patch:
        stop_at(patch, areas, "area_metrics")
        with pytest.raises(RuntimeError, match="killed"):
            run(*tables, str(tmp_path), SETTINGS, resumable=True)
    history = runs.read_runs(spark, str(tmp_path / "run_metrics"))
    run_id = history.first()["run_id"]
    folder = tmp_path / run_id
    before = files(folder)
    assert {p.name for p in folder.iterdir() if p.is_dir()} == {
        "reviews", "listings", "cleaning_audit", "customers", "steps",
    }
    with pytest.MonkeyPatch.context() as patch:
        # None of the earlier steps is performed again.
        patch.setattr(segments, "segment_label", lambda *_: F.lit("unused"))
        recorded = run(*tables, str(tmp_path), SETTINGS, resume=run_id).first()
    assert recorded["run_id"] == run_id and recorded["status"] == "SUCCESS"
    assert [f for f in files(folder) if "/areas/" not in f[0]] == before
    whole = run(*tables, str(tmp_path / "whole"), SETTINGS).first()
    for name in ("input_rows", "output_rows", "rows_filtered", "segments", "data_quality_warnings"):
        assert recorded[name] == whole[name]
    for name in ("areas", "customers"):
        a = spark.read.parquet(str(folder / name))
        b = spark.read.parquet(str(tmp_path / "whole" / whole["run_id"] / name))
        assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0
    statuses = runs.read_runs(spark, str(tmp_path / "run_metrics")).orderBy("timestamp")
    assert [r["status"] for r in statuses.collect()] == ["FAILED", "SUCCESS"]


def test_half_written_step_is_replaced(spark, sf_dir, tmp_path):
    tables = inputs(spark, sf_dir)
    with pytest.MonkeyPatch.context() as patch:
        stop_at(patch, cleaning, "judged_listings_counts")
        with pytest.raises(RuntimeError, match="killed"):
            run(*tables, str(tmp_path), SETTINGS, resumable=True)
    run_id = runs.read_runs(spark, str(tmp_path / "run_metrics")).first()["run_id"]
    leftover = cleaning.judged_listings(tables[1]).limit(3)
    write_table(leftover, str(tmp_path / run_id / "listings"))
    recorded = run(*tables, str(tmp_path), SETTINGS, resume=run_id).first()
    assert recorded["run_id"] == run_id
    assert spark.read.parquet(str(tmp_path / run_id / "listings")).count() == 200


@pytest.mark.parametrize("change", ["rows", "settings", "unknown"])
def test_changed_input_starts_afresh(spark, sf_dir, tmp_path, change):
    reviews, listings = inputs(spark, sf_dir)
    first = run(reviews, listings, str(tmp_path), SETTINGS, resumable=True).first()
    settings, run_id = SETTINGS, first["run_id"]
    if change == "rows":
        reviews = reviews.filter("listing_id <> '7'")
    elif change == "settings":
        settings = Settings(reference_date="2001-01-01", nights_per_booking=4)
    else:
        run_id = "19990101_000000_000000"
    again = run(reviews, listings, str(tmp_path), settings, resume=run_id).first()
    assert again["run_id"] not in {run_id, first["run_id"]}
    rows = reviews.count()
    assert again["input_rows"]["reviews"] == rows


def test_fingerprint_sees_every_value(spark):
    def of(*rows):
        return rows_fingerprint((spark.createDataFrame(list(rows), "a string, b long"), ["a", "b"]))

    base = of(("x", 1), ("y", 2))
    assert base == of(("y", 2), ("x", 1))
    others = [
        of(("x", 1)), of(("x", 1), ("y", 2), ("y", 2)), of(("x", 1), ("y", 3)), of(("x", 1), ("y", None)),
        of(("x", 1), (None, 2)), of((None, None)), of(("x", 2), ("y", 1)),
    ]
    assert len({base, *others}) == len(others) + 1


RETRIED = """
import glob, os, sys
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
folder = sys.argv[1]
sys.path.insert(0, sys.argv[2])
from stayvalue.operators import cleaning, quality
from stayvalue.sources import write_table

spark = (
    SparkSession.builder.master("local[1,4]").config("spark.ui.enabled", "false")
    .config("spark.local.dir", folder + "/local").config("spark.sql.shuffle.partitions", "4")
    .config("spark.sql.adaptive.coalescePartitions.enabled", "false").getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
n = 4000
reviews = spark.range(0, n, 1, 3).selectExpr(
    "cast(id % 50 as string) as listing_id", "id % 700 as reviewer_id",
    "case when id % 9 = 0 then 'none' else '2023-01-0' || (1 + id % 7) end as date")

def losing(batches):
    # Each partition fails once after its rows; the first also loses all shuffle files, so that the
    # stage before has to be run again while this one goes on.
    context = TaskContext.get()
    mark = f"{folder}/tried-{context.partitionId()}"
    yield from batches
    if not os.path.exists(mark):
        open(mark, "w").close()
        if context.partitionId() == 0:
            for path in glob.glob(folder + "/local/**/shuffle_*.data", recursive=True):
                os.remove(path)
        raise RuntimeError("lost")

unique = cleaning.unique_reviews(reviews)
observed = quality.clean_reviews_checker().observe(
    unique.mapInArrow(losing, unique.schema), F.col("date").isNotNull())
observed.counting(**cleaning.unique_reviews_counts())
table = write_table(observed.df, folder + "/reviews")
names = list(cleaning.unique_reviews_counts())
again = table.agg(*(c.alias(k) for k, c in cleaning.unique_reviews_counts().items())).first()
dated = table.filter("date is not null")
a = [(r.rule_name, r.passed, r.metric_value) for r in observed.results(dated)]
b = [(r.rule_name, r.passed, r.metric_value) for r in quality.clean_reviews_checker().run_checks(dated)]
assert a == b, (a, b)
assert [observed.counts[k] for k in names] == list(again), (observed.counts, again)
assert again["raw"] == n
print("tried", len(glob.glob(folder + "/tried-*")))
"""


def test_counts_of_a_repeated_stage(tmp_path):
    root = str(Path(__file__).resolve().parent.parent)
    (tmp_path / "local").mkdir()
    done = subprocess.run(
        [sys.executable, "-c", RETRIED, str(tmp_path), root],
        capture_output=True, text=True, timeout=300,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert "tried 4" in done.stdout
