import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stayvalue.operators import runs
from stayvalue.plans import Settings, customer_table, run
from stayvalue.sources import parquet_tables


def record(run_id, **changes):
    row = {
        "run_id": run_id,
        "timestamp": "2025-01-01T00:00:00",
        "status": "SUCCESS",
        "total_duration_seconds": 100.0,
        "stage_durations": {"load": 75.0, "clean": 25.0},
        "input_rows": {"reviews": 80, "listings": 20},
        "output_rows": 40,
        "rows_filtered": 20,
        "data_quality_passed": True,
        "data_quality_warnings": 0,
        "data_quality_errors": 0,
        "segments": {"Loyal": 30, "Lost": 10},
        "errors": [],
    } | changes
    return tuple(row[f] for f in runs.RUN_SCHEMA.names)


def history(spark, *records):
    return spark.createDataFrame(list(records), runs.RUN_SCHEMA)


def alerts(spark, *records):
    return {
        (r["run_id"], r["alert"]): r["detail"]
        for r in runs.run_alerts(history(spark, *records)).collect()
    }


def test_limits_are_exclusive(spark):
    assert alerts(spark, record("ok", total_duration_seconds=300.0)) == {}


def test_every_alert(spark):
    found = alerts(
        spark,
        record("slow", total_duration_seconds=301.5),
        record("filtered", rows_filtered=21),
        record("quality", data_quality_passed=False, data_quality_errors=2),
        record("failed", status="FAILED", errors=["load: gone", "gone"], output_rows=0,
               rows_filtered=99),
        record("empty", input_rows={}, rows_filtered=99),
    )
    assert found == {
        ("slow", "SLOW"): "took 302 s, limit 300 s",
        ("filtered", "HIGH FILTER RATE"): "21.0% rows filtered",
        ("quality", "DATA QUALITY"): "2 errors",
        ("failed", "PIPELINE FAILED"): "load: gone; gone",
    }


def test_shares(spark):
    rows = runs.run_shares(
        history(spark, record("a"), record("b", total_duration_seconds=0.0, output_rows=0))
    ).collect()
    share = {(r["run_id"], r["kind"], r["name"]): r["pct"] for r in rows}
    assert share[("a", "stage", "load")] == 75.0
    assert share[("a", "segment", "Lost")] == 25.0
    assert share[("b", "stage", "load")] == share[("b", "segment", "Lost")] == 0.0


def test_json_history_grows(spark, tmp_path):
    path = str(tmp_path / "runs")
    runs.append_runs(history(spark, record("a")), path)
    runs.append_runs(history(spark, record("b", errors=["x"])), path)
    back = {r["run_id"]: r for r in runs.read_runs(spark, path).collect()}
    assert set(back) == {"a", "b"}
    assert back["b"]["errors"] == ["x"] and back["a"]["segments"] == {"Loyal": 30, "Lost": 10}


def test_whole_run(spark, sf_dir, tmp_path):
    recorded = run(
        parquet_tables.reviews(spark, sf_dir),
        parquet_tables.listings(spark, sf_dir),
        str(tmp_path),
        Settings(reference_date="2001-01-01"),
    ).first()
    assert recorded["status"] == "SUCCESS"
    assert recorded["input_rows"] == {"reviews": 6000, "listings": 200}
    assert recorded["data_quality_passed"] and recorded["data_quality_errors"] == 0
    assert len(recorded["stage_durations"]) >= 4
    folder = tmp_path / recorded["run_id"]
    customers = spark.read.parquet(str(folder / "customers"))
    assert recorded["output_rows"] == customers.count() == sum(recorded["segments"].values())
    kept = spark.read.parquet(str(folder / "reviews")).filter("date is not null").count()
    listings = spark.read.parquet(str(folder / "listings")).count()
    assert listings == 200
    accepted = spark.read.parquet(str(folder / "listings")).filter("area_ok and price_ok").count()
    assert recorded["rows_filtered"] == 6200 - kept - accepted
    assert spark.read.parquet(str(folder / "cleaning_audit")).count() == 4
    areas = spark.read.parquet(str(folder / "areas"))
    assert areas.count() == customers.select("favourite_neighbourhood").distinct().count()
    assert runs.read_runs(spark, str(tmp_path / "run_metrics")).count() == 1
    low, high = customers.selectExpr("min(recency)", "max(recency)").first()
    assert low >= 0 and high < 10000
    assert customers.filter("frequency < 1 or monetary < 0").count() == 0
    biggest = max(recorded["segments"].values()) / recorded["output_rows"]
    assert len(recorded["segments"]) == 6 and biggest < 0.8


def test_run_equals_the_lazy_analysis(spark, sf_dir, tmp_path):
    inputs = parquet_tables.reviews(spark, sf_dir), parquet_tables.listings(spark, sf_dir)
    settings = Settings(reference_date="2001-01-01")
    run_id = run(*inputs, str(tmp_path), settings).first()["run_id"]
    written = spark.read.parquet(str(tmp_path / run_id / "customers"))
    lazy = customer_table(*inputs, settings)
    assert written.exceptAll(lazy).count() == lazy.exceptAll(written).count() == 0


def test_failed_run_is_recorded_and_raised(spark, sf_dir, tmp_path):
    reviews = parquet_tables.reviews(spark, sf_dir)
    listings = parquet_tables.listings(spark, sf_dir).drop("price")
    with pytest.raises(Exception, match="price"):
        run(reviews, listings, str(tmp_path))
    row = runs.read_runs(spark, str(tmp_path / "run_metrics")).first()
    assert row["status"] == "FAILED"
    assert row["errors"][0].startswith("clean_listings: ") and "price" in row["errors"][0]
    assert row["data_quality_passed"] is None
    assert {r["alert"] for r in runs.run_alerts(
        runs.read_runs(spark, str(tmp_path / "run_metrics"))).collect()} == {"PIPELINE FAILED"}


def test_run_with_quality_errors_is_partial(spark, sf_dir, tmp_path):
    reviews = parquet_tables.reviews(spark, sf_dir).withColumn(
        "listing_id", F.when(F.col("reviewer_id") % 2 == 0, F.col("listing_id"))
    )
    recorded = run(reviews, parquet_tables.listings(spark, sf_dir), str(tmp_path)).first()
    assert (recorded["status"], recorded["data_quality_passed"]) == ("PARTIAL", False)
    assert recorded["data_quality_errors"] == 1 and recorded["output_rows"] > 0


def test_failing_record_does_not_hide_the_error(spark, sf_dir, tmp_path, monkeypatch):
    def refuse(*_):
        raise OSError("disk full")

    monkeypatch.setattr(runs, "append_runs", refuse)
    listings = parquet_tables.listings(spark, sf_dir).drop("price")
    with pytest.raises(AnalysisException, match="price") as caught:
        run(parquet_tables.reviews(spark, sf_dir), listings, str(tmp_path))
    assert "disk full" in caught.value.__notes__[0]
