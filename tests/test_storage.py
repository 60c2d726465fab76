"""Tables stored by key, exports by segment, sketches per period, levels and deviations."""

import re
from pathlib import Path

import pytest
from helpers import exchanges, final_plan, rows
from pyspark.sql import functions as F

from stayvalue.operators import distinct, rfm, runs, segments
from stayvalue.plans import Settings, customer_table, stays_table
from stayvalue.sources import export_parts, parquet_tables
from stayvalue.sources.keyed import open_by_key, write_by_key

SETTINGS = Settings(reference_date="2001-01-01")


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    inputs = parquet_tables.reviews(spark, sf_dir), parquet_tables.listings(spark, sf_dir)
    return stays_table(*inputs, SETTINGS), customer_table(*inputs, SETTINGS)


@pytest.fixture
def stored(spark, tables, tmp_path):
    stays, customers = tables
    out = {}
    for name, df in (("stays", stays), ("state", rfm.rfm_state(stays)), ("customers", customers)):
        out[name] = write_by_key(df, f"keyed_{name}", str(tmp_path / name), ["reviewer_id"], 4)
    yield out
    for name in out:
        spark.sql(f"DROP TABLE IF EXISTS keyed_{name}")


def test_stored_by_key_is_grouped_and_joined_where_it_lies(stored, tables, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    again = rfm.metrics_of_state(stored["state"], "2001-01-01", stored_by_reviewer=True)
    assert exchanges(final_plan(again)) == 0
    assert rows(again, "reviewer_id") == rows(tables[1].drop("segment"), "reviewer_id")
    counts = stored["stays"].groupBy("reviewer_id").agg(F.count("*").alias("stays"))
    joined = stored["customers"].join(counts, "reviewer_id")
    plan = final_plan(joined)
    assert exchanges(plan) == 0 and "SortMergeJoin" in plan
    assert joined.filter("stays <> frequency").count() == 0
    assert joined.count() == tables[1].count()


def test_one_file_per_bucket(stored, tmp_path):
    for name in stored:
        files = [p.name for p in (tmp_path / name).glob("*.parquet")]
        assert len(files) == len({re.search(r"_(\d+)\.", f).group(1) for f in files}) <= 4


def test_opened_in_a_catalog_that_does_not_know_it(spark, stored, tmp_path):
    schema = ", ".join(f"{n} {t}" for n, t in stored["customers"].dtypes)
    other = open_by_key(spark, "keyed_again", str(tmp_path / "customers"), schema, ["reviewer_id"], 4)
    try:
        assert rows(other, "reviewer_id") == rows(stored["customers"], "reviewer_id")
        assert exchanges(final_plan(other.groupBy("reviewer_id").count())) == 0
    finally:
        spark.sql("DROP TABLE keyed_again")


def contents(path):
    return {
        p.parent.name + "/" + p.name: p.stat().st_mtime_ns
        for p in Path(path).rglob("*.csv")
    }


def test_one_segment_is_exported_anew(spark, tables, tmp_path):
    customers, path = tables[1], str(tmp_path / "export")
    export_parts(customers, path, "segment")
    before = contents(path)
    names = {r["segment"] for r in customers.select("segment").distinct().collect()}
    assert {k.split("/")[0] for k in before} == {f"segment={n}" for n in names}
    changed = customers.filter("segment = 'Loyal'").withColumn("monetary", F.lit(1.0))
    export_parts(changed, path, "segment")
    after = contents(path)
    others = {k: v for k, v in before.items() if not k.startswith("segment=Loyal/")}
    assert {k: v for k, v in after.items() if not k.startswith("segment=Loyal/")} == others
    assert not set(before) - set(others) & set(after)
    back = spark.read.option("header", True).csv(path)
    assert back.count() == customers.count()
    assert {r["monetary"] for r in back.filter("segment = 'Loyal'").collect()} == {"1.0"}
    export_parts(customers.limit(0), path, "segment")
    assert contents(path) == after


@pytest.mark.parametrize("lg_cells", [10, 14])
def test_united_sketches_are_within_their_error(spark, lg_cells):
    df = spark.range(200_000).selectExpr("cast(id % 40 as int) as day", "pmod(hash(id div 3), 60000) as guest")
    daily = distinct.period_sketches(df, F.col("day"), "guest", lg_cells)
    assert daily.count() == 40
    for low, high in ((0, 39), (3, 3), (10, 25)):
        span = daily.filter(F.col("period").between(low, high))
        found = distinct.estimates(distinct.united(span, F.lit("all"))).first()
        chosen = df.filter(F.col("day").between(low, high))
        exact = chosen.select("guest").distinct().count()
        assert abs(found["estimate"] - exact) <= 4 * distinct.relative_error(lg_cells) * exact
        assert found["row_count"] == chosen.count()
    # Unions of unions are unions.
    weekly = distinct.united(daily, F.floor(F.col("period") / 7))
    twice = distinct.united(weekly.withColumnRenamed("span", "week"), F.lit("all"))
    assert distinct.estimates(twice).first()["estimate"] == distinct.estimates(
        distinct.united(daily, F.lit("all"))
    ).first()["estimate"]


def test_sketches_of_nulls_and_nothing(spark):
    df = spark.createDataFrame([(None, "a"), ("d", None), ("d", "b"), ("d", "b")], "day string, guest string")
    found = distinct.estimates(distinct.period_sketches(df, F.col("day"), "guest"))
    assert rows(found, "period") == [(None, 1, 1), ("d", 3, 1)]
    assert distinct.period_sketches(df.limit(0), F.col("day"), "guest").count() == 0


def test_levels_take_one_aggregation_shuffle(spark, sf_dir, tables):
    regions = parquet_tables.guest_regions(spark, sf_dir)
    customers = spark.createDataFrame(tables[1].collect(), tables[1].schema)
    df = segments.value_by_levels(customers, regions)
    plan = final_plan(df)
    assert len(re.findall(r"Exchange hashpartitioning\(segment#\d+, area#\d+, region#\d+, spark_grouping_id", plan)) == 1
    found = rows(df, "level", "segment", "area", "region")
    whole = [r for r in found if r[0] == 7]
    assert len(whole) == 1 and whole[0][4] == customers.count()
    by_segment = {r[1]: r[4] for r in found if r[0] == 3}
    assert by_segment == {r["segment"]: r["count"] for r in segments.segment_counts(customers).collect()}
    assert sum(r[4] for r in found if r[0] == 0) == customers.count()


def test_levels_keep_nulls_apart_from_sums(spark):
    customers = spark.createDataFrame(
        [(1, "Loyal", None, 5.0), (2, None, "A", 7.0)],
        "reviewer_id long, segment string, favourite_neighbourhood string, monetary double",
    )
    regions = spark.createDataFrame([(1, "N", None)], "reviewer_id long, nation string, region string")
    found = {tuple(r)[:4]: tuple(r)[4:] for r in segments.value_by_levels(customers, regions).collect()}
    assert found[7, None, None, None] == (2, 12.0)
    assert found[3, None, None, None] == (1, 7.0)
    assert found[6, None, None, None] == (2, 12.0)
    assert found[5, None, None, None] == (1, 5.0)


def test_deviations(spark):
    def record(i, seconds, filtered, status="SUCCESS"):
        row = dict.fromkeys(runs.RUN_SCHEMA.names) | {
            "run_id": f"r{i}", "timestamp": f"2025-01-{i:02d}", "status": status,
            "total_duration_seconds": seconds, "input_rows": {"reviews": 100}, "rows_filtered": filtered,
        }
        return tuple(row[n] for n in runs.RUN_SCHEMA.names)

    history = [
        record(1, 100.0, 10), record(2, 120.0, 12), record(3, 5.0, 90, "FAILED"), record(4, 110.0, 11),
        record(5, 166.0, 11), record(6, 100.0, 17), record(7, 100.0, 16),
    ]
    df = runs.run_deviations(spark.createDataFrame(history, runs.RUN_SCHEMA), span=3)
    found = {r["run_id"]: r for r in df.collect()}
    assert found["r1"]["usual_seconds"] is None and not found["r1"]["deviates"]
    assert found["r4"]["usual_seconds"] == 110.0  # of r1 and r2; the failed run is no measure
    assert found["r5"]["usual_seconds"] == 115.0 and not found["r5"]["deviates"]
    assert [k for k, r in found.items() if r["deviates"]] == ["r3", "r6"]
    alone = runs.run_deviations(spark.createDataFrame(history[:1], runs.RUN_SCHEMA))
    assert alone.count() == 1
