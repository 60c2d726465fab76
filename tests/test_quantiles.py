import numpy as np
import pytest
from helpers import final_plan
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stayvalue.operators import quantiles
from stayvalue.operators.quantiles import exact_quantiles

QS = {"lowest": 0.0, "q1": 0.25, "median": 0.5, "p83": 0.83, "highest": 1.0}


def check(spark, pairs):
    df = spark.createDataFrame(pairs, "g string, v double")
    out = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", QS).collect()}
    groups = {g for g, v in pairs if v is not None and not np.isnan(v)}
    assert set(out) == groups
    for g in groups:
        values = sorted(v for k, v in pairs if k == g and v is not None and not np.isnan(v))
        for name, p in QS.items():
            low, part = divmod((len(values) - 1) * p, 1)
            a, b = values[int(low)], values[min(int(low) + 1, len(values) - 1)]
            expected = a if part == 0 or a == b else a + (b - a) * part
            assert out[g][name] == pytest.approx(expected, rel=1e-9, abs=1e-300, nan_ok=True)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]),
            st.one_of(
                st.none(),
                st.sampled_from([0.0, -0.0, -1.5, 3.25, 1e12, 1e-12, -1e-12, 5e-324, 1e300]),
                st.sampled_from([float("nan"), float("inf"), float("-inf")]),
                st.floats(-1e9, 1e9, allow_nan=False),
            ),
        ),
        min_size=1,
        max_size=60,
    )
)
def test_against_numpy(spark, pairs):
    check(spark, pairs)


def test_one_value_holding_most_rows(spark):
    rng = np.random.default_rng(3)
    values = np.where(rng.random(20_000) < 0.6, 42.0, rng.normal(100, 80, 20_000).round(2))
    check(spark, [("x", float(v)) for v in values] + [("y", 1.0)])


def test_without_groups_and_on_integers(spark):
    df = spark.range(101)
    assert exact_quantiles(df, [], "id", {"m": 0.5, "d": 0.1}).first().asDict() == {
        "m": 50.0,
        "d": 10.0,
    }
    assert exact_quantiles(df.limit(0), ["id"], "id", {"m": 0.5}).count() == 0


def test_bounds(spark):
    with pytest.raises(ValueError, match="between 0 and 1"):
        exact_quantiles(spark.range(3), [], "id", {"m": 1.5})


def test_small_values_spread_over_buckets(spark):
    from stayvalue.operators.quantiles import _bucket

    df = spark.range(1, 200_001).selectExpr("id / 2.0e8 as v")
    assert df.select(_bucket(F.col("v")).alias("b")).distinct().count() > 5_000
    assert exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"] == pytest.approx(100_000.5 / 2e8)


def counted(df, by):
    counts = quantiles.value_counts(df, by, "v")
    return counts.withColumn("bucket", quantiles._bucket(F.col("value")))


def test_too_full_buckets_are_split_again(spark):
    # A million different values within a thousandth of each other: one bucket, nearly.
    million = 1_000_000
    close = spark.range(million).selectExpr("'x' as g", "1000 + id / 5.0e6 as v")
    few = spark.range(100).selectExpr("'y' as g", "cast(id as double) as v")
    df = close.unionAll(few)
    counts = counted(df, ["g"])
    assert counts.groupBy("g", "bucket").count().agg(F.max("count")).first()[0] > 200_000
    bound = 2_000
    ranges = quantiles.wanted_ranges(counts, ["g"], QS, bound).collect()
    assert max(r["different"] for r in ranges) <= bound
    assert {r["g"] for r in ranges} == {"x", "y"}
    # No more of the table is ordered than the ranges hold.
    members = quantiles._members(counts, quantiles.wanted_ranges(counts, ["g"], QS, bound), ["g"])
    assert members.count() == sum(r["different"] for r in ranges)
    out = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", QS, bound).collect()}
    for name, p in QS.items():
        place = (million - 1) * p
        assert out["x"][name] == pytest.approx(1000 + place / 5e6, rel=1e-12)
        assert out["y"][name] == pytest.approx(99 * p)


def test_values_that_equal_ranges_do_not_separate(spark):
    # Nearly all values lie within a few thousand doubles, and one far off in the same bucket.
    base = np.float64(1.5)
    steps = np.spacing(base)
    values = [float(base + steps * i) for i in range(5000)] + [1.5004]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ranges = quantiles.wanted_ranges(counted(df, []), [], QS, 1024).collect()
    assert max(r["different"] for r in ranges) <= 1024
    out = exact_quantiles(df, [], "v", QS, 1024).first()
    assert out["lowest"] == values[0] and out["highest"] == 1.5004 and out["median"] == values[2500]


def test_negative_values_are_split_in_order(spark):
    df = spark.range(20_000).selectExpr("-7.0 - id / 1.0e8 as v")
    out = exact_quantiles(df, [], "v", {"a": 0.0, "m": 0.5, "z": 1.0}, 1024).first()
    assert (out["a"], out["z"]) == (-7.0 - 19_999 / 1e8, -7.0)
    assert out["m"] == pytest.approx(-7.0 - 9_999.5 / 1e8, rel=1e-14)


def test_rounds_that_nothing_needs_are_left_out(spark, conf):
    df = spark.range(5000).selectExpr("id % 3 as g", "cast(id as double) as v")
    plan = final_plan(exact_quantiles(df, ["g"], "v", {"m": 0.5}))
    assert "4096" not in plan


def test_row_bound_has_a_least_value(spark):
    with pytest.raises(ValueError, match="row bound"):
        exact_quantiles(spark.range(3), [], "id", {"m": 0.5}, 10)
