"""Deliveries against the history, and the customer table that they keep up to date."""

import re

import pytest
from helpers import exchanges, final_plan, rows

from stayvalue.operators import cleaning, history, rfm
from stayvalue.plans import Settings, customer_table
from stayvalue.plans.deliveries import Deliveries
from stayvalue.sources import parquet_tables

SETTINGS = Settings(reference_date="2001-01-01")
KEYS = "listing_id string, reviewer_id long, date string"


def keys(spark, *pairs):
    return spark.createDataFrame(list(pairs), KEYS)


@pytest.mark.parametrize("bits", [64, 1 << 10, history.FILTER_BITS])
def test_new_only_is_exact_with_any_filter(spark, bits):
    # With 64 bits nearly every row of the history passes.
    old = spark.range(3000).selectExpr("cast(id as string) as listing_id", "id % 7 as reviewer_id", "'d' as date")
    new = spark.range(2500, 3500).selectExpr(
        "cast(id as string) as listing_id", "id % 7 as reviewer_id", "'d' as date"
    )
    found = history.new_only(new.unionAll(new), old, bits=bits)
    assert sorted(int(r.listing_id) for r in found.collect()) == list(range(3000, 3500))


def test_nulls_are_equal(spark):
    old = keys(spark, (None, None, None), ("a", None, "x"), ("", 1, "x"))
    new = keys(
        spark, (None, None, None), ("a", None, "x"), ("a", None, "y"), (None, 1, "x"), (None, 1, "x"), ("", 1, "x")
    )
    assert rows(history.new_only(new, old)) == [(None, 1, "x"), ("a", None, "y")]


def test_empty_sides(spark):
    some, none = keys(spark, ("a", 1, "x")), keys(spark, ("a", 1, "x")).limit(0)
    assert history.new_only(none, some).count() == 0
    assert rows(history.new_only(some, none)) == [("a", 1, "x")]


def test_no_key_of_the_delivery_is_lost_by_the_filter(spark):
    new = spark.range(5000).selectExpr(
        "cast(id as string) as listing_id", "if(id % 3 = 0, null, id) as reviewer_id", "'d' as date"
    )
    for bits in (64, 1 << 12, 1 << 16):
        words = history.key_bitmap(new, bits=bits).scalar()
        assert new.filter(~history.maybe_among(words, bits=bits)).count() == 0
    other = spark.range(10**6, 10**6 + 5000).selectExpr(
        "cast(id as string) as listing_id", "id as reviewer_id", "'d' as date"
    )
    words = history.key_bitmap(new, bits=1 << 16).scalar()
    # 25,000 of 65,536 bits: about 0.3^5 of other keys pass.
    assert other.filter(history.maybe_among(words, bits=1 << 16)).count() < 5000 * 0.02


def test_history_is_filtered_before_the_shuffle(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    path = str(tmp_path / "history")
    spark.range(20_000).selectExpr(
        "cast(id as string) as listing_id", "id as reviewer_id", "'2023-01-01' as date", "'text' as comments"
    ).write.parquet(path)
    new = spark.range(19_990, 20_010).selectExpr(
        "cast(id as string) as listing_id", "id as reviewer_id", "'2023-01-01' as date"
    )
    df = history.new_only(new, spark.read.parquet(path))
    assert df.count() == 10
    plan = df._jdf.queryExecution().executedPlan().toString()
    # Nothing lies between the filter of the history and its shuffle but a projection.
    line = r"\n[ :|+-]*(\*\(\d+\) )?"
    assert re.search(rf"Exchange hashpartitioning\(coalesce[^\n]*{line}Project[^\n]*{line}Filter [^\n]*getbit", plan)
    assert "comments" not in plan
    known = spark.read.parquet(path).filter(
        history.maybe_among(history.key_bitmap(new).scalar())
    )
    assert known.count() < 20


def stored(spark, path, start, end):
    spark.range(start, end).selectExpr(
        "if(id % 50 = 0, null, cast(id as string)) as listing_id", "if(id % 70 = 0, null, id) as reviewer_id",
        "if(id % 90 = 0, null, '2023-01-01') as date",
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_a_delivery_like_its_history_is_not_filtered(spark, tmp_path):
    old = stored(spark, str(tmp_path / "old"), 0, 6000)
    new = stored(spark, str(tmp_path / "new"), 3000, 9000)
    assert not history.filter_pays(new, old)
    df = history.new_only(new.unionAll(new), old)
    plan = final_plan(df)
    assert "getbit" not in plan and "Join" not in plan
    assert exchanges(plan) == 1
    assert df.columns == new.columns and df.dtypes == new.dtypes
    assert sorted(rows(df), key=repr) == sorted(set(rows(new)) - set(rows(old)), key=repr)


def test_columns_besides_the_keys_stay(spark, tmp_path):
    old = stored(spark, str(tmp_path / "old"), 0, 60)
    new = stored(spark, str(tmp_path / "new"), 30, 90)
    found = history.new_only(new.selectExpr("*", "'x' as comments"), old)
    assert found.columns == [*new.columns, "comments"]
    assert sorted((r[:3] for r in rows(found)), key=repr) == sorted(set(rows(new)) - set(rows(old)), key=repr)


def test_a_first_delivery_and_the_customers_take_one_shuffle_each(spark, conf, inputs, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "new_only", None)
    store = Deliveries(spark, str(tmp_path), SETTINGS)
    store.deliver("a", *inputs)
    df = store.customers()
    assert exchanges(final_plan(df)) == 1
    same(df, customer_table(*inputs, SETTINGS))


@pytest.mark.parametrize("bits", [0, 100, history.MAX_FILTER_BITS * 2])
def test_filter_sizes(spark, bits):
    with pytest.raises(ValueError, match="bits"):
        history.key_bitmap(keys(spark, ("a", 1, "x")), bits=bits)


def test_states_merge_in_any_order(spark):
    stays = spark.range(1000).selectExpr(
        "id % 20 as reviewer_id", "cast(id % 3 as string) as neighbourhood",
        "date_add(date'2020-01-01', cast(id as int)) as date", "id / 7.0 + 0.01 as price_cleaned",
    )
    whole = rows(rfm.rfm_state(stays))
    pieces = [stays.filter(f"pmod(hash(date), 3) = {i}") for i in range(3)]
    for order in ((0, 1, 2), (2, 0, 1)):
        union = rfm.rfm_state(pieces[order[0]])
        for i in order[1:]:
            union = rfm.merged_states(union.unionByName(rfm.rfm_state(pieces[i])))
        assert rows(union) == whole


def same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == b.exceptAll(a).count() == 0


@pytest.fixture
def inputs(spark, sf_dir):
    return parquet_tables.reviews(spark, sf_dir), parquet_tables.listings(spark, sf_dir)


def test_deliveries_equal_the_whole(spark, inputs, tmp_path):
    reviews, listings = inputs
    store = Deliveries(spark, str(tmp_path), SETTINGS)
    assert store.customers().count() == 0
    whole = customer_table(reviews, listings, SETTINGS)
    halves = [reviews.filter(f"reviewer_id % 2 = {i} or listing_id < '15'") for i in (0, 1)]
    store.deliver("a", halves[0], listings)
    same(store.customers(), customer_table(halves[0], listings, SETTINGS))
    store.deliver("b", halves[1], listings)
    same(store.customers(), whole)
    # Delivered twice, under the same name and another.
    store.deliver("b", halves[1], listings)
    store.deliver("c", reviews, listings)
    same(store.customers(), whole)
    assert store.keys().count() == cleaning.drop_duplicate_reviews(cleaning.review_keys(reviews)).count()
    store.compact("all")
    assert store.names() == ["all"]
    same(store.customers(), whole)
    store.deliver("a", halves[0].limit(0), listings)
    store.deliver("d", halves[1], listings)
    same(store.customers(), whole)


def test_interrupted_delivery_is_made_again(spark, inputs, tmp_path, monkeypatch):
    reviews, listings = inputs
    store = Deliveries(spark, str(tmp_path), SETTINGS)
    store.deliver("a", reviews.filter("reviewer_id % 3 = 0"), listings)
    before = store.customers().collect()
    with monkeypatch.context() as patch:
        patch.setattr(Deliveries, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            store.deliver("b", reviews, listings)
    # Its tables are there, but it does not count yet.
    assert sorted(store.customers().collect()) == sorted(before)
    store.deliver("b", reviews, listings)
    same(store.customers(), customer_table(reviews, listings, SETTINGS))


def test_late_reviews_change_only_their_reviewers(spark, tmp_path):
    listings = spark.createDataFrame([("1", "$100.00", "A"), ("2", "$50.00", "B")],
                                     "id string, price string, neighbourhood_cleansed string")
    store = Deliveries(spark, str(tmp_path), SETTINGS)
    store.deliver("a", keys(spark, ("1", 7, "2000-01-01"), ("2", 8, "2000-02-01"), ("2", 8, "junk")), listings)
    store.deliver("b", keys(spark, ("2", 7, "1999-05-05"), ("2", 7, "1999-05-05"), ("2", 7, "1999-06-05")), listings)
    found = {r["reviewer_id"]: r for r in store.customers().collect()}
    assert (found[7]["frequency"], found[7]["monetary"], found[7]["favourite_neighbourhood"]) == (3, 600.0, "B")
    assert found[7]["recency"] == 366
    assert (found[8]["frequency"], found[8]["monetary"]) == (1, 150.0)
