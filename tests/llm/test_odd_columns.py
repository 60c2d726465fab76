"""Every corpus query over tables with further columns, named like those the operators use."""

import time

import pytest
from pyspark.sql import functions as F

from stayvalue.llm import packing, queries
from stayvalue.llm.queries import QUERIES

NAMES = (
    "trusted vec tokens topic kept keep_probability text_hash fp root component_id n bytes bucket score "
    "llr quality toxic term count docs terms total lang_pred held_out place index x y z dim tile block "
    "rank piece shard payload raw header file start pos offset entity context spans contexts bits_left "
    "h above label value item part id key gone_id a b u v"
).split()


@pytest.fixture
def with_more_columns(monkeypatch):
    plain = queries._table

    def table(spark, sf_dir, name):
        df = plain(spark, sf_dir, name)
        taken = {c.lower() for c in df.columns}
        return df.withColumns({n: F.lit("own") for n in NAMES if n not in taken})

    monkeypatch.setattr(queries, "_table", table)


def comparable(df):
    return sorted(repr([None if isinstance(v, float) else v for v in row]) for row in df.collect())


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n != "pipeline"))
def test_clashing_columns(spark, sf_dir, monkeypatch, with_more_columns, name):
    found = QUERIES[name](spark, sf_dir)
    monkeypatch.undo()
    expected = QUERIES[name](spark, sf_dir)
    assert found.columns == expected.columns
    assert comparable(found) == comparable(expected)


def test_long_runs_of_blanks(spark):
    runs = [" " * 5_000_000, "a" + " \t\n" * 1_500_000 + "b", "x " * 100_000, "", None, "\x0b\x0c a\r"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(runs)], "i long, text string")
    begin = time.monotonic()
    found = docs.select("i", packing.word_count(F.col("text")).alias("n")).orderBy("i").collect()
    assert [r.n for r in found] == [0, 2, 100_000, 0, 0, 1]
    assert time.monotonic() - begin < 30
