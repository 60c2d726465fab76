"""Every registered query against its SQL, on the smallest tables."""

import __spark_entry__ as contract
import duckdb
import pytest

from stayvalue.plans.oracle import ORACLE_SQL
from stayvalue.plans.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = duck.execute(ORACLE_SQL[name])
    types = {d[0]: str(d[1]) for d in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    order = sorted(types)
    place = {d[0]: i for i, d in enumerate(result.description)}
    expected = sorted(repr([row[place[c]] for c in order]) for row in result.fetchall())
    assert sorted(repr([row[c] for c in columns]) for row in df.collect()) == expected


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == [
        "reviewer_id", "recency", "frequency", "monetary", "favourite_neighbourhood", "segment",
    ]
    assert df.count() > 0
