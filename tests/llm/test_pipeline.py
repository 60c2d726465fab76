import __spark_entry__ as contract
import corpus_pipeline
import duckdb
import pytest
from pyspark.sql import functions as F

from stayvalue.llm import queries
from stayvalue.llm.queries import ORACLE_SQL, QUERIES


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id for r in docs.select("doc_id").collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_dedup", "personal_data", "mixture", "packing",
    ]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        after = {r.doc_id for r in docs.select("doc_id").collect()}
        assert after <= before
        if name == "language":
            assert len(after) > 0.97 * len(before)
        if name == "personal_data":
            assert after == before
            assert docs.filter("text rlike '[a-z0-9]+@[a-z0-9-]+[.][a-z]+'").count() == 0
        before = after
    places = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id for r in places.collect()} <= before
    assert sorted(r.doc_id for r in places.filter("piece = 0").collect()) == sorted(before)


def test_registered():
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLE_SQL) <= set(contract.oracle_sql())
    assert {name.split("_")[0] for name in QUERIES} == {"pipeline", *(f"op{n}" for n in range(1, 14))}
    assert queries.QUERIES is QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    result = connection.execute(ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    expected = sorted(repr([dict(zip(names, row))[c] for c in sorted(names)]) for row in result.fetchall())
    df = QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(names)
    assert sorted(repr([row[c] for c in sorted(names)]) for row in df.collect()) == expected


def test_extra_columns_of_any_name(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    for name in ("tokens", "topic", "kept", "keep_probability", "text_hash", "lowered", "k0", "fp"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    docs = docs.cache()
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        assert docs.select("tokens", "kept", "k0", "fp").distinct().collect() == [
            ("own tokens", "own kept", "own k0", "own fp")
        ]
    assert corpus_pipeline.packed(spark, docs, sf_dir).count() >= docs.count()
