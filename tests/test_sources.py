import gzip

import pytest
from pyspark.sql import functions as F

from stayvalue.sources import csv_files, writers

REVIEWS = (
    'listing_id,id,date,reviewer_id,reviewer_name,comments\n'
    '001,10,2023-01-05,7,Ann,"he said ""hi"", ok\nline2"\n'
    '002,11,2023-01-06,8,Bob,fine\n'
)


def test_columns_by_name_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "reviews.csv.gz"
    path.write_bytes(gzip.compress(REVIEWS.encode()))
    df = csv_files.read_reviews_csv(spark, str(path), extra=["comments"])
    assert [tuple(r) for r in df.orderBy("listing_id").collect()] == [
        ("001", "7", "2023-01-05", 'he said "hi", ok\nline2'),
        ("002", "8", "2023-01-06", "fine"),
    ]


def test_backslash_escapes_on_request(spark, tmp_path):
    path = tmp_path / "listings.csv"
    path.write_text('id,name,price,neighbourhood_cleansed\n1,"a \\"b\\", c",$5.00,Anglet\n')
    df = csv_files.read_listings_csv(spark, str(path), extra=["name"], escape="\\")
    assert tuple(df.first()) == ("1", "$5.00", "Anglet", 'a "b", c')


def test_missing_column_is_named(spark, tmp_path):
    path = tmp_path / "listings.csv"
    path.write_text("id,price\n1,$5.00\n")
    with pytest.raises(ValueError, match="neighbourhood_cleansed"):
        csv_files.read_listings_csv(spark, str(path))


def test_unneeded_columns_are_not_parsed(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(REVIEWS)
    plan = csv_files.read_reviews_csv(spark, str(path))._jdf.queryExecution().executedPlan()
    assert "ReadSchema: struct<listing_id:string,date:string,reviewer_id:string>" in (
        plan.toString()
    )


def test_write_table_reads_back_and_limits_file_size(spark, tmp_path):
    df = spark.range(0, 1000, 1, 1).withColumnRenamed("id", "n")
    out = writers.write_table(df, str(tmp_path / "t"), max_records_per_file=300)
    assert out.count() == 1000
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 4
    balanced = writers.write_table(df, str(tmp_path / "b"), balance=True)
    assert balanced.count() == 1000


def test_export_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [(1, 'a "b", c'), (2, None), (3, "x\ny")], "id int, name string"
    )
    writers.export_csv(df, str(tmp_path / "csv"))
    back = csv_files.read_csv_columns(spark, str(tmp_path / "csv"), ["id", "name"])
    assert [tuple(r) for r in back.orderBy("id").collect()] == [
        ("1", 'a "b", c'),
        ("2", None),
        ("3", "x\ny"),
    ]


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = (writers.scratch_path(spark, "x") for _ in range(2))
    assert first.startswith(shared) and first != second


def test_balanced_partitions_keep_all_rows(spark):
    from stayvalue.operators.layout import balance_partitions

    df = spark.range(0, 5000, 1, 7).selectExpr("id", "id % 2 as k")
    assert balance_partitions(df).count() == 5000
    assert balance_partitions(df, "k").selectExpr("sum(id)").first()[0] == 5000 * 4999 // 2


@pytest.mark.parametrize("columns", [(), ("k",)])
def test_balanced_partitions_are_even(spark, conf, tmp_path, columns):
    """One big and many small partitions, and a clustering value that most rows hold."""
    from stayvalue.operators.layout import balance_partitions

    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="20k",
         spark__sql__adaptive__coalescePartitions__minPartitionSize="1k",
         spark__sql__shuffle__partitions="8")
    key = "if(id % 10 < 8, 0, id) as k"
    big = spark.range(0, 60_000, 1, 12).selectExpr("id", key)
    small = spark.range(60_000, 60_400, 1, 20).selectExpr("id", key)
    path = str(tmp_path / "balanced")
    balance_partitions(big.unionAll(small), *columns).write.parquet(path)
    files = spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.count("*").alias("n"))
    sizes = [r["n"] for r in files.collect()]
    assert sum(sizes) == 60_400
    assert len(sizes) >= 6
    assert max(sizes) <= 60_400 / 4


def test_scratch_needs_a_shared_folder(monkeypatch):
    class Context:
        def __init__(self, master, folder=None):
            self.master, self.folder = master, folder

        def getCheckpointDir(self):
            return self.folder

    class Session:
        def __init__(self, context, folder=None):
            self.sparkContext = context
            self.conf = {"spark.checkpoint.dir": folder}

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            writers.shared_folder(Session(Context(master)))
        assert writers.shared_folder(Session(Context(master, "hdfs://a/b/"))) == "hdfs://a/b"
        assert writers.shared_folder(Session(Context(master), "hdfs://c")) == "hdfs://c"
        assert writers.shared_folder(Session(Context(master), "hdfs://c"), "s3://d/") == "s3://d"
    assert writers.shared_folder(Session(Context("local[4]")))
