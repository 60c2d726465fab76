"""Fixtures of the corpus operators' tests."""

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """A documents table from texts (ids from 0), or from whole rows."""

    def make(rows, partitions=3):
        full = [
            row if isinstance(row, tuple) else (i, row, "en", "a", len(row or ""))
            for i, row in enumerate(rows)
        ]
        return spark.createDataFrame(full, DOCUMENTS).repartition(partitions)

    return make


@pytest.fixture
def read(spark, sf_dir):
    return lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
