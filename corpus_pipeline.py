"""From raw documents to packed training sequences.

Each stage works on all its predecessor kept and is written as Parquet before the next one reads
it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayvalue.llm import langid, mixing, packing, pii, simhash
from stayvalue.llm.shared import free_name, store

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language, or a jumble of several, go."""
    model = langid.train(docs.filter(~langid.held_out()).select("text", "lang"))
    return langid.keep_identified(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by fingerprints the document with the smallest id stays.

    Shingle length and bit limit are those of the near-duplicate operator.
    """
    return simhash.deduplicate(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are masked in the texts, and the terms that would disclose them."""
    return pii.sanitise(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Only the documents drawn at the calibrated rates go on."""
    names = {
        name: free_name(name, docs.columns)
        for name in ("tokens", "topic", "kept", "keep_probability")
    }
    measured = mixing.with_tokens_and_topic(docs, tokens=names["tokens"], topic=names["topic"])
    drawn = mixing.mix(
        measured,
        dimensions=("source", "lang", names["topic"]),
        tokens=names["tokens"],
        kept=names["kept"],
        probability=names["keep_probability"],
    )
    return drawn.filter(F.col(names["kept"])).select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places in training sequences for every piece of every document."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("packing", packed),
]

#: The stages are learned or iterative; the tests hold them against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the last stage's result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = store(out, f"stage-{number}-{name}") if number < len(STAGES) - 1 else out
    return docs
