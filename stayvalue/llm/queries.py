"""The corpus operators as queries over the whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from stayvalue.llm import (
    ann,
    divergence,
    html_text,
    langid,
    mixing,
    packing,
    pieces,
    pii,
    quality_llr,
    simhash,
    substrings,
    warc,
    whitening,
)
from stayvalue.llm.shared import store

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def _query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))


@_query
def op1_quality_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures, log-likelihood ratio and verdict of every document."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    return quality_llr.judge(docs, labels)


@_query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.report(_table(spark, sf_dir, "documents"))


@_query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out()).select("text", "lang"))
    return langid.identify(docs, model).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score"
    )


@_query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its bin."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


@_query
def op5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its cell, its probability and whether it was drawn."""
    docs = mixing.with_tokens_and_topic(_table(spark, sf_dir, "documents"))
    slim = store(docs.select("doc_id", "source", "lang", "topic", "tokens"), "mix-documents")
    return mixing.mix(slim).withColumn("keep_probability", F.round("keep_probability", 6))


@_query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back."""
    return warc.round_trip(_table(spark, sf_dir, "pages"))


@_query
def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms of every document."""
    return pii.report(_table(spark, sf_dir, "documents"))


@_query
def op8_repeated_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of every document without its repeated 200-byte strings."""
    return substrings.report(_table(spark, sf_dir, "documents"))


@_query
def op9_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every hundredth."""
    return ann.nearest(_vectors(spark, sf_dir))


@_query
def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = _table(spark, sf_dir, "pages")
    return html_text.extract(pages, html_text.train(pages))


@_query
def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, decoded, and compared with the library."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encode(_table(spark, sf_dir, "documents"), model, with_ids=False)


@_query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on the whitened components."""
    return whitening.whiten(_vectors(spark, sf_dir))


@_query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language are apart, and by which terms."""
    return divergence.audit(_table(spark, sf_dir, "documents"))


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline over the documents."""
    return corpus_pipeline.run(spark, sf_dir)


OP6_SQL = f"""
with sums as (
    select page_id, coalesce(octet_length(encode(html)), 0)::BIGINT as payload_bytes,
        sha256(coalesce(html, '')) as payload_digest from pages),
firsts as (
    select payload_digest, min(page_id) as first_id from sums
    where payload_bytes >= {warc.MIN_REVISIT_BYTES} group by payload_digest)
select page_id, payload_bytes, payload_digest,
    case when first_id is null or first_id is not distinct from page_id then 'response'
        else 'revisit' end as record_type,
    case when first_id is distinct from page_id then first_id end as refers_to
from sums left join firsts using (payload_digest)
"""

ORACLE_SQL: dict[str, str] = {
    "op5_mixture": mixing.oracle_sql(),
    "op6_warc": OP6_SQL,
    "op9_nearest": ann.oracle_sql(),
    "op13_source_divergence": divergence.oracle_sql(),
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
