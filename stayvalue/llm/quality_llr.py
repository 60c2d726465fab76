"""Quality rules: fixed base rules, then a hashed n-gram log-likelihood ratio.

Two multinomials over hashed byte n-grams are counted from the corpus: the *target* from all trusted
documents, the *raw* one from all documents. The score of a document is the mean over its n-grams of
log(target / raw), so long and short texts compare. A document is kept if its score is at least a
threshold. The threshold is a pure function of the score histograms of the labelled documents.

The counts are kept per task in a fixed number of buckets and summed by bucket; what reaches the
driver has that size, whatever the corpus. Texts are never shuffled.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayvalue.llm.shared import Tally, store, utf8

BUCKETS = 1 << 16
NGRAM = 4
#: Pseudo-count of every bucket.
SMOOTHING = 1.0
#: Bytes of a text that are hashed at a time; only memory depends on it.
CHUNK = 1 << 20
#: Labelled ids up to this many are broadcast; more are joined by a shuffle. Same result.
BROADCAST_IDS = 1_000_000
#: Score histogram: width of a cell, and the range it covers (scores beyond it count at the ends).
CELL, REACH = 0.002, 8.0
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

_CONTINUATION = bytes(range(0x80, 0xC0))
_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_HASH = np.array([2654435761, 2246822519, 3266489917, 668265263], dtype=np.uint32)


def base_rules(text: bytes) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed of one text."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts = Counter(windows)
        end = 0  # words before this one are counted
        for start, window in enumerate(windows):
            if counts[window] > 1:
                repeated += start + 3 - max(end, start)
                end = start + 3
    failed = len(words) < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * len(words)
    return (
        len(words),
        len(text.translate(None, _CONTINUATION + _SPACE)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated,
        failed,
    )


def ngram_buckets(text: bytes) -> Iterator[np.ndarray]:
    """Buckets of all n-grams of a text, a bounded chunk at a time."""
    for at in range(0, len(text) - NGRAM + 1, CHUNK):
        part = np.frombuffer(text[at : at + CHUNK + NGRAM - 1], dtype=np.uint8).astype(np.uint32)
        hashed = part[: len(part) - NGRAM + 1] * _HASH[0]
        for i in range(1, NGRAM):
            hashed ^= part[i : len(part) - NGRAM + 1 + i] * _HASH[i]
        hashed ^= hashed >> np.uint32(15)
        hashed *= np.uint32(2246822519)
        yield hashed >> np.uint32(32 - 16)


def _count_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tally = Tally(2, BUCKETS)
    for batch in batches:
        texts, trusted = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for text, good in zip(texts, trusted, strict=True):
            for buckets in ngram_buckets(text):
                tally.add(0, buckets)
                if good:
                    tally.add(1, buckets)
    counts = tally.total()
    used = np.flatnonzero(counts[0])
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), pa.array(counts[0][used]), pa.array(counts[1][used])],
        names=["bucket", "raw", "target"],
    )


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids labelled as good and never as bad or toxic."""
    return (
        labels.filter(F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("worst"), F.max("toxic").alias("toxic"))
        .filter("worst = 1 and coalesce(toxic, 0) = 0")
        .select("doc_id")
    )


def log_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """log(target / raw) per bucket, from the n-grams of all documents."""
    good = store(trusted_ids(labels), "trusted").withColumn("trusted", F.lit(True))
    if good.count() <= BROADCAST_IDS:
        good = F.broadcast(good)
    flagged = docs.select("doc_id", "text").join(good, "doc_id", "left").select(
        utf8("text").alias("bytes"), F.coalesce("trusted", F.lit(False)).alias("trusted")
    )
    counted = flagged.mapInArrow(_count_task, "bucket int, raw long, target long")
    table = counted.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).toPandas()
    counts = np.full((2, BUCKETS), SMOOTHING)
    counts[:, table["bucket"]] += table.iloc[:, 1:].to_numpy(dtype=np.float64).T
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def score(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """Base figures and ``llr`` (double, 0 for texts without n-grams) per document."""
    shared = docs.sparkSession.sparkContext.broadcast(ratios)
    fields = [docs.schema["doc_id"]]
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
        fields.append(T.StructField(name, T.LongType()))
    fields += [T.StructField("base_failed", T.BooleanType()), T.StructField("llr", T.DoubleType())]
    names = [field.name for field in fields]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                total = sum(float(table[buckets].sum()) for buckets in ngram_buckets(text))
                rows.append((*base_rules(text), total / max(1, len(text) - NGRAM + 1)))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
            arrays += [pa.array(columns[5], pa.bool_()), pa.array(columns[6], pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=names)

    return docs.select("doc_id", utf8("text").alias("bytes")).mapInArrow(
        task, T.StructType(fields)
    )


def best_threshold(good: dict[int, int], bad: dict[int, int]) -> float:
    """The score at which the shares of good above and bad below add up to most.

    Keys are histogram cells. If a stretch of cells does equally well, its middle is taken. Without
    labels of both kinds nothing is rejected.
    """
    if not good or not bad:
        return -float("inf")
    all_good, all_bad = sum(good.values()), sum(bad.values())
    lost = caught = 0
    best, low, high = 0.0, -float("inf"), -float("inf")
    cells = sorted(good.keys() | bad.keys())
    for cell, following in zip(cells, [*cells[1:], cells[-1] + 1], strict=True):
        lost += good.get(cell, 0)
        caught += bad.get(cell, 0)
        gain = caught / all_bad - lost / all_good
        if gain > best:
            best, low, high = gain, cell + 1, following
    return (low + high) / 2 * CELL


def threshold(scored: DataFrame, labels: DataFrame) -> float:
    """The threshold from the score histograms of all labelled documents that pass the base."""
    known = (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    cell = F.floor(F.greatest(F.lit(-REACH), F.least(F.lit(REACH), "llr")) / CELL).cast("int")
    table = (
        scored.filter("not base_failed")
        .join(known, "doc_id")
        .groupBy((F.col("quality") >= 1).alias("good"), cell.alias("cell"))
        .count()
        .collect()
    )  # at most two histograms
    histograms: dict[bool, dict[int, int]] = {True: {}, False: {}}
    for row in table:
        histograms[row["good"]][row["cell"]] = row["count"]
    return best_threshold(histograms[True], histograms[False])


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base figures, ``llr`` and ``kept`` for every document.

    NULL texts count as empty and fail the base; repeated rows are judged alike, each; NULL ids are
    never labelled. Other columns are not read, so their names cannot clash. An empty table gives an
    empty result.
    """
    scored = store(score(docs, log_ratios(docs, labels)), "quality")
    limit = threshold(scored, labels)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= F.lit(limit)))
