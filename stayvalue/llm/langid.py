"""Language identification: scripts narrow the candidates, Viterbi labels the words.

Training counts, over all training documents, hashed character n-grams (with word ends) and scripts
per language. A word's score for a language is the sum of its n-grams' log-probabilities; languages
that hardly ever use the word's script are no candidates for it. Viterbi then finds the best label
sequence of the words, where each change of language costs a penalty, so that a span of another
language is found but a single odd word is not. The document's language is the one that labels most
letters; its score is the share of letters so labelled.

Counts are kept per task in tables of fixed size (buckets x languages) and summed by bucket. Only
those sums reach the driver. Texts are never shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayvalue.llm.shared import Tally, free_name, in_parts

BUCKETS = 1 << 16
ORDERS = (2, 3)
#: Pseudo-count of an n-gram in each language.
SMOOTHING = 0.5
#: A language is a candidate for a script that makes up at least this share of its letters.
SCRIPT_SHARE = 0.001
#: What a change of language costs, in natural log units.
SWITCH_PENALTY = 12.0
#: Letters that are scored at a time; only memory depends on it.
CHUNK = 1 << 18
UNKNOWN = "und"
#: A document is rejected if its language labels a smaller share of its letters.
MIN_SCORE = 0.3

#: First code points of the script ranges, with the script's number; 0 is other.
SCRIPTS = (
    (0x0000, 1),  # Latin
    (0x0370, 2),  # Greek
    (0x0400, 3),  # Cyrillic
    (0x0530, 4),  # Armenian
    (0x0590, 5),  # Hebrew
    (0x0600, 6),  # Arabic
    (0x0780, 0),
    (0x0900, 7),  # Devanagari
    (0x0980, 0),
    (0x0E00, 8),  # Thai
    (0x0E80, 0),
    (0x10A0, 9),  # Georgian
    (0x1100, 10),  # Hangul
    (0x1200, 0),
    (0x1E00, 1),  # Latin, additional
    (0x1F00, 2),  # Greek, extended
    (0x2000, 0),
    (0x3040, 11),  # Kana
    (0x3100, 0),
    (0x3400, 12),  # Han
    (0xA000, 0),
    (0xAC00, 10),  # Hangul syllables
    (0xD7B0, 0),
)
N_SCRIPTS = 13
_SCRIPT_FROM = np.array([start for start, _ in SCRIPTS])
_SCRIPT_OF = np.array([number for _, number in SCRIPTS], dtype=np.int64)


#: Whether each code point is a letter.
_LETTERS = np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)])


@dataclass
class Words:
    """The letter runs of a text: n-gram buckets of all words, and per word what belongs to it."""

    buckets: np.ndarray  # (letters, orders) buckets of the n-grams that end at each letter
    starts: np.ndarray  # first letter of each word
    scripts: np.ndarray  # script of each word, by its first letter
    lengths: np.ndarray


def words_of(text: str) -> Iterator[Words]:
    """The words of a lower-cased text, a bounded chunk at a time; a chunk ends between words."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    at = 0
    while at < len(codes):
        end = min(len(codes), at + CHUNK)
        if end < len(codes):
            gaps = np.flatnonzero(~_LETTERS[codes[at:end]])
            end = at + int(gaps[-1]) + 1 if len(gaps) else end
        part = codes[at:end]
        at = end
        letter = _LETTERS[part]
        places = np.flatnonzero(letter)
        if not len(places):
            continue
        letters = part[places].astype(np.uint64)
        first = np.ones(len(places), dtype=bool)
        first[1:] = np.diff(places) > 1
        starts = np.flatnonzero(first)
        # Mark the word's start; n-grams reach back over it at most to the mark.
        mark = np.uint64(0x110000)
        before = np.where(first, mark, np.roll(letters, 1))
        back_first = np.roll(first, 1)
        back_first[0] = True
        two_before = np.where(first, mark, np.where(back_first, mark, np.roll(letters, 2)))
        pairs = letters + before * np.uint64(0x200003)
        columns = []
        for order, grams in zip(ORDERS, (pairs, pairs + two_before * np.uint64(0x40000B00007))):
            mixed = (grams + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
            columns.append((mixed >> np.uint64(48)).astype(np.int64))
        lengths = np.diff(np.append(starts, len(places)))
        scripts = _SCRIPT_OF[
            np.searchsorted(_SCRIPT_FROM, letters[starts].astype(np.int64), side="right") - 1
        ]
        yield Words(np.stack(columns, axis=1), starts, scripts, lengths)


#: Languages a model has at most; each takes half a megabyte in every task.
MAX_LANGUAGES = 500


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (BUCKETS, languages) log-probability
    candidates: np.ndarray  # (N_SCRIPTS, languages) 0 for a candidate, -inf otherwise
    penalty: float = SWITCH_PENALTY


def train(docs: DataFrame, penalty: float = SWITCH_PENALTY) -> Model:
    """Count all documents with a language; ``docs`` has ``text`` and ``lang``.

    More than ``MAX_LANGUAGES`` names are an error: every task holds a table per language.
    """
    known = docs.filter("text is not null and lang is not null")
    names = known.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; is the column clean?")
    languages = sorted(row[0] for row in names)
    place = {language: i for i, language in enumerate(languages)}

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(len(place), BUCKETS + N_SCRIPTS)
        for batch in in_parts(batches, 0):
            for text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for words in words_of(text):
                    tally.add(place[lang], words.buckets.ravel())
                    tally.add(place[lang], BUCKETS + np.repeat(words.scripts, words.lengths))
        counts = tally.total()
        number, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(number, pa.int32()),
                pa.array(bucket, pa.int32()),
                pa.array(counts[number, bucket]),
            ],
            names=["language", "bucket", "n"],
        )

    sums = (
        known.select(F.lower("text").alias("text"), "lang")
        .mapInArrow(task, "language int, bucket int, n long")
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )  # at most languages x (buckets + scripts) rows
    counts = np.zeros((BUCKETS + N_SCRIPTS, len(languages)))
    counts[sums["bucket"], sums["language"]] = sums["n"]
    grams = counts[:BUCKETS] + SMOOTHING
    weights = np.log(grams / grams.sum(axis=0, keepdims=True))
    letters = counts[BUCKETS:]
    shares = letters / np.maximum(1, letters.sum(axis=0, keepdims=True))
    candidates = np.where(shares >= SCRIPT_SHARE, 0.0, -np.inf)
    # A script that no language uses rules nobody out.
    candidates[~np.isfinite(candidates).any(axis=1)] = 0.0
    return Model(languages, weights.astype(np.float32), candidates, penalty)


def word_scores(words: Words, model: Model) -> np.ndarray:
    """(words, languages) log-probabilities, -inf for languages that the script rules out."""
    grams = model.weights[words.buckets.ravel()]
    sums = np.add.reduceat(grams, words.starts * len(ORDERS), axis=0, dtype=np.float64)
    return sums + model.candidates[words.scripts]


def label_words(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word; ties go to the smaller label and to not switching.

    If no stretch of words would gain as much as one switch costs by leaving the best single
    language, that language is the answer; otherwise Viterbi runs over the words.
    """
    total = scores.sum(axis=0)
    best = int(np.argmax(total))
    if np.isfinite(total[best]):
        rest = scores.copy()
        rest[:, best] = -np.inf
        with np.errstate(invalid="ignore"):
            gain = np.cumsum(np.maximum(rest.max(axis=1) - scores[:, best], -1e6))
        lowest = np.minimum.accumulate(np.append(0.0, gain[:-1]))
        if (gain - lowest).max() <= penalty:
            return np.full(len(scores), best)
    came_from = []
    value = None
    for word in scores.tolist():
        if value is None:
            value = word
            continue
        top = max(value)
        best, switch = value.index(top), top - penalty
        came_from.append([i if v >= switch else best for i, v in enumerate(value)])
        value = [(v if v >= switch else switch) + w for v, w in zip(value, word, strict=True)]
    path = [value.index(max(value))]
    for origin in reversed(came_from):
        path.append(origin[path[-1]])
    return np.array(path[::-1])


def predict(text: str | None, model: Model) -> tuple[str, float, list[tuple[int, str]]]:
    """Language, score and spans (words, language) of one lower-cased text."""
    parts = list(words_of(text or ""))
    if not parts or not model.languages:
        return UNKNOWN, 0.0, []
    scores = np.concatenate([word_scores(words, model) for words in parts])
    lengths = np.concatenate([words.lengths for words in parts])
    path = label_words(scores, model.penalty)
    letters = np.bincount(path, weights=lengths, minlength=len(model.languages))
    best = int(np.argmax(letters))
    ends = np.append(np.flatnonzero(np.diff(path)) + 1, len(path))
    counts = np.diff(np.append(0, ends))
    spans = [(int(n), model.languages[path[e - 1]]) for n, e in zip(counts, ends, strict=True)]
    return model.languages[best], float(letters[best] / lengths.sum()), spans


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``spans`` to ``doc_id`` for every document.

    ``spans`` lists (words, language) in text order. NULL texts and texts without a letter are
    ``und`` with score 0 and no spans; with no training documents every text is. Only the text is
    looked at; repeated rows get the same answer, each. An empty table gives an empty result.
    """
    span = T.StructType(
        [T.StructField("words", T.LongType()), T.StructField("lang", T.StringType())]
    )
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("spans", T.ArrayType(span)),
        ]
    )
    span_type = pa.list_(pa.struct([("words", pa.int64()), ("lang", pa.string())]))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, 1):
            found = [predict(text, model) for text in batch.column(1).to_pylist()]
            spans = [[{"words": n, "lang": lang} for n, lang in row[2]] for row in found]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([row[0] for row in found], pa.string()),
                    pa.array([row[1] for row in found], pa.float64()),
                    pa.array(spans, span_type),
                ],
                names=schema.names,
            )

    return docs.select("doc_id", F.lower("text").alias("text")).mapInArrow(task, schema)


def keep_identified(docs: DataFrame, model: Model, min_score: float = MIN_SCORE) -> DataFrame:
    """The documents, unchanged, whose language is known and labels enough of their letters."""
    lowered = free_name("lowered", docs.columns)
    last = len(docs.columns)

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, last):
            found = [predict(text, model) for text in batch.column(lowered).to_pylist()]
            good = [lang != UNKNOWN and score >= min_score for lang, score, _ in found]
            yield batch.drop_columns([lowered]).filter(pa.array(good, pa.bool_()))

    return docs.withColumn(lowered, F.lower("text")).mapInArrow(task, docs.schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training: CRC-32 of its id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))
