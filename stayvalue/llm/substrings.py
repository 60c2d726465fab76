"""Removal of repeated byte strings: runs around content-defined anchors, compared in groups.

This stands in for external induced sorting of all suffixes with disk-backed queues; that method is
not built.

Wanted is every 200-byte stretch that starts at two places. Sorting all suffixes of the corpus tells,
by the common prefixes of neighbours, but most suffixes cannot take part. As induced sorting does,
the text is first reduced to few named places, equal text having equal names: the *anchors*, local
minima of a hash, which every stretch contains and which are chosen by its content alone. Recursion
onto the anchors leaves those whose name occurs twice:

* Runs of stretches around an anchor that are equal as a whole are recognised by their names; all of
  them are repeated, and one stands for them in what follows.
* Where runs with one anchor differ, the suffix tuples (anchor, bytes to the right) are sorted with
  the common prefixes of neighbours, and the bytes to the left are induced from there: a stretch
  that begins e bytes before the anchor is repeated if some neighbour shares e bytes to the left and
  200 - e to the right.

The queues that hold the tuples on disk between the steps are Spark's shuffles and external sorts.
An anchor with very many different runs is not compared in one task: its stretches are counted by a
hash of all their bytes instead.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayvalue.llm.anchors import STRETCH, anchors, context_hash
from stayvalue.llm.shared import store, utf8

#: Different runs of one anchor up to which one task sorts them; they take some 8 MB.
RUN_LIMIT = 20_000
#: Runs up to which it is quicker to compare each with its neighbours than to number prefixes.
PAIR_LIMIT = 12

RUN_SCHEMA = "gram long, run long, place long, first long, last long"


def _key(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``bytes``: repeated ids with other texts stay apart."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), utf8("text").alias("bytes"))


def runs_of(keyed: DataFrame) -> DataFrame:
    """All runs of stretches of all documents: their anchor's name, their own, and their place."""
    schema = T.StructType(
        [keyed.schema["doc_id"], keyed.schema["text_hash"], *T.StructType.fromDDL(RUN_SCHEMA).fields]
    )

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, columns = [], [[], [], [], [], []]
            for at, text in enumerate(batch.column(2).to_pylist()):
                for gram, place, first, last in anchors(text):
                    named = [
                        context_hash(text, a, b)
                        for a, b in zip(first.tolist(), last.tolist(), strict=True)
                    ]
                    row.append(np.full(len(gram), at))
                    parts = (gram, np.array(named, dtype=np.int64), place, first, last)
                    for column, part in zip(columns, parts, strict=True):
                        column.append(part)
            if row:
                taken = pa.array(np.concatenate(row))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(taken),
                        batch.column(1).take(taken),
                        *[pa.array(np.concatenate(column), pa.int64()) for column in columns],
                    ],
                    names=schema.names,
                )

    return keyed.mapInArrow(task, schema)


def with_partners(runs: DataFrame) -> DataFrame:
    """The runs whose anchor is found twice or more; the others, the most, take no part."""
    grams = runs.groupBy("gram").agg(F.count("*").alias("places")).filter("places > 1")
    return runs.join(store(grams.select("gram"), "substring-grams"), "gram", "left_semi")


def named_runs(runs: DataFrame) -> DataFrame:
    """(gram, run) with ``copies``, one of its places, and the anchor's number of runs."""
    named = store(
        runs.groupBy("gram", "run").agg(
            F.count("*").alias("copies"),
            F.min(F.struct("doc_id", "text_hash", "place", "first", "last")).alias("one"),
        ),
        "substring-named",
    )
    return named.join(named.groupBy("gram").agg(F.count("*").alias("n_runs")), "gram")


def suffix_tuples(keyed: DataFrame, different: DataFrame) -> DataFrame:
    """The bytes around the anchor of one run per name: ``right`` from the anchor, ``left`` before
    it, backwards, and how far before the anchor the run's stretches begin."""
    wanted = (
        different.select("gram", "run", "n_runs", "one.*")
        .groupBy("doc_id", "text_hash")
        .agg(
            F.collect_list(
                F.struct("gram", "run", "n_runs", "place", "first", "last")
            ).alias("wanted")
        )
        .withColumnsRenamed({"doc_id": "wanted_id", "text_hash": "wanted_hash"})
    )
    joined = keyed.join(
        wanted,
        keyed["doc_id"].eqNullSafe(F.col("wanted_id"))
        & (keyed["text_hash"] == F.col("wanted_hash")),
    ).select("bytes", "wanted")

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, runs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for r in runs:
                    place, first, last = r["place"], r["first"], r["last"]
                    right, left = text[place : last + STRETCH], text[first:place][::-1]
                    key = (r["gram"], r["run"], r["n_runs"])
                    rows.append((*key, right, left, place - last, place - first))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 3 + [pa.binary()] * 2 + [pa.int32()] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["gram", "run", "n_runs", "right", "left", "nearest", "farthest"],
            )

    return joined.mapInArrow(
        task,
        "gram long, run long, n_runs long, right binary, left binary, nearest int, farthest int",
    )


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Inclusive spans of integers, joined where they overlap or touch."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def repeated_starts(tuples: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
    """(gram, run, from, to): how far before the anchor repeated stretches of a run begin.

    ``tuples`` are the suffix tuples of one anchor, sorted by their bytes to the right. Going along
    the sorted neighbours, the common prefix with the suffix at hand is the least one passed. For
    few runs: the time grows with the square of their number.
    """
    found: list[list[tuple[int, int]]] = [[] for _ in tuples]
    next_prefix = [
        common_prefix(a[2], b[2]) for a, b in zip(tuples, tuples[1:], strict=False)
    ]
    for i, (_, _, _, left, nearest, farthest) in enumerate(tuples):
        right = STRETCH
        for j in range(i + 1, len(tuples)):
            right = min(right, next_prefix[j - 1])
            low = STRETCH - right
            if low > STRETCH:
                break
            _, _, _, other_left, other_nearest, other_farthest = tuples[j]
            high = common_prefix(left, other_left)
            if low <= high:
                for k, a, b in ((i, nearest, farthest), (j, other_nearest, other_farthest)):
                    if max(low, a) <= min(high, b):
                        found[k].append((max(low, a), min(high, b)))
    for item, spans in zip(tuples, found, strict=True):
        for low, high in merged(spans):
            yield item[0], item[1], low, high


def repeated_starts_of_many(tuples: list[tuple]) -> Iterator[tuple[int, int, int, int]]:
    """The same in about linear time, for many runs.

    Common prefixes of sorted neighbours number the distinct prefixes of any length: a new one begins
    where the common prefix is shorter. A stretch is the pair of its left and right prefix.
    """
    rights = [t[2] for t in tuples]
    lefts = [t[3] for t in tuples]
    by_left = sorted(range(len(tuples)), key=lefts.__getitem__)
    right_common = np.array([common_prefix(a, b) for a, b in zip(rights, rights[1:], strict=False)])
    left_common = np.array(
        [common_prefix(lefts[a], lefts[b]) for a, b in zip(by_left, by_left[1:], strict=False)]
    )
    nearest = np.array([t[4] for t in tuples])
    farthest = np.array([t[5] for t in tuples])
    left_number = np.zeros(len(tuples), dtype=np.int64)
    found: list[list[tuple[int, int]]] = [[] for _ in tuples]
    for e in range(int(nearest.min()), int(farthest.max()) + 1):
        here = np.flatnonzero((nearest <= e) & (e <= farthest))
        right_number = np.append(0, np.cumsum(right_common < STRETCH - e))
        left_number[by_left] = np.append(0, np.cumsum(left_common < e))
        stretch = right_number[here] * len(tuples) + left_number[here]
        _, which, counts = np.unique(stretch, return_inverse=True, return_counts=True)
        for k in here[counts[which] > 1]:
            found[k].append((e, e))
    for item, spans in zip(tuples, found, strict=True):
        for low, high in merged(spans):
            yield item[0], item[1], low, high


def compared(tuples: DataFrame) -> DataFrame:
    """(gram, run, low, high) from the sorted suffix tuples of each anchor."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        out: list[tuple[int, int, int, int]] = []

        def batch_of() -> pa.RecordBatch:
            columns = list(zip(*out, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["gram", "run", "low", "high"],
            )

        for _, group in groupby(rows(), key=lambda row: row[0]):
            # Repeated rows of a document give their tuples once each; one is enough.
            runs = list({row[1]: row for row in group}.values())
            few = len(runs) <= PAIR_LIMIT
            out.extend(repeated_starts(runs) if few else repeated_starts_of_many(runs))
            if len(out) > 50_000:
                yield batch_of()
                out.clear()
        yield batch_of()

    return (
        tuples.repartition("gram")
        .sortWithinPartitions("gram", "right")
        .mapInArrow(task, "gram long, run long, low int, high int")
    )


def counted(tuples: DataFrame) -> DataFrame:
    """The same for anchors with very many runs: stretches are counted by a hash of their bytes."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for gram, run, right, left, near, far in zip(
                *(c.to_pylist() for c in batch.columns), strict=True
            ):
                whole = left[::-1] + right
                for e in range(near, far + 1):
                    start = len(left) - e
                    rows.append(
                        (gram, run, e, xxhash.xxh3_128_digest(whole[start : start + STRETCH]))
                    )
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)],
                names=["gram", "run", "e", "stretch"],
            )

    stretches = store(
        tuples.mapInArrow(task, "gram long, run long, e int, stretch binary"), "substring-stretches"
    )
    repeated = (
        stretches.groupBy("stretch")
        .agg(F.min("run").alias("a"), F.max("run").alias("b"))
        .filter("a < b")
    )
    return stretches.join(repeated, "stretch", "left_semi").select(
        "gram", "run", F.col("e").alias("low"), F.col("e").alias("high")
    )


def repeated_spans(keyed: DataFrame, run_limit: int = RUN_LIMIT) -> DataFrame:
    """``doc_id``, ``text_hash`` and ``spans`` (start, end; end exclusive) of repeated bytes."""
    runs = store(with_partners(store(runs_of(keyed), "substring-runs")), "substring-partners")
    named = store(named_runs(runs), "substring-repeated")
    whole = named.filter("copies > 1").select(
        "gram", "run", F.lit(0).alias("low"), F.lit(STRETCH).alias("high")
    )
    # A run with copies is repeated anyway, but others may share a part of it.
    tuples = store(suffix_tuples(keyed, named.filter("n_runs > 1")), "substring-tuples")
    columns = ["gram", "run", "right", "left", "nearest", "farthest"]
    parts = compared(tuples.filter(F.col("n_runs") <= run_limit).select(*columns))
    many = tuples.filter(F.col("n_runs") > run_limit)
    if not many.isEmpty():
        parts = parts.unionAll(counted(many.select(*columns)))
    single = named.filter("copies = 1").select("gram", "run")
    parts = parts.join(single, ["gram", "run"], "left_semi")
    found = store(whole.unionAll(parts), "substring-found")
    start = F.greatest(F.col("first"), F.col("place") - F.col("high"))
    end = F.least(F.col("last"), F.col("place") - F.col("low")) + STRETCH
    return (
        runs.join(found, ["gram", "run"])
        .select("doc_id", "text_hash", F.struct(start.alias("start"), end.alias("end")).alias("s"))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list("s").alias("spans"))
    )


def without(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The text without the spans, the bytes removed, and the number of maximal removed runs."""
    runs = merged([(start, end - 1) for start, end in spans])
    kept, at, removed = [], 0, 0
    for low, high in runs:
        kept.append(text[at:low])
        removed += high + 1 - low
        at = high + 1
    return b"".join([*kept, text[at:]]), removed, len(runs)


def _with_spans(docs: DataFrame, run_limit: int) -> DataFrame:
    keyed = _key(docs)
    spans = store(repeated_spans(keyed, run_limit), "substring-spans").withColumnsRenamed(
        {"doc_id": "span_id", "text_hash": "span_hash"}
    )
    return keyed.join(spans, _same(keyed, spans), "left").select("doc_id", "bytes", "spans")


def _same(keyed: DataFrame, spans: DataFrame) -> Column:
    return keyed["doc_id"].eqNullSafe(spans["span_id"]) & (
        keyed["text_hash"] == spans["span_hash"]
    )


def remove_repeats(docs: DataFrame, run_limit: int = RUN_LIMIT) -> DataFrame:
    """``doc_id``, ``kept`` (bytes), n_bytes, n_removed and n_spans of every document.

    Every byte covered by a 200-byte string that also starts elsewhere, in the same document or
    another, is removed; all judged on the input. NULL texts count as empty; texts shorter than 200
    bytes are never touched; repeated rows are documents of their own and remove each other. Only
    ``doc_id`` and ``text`` are read. An empty table gives an empty result.
    """
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("kept", T.BinaryType()),
            *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")],
        ]
    )

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [
                without(text, [(s["start"], s["end"]) for s in spans or []])
                for text, spans in zip(texts, batch.column(2).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([f[0] for f in found], pa.binary()),
                    pa.array([len(text) for text in texts], pa.int64()),
                    pa.array([f[1] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.int64()),
                ],
                names=schema.names,
            )

    return _with_spans(docs, run_limit).mapInArrow(task, schema)


def report(docs: DataFrame) -> DataFrame:
    """``remove_repeats`` with the SHA-256 of what is kept."""
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )

