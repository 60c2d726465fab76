"""Near-duplicates by SimHash and a byte-position inverted index with count filtering.

A fingerprint of 64 bits is 8 positional bytes. Fingerprints that differ in at most 4 bits differ in
at most 4 bytes, so they share at least 4 positional bytes: the guaranteed number of matches. The
index is keyed by 4 positional bytes at once, that is, a posting list is the intersection of the
lists of 4 positions. Two fingerprints meet in a list exactly if their tally of shared bytes reaches
4, and pairs below it never come up. Pairs that meet are verified on the whole fingerprint.

Only distinct fingerprints are indexed; copies meet in their fingerprint. A list with very many
members is never expanded into pairs: its members are tied together through all fingerprints within
2 bits of them (two fingerprints within 4 bits share one), at a fixed number of rows per member.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayvalue.llm.graph import components
from stayvalue.llm.shared import free_name, in_parts, store, utf8

SHINGLE = 4
SEED = 42
MAX_BITS = 4
BYTES = 8
MIN_SHARED = BYTES - MAX_BITS
#: Members above which a posting list is not expanded into pairs.
LIST_LIMIT = 256
#: Keys of removed documents up to this many are broadcast (16 bytes each, some 40 MB in memory).
BROADCAST_KEYS = 500_000
#: Shingles whose bits are counted at a time; only memory depends on it.
CHUNK = 1 << 15


def fingerprint(text: bytes) -> int:
    """Majority bits of the XXH64 of all word shingles; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends, at = [], -1
    for word in words:
        at += len(word) + 1
        ends.append(at)
    starts = [0, *(end + 1 for end in ends[:-1])]
    last = max(1, len(words) - SHINGLE + 1)
    stops = ends[SHINGLE - 1 :] or ends[-1:]
    counts = np.zeros(64, dtype=np.int64)
    hash_of = xxhash.xxh64_intdigest
    for begin in range(0, last, CHUNK):
        hashes = np.array(
            [
                hash_of(joined[a:b], SEED)
                for a, b in zip(
                    starts[begin : min(begin + CHUNK, last)],
                    stops[begin : begin + CHUNK],
                    strict=True,
                )
            ],
            dtype=">u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > last).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id``, a hash of the text, and ``fp`` (the 64 bits as a long) of every document."""
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("text_hash", T.LongType()),
            T.StructField("fp", T.LongType()),
        ]
    )

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches, 2):
            found = [fingerprint(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.int64())],
                names=schema.names,
            )

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), utf8("text")).mapInArrow(
        task, schema
    )


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def postings(fps: DataFrame) -> DataFrame:
    """(fp, positions, shared): an entry per choice of 4 byte positions, with those bytes."""
    masks = [
        _signed(sum(0xFF << (8 * position) for position in chosen))
        for chosen in combinations(range(BYTES), MIN_SHARED)
    ]
    keys = F.array(*[F.col("fp").bitwiseAND(F.lit(mask)) for mask in masks])
    return fps.select("fp", F.posexplode(keys).alias("positions", "shared"))


def shared_lists(index: DataFrame) -> DataFrame:
    """The index without lists of one member; ``n`` is the length of the list.

    One shuffle, whatever the size; a list streams through its task and spills if it is long.
    """
    in_list = Window.partitionBy("positions", "shared")
    return index.withColumn("n", F.count("*").over(in_list)).filter("n > 1")


def verified_pairs(members: DataFrame) -> DataFrame:
    """Distinct (a, b) with a < b that meet in a list and differ in few enough bits."""
    other = members.withColumnRenamed("fp", "b")
    return (
        members.withColumnRenamed("fp", "a")
        .join(other, ["positions", "shared"])
        .filter("a < b")
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)
        .select("a", "b")
        .distinct()
    )


def ties_of_long_lists(members: DataFrame) -> DataFrame:
    """(a, b) that connect all linked members of the lists, without comparing pairs.

    Each member stands at every fingerprint within 2 bits of it; all that stand at one place are
    within 4 bits of each other and are tied to the smallest of them.
    """

    def flip(bit: str):
        # Bit 64 stands for no flip.
        return F.when(F.col(bit) == 64, F.lit(0).cast("long")).otherwise(
            F.expr(f"shiftleft(1L, {bit})")
        )

    places = (
        store(members.select("fp").distinct(), "simhash-long")
        .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(64))))
        .withColumn("j", F.explode(F.sequence(F.col("i"), F.lit(64))))
        .filter("i < j or i = 64")
        .select("fp", F.col("fp").bitwiseXOR(flip("i")).bitwiseXOR(flip("j")).alias("place"))
    )
    first = places.groupBy("place").agg(F.min("fp").alias("first"), F.count("*").alias("n"))
    return (
        places.join(first.filter("n > 1"), "place")
        .filter("fp <> first")
        .select(F.col("first").alias("a"), F.col("fp").alias("b"))
        .distinct()
    )


def links(fps: DataFrame, list_limit: int = LIST_LIMIT) -> DataFrame:
    """(a, b) that connect exactly the fingerprints which links of at most 4 bits connect."""
    members = store(shared_lists(postings(fps)), "simhash-lists")
    pairs = verified_pairs(members.filter(F.col("n") <= list_limit).drop("n"))
    long_lists = members.filter(F.col("n") > list_limit)
    if long_lists.isEmpty():
        return pairs
    return pairs.unionAll(ties_of_long_lists(long_lists))


def group(docs: DataFrame, list_limit: int = LIST_LIMIT) -> DataFrame:
    """``doc_id``, ``text_hash``, ``fp``, ``root`` and ``component_id`` of every document.

    ``root`` is a fingerprint that identifies the component; ``component_id`` is only its smallest
    id, which other components may have as well.

    NULL and empty texts share fingerprint 0 and are linked like any other. NULL ids are grouped but
    name no component unless there is no other id in it. Repeated rows come out repeatedly. Only
    ``doc_id`` and ``text`` are read. An empty table gives an empty result.
    """
    marked = store(fingerprints(docs), "simhash")
    distinct = store(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-fps")
    roots = components(links(distinct.select("fp"), list_limit))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = store(rooted.join(named, "root").select("fp", "root", "component_id"), "simhash-components")
    return marked.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def report(docs: DataFrame) -> DataFrame:
    """``group`` with the fingerprint as 16 hex digits."""
    return group(docs).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def removed_keys(groups: DataFrame) -> tuple[DataFrame, bool]:
    """(doc_id, text_hash) of what goes, and whether something that stays is there repeatedly."""
    keys = store(
        groups.groupBy("doc_id", "text_hash").agg(
            F.count("*").alias("n"),
            F.min("root").alias("root"),
            F.min("component_id").alias("component_id"),
        ),
        "simhash-keys",
    )
    own = F.col("doc_id").eqNullSafe(F.col("component_id"))
    # Per root: one id may name several components, and NULL any number of them.
    stays = (
        keys.filter(own).groupBy("root").agg(F.min(F.struct("text_hash", "doc_id", "n")).alias("stays"))
    )
    stays = store(stays.select("stays.*"), "simhash-stays")
    staying = stays.select(F.col("doc_id").alias("stays_id"), F.col("text_hash").alias("stays_hash"))
    gone = keys.join(
        staying,
        keys["doc_id"].eqNullSafe(F.col("stays_id")) & (keys["text_hash"] == F.col("stays_hash")),
        "left_anti",
    ).select("doc_id", "text_hash")
    return store(gone, "simhash-removed"), not stays.filter("n > 1").isEmpty()


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents without near-duplicates: of each group the smallest id stays, in one row."""
    return keep_one(docs, group(docs))


def keep_one(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """One row of each group: ``groups`` has ``doc_id``, ``text_hash``, ``root``, ``component_id``.

    Of several texts with the smallest id in the group the one of the smallest hash stays. Columns
    may have any names besides. What goes is less than what stays: up to ``BROADCAST_KEYS`` keys it
    is sent to the texts, beyond that both are shuffled; the result is the same.
    """
    gone, repeated = removed_keys(groups)
    key = free_name("text_hash", docs.columns)
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("text_hash").alias("gone_hash"))
    if gone.count() <= BROADCAST_KEYS:
        gone = F.broadcast(gone)
    keyed = docs.withColumn(key, F.xxhash64("text"))
    kept = keyed.join(
        gone,
        keyed["doc_id"].eqNullSafe(F.col("gone_id")) & (keyed[key] == F.col("gone_hash")),
        "left_anti",
    )
    # Rows that repeat each other are rare, and only they need the texts to be shuffled.
    if repeated:
        kept = kept.dropDuplicates(["doc_id", key])
    return kept.drop(key)
