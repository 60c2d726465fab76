"""Variable-capacity best-fit packing of documents into training sequences.

A document longer than the largest permitted length is cut into pieces of that length and a rest.
Pieces are placed longest first, each into the open bin it fills best; when none has room, the bin
size of least cost per token it is likely to hold is opened. At the end every bin is downsized to
the smallest permitted length that holds its contents.

Best fit only ever looks at lengths, so it runs on the *histogram* of piece lengths, which has at
most as many rows as the largest length has values however many documents there are. Bins with the
same room are one entry with a count. The outcome is a list of runs, "pieces of length l with ranks
r..r+n go to bins b..b+n at offset o", and the documents find their run by their rank among the
pieces of equal length. Ranks come from counts per (length, hash shard), so that no task sees all
pieces of a common length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayvalue.llm.shared import free_name, store

#: Permitted sequence lengths, in tokens.
LENGTHS = (512, 1024, 2048, 4096)
#: Cost of a bin: its length plus this many tokens for handling a sequence at all.
BIN_OVERHEAD = 16
#: Pieces of one length and hash shard that a task ranks, about.
SHARD_PIECES = 2_000

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_length", T.IntegerType()),
        T.StructField("first_rank", T.LongType()),
        T.StructField("run_pieces", T.LongType()),
        T.StructField("first_bin", T.LongType()),
        T.StructField("bin_offset", T.IntegerType()),
        T.StructField("bin_length", T.IntegerType()),
    ]
)


def word_count(text: Column) -> Column:
    """Tokens of a text: its words. Give ``tokens=`` a column where real token counts exist."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+")))


@dataclass
class _Bins:
    """Equal open bins: numbers ``first .. first + count``, filled up to ``used`` of ``size``."""

    first: int
    count: int
    size: int
    used: int
    parts: list


def _likely_fill(room: int, lengths: list[int]) -> int:
    """Tokens that shorter pieces would add to this room, the longest that fits each time."""
    filled = 0
    while room > 0 and (at := bisect_left(lengths, room + 1)) > 0:
        filled += lengths[at - 1]
        room -= lengths[at - 1]
    return filled


def _size_to_open(length: int, shorter: list[int], sizes: Sequence[int], overhead: int) -> int:
    """The permitted size with the least cost per token held; the smaller one on a tie."""
    best = None
    for size in sizes:
        if size >= length:
            held = length + _likely_fill(size - length, shorter)
            cost = (size + overhead) / held
            if best is None or cost < best[0]:
                best = (cost, size)
    return best[1]


def plan_runs(
    histogram: Iterable[tuple[int, int]],
    sizes: Sequence[int] = LENGTHS,
    overhead: int = BIN_OVERHEAD,
) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit over (length, count), longest first; rows as in ``RUN_SCHEMA``.

    Equal pieces of one step go to bins of equal room, the tightest room first. Bin numbers count
    up from 0 in the order of opening.
    """
    sizes = sorted(sizes)
    counts = {int(length): int(n) for length, n in histogram if n > 0}
    lengths = sorted(counts)
    rooms: list[int] = []  # sorted distinct rooms of open bins
    open_bins: dict[int, list[_Bins]] = {}
    done: list[_Bins] = []
    next_bin = 0

    def put(bins: _Bins) -> None:
        room = bins.size - bins.used
        if room == 0:
            done.append(bins)
            return
        if room not in open_bins:
            open_bins[room] = []
            insort(rooms, room)
        open_bins[room].append(bins)

    for at in range(len(lengths) - 1, -1, -1):
        length = lengths[at]
        left, rank = counts[length], 0
        while left > 0:
            place = bisect_left(rooms, length)
            if place < len(rooms):
                room = rooms[place]
                bins = open_bins[room].pop()
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(place)
            else:
                size = _size_to_open(length, lengths[: at + 1], sizes, overhead)
                bins = _Bins(next_bin, max(1, left // (size // length)), size, 0, [])
                next_bin += bins.count
            # A bin that took a piece is the tightest one: it goes on until it has no room.
            each = min((bins.size - bins.used) // length, left)
            n = min(left // each, bins.count)
            if n < bins.count:
                put(_Bins(bins.first + n, bins.count - n, bins.size, bins.used, list(bins.parts)))
            parts = [
                (length, rank + i * n, n, bins.used + i * length, bins.first) for i in range(each)
            ]
            put(_Bins(bins.first, n, bins.size, bins.used + each * length, bins.parts + parts))
            left -= n * each
            rank += n * each
    for groups in open_bins.values():
        done.extend(groups)

    runs = []
    for bins in done:
        final = sizes[bisect_left(sizes, bins.used)]
        for length, rank, _, offset, first in bins.parts:
            # A run may have been split since: keep the part that belongs to these bins.
            runs.append(
                (length, rank + bins.first - first, bins.count, bins.first, offset, final)
            )
    return sorted(runs)


def pieces_of(docs: DataFrame, tokens: str, largest: int) -> DataFrame:
    """One row per piece: ``piece`` from 0, ``piece_start`` and ``piece_length`` in tokens."""
    count = F.ceil(F.col(tokens) / F.lit(largest)).cast("int")
    numbers = F.explode(F.sequence(F.lit(0), count - 1))
    return (
        docs.filter(F.col(tokens) > 0)
        .withColumn("piece", numbers)
        .withColumn("piece_start", F.col("piece").cast("long") * largest)
        .withColumn(
            "piece_length",
            F.least(F.lit(largest), F.col(tokens) - F.col("piece_start")).cast("int"),
        )
    )


def pack(
    docs: DataFrame,
    *,
    identity: str = "doc_id",
    tokens: str = "tokens",
    lengths: Sequence[int] = LENGTHS,
    overhead: int = BIN_OVERHEAD,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """Where each piece of each document goes.

    Reads only the id and the token count (NULL or less than 1: nothing to place). Returns the id,
    piece, piece_start (long), piece_length (int), bin_id (long), bin_offset (int) and bin_length
    (int, the bin after downsizing), one row per piece. Pieces of equal length are ranked by shard,
    id and piece; repeated rows take places of their own, in any order. An empty table gives an
    empty result.
    """
    largest = max(lengths)
    # Stored, as the counts are read twice and may cost a pass over the texts.
    slim = store(
        docs.select(
            F.col(identity).alias("id"),
            F.col(tokens).cast("long").alias("tokens"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "pack-tokens",
    )
    pieces = pieces_of(slim, "tokens", largest)
    histogram = {
        row["piece_length"]: row["n"]
        for row in pieces.groupBy("piece_length").agg(F.count("*").alias("n")).collect()
    }  # at most `largest` rows
    spark = docs.sparkSession
    runs = spark.createDataFrame(plan_runs(histogram.items(), lengths, overhead), RUN_SCHEMA)
    split = spark.createDataFrame(
        [(length, -(-n // shard_pieces)) for length, n in histogram.items()],
        "piece_length int, shards long",
    )
    sharded = store(
        pieces.drop("tokens")
        .join(F.broadcast(split), "piece_length")
        # Rows without an id are spread by their place in the stored table.
        .withColumn("spread", F.when(F.col("id").isNull(), F.col("place")))
        .withColumn("shard", F.pmod(F.xxhash64("id", "piece", "spread"), F.col("shards")))
        .drop("shards", "place", "spread"),
        "pieces",
    )
    sizes = sharded.groupBy("piece_length", "shard").agg(F.count("*").alias("n"))
    before = Window.partitionBy("piece_length").orderBy("shard")
    starts = sizes.select(
        "piece_length",
        "shard",
        (F.sum("n").over(before) - F.col("n")).alias("shard_start"),
    )
    in_shard = Window.partitionBy("piece_length", "shard").orderBy("id", "piece")
    ranked = (
        sharded.withColumn("in_shard", F.row_number().over(in_shard))
        .join(starts, ["piece_length", "shard"])
        .withColumn("piece_rank", F.col("shard_start") + F.col("in_shard") - 1)
    )
    # The runs are bounded by the largest length, not by the documents.
    placed = ranked.join(
        F.broadcast(runs),
        (F.col("piece_length") == F.col("run_length"))
        & (F.col("piece_rank") >= F.col("first_rank"))
        & (F.col("piece_rank") < F.col("first_rank") + F.col("run_pieces")),
    )
    return placed.select(
        F.col("id").alias(identity),
        "piece",
        "piece_start",
        "piece_length",
        (F.col("first_bin") + F.col("piece_rank") - F.col("first_rank")).alias("bin_id"),
        "bin_offset",
        "bin_length",
    )


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """``pack`` over raw documents, with words as tokens."""
    name = free_name("tokens", docs.columns)
    return pack(
        docs.select("doc_id", word_count(F.col("text")).alias(name)), tokens=name, **options
    )
