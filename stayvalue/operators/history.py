"""Deliveries against what was delivered before: which of their reviews are new.

A history is mostly far larger than a delivery. A Bloom filter of the delivery's keys, a bitmap put
together by a bitwise aggregate, reaches the scan of the history as a scalar; only history rows that may
be in the delivery are shuffled, to an exact anti-join.

For a delivery that is not far smaller, or that fills the bitmap, the filter would let most rows by. Then
both are grouped by the keys: one shuffle of each, no sort, no second pass over the delivery.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayvalue.operators.cleaning import REVIEW_KEY
from stayvalue.operators.stays import estimated_size

#: Bits of the filter (a megabyte) and hash functions. About 800,000 keys let 1 % of the other rows by;
#: more keys let by more, and change nothing in the result.
FILTER_BITS = 1 << 23
MAX_FILTER_BITS = 1 << 27
HASHES = 5
WORD = 64  # 2^6
#: By the sizes that are known before the work: the history has to be so many times larger for the filter
#: to be made, and a key of the delivery takes so many bytes at least.
FAR_LARGER = 8
KEY_BYTES = 8


def _places(keys: Sequence[str], bits: int) -> list[Column]:
    """Positions of a row's keys in the bitmap; NULL keys have positions as well."""
    named = [F.col(k) for k in keys]
    return [F.pmod(F.xxhash64(F.lit(i), *named), F.lit(bits)) for i in range(HASHES)]


def key_bitmap(delivery: DataFrame, keys: Sequence[str] = REVIEW_KEY, bits: int = FILTER_BITS) -> DataFrame:
    """One row with ``words``: the bitmap of the keys as an array of 64-bit words.

    Map tasks combine, so no more than ``bits / 64`` rows of each are shuffled.
    """
    if bits % WORD or not 0 < bits <= MAX_FILTER_BITS:
        raise ValueError(f"a filter has a multiple of {WORD} bits, at most {MAX_FILTER_BITS}")
    set_bits = (
        delivery.select(F.explode(F.array(*_places(keys, bits))).alias("place"))
        .groupBy(F.shiftright("place", 6).cast("int").alias("word"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(place % {WORD} as int))")).alias("held"))
    )
    words = delivery.sparkSession.range(bits // WORD).select(F.col("id").cast("int").alias("word"))
    filled = words.join(set_bits, "word", "left").select(
        F.struct("word", F.coalesce("held", F.lit(0).cast("long")).alias("held")).alias("w")
    )
    return filled.agg(F.transform(F.array_sort(F.collect_list("w")), lambda w: w["held"]).alias("words"))


def maybe_among(words: Column, keys: Sequence[str] = REVIEW_KEY, bits: int = FILTER_BITS) -> Column:
    """Whether a row's keys may be among those of a bitmap: never False for one that is."""
    found = F.lit(True)
    for place in _places(keys, bits):
        held = F.get(words, F.shiftright(place, 6).cast("int"))
        found = found & (F.getbit(held, (place % WORD).cast("int")) == 1)
    return found


def filter_pays(delivery: DataFrame, history: DataFrame, bits: int = FILTER_BITS) -> bool:
    """Whether a filter of the delivery's keys is likely to spare most of the history the shuffle.

    Only how the work is done depends on it, so estimates do; without one the filter is made.
    """
    new, old = estimated_size(delivery), estimated_size(history)
    if new is None or old is None:
        return True
    return new * FAR_LARGER <= old and new // KEY_BYTES * HASHES <= 2 * bits


def _grouped(delivery: DataFrame, history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that only the delivery has; map tasks combine the copies of a key."""
    key = F.struct(*keys).alias("key")
    both = delivery.select(key, F.lit(False).alias("old")).unionAll(
        history.select(key, F.lit(True).alias("old"))
    )
    found = both.groupBy("key").agg(F.bool_or("old").alias("old"))
    return found.filter(~F.col("old")).select("key.*")


def new_only(
    delivery: DataFrame,
    history: DataFrame,
    keys: Sequence[str] = REVIEW_KEY,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """One row for each key of the delivery that the history does not have; NULLs are equal.

    Exact: the filter only spares history rows the shuffle.
    """
    held, known = delivery.select(*keys), history.select(*keys)
    plain = delivery.columns == held.columns and [t for _, t in held.dtypes] == [t for _, t in known.dtypes]
    if plain and not filter_pays(held, known, bits):
        return _grouped(held, known, keys)
    unique = delivery.dropDuplicates(list(keys))
    words = key_bitmap(held, keys, bits).scalar()
    known = known.filter(maybe_among(words, keys, bits))
    new, old = unique.alias("d"), known.alias("h")
    return new.join(old, [F.col(f"d.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys], "left_anti")
