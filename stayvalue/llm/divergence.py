"""How far the sources of a language are apart: term shares compared pair by pair.

Terms are counted per (language, source) in the tasks that read the texts; what is shuffled are
counts. The terms that stand in enough documents of their language are kept and numbered, and each
source's counts become arrays sorted by term number, one array for each block of terms.

A pair task gets the arrays of two sources for one block and merges them sparsely: the shorter array
gallops through the longer one, matching terms are priced with both counts, terms of one side with
the other side's share of an absent term, both ways. Terms absent from both are not looked at: their
number, times the distance of the two absent shares, is added when the blocks' sums are put together.
So a pair costs what its sources hold, not the vocabulary, and no task holds more than two blocks.

All shares are integers, p = 1 + floor(10^9 (count + 5) / (N + 5 V)), and exact at any size.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayvalue.llm.shared import store

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
MIN_DOCUMENTS = 30
UNIT = 1_000_000_000
PSEUDO = 5
TOP_TERMS = 50
#: Terms in a block, about; bounds what a pair task holds.
BLOCK_TERMS = 1 << 15
#: Counts a task gathers before it passes them on; only memory depends on it.
GATHERED = 1 << 19
#: Terms of the shorter array that gallop together.
STRIDE = 512

COUNT_SCHEMA = "lang string, source string, term string, count long, docs long"
PAIR_SCHEMA = "lang string, a string, b string, distance long, seen long"


def _count_task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts per (language, source, term); a row without a term for each group met."""
    # group -> term -> [occurrences, documents]
    groups: dict[tuple[str, str], dict[str, list[int]]] = {}
    held = 0

    def flush() -> pa.RecordBatch:
        rows: tuple[list, ...] = ([], [], [], [], [])
        for (lang, source), terms in groups.items():
            for column, values in zip(
                rows,
                (
                    [lang] * (len(terms) + 1),
                    [source] * (len(terms) + 1),
                    [None, *terms],
                    [0, *(n for n, _ in terms.values())],
                    [0, *(n for _, n in terms.values())],
                ),
                strict=True,
            ):
                column.extend(values)
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)],
            names=["lang", "source", "term", "count", "docs"],
        )

    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            terms = groups.setdefault((lang, source), {})
            # Bytes are lower-cased in A-Z alone.
            here = Counter(TERM.findall(text.encode().lower().decode()))
            for term, n in here.items():
                entry = terms.get(term)
                if entry is None:
                    terms[term] = [n, 1]
                    held += 1
                else:
                    entry[0] += n
                    entry[1] += 1
            if held > GATHERED:
                yield flush()
                groups.clear()
                held = 0
    yield flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, count, docs``, and a row with a NULL term for every group."""
    texts = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    return (
        texts.mapInArrow(_count_task, COUNT_SCHEMA)
        .groupBy("lang", "source", "term")
        .agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    )


def share(count: str, total: str, terms: str) -> Column:
    """1 + floor(UNIT * (count + PSEUDO) / (total + PSEUDO * terms)) of columns, in exact decimals."""
    top = f"cast({count} + {PSEUDO} as decimal(20,0)) * {UNIT}BD"
    return F.expr(f"1L + ({top}) div cast({total} + {PSEUDO} * {terms} as decimal(20,0))")


def shares(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """``share`` of an array: long division by thousands, so that no product leaves 64 bits."""
    below = total + PSEUDO * terms
    if below >= 1 << 53:
        found = [1 + UNIT * (int(c) + PSEUDO) // below for c in counts]
        return np.array(found, dtype=np.int64)
    quotient, rest = np.divmod(counts.astype(np.int64) + PSEUDO, below)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, below)
        quotient = quotient * 1000 + digits
    return quotient + 1


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in two sorted arrays without repeats where the same numbers stand.

    A stride of the shorter array is taken at a time. From where the last stride ended, doubling
    steps find a stretch of the longer array that reaches beyond the stride's last number, and only
    this stretch is searched.
    """
    here: list[np.ndarray] = []
    there: list[np.ndarray] = []
    at = 0
    for begin in range(0, len(short), STRIDE):
        wanted = short[begin : begin + STRIDE]
        step = STRIDE
        while at + step < len(long) and long[at + step] < wanted[-1]:
            step *= 2
        stretch = long[at : at + step + 1]
        places = np.searchsorted(stretch, wanted)
        inside = np.flatnonzero(places < len(stretch))
        inside = inside[stretch[places[inside]] == wanted[inside]]
        here.append(begin + inside)
        there.append(at + places[inside])
        at += int(places[-1])
    if not here:
        none = np.zeros(0, dtype=np.int64)
        return none, none
    return np.concatenate(here), np.concatenate(there)


def price(
    left: tuple[np.ndarray, np.ndarray, int], right: tuple[np.ndarray, np.ndarray, int], terms: int
) -> tuple[int, int]:
    """(distance, number) over the terms that either of two sources holds.

    A source is (sorted term numbers, counts, sum of all its counts).
    """
    (ids_a, counts_a, total_a), (ids_b, counts_b, total_b) = left, right
    if len(ids_a) <= len(ids_b):
        in_a, in_b = gallop(ids_a, ids_b)
    else:
        in_b, in_a = gallop(ids_b, ids_a)
    share_a, share_b = shares(counts_a, total_a, terms), shares(counts_b, total_b, terms)
    nothing = np.zeros(1, dtype=np.int64)
    absent_a = int(shares(nothing, total_a, terms)[0])
    absent_b = int(shares(nothing, total_b, terms)[0])
    only_a = np.ones(len(ids_a), dtype=bool)
    only_b = np.ones(len(ids_b), dtype=bool)
    only_a[in_a] = False
    only_b[in_b] = False
    distance = int(np.abs(share_a[in_a] - share_b[in_b]).sum())
    distance += int(np.abs(share_a[only_a] - absent_b).sum())
    distance += int(np.abs(share_b[only_b] - absent_a).sum())
    return distance, len(ids_a) + len(ids_b) - len(in_a)


def _pair_task(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    lang, a, b = (part.as_py() for part in key[:3])

    def side(table: pa.Table, other: pa.Table, own: str, others: str) -> tuple:
        if not table.num_rows:
            none = np.zeros(0, dtype=np.int64)
            return none, none, other[others][0].as_py()
        entries = table["entries"].combine_chunks().flatten()
        ids, counts = (entries.field(name).to_numpy(zero_copy_only=False) for name in ("id", "count"))
        return ids, counts, table[own][0].as_py()

    some = left if left.num_rows else right
    distance, seen = price(
        side(left, right, "own_total", "other_total"),
        side(right, left, "own_total", "other_total"),
        some["terms"][0].as_py(),
    )
    return pa.table(
        {
            "lang": pa.array([lang], pa.string()),
            "a": pa.array([a], pa.string()),
            "b": pa.array([b], pa.string()),
            "distance": pa.array([distance], pa.int64()),
            "seen": pa.array([seen], pa.int64()),
        }
    )


def pair_distances(entries: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, distance``: one row per unordered pair of sources of a language, a < b.

    ``entries`` has the kept terms of every source (lang, source, block, id, count), ``groups`` every
    (lang, source) with its ``total`` and the language's ``terms``.
    """
    arrays = entries.groupBy("lang", "source", "block").agg(
        F.array_sort(F.collect_list(F.struct("id", "count"))).alias("entries")
    )
    arrays = store(
        arrays.join(groups.withColumnRenamed("total", "own_total"), ["lang", "source"]),
        "divergence-arrays",
    )
    partners = groups.select(
        "lang", F.col("source").alias("partner"), F.col("total").alias("other_total")
    )
    met = arrays.join(partners, "lang")
    key = ["lang", "a", "b", "block"]

    def sides(own: str, other: str) -> DataFrame:
        # Aliased, so that the two sides are told apart although they come from one table.
        carried = ("lang", "block", "entries", "own_total", "other_total", "terms")
        return met.select(
            F.col("source").alias(own), F.col("partner").alias(other), *(F.col(c).alias(c) for c in carried)
        ).filter("a < b")

    held = (
        sides("a", "b")
        .groupBy(*key)
        .cogroup(sides("b", "a").groupBy(*key))
        .applyInArrow(_pair_task, PAIR_SCHEMA)
        .groupBy("lang", "a", "b")
        .agg(F.sum("distance").alias("distance"), F.sum("seen").alias("seen"))
    )
    one = groups.select("lang", F.col("source").alias("a"), F.col("total").alias("total_a"), "terms")
    two = groups.select("lang", F.col("source").alias("b"), F.col("total").alias("total_b"))
    nothing = F.lit(0).cast("long")
    apart = F.abs(share("0L", "total_a", "terms") - share("0L", "total_b", "terms"))
    unseen = (F.col("terms") - F.coalesce("seen", nothing)) * apart
    distance = F.when(F.col("terms") == 0, nothing).otherwise(F.coalesce("distance", nothing) + unseen)
    return (
        one.join(two, "lang")
        .filter("a < b")
        .join(held, ["lang", "a", "b"], "left")
        .select("lang", "a", "b", distance.alias("distance"))
    )


def audit(
    docs: DataFrame,
    *,
    min_documents: int = MIN_DOCUMENTS,
    top_terms: int = TOP_TERMS,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how each source of a language differs.

    Part ``pair``: each other source of the language with the summed distance of all kept terms'
    shares. Part ``term``: the terms the source has more of than its language, the first
    ``top_terms``. NULL text, lang and source count as empty; an empty name is a name like any other.
    A language without kept terms has pairs of value 0 and no terms. Repeated rows count each. Only
    those three columns are read, so other columns may have any names. An empty table gives an empty
    result.
    """
    counts = store(term_counts(docs), "divergence-counts")
    found = counts.filter("term is not null")
    kept = (
        found.groupBy("lang", "term")
        .agg(F.sum("docs").alias("docs"), F.sum("count").alias("lang_count"))
        .filter(F.col("docs") >= min_documents)
        .select("lang", "term", "lang_count", F.monotonically_increasing_id().alias("id"))
    )
    kept = store(kept, "divergence-terms")  # the numbers are fixed by being written
    sizes = kept.groupBy("lang").agg(
        F.count("*").alias("terms"), F.sum("lang_count").alias("lang_total")
    )
    blocks = F.ceil(F.col("terms") / block_terms).cast("long")
    entries = store(
        found.select("lang", "source", "term", "count")
        .join(kept, ["lang", "term"])
        .join(sizes, "lang")
        .withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")),
        "divergence-entries",
    )
    totals = entries.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    groups = store(
        counts.filter("term is null")
        .select("lang", "source")
        .join(totals, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .select(
            "lang",
            "source",
            F.coalesce("total", F.lit(0).cast("long")).alias("total"),
            F.coalesce("terms", F.lit(0).cast("long")).alias("terms"),
        ),
        "divergence-groups",
    )
    pairs = store(pair_distances(entries.select("lang", "source", "block", "id", "count"), groups), "divergence-pairs")
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "distance").unionAll(
        pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "distance")
    )
    in_order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(in_order)).select(
            "lang", "source", F.lit(part).alias("part"), "item", "value", "rank"
        )

    own = share("count", "total", "terms")
    whole = share("lang_count", "lang_total", "terms")
    more = (
        entries.join(groups.select("lang", "source", "total"), ["lang", "source"])
        .select("lang", "source", F.col("term").alias("item"), (own - whole).alias("value"))
        .filter("value > 0")
    )
    # The planner keeps the first rows of each group before it shuffles them.
    return ranked(both.withColumnRenamed("distance", "value"), "pair").unionAll(
        ranked(more, "term").filter(F.col("rank") <= top_terms)
    )


def oracle_sql() -> str:
    """The same rows as SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

    def p(count: str, total: str) -> str:
        return f"1 + ({UNIT}::HUGEINT * ({count} + {PSEUDO})) // ({total} + {PSEUDO} * terms)"

    return rf"""
with docs as (
    select row_number() over () as row_no, coalesce(lang, '') as lang, coalesce(source, '') as source,
        regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as found
    from documents),
words as (select row_no, lang, source, unnest(found) as term from docs),
kept as (
    select lang, term, count(*) as lang_count from words
    group by lang, term having count(distinct row_no) >= {MIN_DOCUMENTS}),
sizes as (select lang, count(*) as terms, sum(lang_count) as lang_total from kept group by lang),
groups as (select distinct lang, source from docs),
counts as (select lang, source, term, count(*) as n from words group by all),
dense as (
    select g.lang, g.source, k.term, k.lang_count, coalesce(c.n, 0) as n,
        sum(coalesce(c.n, 0)) over (partition by g.lang, g.source) as total
    from groups g join kept k on k.lang = g.lang
    left join counts c on c.lang = g.lang and c.source = g.source and c.term = k.term),
priced as (
    select lang, source, term, n, {p('n', 'total')} as p, {p('lang_count', 'lang_total')} as q
    from dense join sizes using (lang)),
apart as (
    select a.lang, a.source, b.source as item, sum(abs(a.p - b.p)) as value
    from priced a join priced b on a.lang = b.lang and a.term = b.term and a.source <> b.source
    group by all),
pairs as (
    select a.lang, a.source, b.source as item, coalesce(value, 0) as value
    from groups a join groups b on a.lang = b.lang and a.source <> b.source
    left join apart x on x.lang = a.lang and x.source = a.source and x.item = b.source),
listed as (
    select lang, source, 'pair' as part, item, value from pairs
    union all
    select lang, source, 'term', term, p - q from priced where n > 0 and p > q),
ranked as (
    select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
    from listed)
select lang, source, part, item, value::BIGINT as value, rank::INTEGER as rank
from ranked where part = 'pair' or rank <= {TOP_TERMS}
"""
