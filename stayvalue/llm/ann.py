"""Nearest neighbours by a block matrix join on int8 tiles with error bounds.

Queries and candidates are dealt into blocks of a bounded number of vectors. A tile is one query
block against one candidate block. In it all vectors are quantised to int8 with a scale each; the
integer products give approximate distances, and the two quantisation errors bound how far the true
distance can be off (triangle inequality). A pair survives if its lower bound does not exceed the
k-th smallest upper bound of its query in the tile. Only survivors are computed in double
precision; each tile passes on the k best of each query, and heaps merge the tiles' lists.

Since the bounds are proven, the result is exact: recall is 1 up to ties in the last bit.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayvalue.llm.shared import store

K = 10
QUERY_STEP = 100
#: Vectors in a block, about.
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 4096
#: Lists of this many tiles are merged at a time, so that no task gathers all lists of a query.
MERGE_TILES = 64
#: Relative allowance for the rounding of the bounds themselves.
SLACK = 1e-9

TILE_SCHEMA = "query_id long, tile int, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Not NULL, not empty, all components finite, and not the zero vector."""
    finite = F.forall(
        vector,
        lambda x: x.isNotNull()
        & ~F.isnan(x)
        & (F.abs(x.cast("double")) < F.lit(float("inf"))),
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def quantise(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale and error norm of each row."""
    scale = np.abs(vectors).max(axis=1) / 127.0
    scale[scale == 0] = 1.0
    codes = np.rint(vectors / scale[:, None]).astype(np.int8)
    error = np.linalg.norm(vectors - codes * scale[:, None], axis=1)
    return codes, scale, error


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of int8 codes; float32 holds sums below 2^24 exactly."""
    kind = np.float32 if a.shape[1] * 127 * 127 < 1 << 24 else np.float64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.float64)


def tile_bounds(queries: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all distances between two sets of rows."""
    (qa, qs, qe), (ca, cs, ce) = quantise(queries), quantise(candidates)
    q_norm = (qa.astype(np.float64) ** 2).sum(axis=1) * qs**2
    c_norm = (ca.astype(np.float64) ** 2).sum(axis=1) * cs**2
    squared = q_norm[:, None] + c_norm[None, :] - 2 * product(qa, ca) * np.outer(qs, cs)
    # The difference of large squares loses digits; allow for that before the root.
    fuzz = SLACK * (q_norm[:, None] + c_norm[None, :])
    errors = qe[:, None] + ce[None, :]
    low = np.sqrt(np.maximum(0.0, squared - fuzz)) - errors * (1 + SLACK)
    high = np.sqrt(np.maximum(0.0, squared) + fuzz) + errors * (1 + SLACK)
    return low, high


def distance(query: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, the squares added up in order."""
    total = np.zeros(len(candidates))
    for own, theirs in zip(query, candidates.T, strict=True):
        total += (theirs - own) ** 2
    return np.sqrt(total)


def tile(queries: pd.DataFrame, candidates: pd.DataFrame, k: int = K) -> pd.DataFrame:
    """The k nearest candidates of the tile for each query; ties go to the smaller id."""
    rows: list[tuple[int, int, int, float]] = []
    if len(queries) and len(candidates):
        number = int(candidates["tile"].iloc[0])
        q = np.stack(queries["vec"].to_numpy()).astype(np.float64)
        c = np.stack(candidates["vec"].to_numpy()).astype(np.float64)
        q_ids, c_ids = queries["vec_id"].to_numpy(), candidates["vec_id"].to_numpy()
        low, high = tile_bounds(q, c)
        for i, query_id in enumerate(q_ids):
            other = c_ids != query_id
            if not other.any():
                continue
            tops = np.where(other, high[i], np.inf)
            limit = np.partition(tops, min(k, len(tops)) - 1)[min(k, len(tops)) - 1]
            chosen = np.flatnonzero(other & (low[i] <= limit))
            exact = distance(q[i], c[chosen])
            best = heapq.nsmallest(k, zip(exact.tolist(), c_ids[chosen].tolist(), strict=True))
            rows += [(query_id, number, vec_id, score) for score, vec_id in best]
    return pd.DataFrame(rows, columns=["query_id", "tile", "vec_id", "score"])


def merged(lists: DataFrame, keys: Iterable[str], k: int = K) -> DataFrame:
    """The k best of the lists in each group, by a heap."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        best = heapq.nsmallest(
            k, zip(group["score"].tolist(), group["vec_id"].tolist(), strict=True)
        )
        first = group.iloc[0]
        rows = [(first["query_id"], first["tile"], vec_id, score) for score, vec_id in best]
        return pd.DataFrame(rows, columns=["query_id", "tile", "vec_id", "score"])

    return lists.groupBy(*keys).applyInPandas(merge, TILE_SCHEMA)


def nearest(
    vectors: DataFrame,
    *,
    k: int = K,
    query_step: int = QUERY_STEP,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """The k nearest rows of each query: query_id, rank (int), vec_id, score.

    ``vectors`` has ``vec_id`` (long) and ``vec`` (array of a float type). Queries are the rows whose
    id is a multiple of ``query_step``. Rows without an id, and vectors that are NULL, empty, zero or
    not finite, take no part; vectors of another length than the query's are no candidates. A
    repeated row is a candidate each time, but rows with the query's id never are; of several rows
    with one query id the smallest vector asks. With fewer candidates than k all are returned.
    """
    rows = store(
        vectors.filter(F.col("vec_id").isNotNull() & usable(F.col("vec"))).select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.col("vec").cast("array<double>").alias("vec"),
            F.size("vec").alias("dim"),
        ),
        "ann-vectors",
    )
    asked = rows.filter(F.col("vec_id") % query_step == 0)
    asked = store(asked.groupBy("vec_id").agg(F.min(F.struct("dim", "vec")).alias("q")), "ann-queries")
    asked = asked.select("vec_id", "q.vec", "q.dim")
    n_query = max(1, -(-asked.count() // query_block))
    n_candidate = max(1, -(-rows.count() // candidate_block))

    def dealt(blocks: int) -> Column:
        # By place in the stored table, so that rows of one id spread too.
        place = F.monotonically_increasing_id()
        return F.pmod(F.xxhash64("vec_id", place), F.lit(blocks)).cast("int")

    # Every query block meets every candidate block: that is the search, tile by tile.
    candidates = rows.withColumn("tile", dealt(n_candidate)).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(n_query - 1)))
    )
    queries = asked.withColumn("block", dealt(n_query)).withColumn(
        "tile", F.explode(F.sequence(F.lit(0), F.lit(n_candidate - 1)))
    )
    key = ["dim", "block", "tile"]
    lists = (
        queries.groupBy(*key)
        .cogroup(candidates.groupBy(*key))
        .applyInPandas(lambda q, c: tile(q, c, k), TILE_SCHEMA)
    )
    wave = lists
    tiles = n_candidate
    while tiles > MERGE_TILES:
        wave = merged(
            wave.withColumn("tile", F.expr(f"cast(floor(tile / {MERGE_TILES}) as int)")),
            ["query_id", "tile"],
            k,
        )
        tiles = -(-tiles // MERGE_TILES)

    def ranked(group: pd.DataFrame) -> pd.DataFrame:
        best = heapq.nsmallest(
            k, zip(group["score"].tolist(), group["vec_id"].tolist(), strict=True)
        )
        query_id = int(group["query_id"].iloc[0])
        rows = [(query_id, i, v, s) for i, (s, v) in enumerate(best, 1)]
        return pd.DataFrame(rows, columns=["query_id", "rank", "vec_id", "score"])

    return wave.groupBy("query_id").applyInPandas(
        ranked, "query_id long, rank int, vec_id long, score double"
    )


def oracle_sql(k: int = K, query_step: int = QUERY_STEP) -> str:
    """The same rows as SQL, for tables without repeated ids and with vectors of one length."""
    return f"""
with good as (
    select vec_id, embedding::DOUBLE[] as v from embeddings
    where vec_id is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
        and len(list_filter(embedding, lambda c: c <> 0)) > 0),
pairs as (
    select q.vec_id as query_id, c.vec_id,
        sqrt(list_reduce(
            list_transform(list_zip(q.v, c.v), lambda z: (z[2] - z[1]) * (z[2] - z[1])),
            lambda a, b: a + b)) as score
    from good q join good c on q.vec_id % {query_step} = 0 and c.vec_id <> q.vec_id),
ranked as (
    select *, row_number() over (partition by query_id order by score, vec_id) as rank from pairs)
select query_id, rank::INTEGER as rank, vec_id, score from ranked where rank <= {k}
"""
