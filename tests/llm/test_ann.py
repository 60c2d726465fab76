import math
from functools import reduce
from operator import add

import numpy as np
import pytest

from stayvalue.llm import ann

SCHEMA = "vec_id long, vec array<float>"


def plain(rows, k, step):
    usable = [
        (i, np.array(v, dtype=np.float32).astype(float))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = []
    for q in sorted({i for i, _ in usable if i % step == 0}):
        x = min((v.tolist() for i, v in usable if i == q), key=lambda v: (len(v), v))
        near = sorted(
            (math.sqrt(reduce(add, ((a - b) * (a - b) for a, b in zip(v.tolist(), x)))), i)
            for i, v in usable
            if i != q and len(v) == len(x)
        )[:k]
        out += [(q, n, i, d) for n, (d, i) in enumerate(near, 1)]
    return out


def result(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("blocks", [(512, 4096), (3, 20)])
def test_against_brute_force(spark, monkeypatch, blocks):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 12))
    vectors = [(centres[i % 6] + rng.normal(0, 0.05, 12)).tolist() for i in range(400)]
    vectors += [vectors[0]] * 5 + [(np.array(vectors[1]) * 1e6).tolist(), (np.array(vectors[2]) * 1e-6).tolist()]
    rows = list(enumerate(vectors))
    monkeypatch.setattr(ann, "MERGE_TILES", 4)
    df = spark.createDataFrame(rows, SCHEMA)
    found = ann.nearest(df, k=7, query_step=10, query_block=blocks[0], candidate_block=blocks[1])
    assert result(found) == plain(rows, 7, 10)


def test_bounds_hold():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=(30, 64)), rng.normal(size=(50, 64)) * rng.uniform(1e-3, 1e3, (50, 1))
    low, high = ann.tile_bounds(a, b)
    true = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
    assert (low <= true).all() and (true <= high).all()


def test_recall_on_the_table(spark, read):
    table = read("embeddings").withColumnRenamed("embedding", "vec")
    rows = [(r.vec_id, r.vec) for r in table.collect()]
    assert result(ann.nearest(table)) == plain(rows, 10, 100)


def test_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (100, None), (200, []), (300, [0.0, 0.0]),
            (400, [float("nan"), 1.0]), (500, [1.0, None]), (600, [float("inf"), 1.0]), (None, [1.0, 1.0]),
            (7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [3.0, 2.0, 1.0]), (9, [2.0, 2.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(ann.nearest(df)) == [(0, 1, 7, 0.0), (0, 2, 7, 0.0), (0, 3, 9, 1.0)]
    assert ann.nearest(df.limit(0)).collect() == []
