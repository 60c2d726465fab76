"""Connected components of a distributed graph, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayvalue.llm.shared import store


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that is not itself the smallest of its component.

    ``edges`` has two columns of one type. Each round ties the larger neighbours of every node to
    its smallest one (large star), then the smaller neighbours likewise (small star), and stores the
    result; after about log(n) rounds nothing changes. The minima combine before the shuffle, so a
    node with very many neighbours is no hot group; its edges are joined, not gathered.
    """
    a, b = (F.col(f"`{c}`") for c in edges.columns)
    current = store(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter("u <> v")
        .distinct(),
        "edges",
    )
    mark = _mark(current)
    while True:
        both = current.select(F.col("u").alias("x"), F.col("v").alias("y")).unionAll(
            current.select(F.col("v").alias("x"), F.col("u").alias("y"))
        )
        least = both.groupBy("x").agg(F.min("y").alias("m"))
        large = (
            both.filter("y > x")
            .join(least, "x")
            .select(F.col("y").alias("u"), F.least("x", "m").alias("v"))
            .distinct()
        )
        large = store(large, "large-star")
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(smallest, "u")
            .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), "m")
            .distinct()
        )
        current = store(small.withColumnRenamed("m", "v"), "small-star")
        before, mark = mark, _mark(current)
        if mark == before:
            return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge table."""
    return tuple(
        edges.agg(
            F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
    )
