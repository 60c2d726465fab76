"""Whitening of embeddings with Spark MLlib's block matrices.

The entries become integers, their sums per dimension are exact, and every row is centred before
anything is multiplied. The centred rows are numbered without gaps and dealt into the blocks of a
``BlockMatrix``; its transpose times itself is the scatter matrix, of which only dimension x
dimension numbers reach the driver. There the eigenvectors are found, and the block matrix times the
whitening matrix projects all rows.

The inner dimension of the scatter product is split, so that it is summed by many tasks and not by
the one that holds the result. A block matrix lists its blocks on the driver and numbers its rows
with 32 bits; more rows than ``MATRIX_BLOCKS`` blocks hold are therefore taken as several matrices,
whose scatters add up.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayvalue.llm.shared import store

STEPS = 64
SHIFT = 1_000_000
COMPONENTS = 32
#: Entries at least this large cannot be counted in steps with 64 bits to spare.
LARGEST = float(1 << 40)
#: Vectors of more dimensions are refused: their scatter matrix would not fit the driver.
MAX_DIMENSION = 8192
#: Bytes of a block, about; columns of a block at most; blocks of a matrix.
BLOCK_BYTES = 4 << 20
BLOCK_COLUMNS = 1024
MATRIX_BLOCKS = 1 << 14
#: Blocks, at least, over which the rows are spread as long as blocks stay above 256 rows.
SPREAD_BLOCKS = 64
#: Blocks of one inner stretch of the scatter product.
STRETCH = 8
#: Eigenvalues not above this part of the largest count as zero.
RANK_TOLERANCE = 1e-11


def usable(vector: Column) -> Column:
    """Not NULL, not empty, every entry there, finite and below ``LARGEST``."""
    fine = F.forall(
        vector,
        lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(LARGEST), F.lit(False))
        & ~F.isnan(c.cast("double")),
    )
    return F.coalesce((F.size(vector) > 0) & fine, F.lit(False))


def in_steps(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``x`` (array<long>) and ``place`` of the usable rows of the commonest length."""
    rows = vectors.select("vec_id", F.col("vec")).filter(usable(F.col("vec")))
    sizes = rows.groupBy(F.size("vec").alias("size")).count()
    common = sizes.orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    size = common[0]["size"] if common else 0
    if size > MAX_DIMENSION:
        raise ValueError(f"{size} dimensions are more than {MAX_DIMENSION}")
    steps = F.transform(
        "vec", lambda c: F.floor(c.cast("double") * STEPS).cast("long") + F.lit(SHIFT).cast("long")
    )
    return store(
        rows.filter(F.size("vec") == size).select(
            "vec_id", steps.alias("x"), F.monotonically_increasing_id().alias("place")
        ),
        "whiten-steps",
    )


def exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """The number of rows and the sum of each dimension."""
    sums = (
        rows.select(F.posexplode("x"))
        .groupBy("pos")
        .agg(F.count("*").alias("n"), F.sum(F.col("col").cast("decimal(20,0)")).alias("s"))
        .collect()
    )  # one row per dimension
    by_place = {row["pos"]: int(row["s"]) for row in sums}
    return (sums[0]["n"] if sums else 0), [by_place[i] for i in range(len(by_place))]


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``index`` from 0 without gaps, from their places in the written files."""
    part = F.shiftright("place", 33)
    counts = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    # One row per write task.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    inner = F.col("place").bitwiseAND((1 << 33) - 1)
    return (
        rows.withColumn("part", part)
        .join(offsets, "part")
        .select("vec_id", "x", (F.col("offset") + inner).alias("index"))
    )


def centred(rows: DataFrame, n: int, sums: list[int]) -> DataFrame:
    """``index``, ``vec_id``, ``y`` (x minus its mean) and ``deviation`` (long).

    The deviation, the sum of (n x - S)^2, is exact; it is NULL where 64 bits cannot hold it.
    """
    fields = [rows.schema["vec_id"], T.StructField("deviation", T.LongType())]
    schema = T.StructType(
        [
            T.StructField("index", T.LongType()),
            *fields,
            T.StructField("y", T.ArrayType(T.DoubleType())),
        ]
    )

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(sums))
            # As 64-bit integers if those suffice, else as Python's own.
            top = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
            if top < 1 << 62:
                off = x * n - np.array(sums, dtype=np.int64)
            else:
                off = x.astype(object) * n - np.array(sums, dtype=object)
            widest = int(np.abs(off).max(initial=0))
            if len(sums) * widest**2 < 1 << 62:
                deviation = (off**2).sum(axis=1).tolist()
            else:
                exact = [sum(int(v) ** 2 for v in row) for row in off]
                deviation = [v if v < 1 << 63 else None for v in exact]
            y = (off / n).astype(np.float64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(deviation, pa.int64()),
                    pa.ListArray.from_arrays(
                        np.arange(0, y.size + 1, len(sums), dtype=np.int32), y.ravel()
                    ),
                ],
                names=schema.names,
            )

    return store(rows.select("index", "vec_id", "x").mapInArrow(task, schema), "whiten-centred")


def block_matrices(rows: DataFrame, n: int, dimension: int) -> list[BlockMatrix]:
    """The centred rows as block matrices of a bounded number of blocks each."""
    columns = min(dimension, BLOCK_COLUMNS)
    per_block = max(1, BLOCK_BYTES // (8 * columns))
    per_block = min(per_block, max(256, -(-n // SPREAD_BLOCKS)))
    per_matrix = per_block * MATRIX_BLOCKS
    matrices = []
    for begin in range(0, n, per_matrix):
        held = min(per_matrix, n - begin)
        inside = (F.col("index") >= begin) & (F.col("index") < begin + held)
        vectors = rows.filter(inside).select(
            (F.col("index") - begin).alias("index"), array_to_vector("y").alias("y")
        )
        indexed = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "y"), held, dimension)
        matrices.append(indexed.toBlockMatrix(per_block, columns))
    return matrices


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """The transpose times the matrix, summed over stretches of its rows by many tasks."""
    stretches = max(1, -(-matrix.numRows() // (matrix.rowsPerBlock * STRETCH)))
    turned = matrix.transpose()
    # The Python method lacks the number of inner stretches that the same method in the JVM takes.
    product = turned._java_matrix_wrapper.call(
        "multiply", matrix._java_matrix_wrapper._java_model, stretches
    )
    return BlockMatrix(product, turned.rowsPerBlock, matrix.colsPerBlock).toLocalMatrix().toArray()


def whitening_matrix(
    covariance: np.ndarray, components: int
) -> tuple[np.ndarray, list[float]]:
    """Columns are eigenvectors over the roots of their eigenvalues; with the shares explained.

    The eigenvector's largest entry is positive. Directions without spread are left out.
    """
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(values)[::-1][:components]
    order = order[values[order] > RANK_TOLERANCE * max(values.max(initial=0.0), 0.0)]
    values, vectors = values[order], vectors[:, order]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[largest, np.arange(len(values))])
    trace = float(np.trace(covariance))
    return vectors / np.sqrt(values), [float(v) / trace for v in values]


def projected(matrix: BlockMatrix, whitening: np.ndarray) -> DataFrame:
    """``index`` and ``z`` of every row of the matrix times the whitening matrix."""
    k = whitening.shape[1]
    blocks = [
        ((i, 0), DenseMatrix(len(part), k, part.ravel(order="F")))
        for i, part in enumerate(
            whitening[at : at + matrix.colsPerBlock]
            for at in range(0, len(whitening), matrix.colsPerBlock)
        )
    ]
    right = BlockMatrix(
        SparkContext.getOrCreate().parallelize(blocks, len(blocks)), matrix.colsPerBlock, k, *whitening.shape
    )
    rows = matrix.multiply(right).toIndexedRowMatrix()
    # As a frame, its rows need not pass through Python.
    frame = callMLlibFunc("getIndexedRows", rows._java_matrix_wrapper._java_model)
    return frame.select("index", vector_to_array("vector").alias("z"))


def identity_error(rows: DataFrame, n: int, k: int) -> float:
    """Largest entry, by size, of the covariance of ``z`` minus the identity."""
    sums = rows.select(F.posexplode("z")).groupBy("pos").agg(F.sum("col").alias("s")).collect()
    mean = np.zeros(k)
    for row in sums:
        mean[row["pos"]] = row["s"] / n

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            z = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, k) - mean
            total += z.T @ z
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k * k), pa.int32()), pa.array(total.ravel(), pa.float64())],
            names=["cell", "s"],
        )

    cells = rows.select("z").mapInArrow(task, "cell int, s double").groupBy("cell").agg(F.sum("s").alias("s"))
    covariance = np.zeros(k * k)
    for row in cells.collect():  # k times k numbers
        covariance[row["cell"]] = row["s"] / n
    return float(np.abs(covariance.reshape(k, k) - np.eye(k)).max())


def whitened_rows(vectors: DataFrame, *, components: int = COMPONENTS) -> tuple[DataFrame, dict]:
    """(``vec_id``, ``deviation``, ``z``) of every usable row, and the model's figures.

    The figures are ``n``, ``sums``, ``whitening`` (dimension x components), ``explained`` (a share
    per component) and ``identity_error``. See :func:`whiten` for what becomes of odd rows.
    """
    steps = in_steps(vectors)
    n, sums = exact_sums(steps)
    none = {"n": n, "sums": sums, "whitening": np.zeros((len(sums), 0)), "explained": [], "identity_error": 0.0}
    empty = steps.select(
        "vec_id", F.lit(None).cast("long").alias("deviation"), F.array().cast("array<double>").alias("z")
    ).limit(0)
    if not n:
        return empty, none
    rows = centred(numbered(steps), n, sums)
    matrices = block_matrices(rows, n, len(sums))
    whitening, explained = whitening_matrix(
        np.sum([scatter(matrix) for matrix in matrices], axis=0) / n, components
    )
    k = whitening.shape[1]
    if not k:
        return empty, none
    found = None
    begin = 0
    for matrix in matrices:
        part = projected(matrix, whitening).withColumn("index", F.col("index") + begin)
        begin += matrix.numRows()
        found = part if found is None else found.unionAll(part)
    rows = store(
        rows.select("index", "vec_id", "deviation").join(found, "index").drop("index"), "whiten-rows"
    )
    return rows, {
        "n": n,
        "sums": sums,
        "whitening": whitening,
        "explained": explained,
        "identity_error": identity_error(rows, n, k),
    }


def whiten(vectors: DataFrame, *, components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every usable row.

    ``vectors`` has ``vec_id`` and ``vec`` (an array of a number type); other columns are not read.
    Vectors that are NULL or empty, hold NULL, NaN, an infinity or an entry of 2^40 or more, or are not
    of the commonest length (of equally common ones the longest) take no part and get no rows. Zero
    vectors, repeated rows and NULL ids take part, each. Directions in which the vectors do not spread
    have no component, so a table of equal vectors, like an empty one, gives an empty result. A
    deviation beyond 64 bits is NULL.
    """
    rows, model = whitened_rows(vectors, components=components)
    explained = F.array(*(F.lit(share) for share in model["explained"])).cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("z").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model["n"]).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(model["identity_error"]).alias("identity_error"),
    )
