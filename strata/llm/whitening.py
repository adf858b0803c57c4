"""Embedding whitening with MLlib's distributed matrices.

Vectors are quantised to whole numbers (``floor(scale * c) + shift``), so that
sums are exact. The fit list is every distinct quantised vector once. Its
centred rows are indexed and dealt into the blocks of a ``BlockMatrix``;
transpose-multiply gives the scatter matrix, whose eigenvectors (``eigh``, on
the driver: dimension squared numbers) make the whitening matrix; the block
matrix times the whitening matrix projects the rows. A second
transpose-multiply, of the projected rows, measures how far their covariance is
from the identity.

Scale. The distinct step is a partial aggregate, so a vector in a third of all
rows shrinks before the shuffle. Products are summed over slices of the middle
dimension (a few blocks each), never in one task. Rows get their projection by
a plain equi-join on two 64-bit hashes of the quantised vector, which adaptive
execution may split. The driver holds matrices of dimension squared, one number
per partition and the blocks' places: at most about ``MOST_BLOCKS``.

Defined results: rows whose vector is NULL or empty, or holds a NULL, NaN or
infinity, or a number too large for a quantised long, give no row; the
dimension is the commonest length of the others (ties: the longest), rows of
other lengths give none; repeated rows and NULL ids give rows of their own;
extra columns are ignored; an empty table gives an empty result. Components
without variance are left out. ``deviation`` is NULL where it exceeds a long.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

ROWS_PER_BLOCK = 4096
MOST_BLOCKS = 50_000
BLOCKS_PER_SLICE = 8
NO_VARIANCE = 1e-12  # of the largest eigenvalue


def quantised(vectors: DataFrame, vector: str, scale: float, shift: int) -> DataFrame:
    """(vec_id, x, h1, h2): the whole-numbered vectors of the rows that can be used, and two hashes of them."""
    c = F.col(f"`{vector}`").cast("array<double>")
    x = F.transform(c, lambda v: F.floor(F.try_multiply(F.lit(float(scale)), v)))
    # floor of a double is a long: beyond its range a number would be cut off, not moved
    sound = F.forall(c, lambda v: F.coalesce(F.abs(v) <= F.lit((2.0**62) / scale), F.lit(False)))
    rows = vectors.select("vec_id", F.when(sound & (F.size(c) > 0), x).alias("x")).where("x is not null")
    rows = rows.select("vec_id", F.transform("x", lambda v: v + F.lit(shift).cast("bigint")).alias("x"))
    return rows.select("vec_id", "x", F.xxhash64("x").alias("h1"), F.xxhash64(F.lit(1), "x").alias("h2"))


def _indexed(rows: DataFrame) -> DataFrame:
    """Rows of a stored table with ``index``, from 0 without gaps."""
    part = F.spark_partition_id()
    counts = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()  # a number per partition
    offsets, at = {}, 0
    for r in sorted(counts, key=lambda r: r.part):
        offsets[r.part] = at
        at += r.n
    listed = F.array(*[F.lit(offsets.get(i, 0)).cast("bigint") for i in range(max(offsets, default=0) + 1)])
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return rows.withColumn("index", place + F.get(listed, part))


def block_matrix(rows: DataFrame, n: int, dim: int, rows_per_block: int) -> BlockMatrix:
    """Blocks of the rows (index, v: array of doubles)."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector("v").alias("v")), "v")
    indexed = IndexedRowMatrix(callMLlibFunc("createIndexedRowMatrix", vectors, n, dim), n, dim)
    return indexed.toBlockMatrix(rows_per_block, dim)


def _java(matrix: BlockMatrix):
    return matrix._java_matrix_wrapper._java_model


def scatter(x: BlockMatrix, slices: int) -> np.ndarray:
    """XᵀX, the products of the blocks summed over ``slices`` slices of the middle dimension."""
    product = _java(x.transpose()).multiply(_java(x), slices)
    return BlockMatrix(product, x.colsPerBlock, x.colsPerBlock).toLocalMatrix().toArray()


def project(x: BlockMatrix, weights: np.ndarray, sc) -> BlockMatrix:
    """X times a small matrix, itself a block matrix of one block."""
    dim, k = weights.shape
    right = sc.parallelize([((0, 0), Matrices.dense(dim, k, weights.ravel(order="F")))], 1)
    return BlockMatrix(_java(x).multiply(_java(BlockMatrix(right, dim, k))), x.rowsPerBlock, k)


def rows_of(x: BlockMatrix) -> DataFrame:
    """(index, v: array of doubles) of the matrix's rows."""
    rows = callMLlibFunc("getIndexedRows", _java(x).toIndexedRowMatrix())
    return MLUtils.convertVectorColumnsToML(rows, "vector").select("index", vector_to_array("vector").alias("v"))


def _deviation(x: str, n: int, sums: list[int]) -> Column:
    """Sum over the dimensions of (n * x - S) squared, exact; NULL where a step of it exceeds a long."""
    if max(map(abs, sums)) >= 1 << 63:
        return F.lit(None).cast("bigint")
    listed = F.array(*[F.lit(s).cast("bigint") for s in sums])
    away = F.zip_with(x, listed, lambda a, s: F.try_subtract(F.try_multiply(F.lit(n).cast("bigint"), a), s))
    return F.aggregate(away, F.lit(0).cast("bigint"), lambda acc, d: F.try_add(acc, F.try_multiply(d, d)))


def whiten(
    vectors: DataFrame,
    vector: str = "embedding",
    components: int = 16,
    scale: float = 64.0,
    shift: int = 1_000_000,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Per row: vec_id, n, deviation, whitened (array by falling variance), explained (array), identity_error."""
    spark = vectors.sparkSession
    rows = quantised(vectors, vector, scale, shift)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    nothing = spark.createDataFrame(
        [], f"vec_id {kind}, n bigint, deviation bigint, whitened array<double>, explained array<double>, identity_error double"
    )
    distinct = stored(rows.select("h1", "h2", "x").distinct(), "embeddings-fit")
    by_size = distinct.groupBy(F.size("x").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    commonest = by_size.orderBy(F.desc("n"), F.desc("dim")).first()
    if commonest is None:
        return nothing
    dim, n = commonest.dim, commonest.n
    fit = distinct.where(F.size("x") == dim)
    total = fit.agg(*[F.sum(F.get("x", F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}") for i in range(dim)]).first()
    sums = [int(s) for s in total]

    mean = F.array(*[F.lit(s / n) for s in sums])
    centred = F.zip_with("x", mean, lambda a, m: a.cast("double") - m)
    indexed = _indexed(fit)
    size = max(rows_per_block, -(-n // MOST_BLOCKS))
    slices = -(-n // (size * BLOCKS_PER_SLICE))
    x = block_matrix(indexed.select("index", centred.alias("v")), n, dim, size)
    covariance = scatter(x, slices) / n
    values, unit = np.linalg.eigh((covariance + covariance.T) / 2)
    values, unit = values[::-1], unit[:, ::-1]
    kept = int((values[:components] > max(values[0], 0.0) * NO_VARIANCE).sum())
    if not kept:
        return nothing
    weights = unit[:, :kept] / np.sqrt(values[:kept])

    y = project(x, weights, spark.sparkContext)
    error = float(np.abs(scatter(y, slices) / n - np.eye(kept)).max())
    explained = F.array(*[F.lit(float(v)) for v in values[:kept] / np.trace(covariance)])
    facts = indexed.select("index", "h1", "h2", _deviation("x", n, sums).alias("deviation"))
    found = stored(facts.join(rows_of(y), "index").drop("index"), "embeddings-whitened")
    return (
        rows.select("vec_id", "h1", "h2")
        .join(found, ["h1", "h2"])
        .select(
            "vec_id",
            F.lit(n).cast("bigint").alias("n"),
            "deviation",
            F.col("v").alias("whitened"),
            explained.alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
