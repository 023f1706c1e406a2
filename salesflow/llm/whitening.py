"""Whitening of embeddings on distributed block matrices.

Vectors are put on a grid of integers, so that sums, means and deviations are exact. Centred rows get
dense indices and become a block matrix; its transpose times itself is the scatter matrix, whose
eigenvectors, over the roots of their eigenvalues, are found locally, as it has one row per dimension.
A second product projects all rows. Statistics are over the distinct vectors: copies don't count twice.
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

from salesflow.llm.common import written

COMPONENTS = 16
SCALE = 64
SHIFT = 1_000_000
BLOCK_ROWS = 1024
BLOCK_COLUMNS = 1024
SPLIT_BYTES = 32 << 20
_WIDEST = float(1 << 53)
_SLOT_BITS = 33  # of a monotonically increasing id: the place within a task


def on_grid(rows: DataFrame, id: str, vector: str, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(id, ``x``): floor(scale * c) + shift of each entry, as long, for vectors without null or non-finite
    entries. Entries beyond 2**53 count as that."""
    c = F.col("v")
    rows = rows.select(F.col(id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(c.isNotNull() & F.forall(c, lambda e: F.coalesce(F.abs(e) < F.lit(float("inf")), F.lit(False)) & ~F.isnan(e)))
    held = lambda e: F.greatest(F.least(e, F.lit(_WIDEST)), F.lit(-_WIDEST))
    return rows.select("id", F.transform("v", lambda e: F.floor(F.lit(float(scale)) * held(e)) + F.lit(shift)).alias("x"))


def _indexed(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows written once, with ``index`` from 0 without gaps. One row per task comes to the driver."""
    rows = written(rows.withColumn("slot", F.monotonically_increasing_id()), purpose)
    part = F.shiftright("slot", _SLOT_BITS)
    starts, before = [], 0
    for p, n in sorted(tuple(r) for r in rows.groupBy(part.alias("part")).count().collect()):
        starts.append((p, before))
        before += n
    starts = rows.sparkSession.createDataFrame(starts, "part long, start long")
    rows = rows.join(F.broadcast(starts), part == F.col("part"))
    return rows.withColumn("index", F.col("start") + F.col("slot").bitwiseAND(F.lit((1 << _SLOT_BITS) - 1))).drop("slot", "part", "start")


def _blocks(rows: DataFrame, centred: Column, n: int, width: int) -> BlockMatrix:
    """The centred rows as blocks, by ``index``."""
    vectors = rows.select("index", array_to_vector(centred).alias("vector"))
    vectors = MLUtils.convertVectorColumnsFromML(vectors, "vector")
    return IndexedRowMatrix(vectors, n, width).toBlockMatrix(BLOCK_ROWS, min(width, BLOCK_COLUMNS))


def _square(blocks: BlockMatrix, tasks: int) -> np.ndarray:
    """The transpose times the matrix itself. Rows of blocks are dealt to tasks that each hold about
    SPLIT_BYTES of them; their products are added up by key."""
    width = blocks.numCols()
    splits = max(tasks, -(-blocks.numRows() * width * 16 // SPLIT_BYTES))
    splits = min(splits, -(-blocks.numRows() // BLOCK_ROWS))
    flipped = blocks.transpose()._java_matrix_wrapper  # the split product has no Python method
    product = flipped.call("multiply", blocks._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, width_of(blocks), width_of(blocks)).toLocalMatrix().toArray()


def width_of(blocks: BlockMatrix) -> int:
    return blocks.colsPerBlock


def _projected(blocks: BlockMatrix, matrix: np.ndarray, spark) -> BlockMatrix:
    step, (rows, columns) = width_of(blocks), matrix.shape
    parts = [((a // step, 0), Matrices.dense(min(step, rows - a), columns, matrix[a : a + step].ravel(order="F"))) for a in range(0, rows, step)]
    return blocks.multiply(BlockMatrix(spark.sparkContext.parallelize(parts, len(parts)), step, columns, rows, columns))


def components(scatter: np.ndarray, n: int, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(directions over the roots of their eigenvalues, eigenvalues, share of the trace) of the leading
    components. A direction without variance is 0."""
    covariance = (scatter + scatter.T) / 2 / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    trace = float(np.trace(covariance))
    real = values > len(covariance) * np.finfo(float).eps * max(values[0], 0.0)
    with np.errstate(divide="ignore", invalid="ignore"):
        scaled = np.where(real, vectors / np.sqrt(np.where(real, values, 1.0)), 0.0)
    return scaled, np.where(real, values, 0.0), np.where(real, values, 0.0) / (trace or 1.0)


def whiten(
    rows: DataFrame, id: str = "vec_id", vector: str = "embedding", most: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT
) -> DataFrame:
    """id, ``component`` (from 1, by falling variance, to ``most`` or the dimension), ``n``, ``deviation``, ``whitened``,
    ``explained``, ``identity_error`` for every vector that ``on_grid`` keeps.

    ``n`` counts the distinct vectors on the grid, over which means and covariance (divisor n) are taken.
    ``deviation`` is the sum over dimensions of (n * x - sum)**2, exact, null where it doesn't fit a long.
    ``whitened`` is the centred vector's coordinate over the root of the component's variance, null for a
    component without variance, as all are if n is 1; its share ``explained`` is then 0. ``identity_error`` is
    the largest absolute entry of the whitened distinct vectors' covariance minus the identity, over the
    components with variance; null without any. Vectors whose length is not the most frequent one
    (of several the smallest) take no part, nor do empty ones. Null ids and repeated rows each give rows.
    An empty table gives none. Other columns are not read.
    """
    spark = rows.sparkSession
    schema = f"`{id}` {rows.schema[id].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    kept = written(on_grid(rows, id, vector, scale, shift).where(F.size("x") > 0), "whiten-grid")
    width = kept.agg(F.mode(F.size("x"), True)).first()[0]
    if not width:
        return spark.createDataFrame([], schema)
    kept = _indexed(kept.where(F.size("x") == width), "whiten-rows")
    fit = _indexed(kept.select("x").distinct(), "whiten-fit")
    n, total = fit.count(), kept.count()
    each = fit.select(F.posexplode("x").alias("d", "e")).groupBy("d")
    sums = sorted(tuple(r) for r in each.agg(F.sum(F.col("e").cast("decimal(38,0)")), F.min("e"), F.max("e")).collect())
    widest = max(max(abs(n * r[2] - int(r[1])), abs(n * r[3] - int(r[1]))) for r in sums)
    short = width * widest**2 < 1 << 62 and max(n * max(abs(r[2]), abs(r[3])) for r in sums) < 1 << 62
    kind = "bigint" if short else "decimal(38,0)"
    exact = F.array(*[F.lit(int(r[1])).cast(kind) for r in sums])
    off = F.zip_with("x", exact, lambda e, s: F.lit(n).cast(kind if short else "decimal(18,0)") * e.cast(kind if short else "decimal(19,0)") - s)
    centred = F.transform(off, lambda e: e.cast("double") / F.lit(float(n)))
    if short:
        deviation = F.aggregate(off, F.lit(0).cast("bigint"), lambda t, e: t + e * e)
    else:
        wide = lambda t, e: F.try_add(t, F.try_multiply(e.cast("decimal(38,0)"), e.cast("decimal(38,0)")).cast("decimal(38,0)"))
        deviation = F.aggregate(off, F.lit(0).cast("decimal(38,0)"), lambda t, e: wide(t, e).cast("decimal(38,0)")).try_cast("bigint")
    tasks = spark.sparkContext.defaultParallelism
    fitted = _blocks(fit, centred, n, width)
    scaled, values, share = components(_square(fitted, tasks), n, most)
    real = np.flatnonzero(values > 0)
    error = None
    if len(real):
        spread = _square(_projected(fitted, scaled, spark), tasks)[np.ix_(real, real)] / n
        error = float(np.abs(spread - np.eye(len(real))).max())
    whole = _projected(_blocks(kept, centred, total, width), scaled, spark).toIndexedRowMatrix()
    found = callMLlibFunc("getIndexedRows", whole._java_matrix_wrapper._java_model)
    found = found.select("index", vector_to_array("vector").alias("w"))
    rows = kept.select("index", "id", deviation.alias("deviation")).join(found, "index")
    described = F.array(*[F.struct(F.lit(float(s)).alias("explained"), F.lit(bool(v > 0)).alias("real")) for s, v in zip(share, values, strict=True)])
    rows = rows.select("id", "deviation", F.posexplode(F.arrays_zip("w", described.alias("d"))).alias("c", "p"))
    return rows.select(
        F.col("id").alias(id), (F.col("c") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.when(F.col("p.d.real"), F.col("p.w")).alias("whitened"), F.col("p.d.explained").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
