"""Embedding whitening over distributed block matrices.

Vectors become whole numbers, ``floor(SCALE * c)``.  The fit list (each distinct vector once), less its
mean, is indexed and laid out as a ``BlockMatrix`` A; its transpose times itself is the scatter matrix,
whose eigenvectors one task finds.  A times the whitening matrix (eigenvectors over the roots of their
eigenvalues) gives the fit list's whitened vectors, from which the error is measured; the blocks of all
rows times that matrix give theirs.  Rows stay in the JVM from the scan to the result.

The driver holds matrices of dimensions by dimensions, and Spark's block matrix one pair of numbers
for each block; so ``rows_per_block`` should grow with very large tables.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import stage

SCALE = 256
COMPONENTS = 4
ROWS = 4096
COLUMNS = 1024
#: Blocks that one task of a product holds at once.
BLOCKS_AT_ONCE = 16
# Spark's row ids have the partition above these bits and the place in it below.
_PLACE_BITS = 33


# --- vectors -----------------------------------------------------------------------------


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``x``, whole numbers, of the rows whose vector is whole and finite.

    Products beyond a long stop at its ends.
    """
    odd = F.exists("embedding", lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    product = lambda c: F.floor(F.greatest(F.least(c.cast("double") * scale, F.lit(9.2e18)), F.lit(-9.2e18)))
    return vectors.where(F.col("embedding").isNotNull() & ~F.coalesce(odd, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", product).alias("x")
    )


def _same_width(rows: DataFrame, width: int) -> DataFrame:
    return rows.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x"))))


# --- matrices ----------------------------------------------------------------------------


def indexed(rows: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``rows``, stored, with ``index`` from 0 on without a gap; and how many they are."""
    made = stage(rows.withColumn("__place", F.monotonically_increasing_id()), label)
    made = made.withColumn("__part", F.shiftright("__place", _PLACE_BITS))
    shares = made.groupBy("__part").agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    shares = stage(shares.select("__part", "__n", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")), f"{label}-shares")
    index = F.col("__place").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + F.col("__before")
    found = made.join(shares.drop("__n"), "__part").select(*rows.columns, index.alias("index"))
    return found, shares.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]


def _sums(fit: DataFrame, width: int) -> list[int]:
    """The exact sum of the vectors in each dimension."""
    entries = fit.select(F.posexplode("x").alias("dimension", "c"))
    found = {r.dimension: int(r.total) for r in entries.groupBy("dimension").agg(F.sum(F.col("c").cast("decimal(38,0)")).alias("total")).collect()}
    return [found.get(i, 0) for i in range(width)]


def _matrix(rows: DataFrame, mean: list[float], count: int, rows_per_block: int) -> BlockMatrix:
    """The centred rows, laid out in blocks by their index."""
    centre = F.array(*[F.lit(m) for m in mean])
    centred = F.zip_with("x", centre, lambda x, m: x.cast("double") - m)
    table = MLUtils.convertVectorColumnsFromML(rows.select("index", array_to_vector(centred).alias("vector")), "vector")
    # What the Python class does with rows of its own, for rows that Spark has already.
    java = callMLlibFunc("createIndexedRowMatrix", table, count, len(mean))
    return IndexedRowMatrix(java).toBlockMatrix(rows_per_block, min(len(mean), COLUMNS))


def _rows(matrix: BlockMatrix) -> DataFrame:
    """``index`` and ``z``, an array, of a block matrix's rows."""
    java = matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model
    table = MLUtils.convertVectorColumnsToML(callMLlibFunc("getIndexedRows", java), "vector")
    return table.select("index", vector_to_array("vector").alias("z"))


def _product(left: BlockMatrix, right: BlockMatrix, inner: int) -> BlockMatrix:
    """left x right; the ``inner`` blocks over which sums run are spread over tasks of a few each."""
    splits = max(1, -(-inner // BLOCKS_AT_ONCE))
    # The Python class has no argument for the splits that Spark's public method takes.
    java = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(java, left.rowsPerBlock, right.colsPerBlock)


def _local(matrix: BlockMatrix, shape: tuple[int, int]) -> np.ndarray:
    """A small matrix in the driver."""
    out = np.zeros(shape)
    for (i, j), part in matrix.blocks.collect():
        top, left = i * matrix.rowsPerBlock, j * matrix.colsPerBlock
        out[top : top + part.numRows, left : left + part.numCols] = part.toArray()
    return out


# --- whitening ---------------------------------------------------------------------------


def _eigen(spark, scatter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns), found in one task.

    A task's linear algebra has one thread; in the driver's process it may have several, which
    has been seen to hang.  The largest entry of each vector is made positive.
    """
    width = len(scatter)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["m"]:
                values, vectors = np.linalg.eigh(np.frombuffer(data, dtype="<f8").reshape(width, width))
                yield pd.DataFrame({"values": [values[::-1].tobytes()], "vectors": [np.ascontiguousarray(vectors[:, ::-1]).tobytes()]})

    asked = spark.createDataFrame([(bytearray(scatter.astype("<f8").tobytes()),)], "m binary")
    found = asked.mapInPandas(solve, "values binary, vectors binary").first()
    values = np.frombuffer(bytes(found["values"]), dtype="<f8")
    vectors = np.frombuffer(bytes(found["vectors"]), dtype="<f8").reshape(width, width)
    largest = vectors[np.abs(vectors).argmax(axis=0), np.arange(width)]
    return values, vectors * np.where(largest < 0, -1.0, 1.0)


def _whitener(spark, matrix: np.ndarray) -> BlockMatrix:
    width, k = matrix.shape
    parts = [((j // COLUMNS, 0), DenseMatrix(len(p), k, p.ravel(order="F"))) for j in range(0, width, COLUMNS) for p in [matrix[j : j + COLUMNS]]]
    return BlockMatrix(spark.sparkContext.parallelize(parts, 1), min(width, COLUMNS), k, width, k)


def _deviation(n: int, sums: list[int]) -> Column:
    """Sum over dimensions of (n * x - S) ** 2, exact; null where it is beyond a long."""
    total = F.array(*[F.lit(str(s)).cast("decimal(38,0)") for s in sums])
    away = F.zip_with("x", total, lambda x, s: F.try_subtract(F.try_multiply(x.cast("decimal(38,0)"), F.lit(str(n)).cast("decimal(38,0)")), s))
    square = F.transform(away, lambda d: F.try_multiply(d, d).cast("decimal(38,0)"))
    zero = F.lit("0").cast("decimal(38,0)")
    return F.aggregate(square, zero, lambda a, d: F.try_add(a, d).cast("decimal(38,0)")).try_cast("long")


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, rows_per_block: int = ROWS) -> DataFrame:
    """``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    One row for each whole, finite vector and component (as many as there are dimensions, at most
    ``components``).  Shorter vectors count as followed by zeros.  Repeated rows stay, each is in
    the fit list once; a null vec_id stays null.  A component without variance has null for
    ``whitened`` and takes no part in the error; where nothing varies ``explained`` and
    ``identity_error`` are null.  An empty table, or one of empty vectors, gives no rows.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors, scale)
    width = rows.agg(F.coalesce(F.max(F.size("x")), F.lit(0))).first()[0]
    if not width:
        shown = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return spark.createDataFrame([], shown)
    everything, count = indexed(_same_width(rows, width), "whitening-rows")
    fit, n = indexed(everything.select("x").distinct(), "whitening-fit")
    sums = _sums(fit, width)
    mean = [s / n for s in sums]  # of whole numbers, rounded once

    inner = -(-n // rows_per_block)
    centred = _matrix(fit, mean, n, rows_per_block)
    scatter = _local(_product(centred.transpose(), centred, inner), (width, width))
    values, axes = _eigen(spark, (scatter + scatter.T) / (2 * n))
    trace = float(np.trace(scatter)) / n
    k = min(components, width)
    varies = values[:k] > width * np.finfo(float).eps * max(float(values[0]), 0.0)
    held = int(varies.sum())  # values fall, so these come first
    error = None
    if held:
        whitener = _whitener(spark, axes[:, :held] / np.sqrt(values[:held]))
        whitened = _product(centred, whitener, 1)
        # Projections of centred rows are centred.
        covariance = _local(_product(whitened.transpose(), whitened, inner), (held, held)) / n
        error = float(np.abs(covariance - np.eye(held)).max())
        everything = everything.join(_rows(_product(_matrix(everything, mean, count, rows_per_block), whitener, 1)), "index", "left")
    else:
        everything = everything.withColumn("z", F.lit(None).cast("array<double>"))

    def shown(c: int) -> Column:
        value = F.lit(None) if c >= held else F.coalesce(F.get("z", F.lit(c)), F.lit(0.0))
        share = max(float(values[c]), 0.0) / trace if trace > 0 else None
        return F.struct(F.lit(c + 1).alias("component"), value.cast("double").alias("whitened"), F.lit(share).cast("double").alias("explained"))

    made = everything.select("vec_id", F.lit(n).cast("long").alias("n"), _deviation(n, sums).alias("deviation"), F.explode(F.array(*[shown(c) for c in range(k)])).alias("c"))
    return made.select("vec_id", "c.component", "n", "deviation", "c.whitened", "c.explained", F.lit(error).cast("double").alias("identity_error"))
