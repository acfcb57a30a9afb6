"""Whitening of embeddings: principal components of integer-coded vectors, each scaled to variance one.

Centred rows become blocks of an MLlib ``BlockMatrix``. Its transpose times itself is the scatter matrix, whose blocks are
summed from bounded groups of row blocks; only that matrix, dimensions by dimensions, reaches the driver for ``eigh``.
A second block product with the whitening matrix projects the rows, and a third measures how white the result is.

Nulls: rows without a vector, or with a null or non-finite entry in it, are left out. Short vectors count as zero in the
dimensions they lack; an entry beyond ``LARGEST`` counts as that bound. Repeated rows keep a row each, and their vector
counts once in the fit. Components without variance have no whitened value (null). Empty tables give no rows. Other
columns are not read, whatever their names.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, written

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 53)  # of a scaled entry
BLOCK_ROWS, BLOCK_COLS = 1024, 1024
GROUP_BYTES = 4 * 1024 * 1024  # of centred rows that one task multiplies
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def coded(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, x)``: the vectors that count, their entries as longs."""
    entries = F.col("embedding").cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    bounded = F.transform(entries, lambda c: F.floor(F.greatest(F.least(c * F.lit(float(SCALE)), F.lit(LARGEST)), F.lit(-LARGEST))) + SHIFT)
    return embeddings.where(F.col("embedding").isNotNull() & finite).select("vec_id", bounded.alias("x"))


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows, written, with a dense ``row`` from zero; and the path.

    Each task numbers its rows; the offsets are one row for each task that wrote, which is why they may be broadcast.
    """
    own = F.monotonically_increasing_id()
    table, path = written(df.select("*", F.shiftright(own, 33).alias("part"), own.bitwiseAND(F.lit((1 << 33) - 1)).alias("pos")), name)
    sizes = table.groupBy("part").agg((F.max("pos") + 1).alias("size"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("part").alias("of"), F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    return table.join(F.broadcast(offsets), F.col("part") == F.col("of")).select(*df.columns, (F.col("offset") + F.col("pos")).alias("row")), path


def tasks(rows: int, width: int) -> int:
    return max(1, -(-rows * width * 8 // GROUP_BYTES))


def block_matrix(rows: DataFrame, n: int, width: int) -> BlockMatrix:
    """The matrix of ``rows (row, centred)``; built in the JVM, a bounded share of rows for each task."""
    dealt = rows.repartition(tasks(n, width), F.floor(F.col("row") / BLOCK_ROWS))
    vectors = MLUtils.convertVectorColumnsFromML(dealt.select(F.col("row").cast("long"), array_to_vector("centred").alias("vector")), "vector")
    return IndexedRowMatrix(vectors, n, width).toBlockMatrix(BLOCK_ROWS, BLOCK_COLS)


def product(a: BlockMatrix, b: BlockMatrix, groups: int) -> BlockMatrix:
    """The product; the inner dimension is cut into groups whose partial products are summed by a shuffle."""
    java = a._java_matrix_wrapper.call("multiply", b._java_matrix_wrapper._java_model, groups)
    return BlockMatrix(java, a.rowsPerBlock, b.colsPerBlock)


def local(matrix: BlockMatrix) -> np.ndarray:
    """A matrix that is small in both dimensions."""
    return matrix.toLocalMatrix().toArray()


def whitening(scatter: np.ndarray, n: int, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The matrix that projects centred rows, each component's share of the variance, and which components have any."""
    covariance = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    total = float(np.trace(covariance))
    varies = values > max(float(values[0]), 0.0) * len(covariance) * np.finfo(float).eps
    scaled = np.where(varies, vectors / np.sqrt(np.where(varies, values, 1.0)), 0.0)
    return scaled, np.where(varies, values, 0.0) / (total or 1.0), varies


def literal(values: list, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row of ``OUT`` for each row with a vector and each component, the first ones by falling variance.

    ``deviation`` is exact; null where it does not fit a long.
    """
    spark = embeddings.sparkSession
    rows, rows_path = numbered(coded(embeddings.select("vec_id", "embedding")), "coded")
    total, width = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    if not width:
        discard(spark, rows_path)
        return spark.createDataFrame([], OUT)
    padded = F.concat("x", F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(width) - F.size("x")))
    rows = rows.select("vec_id", "row", padded.alias("x"))
    fit, fit_path = numbered(rows.select("x").distinct(), "fit")
    each = fit.select(F.posexplode("x").alias("dimension", "value")).groupBy("dimension").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("s"))
    sums = sorted(each.collect())  # one row for each dimension
    n = sums[0].n
    gaps = F.zip_with("x", literal([r.s for r in sums], "decimal(38,0)"), lambda v, s: (v.cast("decimal(19,0)") * F.lit(Decimal(n)) - s).cast("decimal(38,0)"))
    centred = F.transform("gaps", lambda g: g.cast("double") / F.lit(float(n))).alias("centred")
    squares = F.transform("gaps", lambda g: F.try_multiply(g, g))
    deviation = F.aggregate(squares, F.lit(Decimal(0)).cast("decimal(38,0)"), lambda a, b: F.try_add(a, b).cast("decimal(38,0)")).try_cast("long")

    learned = block_matrix(fit.select("row", gaps.alias("gaps")).select("row", centred), n, width)
    groups = tasks(n, width)
    scaled, shares, varies = whitening(local(product(learned.transpose(), learned, groups)), n, components)
    matrix = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(scaled)], "row long, centred array<double>")
    turn = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(matrix.select("row", array_to_vector("centred").alias("vector")), "vector"), width, scaled.shape[1])
    turn = turn.toBlockMatrix(BLOCK_COLS, BLOCK_COLS)
    white = product(learned, turn, 1)
    identity = local(product(white.transpose(), white, groups)) / n
    error = float(np.abs(identity - np.eye(len(identity)))[np.ix_(varies, varies)].max(initial=0.0))

    projected = product(block_matrix(rows.select("row", gaps.alias("gaps")).select("row", centred), total, width), turn, 1)
    found = callMLlibFunc("getIndexedRows", projected.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    found, found_path = written(found.select(F.col("index").alias("at"), vector_to_array("vector").alias("values")), "projected")
    own = rows.select("vec_id", "row", gaps.alias("gaps")).select("vec_id", "row", deviation.alias("deviation"))
    long = own.join(found, F.col("row") == F.col("at")).select("vec_id", "deviation", F.posexplode("values").alias("k", "value"))
    result = long.select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.when(F.col("k") < int(varies.sum()), F.col("value")).alias("whitened"),
        F.element_at(literal([float(s) for s in shares], "double"), F.col("k") + 1).alias("explained"), F.lit(error).alias("identity_error"),
    )
    discard(spark, fit_path)
    return result
