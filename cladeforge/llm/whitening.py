"""Whitening of vectors by MLlib's distributed block matrices.

Entries become whole numbers (256ths, rounded down), so equal vectors are equal exactly. Each distinct vector is one row of the fit
list, numbered densely, centred, and put into blocks of ROWS rows. The transposed matrix times the matrix, its middle dimension
split over many tasks, is the scatter; its eigenvectors, on the driver (one square of the vectors' dimension), give the whitening matrix, and
the block matrix times that one projects the rows. Rows of the table take what their vector has by a join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladeforge.llm.common import written

COMPONENTS = 4
#: Entries are counted in parts of one.
PARTS = 256
#: Rows and columns of a block.
ROWS, COLUMNS = 1024, 1024
#: Blocks whose products are summed up in one task.
BLOCKS = 32
#: A component counts if its eigenvalue is above this share of the largest.
LEAST_SHARE = 1e-12
SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf))


def whole_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", parts: int = PARTS) -> DataFrame:
    """vec_id, x (array of long) of the rows whose vector has entries, all of them finite."""
    c = F.col(vector_column).cast("array<double>")
    good = vectors.select(F.col(id_column).cast("long").alias("vec_id"), c.alias("c")).filter((F.size("c") > 0) & F.forall("c", _finite))
    return good.select("vec_id", F.transform("c", lambda v: F.floor(v * parts).cast("long") + F.lit(0)).alias("x"))


def fit_list(whole: DataFrame) -> DataFrame:
    """idx (dense, from 0), x of each distinct vector: places within the parts of a written table, and the sizes of the parts before."""
    distinct = whole.groupBy("x").agg(F.count("*").alias("n")).select("x")
    at = F.monotonically_increasing_id()
    dealt = written(distinct.select("x", F.shiftright(at, 33).cast("int").alias("part"), at.bitwiseAND(F.lit((1 << 33) - 1)).alias("nth")))
    sizes = dealt.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return dealt.join(F.broadcast(offsets), "part").select((F.col("offset") + F.col("nth")).alias("idx"), "x")


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """dim, n, s: sums over a part's vectors, told by their dimension."""
    found: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        x = batch.column("x")
        sizes = x.value_lengths().to_numpy()
        begins, flat = np.cumsum(sizes) - sizes, x.flatten().to_numpy()
        for dim in np.unique(sizes).tolist():
            rows = flat[(begins[sizes == dim][:, None] + np.arange(dim)).ravel()].reshape(-1, dim)
            n, s = found.get(dim, (0, np.zeros(dim, np.int64)))
            found[dim] = n + len(rows), s + rows.sum(axis=0)
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array([n for n, _ in found.values()], pa.int64()), pa.array([s.tolist() for _, s in found.values()], pa.list_(pa.int64()))], ["dim", "n", "s"])


def totals(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sums by dimension. Vectors of several dimensions are an error."""
    parts = fit.select("x").mapInArrow(_sums, "dim int, n long, s array<long>")
    rows = parts.select("dim", "n", F.posexplode("s")).groupBy("dim", "pos").agg(F.sum("n").alias("n"), F.sum("col").alias("s")).collect()  # one row a dimension
    if len({r["dim"] for r in rows}) > 1:
        raise ValueError(f"vectors of several dimensions: {sorted({r['dim'] for r in rows})}")
    rows.sort(key=lambda r: r["pos"])
    return (rows[0]["n"] if rows else 0), [r["s"] for r in rows]


def block_matrix(fit: DataFrame, n: int, sums: list[int]) -> BlockMatrix:
    """The centred vectors as a distributed matrix of dense blocks."""
    mean = F.array(*(F.lit(s / n) for s in sums))
    centred = F.transform("x", lambda v, i: v.cast("double") - F.get(mean, i))
    rows = MLUtils.convertVectorColumnsFromML(fit.select(F.col("idx").alias("index"), array_to_vector(centred).alias("vector")), "vector")
    return IndexedRowMatrix(rows, n, len(sums)).toBlockMatrix(ROWS, min(COLUMNS, len(sums)))


def scatter(matrix: BlockMatrix, blocks: int = BLOCKS) -> np.ndarray:
    """The transposed matrix times the matrix. The product is one block or few, so its middle dimension is split, or one task would get every row."""
    splits = -(-matrix.numRows() // (matrix.rowsPerBlock * blocks))
    left, right = matrix.transpose(), matrix
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock).toLocalMatrix().toArray()


def projected(spark: SparkSession, matrix: BlockMatrix, weights: np.ndarray) -> DataFrame:
    """idx, w (array of double): the matrix's rows times weights."""
    side = matrix.colsPerBlock
    parts = [((i, 0), Matrices.dense(*b.shape, b.ravel(order="F").tolist())) for i, b in enumerate(np.split(weights, range(side, len(weights), side)))]
    whitener = BlockMatrix(spark.sparkContext.parallelize(parts, 1), side, weights.shape[1])
    rows = callMLlibFunc("getIndexedRows", matrix.multiply(whitener).toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return MLUtils.convertVectorColumnsToML(rows, "vector").select(F.col("index").alias("idx"), vector_to_array("vector").alias("w"))


def _identity_error(found: DataFrame, k: int) -> float:
    """The largest entry, without its sign, of the covariance of w minus the identity."""
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = found.select(*(F.col("w")[i].alias(f"w{i}") for i in range(k))).agg(*(F.covar_pop(f"w{i}", f"w{j}").alias(f"c{i}_{j}") for i, j in pairs)).first()
    return max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding", parts: int = PARTS) -> DataFrame:
    """vec_id, component (from 1, by falling eigenvalue), n, deviation, whitened, explained, identity_error: `components` rows for each row with a good vector.

    Rows whose vector is null or empty, or has null or non-finite entries, go. n and the covariance are those of the distinct
    vectors; deviation is the sum over dimensions of (n x - S)^2, exactly (beyond 64 bits it is an error, as is an entry beyond them). Fewer
    components come back where the vectors span fewer dimensions, none for one distinct vector; no rows give none. Repeated rows and
    null ids are rows like others. Vectors of several dimensions are an error. Other columns of vectors are left aside.
    """
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, id_column, vector_column, parts)
    fit = fit_list(whole)
    n, sums = totals(fit)
    if n < 2:
        return spark.createDataFrame([], SCHEMA)
    matrix = block_matrix(fit, n, sums)
    values, axes = np.linalg.eigh(scatter(matrix) / n)
    values, axes = values[::-1], axes[:, ::-1]
    k = int(min(components, (values > values[0] * LEAST_SHARE).sum())) if values[0] > 0 else 0
    if not k:
        return spark.createDataFrame([], SCHEMA)
    found = written(projected(spark, matrix, axes[:, :k] / np.sqrt(values[:k])))
    error = _identity_error(found, k)
    sum_ = F.array(*(F.lit(s).cast("long") for s in sums))
    away = F.aggregate(F.transform("x", lambda v, i: F.lit(n).cast("long") * v - F.get(sum_, i)), F.lit(0).cast("long"), lambda a, d: a + d * d)
    known = fit.join(found, "idx").select("x", away.alias("deviation"), "w")
    rows = whole.join(known, "x").select("vec_id", "deviation", F.posexplode("w").alias("i", "whitened"))
    share = F.array(*(F.lit(float(v / values.sum())) for v in values[:k]))
    columns = [(F.col("i") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(share, F.col("i")).alias("explained"), F.lit(float(error)).alias("identity_error")]
    return rows.select("vec_id", *columns)
