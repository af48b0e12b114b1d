"""Embedding whitening with distributed block matrices.

Entries become whole numbers first (``floor(64 c) + 1,000,000``), so that sums are exact.  Rows are indexed and centred --
``(n x - S) / n``, whose numerator is exact -- and laid out as a Spark MLlib ``BlockMatrix`` of row blocks; its transpose
times itself is the scatter matrix, summed block by block over as many tasks as there are splits of the middle dimension.
Only that matrix (dimensions squared) reaches the driver, where a symmetric eigensolver gives the components; the block
matrix times the whitening matrix projects all rows.  The covariance of the projected rows, computed the same way, says
how far whitening is from the identity.

Rows whose vector is null, empty or holds null or non-finite entries are dropped, and so are rows whose vector has another
length than most (of equally frequent lengths the longest counts), since they have no place in the matrix; entries of
2^40 and more in size, whose products with the row number leave 64 bits, count as non-finite.  Repeated rows, repeated ids
and null ids each keep their rows.  An empty table gives an empty result.  A component without variance (an eigenvalue of
no more than its rounding error) has no whitened values: they are null, and it takes no part in ``identity_error``, which
is null if no component has variance; ``explained`` is null where the trace is zero.  ``deviation`` is null beyond 64 bits;
``deviation_exact`` holds it then too.  Other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quartermaster.llm.common import cut
from quartermaster.session import scratch_path

SCALE, SHIFT, LARGEST = 64, 1_000_000, 1 << 40
#: Rows of a block, until the table has so many rows that there would be more than MOST_BLOCKS; columns of a block.
BLOCK_ROWS, MOST_BLOCKS, BLOCK_COLS = 1024, 50_000, 1024


def whole_numbers(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, x array<long>) of the usable rows."""
    c = F.col(vector)
    usable = c.isNotNull() & (F.size(c) > 0) & F.forall(
        c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < LARGEST // SCALE))
    x = df.filter(usable).select(F.col(key).alias("_key"), F.transform(
        c, lambda v: F.floor(v.cast("double") * SCALE).cast("long") + SHIFT).alias("x"))
    sizes = x.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"))
    common = sizes.agg(F.max(F.struct("n", "size")).alias("m")).select("m.size").first()[0]
    return x.filter(F.size("x") == F.lit(-1 if common is None else common))


def indexed(df: DataFrame) -> DataFrame:
    """``df`` with a gapless row number ``_index``.  Rows are written with their task's own numbering first, as it must not
    change when a task runs again; one offset for each task then makes it gapless."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "whitening")
    df.withColumn("_local", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path).withColumn("_part", F.shiftright("_local", 33))
    parts = sorted(rows.groupBy("_part").count().collect())  # one row for each writing task
    offsets, seen = [], 0
    for part, n in parts:
        offsets.append((part, seen - (part << 33)))
        seen += n
    placed = spark.createDataFrame(offsets, "_part long, _offset long")
    return rows.join(F.broadcast(placed), "_part").withColumn("_index", F.col("_local") + F.col("_offset")).drop("_part", "_local", "_offset")


def blocks(rows: DataFrame, values: str, n: int, dims: int) -> BlockMatrix:
    """The rows' array column as a block matrix, row ``_index`` of it at row ``_index``."""
    vectors = MLUtils.convertVectorColumnsFromML(rows.select(F.col("_index").alias("index"), array_to_vector(values).alias("vector")), "vector")
    per_block = max(BLOCK_ROWS, math.ceil(n / MOST_BLOCKS))
    return IndexedRowMatrix(vectors, n, dims).toBlockMatrix(per_block, BLOCK_COLS)


def scatter(matrix: BlockMatrix) -> np.ndarray:
    """Transpose times itself.  The middle dimension is split, so that products of different row blocks meet in different
    tasks and only their sums in one."""
    row_blocks = math.ceil(matrix.numRows() / matrix.rowsPerBlock)
    splits = min(row_blocks, max(16, math.ceil(row_blocks / 16)))
    right, wrapped = matrix._java_matrix_wrapper._java_model, matrix.transpose()._java_matrix_wrapper
    product = wrapped.call("multiply", right, splits)  # Python's own multiply() has no splits
    return BlockMatrix(product, BLOCK_COLS, BLOCK_COLS).toLocalMatrix().toArray()  # dimensions squared


def projected(matrix: BlockMatrix, weights: np.ndarray) -> DataFrame:
    """(_index, values array<double>): the rows times ``weights``."""
    sc = matrix.blocks.context
    d, k = weights.shape
    cells = [((i // BLOCK_COLS, j // BLOCK_COLS), DenseMatrix(*(b := weights[i:i + BLOCK_COLS, j:j + BLOCK_COLS]).shape, b.ravel(order="F")))
             for i in range(0, d, BLOCK_COLS) for j in range(0, k, BLOCK_COLS)]
    right = BlockMatrix(sc.parallelize(cells, 1), BLOCK_COLS, BLOCK_COLS, d, k)
    rows = matrix.multiply(right).toIndexedRowMatrix()
    frame = callMLlibFunc("getIndexedRows", rows._java_matrix_wrapper._java_model)  # its rows as a DataFrame, without Python rows
    return frame.select(F.col("index").alias("_index"), vector_to_array("vector").alias("values"))


def sums(rows: DataFrame, values: str, dims: int) -> list:
    """The sum of each dimension, partial in every task."""
    found = dict(rows.select(F.posexplode(values).alias("i", "v")).groupBy("i").agg(F.sum("v")).collect())  # one row a dimension
    return [found[i] for i in range(dims)]


def whiten(df: DataFrame, components: int = 32, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, component, n, deviation, deviation_exact, whitened, explained, identity_error): every usable row's first
    ``components`` whitened values, one row each; see the module's text."""
    spark = df.sparkSession
    kind = df.schema[key].dataType
    rows = indexed(whole_numbers(df, key, vector))
    n, dims = rows.agg(F.count("*"), F.max(F.size("x"))).first()
    if not n:
        return spark.createDataFrame([], T.StructType([T.StructField(key, kind), *T._parse_datatype_string(
            "component int, n long, deviation long, deviation_exact decimal(38,0), whitened double, explained double, identity_error double").fields]))
    total = sums(rows, "x", dims)
    # n x - S = n (x - m) - (S - n m) with m = S div n: all terms stay small
    base = F.array(*(F.lit(s // n) for s in total))
    rest = F.array(*(F.lit(s % n) for s in total))
    exact = rows.withColumn("y", F.zip_with(
        F.zip_with("x", base, lambda x, m: (x - m) * F.lit(n)), rest, lambda nx, r: nx - r))
    matrix = blocks(exact.withColumn("c", F.transform("y", lambda y: y.cast("double") / n)), "c", n, dims)
    v = scatter(matrix) / n
    values, vectors = np.linalg.eigh((v + v.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    e, trace = values[order], float(np.trace(v))
    varied = e > max(values.max(), 0.0) * dims * np.finfo(float).eps
    weights = vectors[:, order] / np.sqrt(np.where(varied, e, 1.0))
    white = cut(projected(matrix, weights))

    k = len(order)
    error = None
    if varied.any():
        means = F.array(*(F.lit(float(s) / n) for s in sums(white, "values", k)))
        centred = white.withColumn("c", F.zip_with("values", means, lambda a, m: a - m))
        own = (scatter(blocks(centred, "c", n, k)) / n)[np.ix_(varied, varied)]
        error = float(np.abs(own - np.eye(len(own))).max())

    # squares of doubles tell whether the sum fits 64 bits; beyond it is summed as decimals
    near = F.aggregate("y", F.lit(0.0), lambda s, y: s + y.cast("double") * y.cast("double"))
    small = near < float(1 << 62)
    wide = F.aggregate("y", F.lit(0).cast("decimal(38,0)"), lambda s, y: (
        s + (y.cast("decimal(19,0)") * y.cast("decimal(19,0)"))).cast("decimal(38,0)"))
    narrow = F.aggregate("y", F.lit(0).cast("long"), lambda s, y: s + y * y)
    facts = exact.select("_index", "_key", F.when(small, narrow).alias("narrow"), F.when(~small, wide).alias("wide"))
    explained = [float(x) / trace if trace > 0 else None for x in e]
    per_component = F.array(*(F.struct(F.lit(i + 1).alias("component"), F.lit(bool(varied[i])).alias("varied"),
                                       F.lit(explained[i]).cast("double").alias("explained")) for i in range(k)))
    out = facts.join(white, "_index").select(
        "_key", "narrow", "wide", F.explode(F.zip_with("values", per_component, lambda w, c: F.struct(w.alias("w"), c.alias("c")))).alias("r"))
    return out.select(
        F.col("_key").alias(key), F.col("r.c.component").alias("component"), F.lit(n).cast("long").alias("n"),
        F.coalesce("narrow", F.expr("try_cast(wide AS BIGINT)")).alias("deviation"),
        F.coalesce("wide", F.col("narrow").cast("decimal(38,0)")).alias("deviation_exact"),
        F.when(F.col("r.c.varied"), F.col("r.w")).alias("whitened"), F.col("r.c.explained").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
