"""Whitening of embeddings with Spark MLlib's BlockMatrix.

Centred rows are indexed into distributed blocks; the transpose times the
matrix is the scatter, whose eigenvectors, scaled, are the whitening matrix (a
local ``eigh`` of dimensions squared); the blocks times that matrix are the
whitened rows, and their scatter tells how far they are from white.

The rows are taken in panels of a bounded number of blocks, because MLlib's
multiplication keeps the coordinates of all blocks on the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg import Matrices
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import materialize, python_tasks
from tessera.llm.places import with_places
from tessera.session import scratch_path

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Entries of a block of rows (1 MB of doubles), and rows' blocks of a panel.
BLOCK_ENTRIES, PANEL_BLOCKS = 131_072, 4096


def _times(left: BlockMatrix, right: BlockMatrix, splits: int) -> BlockMatrix:
    """``left`` times ``right``, the middle dimension dealt out to ``splits``
    tasks and their partial products summed: an argument of MLlib's method
    that PySpark's does not pass on."""
    product = left._java_matrix_wrapper._java_model.multiply(right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


class Panels:
    """The centred rows as block matrices, a panel of rows each."""

    def __init__(self, centred: DataFrame, n: int, dim: int, block_entries: int, panel_blocks: int) -> None:
        self.centred, self.n, self.dim = centred, n, dim
        self.cols = min(dim, 1024)
        self.rows = max(1, block_entries // self.cols)
        self.height = self.rows * panel_blocks

    def __iter__(self):
        for start in range(0, self.n, self.height):
            size = min(self.height, self.n - start)
            rows = self.centred.where((F.col("place") >= start) & (F.col("place") < start + size)).select(
                (F.col("place") - start).alias("index"), array_to_vector("centred").alias("vector"))
            matrix = IndexedRowMatrix(MLUtils.convertVectorColumnsFromML(rows, "vector"), size, self.dim)
            yield start, matrix.toBlockMatrix(self.rows, self.cols), -(-size // self.rows)


def _scatter(m: BlockMatrix, splits: int) -> np.ndarray:
    """The transpose times the matrix: columns squared, so it fits the driver."""
    return _times(m.transpose(), m, splits).toLocalMatrix().toArray()


def _as_blocks(spark: SparkSession, m: np.ndarray, rows: int, cols: int) -> BlockMatrix:
    parts = [((i // rows, j // cols), Matrices.dense(*(b := m[i:i + rows, j:j + cols]).shape, b.ravel(order="F")))
             for i in range(0, m.shape[0], rows) for j in range(0, m.shape[1], cols)]
    return BlockMatrix(spark.sparkContext.parallelize(parts, 1), rows, cols, *m.shape)


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS,
           scale: int = SCALE, shift: int = SHIFT, block_entries: int = BLOCK_ENTRIES, panel_blocks: int = PANEL_BLOCKS) -> DataFrame:
    """One row per usable row of ``vectors``: ``id_col``, ``n`` (usable rows),
    ``deviation``, ``whitened`` (an array, one entry per component by falling
    eigenvalue), ``explained`` (the components' shares of the variance) and
    ``identity_error``.

    Entries c become whole numbers ``floor(scale * c) + shift``.  Not usable
    are null vectors, those with a null or non-finite entry or one whose whole
    number does not fit a long, and those of another length than most (of
    equally frequent lengths the longer one counts; empty vectors never).
    ``deviation`` is the sum over dimensions of ``(n * x - S) ** 2``, null
    where it does not fit a long.  Components without variance (an eigenvalue
    of no more than rounding) cannot be whitened and are left out; a table of
    one vector or of equal ones has none, and ``identity_error`` 0.  Null and
    repeated ids are rows like others; an empty table gives an empty result;
    other columns are not looked at.
    """
    spark = vectors.sparkSession
    python_tasks(spark)
    whole = f"transform(v, c -> try_add(floor({scale}D * cast(c as double)), {shift}L))"
    sound = "forall(v, c -> c is not null and not isnan(c) and abs(cast(c as double)) < double('infinity') and abs(cast(c as double)) * {0}D < 9.0E18D)".format(scale)
    usable = (vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).where("v is not null and size(v) > 0")
              .where(sound).select("id", F.expr(whole).alias("x")).where("forall(x, c -> c is not null)"))
    usable = materialize(usable, "whiten_usable")
    schema = "id, cast(null as bigint) n, cast(null as bigint) deviation, cast(null as array<double>) whitened, cast(null as array<double>) explained, cast(null as double) identity_error"
    most = usable.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if most is None:
        return usable.selectExpr(*schema.split(", ")).withColumnRenamed("id", id_col)
    dim, n = int(most["dim"]), int(most["count"])
    rows = with_places(usable.where(F.size("x") == dim).withColumn("g", F.lit("")), "g", [], "whiten")

    # sums per dimension, and each entry less the mean: (x - q) - r / n with S = q * n + r
    sums = usable.where(F.size("x") == dim).select(F.posexplode("x")).groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s"))
    total = {r["pos"]: int(r["s"]) for r in sums.collect()}
    floor = "array(" + ", ".join(f"{total[k] // n}L" for k in range(dim)) + ")"
    rest = "array(" + ", ".join(f"{total[k] % n}L" for k in range(dim)) + ")"
    off = f"zip_with(x, {floor}, (a, q) -> try_subtract(a, q))"
    square = "coalesce(aggregate(zip_with(off, rest, (a, r) -> try_subtract(try_multiply(n, a), r)), 0L, (acc, d) -> try_add(acc, try_multiply(d, d))))"
    rows = rows.select("id", "place", F.lit(n).cast("long").alias("n"), F.expr(off).alias("off"), F.expr(rest).alias("rest"))
    rows = materialize(rows.select("id", "place", F.expr(square).alias("deviation"),
                                   F.expr("zip_with(off, rest, (a, r) -> cast(a as double) - cast(r as double) / n)").alias("centred")), "whiten_centred")

    panels = Panels(rows, n, dim, block_entries, panel_blocks)
    variance = sum(_scatter(m, splits) for _, m, splits in panels) / n
    e, u = np.linalg.eigh((variance + variance.T) / 2)
    e, u = e[::-1], u[:, ::-1]
    k = min(components, int((e > max(e[0], 0.0) * dim * np.finfo(float).eps).sum()))
    explained = (e[:k] / np.trace(variance)).tolist() if k else []
    path, error = scratch_path(spark, "llm/whitened"), 0.0
    if k:
        matrix = _as_blocks(spark, u[:, :k] / np.sqrt(e[:k]), panels.cols, min(k, 1024))
        white = np.zeros((k, k))
        for start, m, splits in panels:
            z = _times(m, matrix, 1)
            white += _scatter(z, splits)
            found = z.toIndexedRowMatrix().rows.map(lambda r, start=start: (int(r.index) + start, r.vector.toArray().tolist()))
            spark.createDataFrame(found, "place long, whitened array<double>").write.mode("append").parquet(path)
        error = float(np.abs(white / n - np.eye(k)).max())
        projected = spark.read.schema("place long, whitened array<double>").parquet(path)
    else:
        projected = rows.select("place", F.expr("cast(array() as array<double>)").alias("whitened"))
    share = F.array(*map(F.lit, explained)) if k else F.expr("cast(array() as array<double>)")
    return rows.select("id", "place", "deviation").join(projected, "place").select(
        F.col("id").alias(id_col), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        share.cast("array<double>").alias("explained"), F.lit(error).alias("identity_error"))


def by_component(whitened: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """``whiten``'s rows, one per component (numbered from 1)."""
    each = whitened.select(id_col, "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("k", "c"))
    return each.select(id_col, (F.col("k") + 1).cast("int").alias("component"), "n", "deviation",
                       F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
