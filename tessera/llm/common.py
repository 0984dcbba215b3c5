"""Helpers shared by the operators: lineage cuts, batch sizes, sample bounds."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: Rows of two or three short columns that may be broadcast (about 50 MB).
BROADCAST_ROWS = 500_000


def materialize(df: DataFrame, kind: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: the lineage cut.

    A written table survives lost executors, keeps column pruning and is read
    by several branches without being computed again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{kind}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (a written table) with a broadcast hint if it has at most
    ``rows`` rows; beyond that the planner's shuffle join, skew splitting
    included, stays."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def python_tasks(spark: SparkSession, rows: int = 512) -> None:
    """Prepare the session for this package's Python tasks: bound the rows of
    an Arrow batch, since texts may be very long, and let workers import the
    package from where the driver has it.  (Executors on machines without that
    folder get the package as any other, with ``--py-files``.)"""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > rows:
        spark.conf.set(key, str(rows))
    env, root = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def id_class(col: Column | str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; 0 for a null id."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(modulus)), F.lit(0)).cast("int")


def bounded_sample(df: DataFrame, id_col: str, bound: int) -> DataFrame:
    """About ``bound`` rows of ``df``, chosen by a hash of the id, the same on
    every run; all rows when there are no more than ``bound``."""
    n = df.count()
    if n <= bound:
        return df
    keep = int(bound / n * 1_000_000)
    return df.where(F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1_000_000)) < keep)


def same(a: DataFrame, b: DataFrame, *cols: str) -> Column:
    """Null-safe equality of the named columns of two frames."""
    on = a[cols[0]].eqNullSafe(b[cols[0]])
    for c in cols[1:]:
        on = on & a[c].eqNullSafe(b[c])
    return on
