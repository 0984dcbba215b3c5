"""Which rows of two stored builds of a table differ.

Rows are hashed into a tree of key buckets.  The roots' children are compared
first (one row per bucket and build, summed in the scan), then the children of
the buckets that differ, and only rows of the last buckets that differ are
compared themselves: equal builds cost two scans and no exchange of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _digest(df: DataFrame, side: str, *by: str) -> DataFrame:
    """Rows and the sum of their hashes per bucket: equal for equal bags of rows."""
    whole = F.sum(F.col("_hash").cast("decimal(38,0)"))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(f"_n_{side}"), whole.alias(f"_sum_{side}"))


def _differing(a: DataFrame, b: DataFrame, *by: str) -> DataFrame:
    both = _digest(a, "a", *by).join(_digest(b, "b", *by), list(by), "full_outer")
    return both.where("not (_n_a <=> _n_b and _sum_a <=> _sum_b)").select(*by)


def tree_difference(a: DataFrame, b: DataFrame, key: list[str], fanout: int = 256, levels: int = 2) -> DataFrame:
    """The rows that one of the tables has more often than the other: all
    columns, ``side`` (``a`` or ``b``) and ``times``, how much more often.

    Rows count as a bag (repeated ones too); NULLs are values.  Both tables
    have the same columns.  The differing buckets, at most ``fanout`` times as
    many as differing keys, are joined to the rows; the planner broadcasts
    them where they are few.
    """
    if set(a.columns) != set(b.columns):
        raise ValueError("the builds have different columns")
    cols = a.columns
    paths = {f"_b{k}": F.pmod(F.shiftright(F.xxhash64(*key), 8 * k), F.lit(fanout)) for k in range(levels)}
    sides = [df.select(*cols).withColumns({**paths, "_hash": F.xxhash64(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}))}) for df in (a, b)]
    by: list[str] = []
    for level in paths:
        by.append(level)
        left = _differing(*sides, *by)
        sides = [s.join(left, by, "left_semi") for s in sides]
    counted = [s.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")) for s in sides]
    signed = counted[0].unionByName(counted[1].withColumn("_n", -F.col("_n")))
    net = signed.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return net.select(*cols, F.when(F.col("_n") > 0, "a").otherwise("b").alias("side"), F.abs("_n").alias("times"))
