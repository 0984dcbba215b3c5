"""Profiling in as few passes as possible.

Each table is profiled by ONE aggregate (counts, distinct counts, non-null
counts of every declared field) and reshaped to long rows with ``stack`` --
instead of one job per metric or per field.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _stack(agg_row: DataFrame, names: list[str], name_col: str, value_col: str) -> DataFrame:
    pairs = ", ".join(f"'{n}', `{n}`" for n in names)
    return agg_row.selectExpr(f"stack({len(names)}, {pairs}) as ({name_col}, {value_col})")


def metrics(df: DataFrame, exprs: dict[str, Column], prefix: str = "") -> DataFrame:
    """One aggregate over ``df``; rows ``(metric, value bigint)``."""
    row = df.agg(*[e.cast("bigint").alias(f"{prefix}{k}") for k, e in exprs.items()])
    return _stack(row, [f"{prefix}{k}" for k in exprs], "metric", "value")


def measured(df: DataFrame, numbers: dict[str, Column], words: dict[str, Column]) -> DataFrame:
    """Numbers and texts of a table by one aggregate: rows ``(metric, value, text)``."""
    row = df.agg(*[e.cast("bigint").alias(k) for k, e in numbers.items()], *[e.cast("string").alias(k) for k, e in words.items()])
    body = [f"'{k}', `{k}`, cast(null as string)" for k in numbers] + [f"'{k}', cast(null as bigint), `{k}`" for k in words]
    return row.selectExpr(f"stack({len(body)}, {', '.join(body)}) as (metric, value, text)")


def blank_fields(df: DataFrame, table: str, fields: list[str]) -> Column:
    """Aggregate: ``table.field`` of the fields without one value, comma-joined."""
    return F.array_join(F.array_sort(F.array_compact(F.array(*[
        F.when(F.count(F.col(f)) == 0, f"{table}.{f}") for f in fields]))), ",")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def field_presence(df: DataFrame, table: str, fields: list[str]) -> DataFrame:
    """Rows ``(table_name, column_name, non_null, is_blank)`` -- a field is
    blank when not one row carries a value.  One pass per table."""
    row = df.agg(*[F.count(F.col(f)).alias(f) for f in fields])
    long = _stack(row, fields, "column_name", "non_null")
    return long.select(
        F.lit(table).alias("table_name"),
        "column_name",
        F.col("non_null").cast("bigint").alias("non_null"),
        (F.col("non_null") == 0).alias("is_blank"),
    )
