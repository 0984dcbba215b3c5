"""The place of every row in its group, without one task that sees the group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, small_side


def with_places(rows: DataFrame, group: str, order: list[str], kind: str) -> DataFrame:
    """``rows`` (a written table) with ``place``, the 0-based place of a row
    in its ``group`` by ``order`` (nulls first), and ``n``, the group's rows.

    Rows are dealt out by ranges of (group, order), so a group of any size is
    spread over many tasks, and numbered inside their range; a range's start
    comes from the sizes of the ranges before it, a table of one row per range
    and group.  Rows alike in ``order`` are spread by a hash of their place in
    ``rows``; ``group`` must not be null.
    """
    spread = rows.withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    keys = [group, *order, "_salt"]
    spread = materialize(spread, f"{kind}_salted")  # the ranges are sampled from it, and then it is dealt out
    dealt = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_salt")
    numbered = materialize(dealt.withColumn("_row", F.monotonically_increasing_id()), f"{kind}_ranges")
    span = F.shiftright("_row", 33).alias("_span")  # the task that numbered the row
    sizes = numbered.groupBy(group, span).agg(F.count(F.lit(1)).alias("_size"), F.min("_row").alias("_first"))
    whole = Window.partitionBy(group)
    starts = sizes.select(
        group, "_span", "_first", F.sum("_size").over(whole).alias("n"),
        (F.sum("_size").over(whole.orderBy("_span")) - F.col("_size")).alias("_start"))
    starts = small_side(materialize(starts, f"{kind}_starts"))
    return (numbered.withColumn("_span", F.shiftright("_row", 33)).join(starts, [group, "_span"])
            .withColumn("place", F.col("_row") - F.col("_first") + F.col("_start"))
            .drop("_row", "_span", "_first", "_start"))
