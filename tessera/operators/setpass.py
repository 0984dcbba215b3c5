"""Distinct counts and overlaps of many key columns in one pass.

Every key set of a profile is a (metric, side): its keys are tagged with the
metric and a bit of their side, one aggregate per (metric, key) or-s the bits,
and one per metric counts them.  So all distinct counts and intersections of
any number of tables share one exchange of keys, pre-aggregated in the scan,
instead of two per metric.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class KeySet:
    """The non-NULL values of ``key`` in ``df``, one side of ``metric``."""

    metric: str
    df: DataFrame
    key: str | Column
    side: int = 0


def set_counts(sets: list[KeySet]) -> DataFrame:
    """``metric, value``, one row per metric: the number of distinct keys that
    are on all of the metric's sides (of one side: a distinct count)."""
    sides: dict[str, int] = {}
    for s in sets:
        sides[s.metric] = sides.get(s.metric, 0) | 1 << s.side
    tagged = [s.df.select(F.lit(s.metric).alias("metric"), (F.col(s.key) if isinstance(s.key, str) else s.key).cast("string").alias("key"),
                          F.lit(1 << s.side).alias("bit")).where("key is not null") for s in sets]
    spark = sets[0].df.sparkSession
    # metrics without a key must be there too: a row each that is no key
    names = spark.createDataFrame(list(sides.items()), "metric string, wanted int")
    none = names.select("metric", F.lit(None).cast("string").alias("key"), F.lit(0).alias("bit"))
    met = reduce(DataFrame.unionByName, [*tagged, none]).groupBy("metric", "key").agg(F.bit_or("bit").alias("bits"))
    wanted = F.create_map(*[F.lit(x) for pair in sides.items() for x in pair])[F.col("metric")]
    return met.groupBy("metric").agg(F.count_if(F.col("bits") == wanted).alias("value"))
