"""As-of join on timestamps: the last quote at or before each fact's time.

Facts and quotes are put together and dealt out by ranges of (key, time), so a
key of any size is spread over many tasks and neither a calendar nor a range
join is built.  Inside a range the latest quote is carried forward; what
reaches over a range's start comes from a table of one row per range, its last
key with that key's last quote: only that key can go on in the next range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path


def _written(df: DataFrame, kind: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, f"asof/{kind}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def asof_join(facts: DataFrame, quotes: DataFrame, key: str, at: str, quoted_at: str, values: list[str]) -> DataFrame:
    """``facts`` with ``quoted_at`` and ``values`` of the last quote of their
    ``key`` at or before ``at``; NULL where there is none.

    Facts keep all their rows, those with a NULL key or time without a quote.
    Quotes without a key or a time are quotes of nothing; of several quotes of
    one key and time the one with the largest ``values`` counts.  ``quotes``
    has ``key``, ``quoted_at`` and ``values``; names of ``facts`` must differ
    from the last two.
    """
    quote = F.struct(F.col(quoted_at), *values)
    tape = (quotes.where(F.col(key).isNotNull() & F.col(quoted_at).isNotNull())
            .select(F.col(key).alias("_k"), F.col(quoted_at).alias("_t"), F.lit(0).alias("_kind"), quote.alias("_quote")))
    asked = facts.select(F.col(key).alias("_k"), F.col(at).alias("_t"), F.lit(1).alias("_kind"), F.struct(*facts.columns).alias("_fact"))
    both = tape.unionByName(asked, allowMissingColumns=True)
    order = ["_k", "_t", "_kind", "_quote"]
    # rows alike in the order are facts of one key and time: a hash of the whole fact spreads them
    both = _written(both.withColumn("_spread", F.xxhash64("_fact")), "tape")
    dealt = both.repartitionByRange(*order, "_spread").sortWithinPartitions(*order, "_spread").drop("_spread")
    rows = _written(dealt.withColumn("_row", F.monotonically_increasing_id()), "ranges")
    rows = rows.withColumn("_range", F.shiftright("_row", 33))

    # a range's last key, and that key's last quote in it
    by_key = rows.groupBy("_range", "_k").agg(F.max("_row").alias("_end"), F.max_by("_quote", F.when(F.col("_kind") == 0, F.col("_row"))).alias("_last"))
    ends = by_key.groupBy("_range").agg(F.max_by(F.struct("_k", "_last"), "_end").alias("_e"))
    before = Window.partitionBy("_k").orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = (ends.select("_range", "_e.*").withColumn("_carried", F.last("_last", ignorenulls=True).over(before))
               .select((F.col("_range") + 1).alias("_range"), "_k", "_carried"))
    # ranges in between may be empty: the last one before counts
    known = ends.select("_range").join(carried, "_range", "full_outer")
    here = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a row per range
    known = known.withColumn("_over", F.last(F.when(F.col("_k").isNotNull(), F.struct("_k", "_carried")), ignorenulls=True).over(here))
    known = known.select("_range", F.col("_over._k").alias("_k"), F.col("_over._carried").alias("_carried"))

    inside = Window.partitionBy("_range", "_k").orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = rows.join(F.broadcast(known), ["_range", "_k"], "left").withColumn(
        "_found", F.coalesce(F.last("_quote", ignorenulls=True).over(inside), F.col("_carried")))
    return (filled.where("_kind = 1")
            .select("_fact.*", *[F.when(F.col("_t").isNotNull(), F.col("_found")[c]).alias(c) for c in [quoted_at, *values]]))
