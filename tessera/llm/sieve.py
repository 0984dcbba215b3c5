"""A Bloom table: which rows of a large table may have one of some keys.

A join of whole texts with a few keys sends all texts to other tasks.  The
sieve lets through every row whose key is among them, and few others, in the
scan.  It is a table of at most ``SLOTS`` rows of 64 bits (two bits a key), so
its size is bounded whatever the number of keys; with more keys than bits it
lets through more, never less.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize

#: Rows of the table: 16 million bits.
SLOTS = 1 << 18


def _slot(key: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("slot")), F.lit(SLOTS))


def _bits(key: Column) -> Column:
    h = F.xxhash64(key, F.lit("bits"))

    def one(by: int) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.shiftright(h, by), F.lit(64)).cast("int"))

    return one(0).bitwiseOR(one(20))


def sieve_of(keys: DataFrame, key: str, kind: str) -> DataFrame:
    """The sieve of column ``key``: ``slot, bits``, pre-aggregated in the scan."""
    rows = keys.select(_slot(F.col(key)).alias("slot"), _bits(F.col(key)).alias("bit")).groupBy("slot").agg(F.bit_or("bit").alias("bits"))
    return materialize(rows, kind)


def _marked(rows: DataFrame, key: Column, sieve: DataFrame) -> DataFrame:
    bits = _bits(F.col("sieve key"))
    return (rows.withColumn("sieve key", key).withColumn("sieve slot", _slot(F.col("sieve key")))
            .join(F.broadcast(sieve.select(F.col("slot").alias("sieve slot"), F.col("bits").alias("sieve bits"))), "sieve slot", "left")
            .withColumn("sieve may", F.coalesce(F.col("sieve bits").bitwiseAND(bits) == bits, F.lit(False))))


def passes(rows: DataFrame, key: Column, sieve: DataFrame) -> DataFrame:
    """The rows whose key may be one of the sieve's."""
    return _marked(rows, key, sieve).where(F.col("sieve may")).drop("sieve slot", "sieve bits", "sieve key", "sieve may")


def stays(rows: DataFrame, key: Column, sieve: DataFrame) -> DataFrame:
    """The rows whose key is none of the sieve's."""
    return _marked(rows, key, sieve).where(~F.col("sieve may")).drop("sieve slot", "sieve bits", "sieve key", "sieve may")
