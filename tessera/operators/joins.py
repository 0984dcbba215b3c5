"""Join helpers: size-checked broadcast, NULL-key-safe full outer join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Upper bound on rows for an explicitly broadcast side.  A side whose size
# is not proven below it is left to the planner (sort-merge, or an AQE
# conversion from the measured shuffle size).
BROADCAST_MAX_ROWS = 2_000_000
#: And on the bytes of its values, as text: rows may hold free text.
BROADCAST_MAX_BYTES = 128 << 20


def small_enough(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Has ``df`` at most ``max_rows`` rows and their values at most
    ``max_bytes`` as text?  One aggregate over no more than ``max_rows + 1`` rows."""
    size = F.octet_length(F.to_json(F.struct(*df.columns)))
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(size)).first()
    return n <= max_rows and (size or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only after proving it small, in rows and in bytes.

    Meant for dimension-like sides that are cheap to compute (calendars, rate
    grids, lists of files), whose size does not grow with the facts.
    """
    return F.broadcast(df) if small_enough(df, max_rows, max_bytes) else df


def full_outer_by_key(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``left FULL OUTER JOIN right USING (key)``, planned for skew.

    * A full outer sort-merge join cannot be split by AQE when one key is hot
      (say a placeholder e-mail shared by a third of the customers).  It is
      written as ``left LEFT JOIN right`` plus the ``right`` rows whose key is
      not on the left (an anti join against the left's distinct keys): AQE
      can split a skewed streamed side of both, and the distinct keys are
      pre-aggregated map-side.
    * Rows with a NULL key never match, but would all hash to one reducer.
      They join on a tagged surrogate instead -- (side, row hash) -- which
      spreads them and can never match across sides.  No extra scan is needed
      to route them.

    Column names other than ``key`` must differ between the sides.
    """
    k = F.col(key)

    def tagged(df: DataFrame, side: str) -> DataFrame:
        return df.select(
            "*",
            F.when(k.isNull(), F.lit(side)).otherwise(F.lit("key")).alias("_jt"),
            F.coalesce(k, F.xxhash64(*[F.col(c) for c in df.columns]).cast("string")).alias("_jk"))

    lt, rt = tagged(left, "left"), tagged(right, "right")
    with_left = lt.join(rt.drop(key), ["_jt", "_jk"], "left")
    left_keys = lt.filter(F.col("_jt") == "key").select("_jt", "_jk").distinct()
    right_only = rt.join(left_keys, ["_jt", "_jk"], "left_anti")
    out_cols = [key] + [c for c in left.columns if c != key] + [c for c in right.columns if c != key]
    return (with_left.unionByName(right_only, allowMissingColumns=True)
            .select(*out_cols))
