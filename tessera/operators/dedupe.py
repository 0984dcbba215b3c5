"""One row per key.

Both operators rank with ``row_number() = 1``; Spark plans that as a partial
``WindowGroupLimit`` before the shuffle and a final one after it, so a hot key
reaches its reducer as at most one row per map partition, never as its whole
group.  The order is made total with explicit tie-breakers, so the pick is
deterministic (a re-run, or a retried task, picks the same row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "_tessera_rn"


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def default_tie_breakers(df: DataFrame, keys: Sequence[str],
                         used: Sequence[str] = ()) -> list[Column]:
    """Every remaining column, ascending, NULLs first: ties then mean the
    rows are identical on every column and the pick cannot be observed."""
    skip = set(keys) | set(used)
    return [F.col(c).asc_nulls_first() for c in df.columns if c not in skip]


def latest_by(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column],
              tie_breakers: Sequence[Column] | None = None) -> DataFrame:
    """Keep the first row per ``keys`` under ``order_by`` (e.g. the highest
    ``event_seq``), breaking ties with ``tie_breakers``."""
    if tie_breakers is None:
        tie_breakers = default_tie_breakers(df, keys)
    w = Window.partitionBy(*keys).orderBy(*_cols(order_by), *_cols(tie_breakers))
    return (df.withColumn(_RN, F.row_number().over(w))
              .filter(F.col(_RN) == 1)
              .drop(_RN))


def one_per_key(df: DataFrame, keys: Sequence[str],
                tie_breakers: Sequence[Column] | None = None) -> DataFrame:
    """One row per key where the source gives no order (vendor resends)."""
    if tie_breakers is None:
        tie_breakers = default_tie_breakers(df, keys)
    return latest_by(df, keys, [], tie_breakers)
