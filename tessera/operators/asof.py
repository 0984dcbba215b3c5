"""As-of (last value at or before a date), carried onto a dense daily grid.

A backward as-of lookup ``max(quote_date) <= day`` is a range join; Catalyst
does not rewrite it.  Here each key's quote days are laid on a dense calendar
from the key's first quote to the global last quote, the latest quote day is
carried forward with a running ``max``, and the quotes of that day are joined
back by equality -- all of them, so a day that was quoted twice gives two rows
on that day and on every day it is carried to.  Quotes without a key or a day
are quotes of nothing.  Work is linear in (days x keys); facts then find their
rate with an equi-join on (key, day), which a broadcast or a shuffle join
handles at any fact volume.

The window is partitioned by the key only; each partition holds one key's
calendar, bounded by the number of days in the span -- never by fact volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def carry_forward(quotes: DataFrame, key: str, date_col: str,
                  values: list[str], through: Column | None = None,
                  quoted_on: str = "quoted_on",
                  carried_flag: str = "rate_is_carried") -> DataFrame:
    """Dense rows ``(date_col, key, *values, quoted_on, carried_flag)``.

    ``through`` is the last day of the grid (default: the latest quote day of
    any quote, computed as a scalar subquery so nothing is collected).  Days
    before a key's first quote have no row.
    """
    if through is None:
        through = quotes.select(F.max(date_col)).scalar()
    q = quotes.filter(F.col(key).isNotNull() & F.col(date_col).isNotNull()).select(
        F.col(key).alias("_k"), F.col(date_col).alias(quoted_on), *values)
    days = q.groupBy("_k", quoted_on).agg(F.lit(1).alias("_quoted"))
    starts = q.groupBy("_k").agg(F.min(quoted_on).alias("_from"))
    grid = starts.select(F.col("_k").alias(key), F.explode(F.sequence("_from", through)).alias(date_col))
    w = (Window.partitionBy(key).orderBy(date_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    on_day = (F.col(key) == F.col("_k")) & (F.col(date_col) == F.col(quoted_on))
    carried = (grid.join(days, on_day, "left")
               .select(date_col, key, F.max(quoted_on).over(w).alias("_on")))
    return carried.join(q, (F.col(key) == F.col("_k")) & (F.col("_on") == F.col(quoted_on))).select(
        date_col, key, *values, quoted_on, (F.col(quoted_on) != F.col(date_col)).alias(carried_flag))


def asof_lookup(facts: DataFrame, dense: DataFrame, fact_key: str, fact_date: Column,
                key: str, date_col: str, how: str = "left") -> DataFrame:
    """Attach the carried values of ``dense`` to each fact by (key, day); the
    key and day columns of ``dense`` are dropped again."""
    d = dense.withColumnsRenamed({key: "_asof_key", date_col: "_asof_date"})
    on = (facts[fact_key] == d["_asof_key"]) & (fact_date == d["_asof_date"])
    return facts.join(d, on, how).drop("_asof_key", "_asof_date")


def carry_forward_rows(quotes: DataFrame, key: str, date_col: str) -> int:
    """At least the row count of ``carry_forward(quotes, ...)`` without
    building it, exact when no key is quoted twice on a day: days from each
    key's first quote to the last of all, times the most quotes a key has on
    one day.  One number reaches the driver."""
    per_day = quotes.groupBy(key, date_col).agg(F.count(F.lit(1)).alias("_n"))
    fine = F.col(key).isNotNull() & F.col(date_col).isNotNull()
    per_key = per_day.filter(fine).groupBy(key).agg(
        F.min(date_col).alias("_from"), F.max("_n").alias("_most"))
    hi = quotes.select(F.max(date_col)).scalar()
    n = per_key.agg(F.sum((F.datediff(hi, F.col("_from")) + 1) * F.col("_most")).alias("n")).collect()[0]["n"]
    return int(n or 0)
