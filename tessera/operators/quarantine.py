"""Split rows into accepted and quarantined, with the reason kept.

A row is bad when any rule holds; the reason is the first rule that holds.
SQL's three-valued logic leaves a hole: a rule that evaluates to NULL (say
``quantity <= 0`` on a NULL quantity) makes the row neither good nor bad, and
the reference semantics drop it from both sides.  ``null_policy="reject"``
routes such rows to quarantine as ``unclassified`` instead, and
``completeness`` counts all four outcomes in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNCLASSIFIED = "unclassified"


def bad_predicate(rules: Sequence[tuple[str, Column]]) -> Column:
    return reduce(lambda a, b: a | b, [c for _, c in rules])


def reason(rules: Sequence[tuple[str, Column]]) -> Column:
    first_reason, first_rule = rules[0]
    expr = F.when(first_rule, F.lit(first_reason))
    for name, rule in rules[1:]:
        expr = expr.when(rule, F.lit(name))
    return expr


def split(df: DataFrame, rules: Sequence[tuple[str, Column]],
          null_policy: str = "drop", reason_col: str = "quarantine_reason"):
    """Return ``(accepted, quarantined)``; quarantined carries ``reason_col``."""
    bad = bad_predicate(rules)
    accepted = df.filter(~bad)
    if null_policy == "drop":
        rejected = df.filter(bad).withColumn(reason_col, reason(rules))
    elif null_policy == "reject":
        rejected = (df.filter(bad | bad.isNull())
                      .withColumn(reason_col, F.coalesce(reason(rules), F.lit(UNCLASSIFIED))))
    else:
        raise ValueError(f"null_policy must be 'drop' or 'reject', not {null_policy!r}")
    return accepted, rejected


def completeness(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """One row: n_in = n_ok + n_rejected + n_unclassified, in one aggregate."""
    bad = bad_predicate(rules)
    return df.agg(
        F.count(F.lit(1)).alias("n_in"),
        F.count_if(~bad).alias("n_ok"),
        F.count_if(bad).alias("n_rejected"),
        F.count_if(bad.isNull()).alias("n_unclassified"),
    )


def routed(df: DataFrame, rules: Sequence[tuple[str, Column]], path: str, fmt: str = "parquet",
           accepted: str = "accepted", verdict_col: str = "verdict") -> DataFrame:
    """Write all rows once, partitioned by ``verdict_col``: ``accepted``, the
    reason of the first rule that holds, or ``unclassified`` where the rules
    are NULL.  The table is returned; both sides of a split are reads of it that
    open their own folders only (``verdict = 'accepted'``, and the rest), and
    the rules are evaluated once."""
    bad = bad_predicate(rules)
    verdict = F.when(bad, reason(rules)).when(~bad, accepted).otherwise(UNCLASSIFIED)
    df.withColumn(verdict_col, verdict).write.mode("overwrite").partitionBy(verdict_col).format(fmt).save(path)
    schema = df.withColumn(verdict_col, F.lit("")).schema
    return df.sparkSession.read.schema(schema).format(fmt).load(path)
