"""Exact de-duplication by progressive refinement.

Texts are grouped by length, groups that survive (more than one row) by a hash
of a prefix, and only rows of groups that survive that too are read whole and
hashed with SHA-256.  All native expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BROADCAST_ROWS, materialize


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = 256, digest: bool = False) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``keep_id`` (the largest id of
    its class of equal texts), ``group_size``, ``kept`` and, with ``digest``,
    ``text_sha256`` (also of texts that no other text came close to).

    Null texts count as empty.  Empty texts are one class.  Rows repeated
    under one id count in ``group_size`` and are kept or dropped together.  A
    null id is smaller than any other; a class of null ids only has a null
    ``keep_id`` and all its rows are kept.  An empty table gives an empty
    result; other columns of ``docs`` are not looked at.

    Shuffled are lengths, prefix hashes and digests, never texts.  A hot class
    is pre-aggregated to one row per task before its exchange, and the join
    back to its members is one that adaptive execution can split.
    """
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    keyed = base.withColumns({"len": F.octet_length("t"),
                              "pre": F.xxhash64(F.substring("t", 1, prefix_chars))})
    keys = materialize(keyed.select("len", "pre"), "exact_keys")

    # 1: length; 2: prefix hash within the lengths that survived
    lengths = keys.groupBy("len").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("len")
    groups = materialize(
        keys.join(lengths, "len", "left_semi")
        .groupBy("len", "pre").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("len", "pre"),
        "exact_groups")

    # 3: full hash of the rows in surviving groups
    full = F.sha2("t", 256).alias("sha")
    if groups.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        small = F.broadcast(groups)
        members = keyed.join(small, ["len", "pre"], "left_semi").select("id", "len", full)
        alone = keyed.join(small, ["len", "pre"], "left_anti").select("id", "len", full)
    else:  # too many groups to send to every task: hash in the scan, so that no text is shuffled
        hashed = keyed.select("id", "len", "pre", full)
        members = hashed.join(groups, ["len", "pre"], "left_semi").drop("pre")
        alone = hashed.join(groups, ["len", "pre"], "left_anti").drop("pre")
    members = materialize(members, "exact_members")
    classes = (members.groupBy("len", "sha")
               .agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    found = (members.join(classes, ["len", "sha"], "left")
             .select("id", F.when(F.col("n").isNull(), F.col("id")).otherwise(F.col("keep")).alias("keep_id"),
                     F.coalesce("n", F.lit(1)).alias("group_size"), "sha"))
    single = alone.select("id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), "sha")
    out = found.unionByName(single)
    return out.select(F.col("id").alias(id_col), "keep_id", "group_size",
                      F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                      *([F.col("sha").alias("text_sha256")] if digest else []))
