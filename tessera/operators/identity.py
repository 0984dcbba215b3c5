"""Cross-system identity: one party per person, keyed on the e-mail.

A POS customer without an e-mail cannot be matched and keeps a key of its own
(``pos:<id>``); web accounts are keyed ``email:<address>``.  The two sides are
full-outer joined so that people known to one system only survive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.joins import full_outer_by_key
from tessera.types import EMAIL_KEY_PREFIX, POS_KEY_PREFIX


def pos_party_key(customer_id, email):
    return (F.when(email == F.lit(""), F.concat(F.lit(POS_KEY_PREFIX), customer_id.cast("string")))
             .otherwise(F.concat(F.lit(EMAIL_KEY_PREFIX), email)))


def web_party_key(email):
    return F.concat(F.lit(EMAIL_KEY_PREFIX), email)


def resolve_parties(pos: DataFrame, web: DataFrame) -> DataFrame:
    """``pos``: customer_id, email, country, marketing_segment, loyalty_tier
    (e-mail already normalised, '' when missing); ``web``: email, country."""
    p = pos.select(
        pos_party_key(F.col("customer_id"), F.col("email")).alias("party_key"),
        F.col("customer_id").alias("p_customer_id"),
        F.col("email").alias("p_email"),
        F.col("country").alias("p_country"),
        "marketing_segment",
        "loyalty_tier",
    )
    w = web.select(
        web_party_key(F.col("email")).alias("party_key"),
        F.col("email").alias("w_email"),
        F.col("country").alias("w_country"),
    )
    j = full_outer_by_key(p, w, "party_key")
    return j.select(
        "party_key",
        F.coalesce("p_email", "w_email").alias("email"),
        F.col("p_customer_id").alias("pos_customer_id"),
        F.col("p_customer_id").isNotNull().alias("in_pos"),
        F.col("w_email").isNotNull().alias("in_web"),
        F.coalesce("p_country", "w_country").alias("country"),
        "marketing_segment",
        "loyalty_tier",
    )


def cohorts(party: DataFrame) -> DataFrame:
    """One row: matched / POS only / web only / no e-mail, plus the total."""
    pos, web = F.col("in_pos"), F.col("in_web")
    return party.agg(
        F.count(F.lit(1)).alias("parties"),
        F.count_if(pos & web).alias("matched"),
        F.count_if(pos & ~web).alias("pos_only"),
        F.count_if(~pos & web).alias("web_only"),
        F.count_if(F.col("email") == F.lit("")).alias("no_email"),
    )


def key_overlap(left: DataFrame, right: DataFrame, col: str) -> DataFrame:
    """One row ``overlap``: distinct non-empty values of ``col`` on both
    sides (INTERSECT: distinct + semi join, never collected)."""
    nonempty = F.col(col).isNotNull() & (F.col(col) != F.lit(""))
    both = left.select(col).filter(nonempty).intersect(right.select(col).filter(nonempty))
    return both.agg(F.count(F.lit(1)).alias("overlap"))
