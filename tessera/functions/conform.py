"""Column -> Column conforming helpers (all JVM-side, foldable)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.types import COUNTRY, MONEY, RATE

# RATE has 19 digits; multiplying MONEY(19,4) by it would need 39 digits and
# Spark would round the product to scale 9 first (a second rounding).  The
# rate values fit 18 digits, so the product is taken at (18,6): exact, scale 10.
_RATE_FOR_PRODUCT = "decimal(18,6)"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def norm_email(col, null_as_empty: bool = False) -> Column:
    """lower(trim(email)); optionally NULL -> '' first (POS customers)."""
    c = _c(col)
    if null_as_empty:
        c = F.coalesce(c, F.lit(""))
    return F.lower(F.trim(c))


def conform_country(col) -> Column:
    """Map a vendor spelling to its ISO code; unknown values pass through
    as upper(trim(value)).  Built as a CASE chain, folded by Catalyst."""
    key = F.upper(F.trim(_c(col)))
    items = list(COUNTRY.items())
    chain = F.when(key == F.lit(items[0][0]), F.lit(items[0][1]))
    for variant, code in items[1:]:
        chain = chain.when(key == F.lit(variant), F.lit(code))
    return F.coalesce(chain, key)


def money(col) -> Column:
    return _c(col).cast(MONEY)


def rate(col) -> Column:
    return _c(col).cast(RATE)


def usd_amount(amount, rate_to_usd) -> Column:
    """amount * rate, computed exactly and rounded once to MONEY."""
    return (_c(amount).cast(MONEY) * _c(rate_to_usd).cast(_RATE_FOR_PRODUCT)).cast(MONEY)
