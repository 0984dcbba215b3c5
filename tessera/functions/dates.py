"""Date helpers: zone-independent UTC dates, the fiscal calendar, date spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.types import FISCAL_YEAR_START_MONTH


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def utc_date(iso_ts) -> Column:
    """UTC calendar date of an ISO-8601 timestamp carrying an offset.

    Goes through epoch seconds, so the answer does not depend on
    ``spark.sql.session.timeZone``: '2026-07-01T03:30:00+08:00' is 30 June.
    A timestamp without an offset (``Z`` or ``+hh[:mm]``) names no instant:
    it gives NULL rather than a date that the session's zone decides.
    """
    ts = _c(iso_ts)
    secs = F.unix_seconds(F.to_timestamp(F.when(ts.rlike("[0-9](?:[zZ]|[+-][0-9]{2}(?::?[0-9]{2})?)\\s*$")
                                                & ts.rlike(":"), ts)))
    return F.date_from_unix_date(F.floor(secs / F.lit(86400)).cast("int"))


#: Why a time names no day, first match wins.
MISSING_TIME, UNPARSEABLE_TIME, TIME_WITHOUT_OFFSET = "missing_time", "unparseable_time", "time_without_offset"


def parsed_utc_date(iso_ts) -> Column:
    """``struct(value, error)``: the UTC date of an ISO-8601 time with an
    offset, or why there is none.  Exactly one of the two is NULL, and nothing
    raises, whatever the text is."""
    ts = _c(iso_ts)
    at = F.try_to_timestamp(ts)
    offset = ts.rlike("[0-9](?:[zZ]|[+-][0-9]{2}(?::?[0-9]{2})?)\\s*$") & ts.rlike(":")
    error = (F.when(ts.isNull() | (F.trim(ts) == ""), MISSING_TIME).when(at.isNull(), UNPARSEABLE_TIME)
             .when(~offset, TIME_WITHOUT_OFFSET))
    day = F.date_from_unix_date(F.floor(F.unix_seconds(at) / F.lit(86400)).cast("int"))
    return F.struct(F.when(error.isNull(), day).alias("value"), error.alias("error"))


def fiscal_columns(date_col) -> dict[str, Column]:
    """The fiscal calendar of a date (year starting 1 April), as named columns.

    One definition used both by ``dim_date`` and by the revenue summary, which
    derives the same attributes straight from the sale date.
    """
    d = _c(date_col)
    m = F.month(d)
    start = FISCAL_YEAR_START_MONTH
    fy = F.when(m >= F.lit(start), F.year(d) + 1).otherwise(F.year(d))
    idx = (m - F.lit(start) + F.lit(12)) % F.lit(12)
    fq = (F.floor(idx / F.lit(3)).cast("int") + F.lit(1)).cast("int")
    return {
        "calendar_year": F.year(d),
        "calendar_month": m,
        "calendar_quarter": F.quarter(d),
        "fiscal_year": fy.cast("int"),
        "fiscal_quarter": fq,
        "fiscal_period": (idx + F.lit(1)).cast("int"),
        **fiscal_labels(fy, fq),
    }


def fiscal_labels(year: Column | str, quarter: Column | str) -> dict[str, Column]:
    """The labels of a fiscal year and quarter, as named columns."""
    label = F.concat(F.lit("FY"), F.substring(_c(year).cast("string"), -2, 2))
    return {"fiscal_year_label": label, "fiscal_quarter_label": F.concat(label, F.lit(" Q"), _c(quarter).cast("string"))}


def date_spine(bounds: DataFrame, lo: str = "lo", hi: str = "hi",
               name: str = "rate_date") -> DataFrame:
    """Every date from ``lo`` to ``hi`` inclusive, one row each, for every row
    of ``bounds`` (other columns of ``bounds`` are kept).  Rows whose bounds
    are NULL produce nothing."""
    keep = [c for c in bounds.columns if c not in (lo, hi)]
    return bounds.select(*keep, F.explode(F.sequence(F.col(lo), F.col(hi))).alias(name))
