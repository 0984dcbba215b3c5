import datetime as dt
from decimal import Decimal


from tessera.functions.conform import conform_country, norm_email, usd_amount
from tessera.functions.dates import date_spine, fiscal_columns, utc_date
from tessera.types import COUNTRY, MONEY, RATE


def test_fixed_values():
    assert MONEY == "decimal(19,4)" and RATE == "decimal(19,6)"
    assert len(COUNTRY) == 12 and set(COUNTRY.values()) == {"US", "GB", "SG"}


def test_conform_country(spark):
    df = spark.createDataFrame([(" u.k. ",), ("USA",), ("singapore",), ("FR",), (None,), ("\tUS",)],
                               "c string")
    got = [r[0] for r in df.select(conform_country("c")).collect()]
    # trim strips spaces only: a tab survives and the value passes through upper-cased
    assert got == ["GB", "US", "SG", "FR", None, "\tUS"]


def test_norm_email(spark):
    df = spark.createDataFrame([(" User1@Example.COM ",), (None,)], "e string")
    assert [r[0] for r in df.select(norm_email("e", null_as_empty=True)).collect()] == \
        ["user1@example.com", ""]
    assert [r[0] for r in df.select(norm_email("e")).collect()] == ["user1@example.com", None]


def test_usd_amount_rounds_once(spark):
    df = spark.createDataFrame([(Decimal("0.0001"), Decimal("0.499999")),
                                (Decimal("10.0000"), None),
                                (Decimal("3.0005"), Decimal("1.500000"))],
                               "a decimal(19,4), r decimal(19,6)")
    got = [r[0] for r in df.select(usd_amount("a", "r")).collect()]
    assert got == [Decimal("0.0000"), None, Decimal("4.5008")]


def test_utc_date_independent_of_session_zone(spark):
    df = spark.createDataFrame([("2026-07-01T03:30:00+08:00",), ("2026-07-01T12:00:00+00:00",)], "s string")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ["UTC", "Asia/Singapore", "America/Los_Angeles"]:
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert [r[0] for r in df.select(utc_date("s")).collect()] == \
                [dt.date(2026, 6, 30), dt.date(2026, 7, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_fiscal_calendar(spark):
    days = [dt.date(2026, 3, 31), dt.date(2026, 4, 1), dt.date(2026, 6, 30), dt.date(2026, 7, 1),
            dt.date(2026, 12, 31), dt.date(2027, 1, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    fc = fiscal_columns("d")
    rows = df.select("d", *[fc[k].alias(k) for k in ["fiscal_year", "fiscal_quarter", "fiscal_period",
                                                       "fiscal_year_label", "fiscal_quarter_label",
                                                       "calendar_quarter"]]).collect()
    got = {r.d: (r.fiscal_year, r.fiscal_quarter, r.fiscal_period, r.fiscal_quarter_label,
                 r.calendar_quarter) for r in rows}
    assert got[dt.date(2026, 3, 31)] == (2026, 4, 12, "FY26 Q4", 1)
    assert got[dt.date(2026, 4, 1)] == (2027, 1, 1, "FY27 Q1", 2)
    assert got[dt.date(2026, 6, 30)] == (2027, 1, 3, "FY27 Q1", 2)
    assert got[dt.date(2026, 7, 1)] == (2027, 2, 4, "FY27 Q2", 3)
    assert got[dt.date(2026, 12, 31)] == (2027, 3, 9, "FY27 Q3", 4)
    assert got[dt.date(2027, 1, 1)] == (2027, 4, 10, "FY27 Q4", 1)


def test_date_spine(spark):
    b = spark.createDataFrame([(dt.date(2026, 1, 30), dt.date(2026, 2, 2)),
                               (dt.date(2026, 5, 5), dt.date(2026, 5, 5))], "lo date, hi date")
    got = [r[0] for r in date_spine(b, name="d").orderBy("d").collect()]
    assert got == [dt.date(2026, 1, 30), dt.date(2026, 1, 31), dt.date(2026, 2, 1),
                   dt.date(2026, 2, 2), dt.date(2026, 5, 5)]


def test_utc_date_without_offset_is_null(spark):
    """A timestamp that names no instant has no UTC date, whatever the zone."""
    df = spark.createDataFrame([("2026-07-01T03:30:00",), ("2026-07-01T03:30:00Z",), ("2026-07-01T03:30:00+08:00",),
                                ("2026-07-01 23:30:00-0500",), ("2026-07-01",), ("",), (None,)], "s string")
    import datetime as dt
    assert [r[0] for r in df.select(utc_date("s")).collect()] == [
        None, dt.date(2026, 7, 1), dt.date(2026, 6, 30), dt.date(2026, 7, 2), None, None, None]
