import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera.operators.asof import carry_forward
from tessera.operators.dedupe import latest_by, one_per_key
from tessera.operators.identity import cohorts, resolve_parties
from tessera.operators.joins import full_outer_by_key
from tessera.operators.quarantine import completeness, split

D = dt.date


def test_latest_by(spark):
    df = spark.createDataFrame([
        ("o1", 1, "a"), ("o1", 3, "b"), ("o1", 2, "c"),      # late arrival with lower seq
        ("o2", 5, "z"), ("o2", 5, "y"),                      # tie on seq -> tie-breaker
        ("o3", 1, "only"),                                    # single event
    ], "k string, seq int, v string")
    got = {r.k: r.v for r in latest_by(df, ["k"], [F.col("seq").desc()]).collect()}
    assert got == {"o1": "b", "o2": "y", "o3": "only"}


def test_latest_by_plans_partial_group_limit(spark):
    df = spark.createDataFrame([("a", 1)], "k string, seq int")
    plan = latest_by(df, ["k"], [F.col("seq").desc()])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_one_per_key(spark):
    df = spark.createDataFrame([("c1", "Ann", "x"), ("c1", "Ann", "x"),   # identical copies
                                ("c2", "Bob", "y"), ("c2", "BOB", "y")],  # differ in one column
                               "id string, name string, e string")
    got = sorted((r.id, r.name) for r in one_per_key(df, ["id"]).collect())
    assert got == [("c1", "Ann"), ("c2", "BOB")]


def _orders(spark):
    return spark.createDataFrame([
        ("a", 0, 1.0), ("b", -1, 1.0), ("c", None, 1.0), ("d", 2, None),
        ("e", 0, None), ("f", 3, 2.5)], "id string, quantity bigint, unit_price double")


def _rules():
    return [("non_positive_quantity", F.col("quantity") <= 0),
            ("missing_unit_price", F.col("unit_price").isNull())]


def test_split_reference_semantics(spark):
    ok, bad = split(_orders(spark), _rules())
    assert [r.id for r in ok.collect()] == ["f"]
    reasons = {r.id: r.quarantine_reason for r in bad.collect()}
    # first matching rule wins; NULL quantity with a price is in NEITHER side
    assert reasons == {"a": "non_positive_quantity", "b": "non_positive_quantity",
                       "d": "missing_unit_price", "e": "non_positive_quantity"}


def test_split_reject_policy_and_completeness(spark):
    _, bad = split(_orders(spark), _rules(), null_policy="reject")
    assert {r.id: r.quarantine_reason for r in bad.collect()}["c"] == "unclassified"
    c = completeness(_orders(spark), _rules()).collect()[0]
    assert (c.n_in, c.n_ok, c.n_rejected, c.n_unclassified) == (6, 1, 4, 1)
    assert c.n_in == c.n_ok + c.n_rejected + c.n_unclassified
    with pytest.raises(ValueError):
        split(_orders(spark), _rules(), null_policy="keep")


def test_carry_forward(spark):
    q = spark.createDataFrame([
        ("USD", D(2026, 7, 3), Decimal("1.0")),      # Friday
        ("USD", D(2026, 7, 6), Decimal("1.0")),      # Monday (weekend gap)
        ("GBP", D(2026, 7, 3), Decimal("1.27")),
        ("GBP", D(2026, 7, 4), None),                # quoted day with a NULL rate
        ("EUR", D(2026, 7, 5), Decimal("1.08")),     # starts late
        ("SGD", D(2026, 7, 3), Decimal("0.74")),     # ends early
    ], "currency string, rate_date date, rate_to_usd decimal(19,6)")
    rows = carry_forward(q, "currency", "rate_date", ["rate_to_usd"]).collect()
    got = {(r.currency, r.rate_date): (r.rate_to_usd, r.quoted_on, r.rate_is_carried) for r in rows}
    assert got[("USD", D(2026, 7, 5))] == (Decimal("1.000000"), D(2026, 7, 3), True)
    assert got[("USD", D(2026, 7, 6))] == (Decimal("1.000000"), D(2026, 7, 6), False)
    assert got[("GBP", D(2026, 7, 4))] == (None, D(2026, 7, 4), False)   # NULL rate is still a quote
    assert got[("GBP", D(2026, 7, 6))] == (None, D(2026, 7, 4), True)
    assert ("EUR", D(2026, 7, 4)) not in got                            # before its first quote
    assert got[("SGD", D(2026, 7, 6))] == (Decimal("0.740000"), D(2026, 7, 3), True)  # to global max
    assert len(rows) == 4 + 4 + 2 + 4


def test_carry_forward_matches_range_join(spark):
    rnd = random.Random(7)
    rows = [(c, D(2026, 1, 1) + dt.timedelta(days=d), Decimal(rnd.randint(1, 999)) / 100)
            for c in ["A", "B", "C"] for d in sorted(rnd.sample(range(60), 15))]
    q = spark.createDataFrame(rows, "currency string, rate_date date, rate_to_usd decimal(19,6)")
    fast = carry_forward(q, "currency", "rate_date", ["rate_to_usd"])
    q.createOrReplaceTempView("q")
    slow = spark.sql("""
      WITH cal AS (SELECT explode(sequence(min(rate_date), max(rate_date))) AS rate_date FROM q),
      dense AS (SELECT c.rate_date, k.currency FROM cal c CROSS JOIN (SELECT DISTINCT currency FROM q) k),
      eff AS (SELECT d.rate_date, d.currency, max(p.rate_date) AS quoted_on FROM dense d
              JOIN q p ON p.currency = d.currency AND p.rate_date <= d.rate_date GROUP BY 1, 2)
      SELECT e.rate_date, e.currency, p.rate_to_usd, e.quoted_on, e.quoted_on <> e.rate_date AS rate_is_carried
      FROM eff e JOIN q p ON p.currency = e.currency AND p.rate_date = e.quoted_on""")
    assert sorted(fast.collect()) == sorted(slow.collect())


def test_single_day_calendar(spark):
    q = spark.createDataFrame([("USD", D(2026, 7, 3), Decimal("1"))],
                              "currency string, rate_date date, rate_to_usd decimal(19,6)")
    rows = carry_forward(q, "currency", "rate_date", ["rate_to_usd"]).collect()
    assert [(r.rate_date, r.rate_is_carried) for r in rows] == [(D(2026, 7, 3), False)]


def test_full_outer_by_key_equals_full_outer(spark):
    rnd = random.Random(3)
    left = spark.createDataFrame([(rnd.choice([None, "a", "b", "c", "d"]), i) for i in range(40)],
                                 "k string, lv int")
    right = spark.createDataFrame([(rnd.choice([None, "b", "c", "e"]), i) for i in range(25)],
                                  "k string, rv int")
    ours = full_outer_by_key(left, right, "k")
    plain = left.join(right, "k", "full_outer")
    assert sorted(ours.collect(), key=str) == sorted(plain.collect(), key=str)


def test_resolve_parties(spark):
    pos = spark.createDataFrame([
        ("C1", "ann@x.com", "US", "premium", "gold"),
        ("C2", "", "GB", "value", "basic"),
        ("C3", "", "GB", "new", "basic"),               # two '' e-mails stay separate
        ("C4", "bob@x.com", "SG", "lapsed", "silver"),  # POS only
    ], "customer_id string, email string, country string, marketing_segment string, loyalty_tier string")
    web = spark.createDataFrame([("ann@x.com", "GB"), ("cy@x.com", "US"), (None, "US")],
                                "email string, country string")
    p = {r.party_key: r for r in resolve_parties(pos, web).collect()}
    assert p["email:ann@x.com"].in_pos and p["email:ann@x.com"].in_web
    assert p["email:ann@x.com"].country == "US"            # POS values win
    assert p["pos:C2"].email == "" and p["pos:C3"].in_pos and not p["pos:C3"].in_web
    assert not p["email:cy@x.com"].in_pos and p["email:cy@x.com"].marketing_segment is None
    assert None in p and not p[None].in_web                # NULL web e-mail: NULL key, not in_web
    c = cohorts(resolve_parties(pos, web)).collect()[0]
    assert (c.parties, c.matched, c.pos_only, c.web_only, c.no_email) == (6, 1, 3, 1, 2)


def test_carry_forward_rows_is_exact(spark):
    from tessera.operators.asof import carry_forward_rows
    q = spark.createDataFrame([
        ("USD", D(2026, 7, 3), Decimal("1.0")), ("USD", D(2026, 7, 6), Decimal("1.0")),
        ("EUR", D(2026, 7, 5), Decimal("1.08")), ("SGD", D(2026, 7, 1), Decimal("0.74"))],
        "currency string, rate_date date, rate_to_usd decimal(19,6)")
    assert carry_forward_rows(q, "currency", "rate_date") == \
        carry_forward(q, "currency", "rate_date", ["rate_to_usd"]).count() == 4 + 2 + 6
