"""Property tests: the custom join shapes equal their textbook definitions on
random inputs (NULL keys, duplicates on both sides, hot keys)."""

import datetime as dt
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators.asof import carry_forward, carry_forward_rows
from tessera.operators.joins import full_outer_by_key

keys = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "hot"]))
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


@SETTINGS
@given(st.lists(st.tuples(keys, st.integers(0, 9)), max_size=25),
       st.lists(st.tuples(keys, st.integers(0, 9)), max_size=25))
def test_full_outer_by_key_is_full_outer(spark, left_rows, right_rows):
    left = spark.createDataFrame(left_rows, "k string, lv int")
    right = spark.createDataFrame(right_rows, "k string, rv int")
    ours = sorted(full_outer_by_key(left, right, "k").collect(), key=str)
    plain = sorted(left.join(right, "k", "full_outer").collect(), key=str)
    assert ours == plain


quote = st.tuples(st.one_of(st.none(), st.sampled_from(["USD", "GBP", "EUR"])), st.one_of(st.none(), st.integers(0, 20)),
                  st.one_of(st.none(), st.integers(1, 999)))


@SETTINGS
@given(st.lists(quote, min_size=1, max_size=20))
def test_carry_forward_is_the_range_join(spark, quotes):
    """Quotes without a currency or a day are none, days quoted twice fan out."""
    rows = [(c, None if d is None else dt.date(2026, 1, 1) + dt.timedelta(days=d), None if r is None else Decimal(r) / 100)
            for c, d, r in quotes]
    q = spark.createDataFrame(rows, "currency string, rate_date date, rate_to_usd decimal(19,6)")
    got = carry_forward(q, "currency", "rate_date", ["rate_to_usd"]).collect()
    expect = []
    hi = max((r[1] for r in rows if r[1] is not None), default=None)
    good = [r for r in rows if None not in r[:2]]
    for c in {r[0] for r in good}:
        mine = [r for r in good if r[0] == c]
        day = min(r[1] for r in mine)
        while day <= hi:
            on = max(r[1] for r in mine if r[1] <= day)
            expect += [(day, c, None if r[2] is None else r[2].quantize(Decimal("0.000001")), on, on != day)
                       for r in mine if r[1] == on]
            day += dt.timedelta(days=1)
    assert sorted(map(tuple, got), key=str) == sorted(expect, key=str)
    most = carry_forward_rows(q, "currency", "rate_date")
    assert most >= len(expect)
    if len({r[:2] for r in good}) == len(good):
        assert most == len(expect)
