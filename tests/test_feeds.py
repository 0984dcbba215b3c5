"""As-of on timestamps, one set pass, times that do not parse, the routed sink, stored builds that differ."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.dates import parsed_utc_date, utc_date
from tessera.operators.asof_ranges import asof_join
from tessera.operators.quarantine import routed
from tessera.operators.setpass import KeySet, set_counts
from tessera.operators.treediff import tree_difference
from tessera.plans.profiles import bronze_metrics
from tessera.session import scratch_path
from tessera.sources.testdata import TestData

T0 = dt.datetime(2026, 7, 1)


def _at(k):
    return None if k is None else T0 + dt.timedelta(microseconds=k)


def _asof(spark, facts, quotes):
    f = spark.createDataFrame([(i, k, _at(t), "x") for i, k, t in facts], "id long, k string, at timestamp, _kind string")
    q = spark.createDataFrame([(k, _at(t), v) for k, t, v in quotes], "k string, quoted timestamp, v long")
    got = asof_join(f, q, "k", "at", "quoted", ["v"])
    assert got.columns == ["id", "k", "at", "_kind", "quoted", "v"]
    return {r["id"]: (r["quoted"], r["v"]) for r in got.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_asof_equals_the_definition(spark, seed):
    pick = random.Random(seed)
    key = lambda: pick.choice(["hot"] * 10 + [None, "a", "b", "only facts", *[f"k{pick.randrange(40)}" for _ in range(10)]])
    facts = [(i, key(), pick.choice([None, pick.randrange(900)])if pick.random() < 0.1 else pick.randrange(900)) for i in range(700)]
    quotes = [(k, None if pick.random() < 0.05 else pick.randrange(900), v) for v in range(120) if (k := key()) != "only facts"]
    want = {}
    for i, k, t in facts:
        seen = [(u, v) for c, u, v in quotes if c == k and k is not None and u is not None and t is not None and u <= t]
        u, v = max(seen, default=(None, None))
        want[i] = (_at(u), v)
    assert _asof(spark, facts, quotes) == want
    assert any(v[0] for v in want.values()) and not all(v[0] for v in want.values())


def test_asof_carries_over_many_ranges(spark):
    facts = [(i, "hot" if i < 4000 else f"z{i % 7}", 10 + i) for i in range(5000)]
    got = _asof(spark, facts, [("hot", 5, 1), ("z3", 4, 2)])
    assert all(got[i] == (_at(5), 1) for i in range(4000))
    assert all(got[i][1] == (2 if i % 7 == 3 else None) for i in range(4000, 5000))


def test_asof_without_rows(spark):
    assert _asof(spark, [], [("a", 1, 1)]) == {}
    assert _asof(spark, [(1, "a", 1)], []) == {1: (None, None)}


def test_set_counts(spark):
    a = spark.createDataFrame([(1, "x"), (1, "y"), (2, None), (None, "x")], "n int, s string")
    b = spark.createDataFrame([("x",), ("z",), (None,)], "s string")
    got = {r["metric"]: r["value"] for r in set_counts([
        KeySet("numbers", a, "n"), KeySet("texts", a, "s"), KeySet("both", a, "s", 0), KeySet("both", b, "s", 1),
        KeySet("none", a.where("n > 5"), "n"), KeySet("apart", a.where("s = 'y'"), "s", 0), KeySet("apart", b, "s", 1)]).collect()}
    assert got == {"numbers": 2, "texts": 2, "both": 1, "none": 0, "apart": 0}


def test_bronze_metrics_exchange_keys_once(spark):
    plan = bronze_metrics(TestData(spark, "/root/testdata/sf0.001").bronze())._jdf.queryExecution().executedPlan().toString()
    # on (metric, key) and on (metric); the feeds' own joins and baskets are the adapter's
    assert plan.count("Exchange hashpartitioning(metric") == 2


def test_parsed_utc_date_gives_a_day_or_a_reason(spark):
    rows = [("2026-07-01T03:30:00+08:00", dt.date(2026, 6, 30), None), ("2026-07-01T12:00:00Z", dt.date(2026, 7, 1), None),
            ("2026-07-01T12:00:00", None, "time_without_offset"), ("2026-07-01", None, "time_without_offset"),
            ("soon", None, "unparseable_time"), ("2026-13-45T00:00:00Z", None, "unparseable_time"), ("", None, "missing_time"),
            ("  ", None, "missing_time"), (None, None, "missing_time")]
    df = spark.createDataFrame([(t,) for t, *_ in rows], "t string")
    got = [(r["t"], r["p"]["value"], r["p"]["error"]) for r in df.select("t", parsed_utc_date("t").alias("p")).collect()]
    assert got == rows
    fine = df.where(parsed_utc_date("t")["error"].isNull())
    assert fine.where(~parsed_utc_date("t")["value"].eqNullSafe(utc_date("t"))).count() == 0


def test_routed_sink_is_read_by_folder(spark):
    df = spark.createDataFrame([(1, 5), (2, 0), (3, None), (4, -1), (5, 7)], "id int, n int")
    rules = [("negative", F.col("n") < 0), ("not_positive", F.col("n") <= 0)]
    table = routed(df, rules, scratch_path(spark, "test/routed"))
    assert table.columns == ["id", "n", "verdict"]
    assert {r["id"]: r["verdict"] for r in table.collect()} == {1: "accepted", 2: "not_positive", 3: "unclassified", 4: "negative", 5: "accepted"}
    ok = table.where("verdict = 'accepted'")
    plan = ok._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(verdict" in plan and ok.count() == 2
    none = routed(df.limit(0), rules, scratch_path(spark, "test/routed"))
    assert none.count() == 0 and none.columns == ["id", "n", "verdict"]


def test_tree_difference(spark):
    rows = [(k, f"v{k % 9}" if k % 5 else None) for k in range(500)] + [(7, "twice"), (7, "twice"), (None, "x")]
    a = spark.createDataFrame(rows, "k int, v string")
    other = [(7, "changed") if r == (7, "v7") else r for r in rows if r[0] != 11]
    other.remove((7, "twice"))
    b = spark.createDataFrame(other + [(None, "x")], "k int, v string").select("v", "k")
    got = {(r["k"], r["v"], r["side"], r["times"]) for r in tree_difference(a, b, ["k"], fanout=8).collect()}
    assert got == {(11, "v2", "a", 1), (7, "changed", "b", 1), (7, "v7", "a", 1), (7, "twice", "a", 1), (None, "x", "b", 1)}
    assert tree_difference(a, a.select("*"), ["k"]).count() == 0
    with pytest.raises(ValueError):
        tree_difference(a, b.drop("v"), ["k"])
