from decimal import Decimal


from tessera.operators.contracts import Check, evaluate, lacking_columns, money_type_offenders, violations
from tessera.plans import contract_suite as K
from tessera.plans.snapshot import against, build_evidence, figures, reconcile
from tessera.types import BRONZE_CONTRACT


def test_declared_counts():
    assert len(K.SILVER_CHECKS) == 12 and len(K.GOLD_CHECKS) == 48


def test_generic_negative_controls(spark):
    parent = spark.createDataFrame([("a",), ("b",), (None,)], "id string")
    child = spark.createDataFrame([("a", "US"), ("a", "FR"), ("z", None), (None, "GB")],
                                  "id string, country string")
    models = {"parent": parent, "child": child}
    checks = [Check("child", "id", "unique"), Check("child", "id", "not_null"),
              Check("child", "country", "accepted_values", ("US", "GB")),
              Check("child", "id", "relationships", to_table="parent", to_column="id"),
              Check("parent", "id", "unique")]
    got = {r.contract: r.failures for r in evaluate(models.__getitem__, checks).collect()}
    assert got == {"unique_child_id": 1, "not_null_child_id": 1, "accepted_values_child_country": 1,
                   "relationships_child_id": 1, "unique_parent_id": 0}


def test_money_types():
    from pyspark.sql import types as T
    s = T.StructType([T.StructField("amount_usd", T.DecimalType(19, 4)),
                      T.StructField("list_price_usd", T.DoubleType()),
                      T.StructField("rate_to_usd", T.FloatType()), T.StructField("units", T.LongType())])
    assert money_type_offenders({"t": s}) == [("t", "list_price_usd", "double"), ("t", "rate_to_usd", "float")]


def test_lacking_columns(spark):
    ok = {t: [c.upper() for c in cols] + ["extra"] for t, cols in BRONZE_CONTRACT.items()}
    assert lacking_columns(spark, BRONZE_CONTRACT, ok).count() == 0
    broken = dict(ok)
    del broken["bronze_ref_fx_rates"]
    broken["bronze_web_orders"] = ["web_order_id", "email"]
    got = {tuple(r) for r in lacking_columns(spark, BRONZE_CONTRACT, broken).collect()}
    assert got == ({("bronze_ref_fx_rates", c, False) for c in BRONZE_CONTRACT["bronze_ref_fx_rates"]}
                   | {("bronze_web_orders", c, True) for c in ("placed_at", "status", "lines")})


def test_violations_are_the_rows_behind_the_counts(spark):
    t = spark.createDataFrame([("a", 1, "US"), ("a", 2, "FR"), ("b", None, None), (None, 3, "GB")], "k string, n int, c string")
    models = {"t": t, "p": spark.createDataFrame([("a",), (None,)], "id string")}
    rows = lambda *c, **kw: sorted((tuple(r) for r in violations(models.__getitem__, Check("t", *c, **kw)).collect()), key=str)
    assert rows("k", "unique") == [("a", 1, "US"), ("a", 2, "FR")]
    assert rows("n", "not_null") == [("b", None, None)]
    assert rows("c", "accepted_values", ("US", "GB")) == [("a", 2, "FR")]
    assert rows("k", "relationships", to_table="p", to_column="id") == [("b", None, None)]


class _P:
    """Just enough of a Product for the singular contracts."""
    def __init__(self, **m):
        self.__dict__.update(m)


def _summary(spark, rows):
    return spark.createDataFrame(rows, "channel_system string, department string, customer_segment string, "
                                       "fiscal_quarter_label string, revenue_usd decimal(29,4), "
                                       "cancelled_revenue_usd decimal(29,4), sale_lines bigint")


def test_both_systems_each_probe_and_empty(spark):
    good = _summary(spark, [("WEB", "Unallocated", "Unsegmented", "FY27 Q1", Decimal(5), Decimal(1), 1),
                            ("POS", "Home", "new", "FY27 Q2", Decimal(7), Decimal(0), 1)])
    assert not any(r.failed for r in K.both_systems(_P(fct_revenue_summary=good)).collect())
    pos_only = _summary(spark, [("POS", "Home", "new", "FY27 Q2", Decimal(7), Decimal(0), 1)])
    failed = {r.problem for r in K.both_systems(_P(fct_revenue_summary=pos_only)).collect() if r.failed}
    assert failed == {"no WEB revenue", "no cancelled revenue", "unallocated product revenue vanished",
                      "unsegmented customer revenue vanished", "the pack covers only one fiscal quarter"}
    empty = _summary(spark, [])
    assert all(r.failed for r in K.both_systems(_P(fct_revenue_summary=empty)).collect())


def test_revenue_conserved(spark):
    sales = spark.createDataFrame([(Decimal("1.0001"),), (Decimal("2"),)], "amount_usd decimal(19,4)")
    eq = _summary(spark, [("WEB", "x", "y", "q", Decimal("2"), Decimal("1.0001"), 2)])
    off = _summary(spark, [("WEB", "x", "y", "q", Decimal("2"), Decimal("1.0000"), 2)])
    empty = _summary(spark, [])
    f = lambda s: K.revenue_conserved(_P(fct_sales=sales, fct_revenue_summary=s)).collect()[0].conserved
    assert f(eq) is True and f(off) is False and f(empty) is False


def test_figures_against_wanted_ones(spark):
    table = lambda rows: spark.createDataFrame(rows, "figure string, value string")
    got = {r.figure: r.verdict for r in against(
        table([("revenue_usd", "129341157.67"), ("sale_lines", "474045"), ("bad", "n/a"), ("null", None), ("more", "1")]),
        table([("revenue_usd", "129341157.6700"), ("sale_lines", "474044"), ("bad", "1"), ("null", "1"), ("gone", "5")])).collect()}
    assert got == {"revenue_usd": "equal", "sale_lines": "differs", "bad": "not a number", "null": "unpublished",
                   "gone": "unpublished", "more": "unasked"}
    snap = spark.createDataFrame([(Decimal("1.5"), None, 3)], "revenue_usd decimal(29,4), cancelled_revenue_usd decimal(29,4), sale_lines long")
    assert {r.figure: r.value for r in figures(snap).collect()} == {
        "revenue_usd": "1.5000", "cancelled_revenue_usd": None, "sale_lines": "3"}


def test_reconcile(spark):
    ten, one, c = Decimal("10"), Decimal("1"), ["x", "y"]
    builds = spark.createDataFrame([
        ("base", ten, one, 5, c, [], None),
        ("same", ten, one, 5, ["y", "x"], [], None),
        ("zeros", Decimal(0), Decimal(0), 0, c, [], None),
        ("nulls", None, None, None, c, ["x"], None),
        ("other", Decimal("11"), one, 5, c, [], None),
        ("fewer contracts", ten, one, 5, ["x"], [], None),
        ("failing", ten, one, 5, c, ["y"], None),
        ("absent", None, None, None, None, None, "not here"),
    ], "build string, revenue_usd decimal(29,4), cancelled_revenue_usd decimal(29,4), sale_lines bigint, "
       "contracts array<string>, failed array<string>, gap string")
    r = {x.build: x for x in reconcile(builds, "base").collect()}
    assert {k: x.verdict for k, x in r.items()} == {
        "base": "agrees", "same": "agrees", "zeros": "no evidence", "nulls": "no evidence", "other": "differs",
        "fewer contracts": "differs", "failing": "failed contracts", "absent": "gap"}
    assert r["failing"].agrees_with_base and r["failing"].contract_failures == 1
    assert not r["zeros"].has_evidence and r["absent"].contract_failures == 0


def test_build_evidence(spark):
    sales = spark.createDataFrame([(Decimal("7"),), (Decimal("3"),)], "amount_usd decimal(19,4)")
    good = _summary(spark, [("WEB", "d", "s", "q", Decimal(5), Decimal(1), 1), ("POS", "d", "s", "q", Decimal(4), Decimal(0), 1)])
    short = _summary(spark, [("POS", "d", "s", "q", Decimal(4), Decimal(0), 1)])
    got = {r.build: r for r in build_evidence({"good": good, "short": short, "empty": good.limit(0)}, sales, {"gone": "why"}).collect()}
    assert got["good"].failed == [] and got["good"].sale_lines == 2 and len(got["good"].contracts) == 2
    assert len(got["short"].failed) == 2 and len(got["empty"].failed) == 2
    assert got["gone"].gap == "why" and got["gone"].revenue_usd is None


def test_quantity_fiscal_country_negative_controls(spark):
    import datetime as dt
    orders = spark.createDataFrame([("O1", 2), ("O2", 0), ("O3", None)], "order_id string, quantity bigint")
    q = K.quantity_positive(_P(silver_orders=orders)).collect()[0]
    assert (q.checked, q.violations) == (3, 2)
    dd = spark.createDataFrame([(dt.date(2026, 7, 1), 2026, 7, 2027), (dt.date(2026, 8, 1), 2026, 8, 2026),
                                (dt.date(2026, 2, 1), 2026, 2, 2026)],
                               "date_key date, calendar_year int, calendar_month int, fiscal_year int")
    f = K.fiscal_not_calendar(_P(dim_date=dd)).collect()[0]
    assert (f.checked, f.violations) == (2, 1)
    c = lambda rows: spark.createDataFrame(rows, "country string")
    got = {r.country: r.resolves for r in K.countries_resolve(_P(
        dim_party=c([("US",), (None,)]), dim_customer=c([("GB",)]), fct_daily_revenue=c([("FR",)]),
        dim_country=c([("US",), ("GB",)]))).collect()}
    assert got == {"US": True, "GB": True, "FR": False}


def test_fused_unique_pass_counts_like_separate_checks(spark):
    df = spark.createDataFrame([("a", None, "US"), ("a", "x", "FR"), ("b", None, "GB"), (None, "y", None),
                                (None, None, "XX"), ("c", "z", "US")], "k string, v string, c string")
    checks = [Check("t", "k", "unique"), Check("t", "k", "not_null"), Check("t", "v", "not_null"),
              Check("t", "c", "accepted_values", ("US", "GB")), Check("t", "v", "unique")]
    got = {r.contract: r.failures for r in evaluate({"t": df}.__getitem__, checks).collect()}
    assert got == {"unique_t_k": 1, "not_null_t_k": 2, "not_null_t_v": 3,
                   "accepted_values_t_c": 2, "unique_t_v": 0}


def test_measures_match_snapshot(spark):
    """K14: every slicer's members add up to the snapshot, NULL members and
    NULL measure values included; an empty summary agrees NULL-safely."""
    from tessera.plans.snapshot import SLICERS, measures_match_snapshot
    ddl = ("fiscal_year_label string, customer_segment string, product_segment string, "
           "channel_system string, revenue_usd decimal(29,4), cancelled_revenue_usd decimal(29,4), "
           "sale_lines bigint")
    rows = [("FY27", "new", "Core", "POS", Decimal("10.0001"), Decimal("0"), 3),
            ("FY27", None, "Core", "WEB", Decimal("5"), Decimal("2.5"), 2),
            ("FY28", "value", None, "WEB", None, Decimal("1"), 1)]
    got = measures_match_snapshot(spark.createDataFrame(rows, ddl)).collect()
    assert sorted(r.slicer for r in got) == sorted(SLICERS)
    for r in got:
        assert (r.revenue_usd, r.cancelled_revenue_usd, r.sale_lines) == \
            (Decimal("15.0001"), Decimal("3.5"), 6)
        assert (r.snapshot_revenue_usd, r.snapshot_sale_lines) == (Decimal("15.0001"), 6)
        assert r.agrees is True
    empty = measures_match_snapshot(spark.createDataFrame([], ddl)).collect()
    assert len(empty) == len(SLICERS) and all(r.agrees and r.sale_lines is None for r in empty)


def test_keys_are_held_without_the_names_of_tests(spark):
    from tessera.operators.contracts import Check, evaluate
    t = {"a": spark.createDataFrame([(1, 1), (1, 2), (None, 3)], "k int, p int"), "b": spark.createDataFrame([(1,), (2,)], "k int")}
    got = evaluate(t.__getitem__, [Check("a", "k", "unique"), Check("a", "p", "relationships", to_table="b", to_column="k")])
    assert {(r.contract, r.failures) for r in got.collect()} == {("unique_a_k", 1), ("relationships_a_p", 1)}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "[_number" in plan and "Aggregate [contract" not in plan
