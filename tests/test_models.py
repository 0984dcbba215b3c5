"""Silver and gold models on hand-made bronze rows."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera.plans import gold
from tessera.plans.product import Product
from tessera.plans.snapshot import snapshot
from tessera.types import POS_ORDERS_SCHEMA, WEB_ORDER_DDL

D = dt.date


def _bronze(spark, extra_published=()):
    cust = spark.createDataFrame([
        ("C1", "Ann", " Ann@X.com ", " u.k. ", "premium", "gold", "1"),
        ("C1", "Ann", " Ann@X.com ", " u.k. ", "premium", "gold", "1"),   # resend
        ("C2", "Noemail", None, "USA", "value", "basic", "2"),
        ("C3", "Bob", "bob@x.com", "singapore", "new", "silver", "3"),
    ], "customer_id string, name string, email string, country string, marketing_segment string, "
       "loyalty_tier string, nation_key string")
    def o(oid, cid, pid, day, ccy, qty, price, seq, status="shipped"):
        return (oid, cid, pid, day, "counter", "S1", ccy, 0.0, 0.0, 0.0, "card", False, None,
                qty, price, status, seq)
    orders = spark.createDataFrame([
        o("O1", "C1", "P1", "2026-07-04", "GBP", 2, 10.0, 1),
        o("O1", "C1", "P1", "2026-07-04", "GBP", 3, 10.0, 2),      # latest event wins
        o("O2", "C2", "P2", "2026-07-06", "USD", 0, 5.0, 1),       # quarantined: quantity
        o("O3", "C3", "P1", "2026-07-03", "USD", 1, None, 1),      # quarantined: price
        o("O4", "C3", "P1", "2026-07-03", "USD", None, 3.0, 1),    # NULL quantity: neither side
    ], POS_ORDERS_SCHEMA)
    webc = spark.createDataFrame([("ANN@x.com", "Ann", "UK", "2019-01-15T09:00:00Z"),
                                  ("cy@x.com", "Cy", "US", "2019-02-15T09:00:00Z")],
                                 "email string, full_name string, country string, signup_ts string")
    L = lambda n, p, q, u: (n, p, q, Decimal(u))
    webo = spark.createDataFrame([
        ("W1", "cy@x.com", "2026-07-01T03:30:00+08:00", "completed", [L(1, "P9", 1, "5"), L(2, "P1", 2, "7.5")]),
        ("W2", "ANN@x.com", "2026-07-03T12:00:00+00:00", "cancelled", [L(1, "P2", 1, "4")]),
        ("W3", "ANN@x.com", "2026-07-03T12:00:00+00:00", "completed", []),
        ("W4", "ANN@x.com", "2026-07-03T12:00:00+00:00", "completed", None),
    ], WEB_ORDER_DDL)
    pub = [("P1", "One", "ECONOMY", "Essentials", "Core", 9.99),
           ("P2", "Two", "SMALL", "Accessories", "Peripheral", 1.5), *extra_published]
    hier = spark.createDataFrame(pub, "product_id string, product_name string, category string, "
                                      "department string, segment string, list_price_usd double")
    days = [D(2026, 6, 29), D(2026, 6, 30), D(2026, 7, 1), D(2026, 7, 2), D(2026, 7, 3), D(2026, 7, 6)]
    fx = spark.createDataFrame([("USD", d, 1.0) for d in days] + [("GBP", d, 1.27) for d in days],
                               "currency string, rate_date date, rate_to_usd double")
    return {"bronze_pos_customers": cust, "bronze_pos_orders": orders, "bronze_web_customers": webc,
            "bronze_web_orders": webo, "bronze_ref_product_hierarchy": hier, "bronze_ref_fx_rates": fx}


@pytest.fixture(scope="module")
def product(spark):
    return Product(_bronze(spark))


def test_silver(product):
    assert product.silver_customers.count() == 3
    so = product.silver_orders.collect()
    assert [(r.order_id, r.quantity, r.amount) for r in so] == [("O1", 3, Decimal("30.0000"))]
    q = {r.order_id: r.quarantine_reason for r in product.silver_quarantine_orders.collect()}
    assert q == {"O2": "non_positive_quantity", "O3": "missing_unit_price"}
    lines = product.silver_web_order_lines.collect()
    assert len(lines) == 3                               # empty and NULL baskets produce no line
    assert {r.order_date for r in lines if r.web_order_id == "W1"} == {D(2026, 6, 30)}


def test_fct_orders_carried_rate(product):
    r = product.fct_orders.collect()[0]
    assert (r.rate_to_usd, r.rate_is_carried, r.amount_usd) == (Decimal("1.270000"), True, Decimal("38.1000"))


def test_fct_sales(product):
    rows = {(r.sale_id, r.product_id): r for r in product.fct_sales.collect()}
    assert set(rows) == {("O1", "P1"), ("W1", "P9"), ("W1", "P1"), ("W2", "P2")}
    assert rows[("O1", "P1")].party_key == "email:ann@x.com"
    assert rows[("W2", "P2")].is_cancelled and rows[("W2", "P2")].party_key == "email:ann@x.com"
    assert rows[("W1", "P9")].party_key == "email:cy@x.com"


def test_dims(product):
    prods = {r.product_id: r for r in product.dim_product.collect()}
    assert set(prods) == {"P1", "P2", "P9"}
    assert prods["P9"].department == "Unallocated" and prods["P9"].list_price_usd is None
    assert product.dim_product.schema["list_price_usd"].dataType.simpleString() == "decimal(19,4)"
    assert {r.country: r.country_name for r in product.dim_country.collect()} == \
        {"GB": "United Kingdom", "US": "United States", "SG": "Singapore"}
    labels = {r.date_key: r.fiscal_quarter_label for r in product.dim_date.collect()}
    assert labels == {D(2026, 6, 30): "FY27 Q1", D(2026, 7, 3): "FY27 Q2", D(2026, 7, 4): "FY27 Q2"}


def test_revenue_summary(product):
    rows = product.fct_revenue_summary.collect()
    total = {k: sum(getattr(r, k) for r in rows) for k in ["revenue_usd", "cancelled_revenue_usd", "sale_lines"]}
    assert total == {"revenue_usd": Decimal("58.1000"), "cancelled_revenue_usd": Decimal("4.0000"),
                     "sale_lines": 4}
    un = [r for r in rows if r.customer_segment == "Unsegmented"]
    assert {(r.department, r.fiscal_quarter_label) for r in un} == \
        {("Unallocated", "FY27 Q1"), ("Essentials", "FY27 Q1")}
    carried = sum(r.revenue_at_carried_rate for r in rows)
    assert carried == Decimal("38.1000")


def test_eager_and_joined_builds_agree(product):
    joined = gold.revenue_summary_joined(product.fct_sales, product.dim_date, product.dim_product,
                                         product.dim_party)
    assert sorted(product.fct_revenue_summary.collect()) == sorted(joined.collect())


def test_null_published_id_hides_unpublished(spark):
    p = Product(_bronze(spark, extra_published=[(None, "ghost", "X", "Home", "Core", 1.0)]))
    assert p.dim_product.filter(F.col("department") == "Unallocated").count() == 0
    joined = gold.revenue_summary_joined(p.fct_sales, p.dim_date, p.dim_product, p.dim_party)
    assert sorted(p.fct_revenue_summary.collect()) == sorted(joined.collect())
    # the unpublished line drops out of the summary, exactly as NOT IN + inner join do
    assert snapshot(p.fct_revenue_summary).collect()[0].sale_lines == 3


@pytest.mark.parametrize("extra", [(), ((None, "ghost", "X", "Home", "Core", 1.0),)])
def test_summary_from_lines_equals_summary_from_fact(spark, extra):
    p = Product(_bronze(spark, extra_published=list(extra)))
    from_lines = gold.revenue_summary_from_lines(p.sales_lines, p.silver_product_hierarchy, p.dim_party)
    from_fact = gold.revenue_summary(p.fct_sales, p.silver_product_hierarchy, p.dim_party)
    assert sorted(from_lines.collect()) == sorted(from_fact.collect())


def test_groups_of_lines_hold_no_labels(product):
    parts = (product.silver_product_hierarchy, product.dim_party)
    for summary in (gold.revenue_summary_from_lines(product.sales_lines, *parts), gold.revenue_summary(product.fct_sales, *parts)):
        plan = summary._jdf.queryExecution().optimizedPlan().toString()
        keys = [line.split("Aggregate [", 1)[1].split("]", 1)[0] for line in plan.splitlines() if "Aggregate [" in line and "is_cancelled" in line]
        assert len(keys) == 1 and "label" not in keys[0] and "_sys#" not in keys[0]
        assert summary.where("fiscal_quarter_label <> concat(fiscal_year_label, ' Q', fiscal_quarter)").count() == 0
