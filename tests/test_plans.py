"""Plan checks: the physical plans stay JVM-side, free of cross joins and
nested-loop joins, de-duplicate with a partial group limit, and read pruned
columns."""

import pytest

import __spark_entry__ as entry
from tessera.plans import catalog

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_cross_join_no_python(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    bad = [f for f in FORBIDDEN if f in plan]
    assert not bad, (name, bad)


def test_dedupe_uses_partial_group_limit(spark):
    plan = _plan(entry.queries()["dedupe_latest"](spark, SF))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_scans_are_pruned(spark):
    import re
    df = entry.queries()["silver_orders"](spark, SF)
    txt = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    schemas = re.findall(r"ReadSchema: (struct<l_[^\n]*)", txt)
    assert schemas, txt
    for s in schemas:                       # columns no POS order needs are never read
        assert "l_shipdate" not in s and "l_linestatus" not in s


def test_fx_grid_is_broadcast(spark):
    plan = _plan(entry.queries()["fct_orders"](spark, SF))
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan


def test_checks_fold_rows_without_scalar_subqueries(spark):
    """Reconciliation and K14 compute each snapshot once: their plans hold no
    scalar subquery (one per figure would re-run the build it reads)."""
    from decimal import Decimal

    from tessera.plans.snapshot import measures_match_snapshot, reconcile
    one = Decimal(1)
    snaps = spark.createDataFrame(
        [("a", one, one, 1, ["c"], [], None), ("b", one, one, 2, ["c"], [], None)],
        "build string, revenue_usd decimal(29,4), cancelled_revenue_usd decimal(29,4), sale_lines bigint, "
        "contracts array<string>, failed array<string>, gap string")
    summary = spark.createDataFrame(
        [("FY27", "new", "Core", "POS", one, one, 1)],
        "fiscal_year_label string, customer_segment string, product_segment string, channel_system string, "
        "revenue_usd decimal(29,4), cancelled_revenue_usd decimal(29,4), sale_lines bigint")
    for df in [reconcile(snaps, "a"), measures_match_snapshot(summary)]:
        df.collect()
        assert "Subquery" not in _plan(df)


def test_summary_groups_before_the_party_join(spark):
    """Lines are summed per quarter, rollup and buyer before they are shuffled
    to the party, and that leaves far fewer groups than lines."""
    from tessera.plans.gold import GROUP_KEYS, _line_sums, _rolled_up
    p = catalog._pm(spark, "/root/testdata/sf0.01", *catalog._SALES)
    groups = _line_sums(_rolled_up(p.sales_lines, p.silver_product_hierarchy, True), [*GROUP_KEYS, "_sys", "_k"])
    assert groups.count() < 0.8 * p.sales_lines.count()


def test_dirty_feed_keeps_the_last_quotes(spark):
    from tessera.plans.catalog import _dirty_quotes
    from tessera.plans.product import Product
    rates = spark.sql("SELECT c AS currency, CAST(d AS STRING) AS rate_date, 1.5D AS rate_to_usd "
                      "FROM (SELECT explode(array('USD', 'SGD')) AS c), (SELECT explode(sequence(DATE'2020-01-01', DATE'2021-06-30')) AS d)")
    got = _dirty_quotes(Product({"bronze_ref_fx_rates": rates}, spark)).groupBy("currency").agg({"*": "count", "rate_date": "max"}).collect()
    assert {(r[0], r[1], str(r[2])) for r in got} == {("USD", 547, "2021-06-30"), ("SGD", 182, "2021-06-30")}
