"""Contracts counted in the write, tables stored by key, builds published whole."""

import pytest
from pyspark.sql import functions as F

from tessera.operators.contracts import Check, Observed, bucketed, evaluate
from tessera.plans import contract_suite as K
from tessera.plans.build import Run, land, run_bronze, run_gold, run_silver
from tessera.plans.catalog_feeds import _BUCKETED, _bucketed_feeds
from tessera.plans.product import Product
from tessera.plans.publish import Store, bound
from tessera.session import scratch_path

SF = "/root/testdata/sf0.001"
CHECKS = [Check("t", "k", "not_null"), Check("t", "v", "accepted_values", ("a", "b")), Check("t", "k", "unique"),
          Check("t", "v", "relationships", to_table="p", to_column="name"), Check("u", "k", "not_null")]


def _tables(spark):
    return {"t": spark.createDataFrame([(1, "a"), (1, "c"), (None, "c"), (2, None), (None, "b")], "k int, v string"),
            "p": spark.createDataFrame([("a",), (None,)], "name string"), "u": spark.createDataFrame([], "k int")}


def test_counts_come_with_the_write(spark):
    t = _tables(spark)["t"]
    seen = Observed(t, "t", CHECKS, {"odd": F.col("k") == 2})
    seen.frame.write.parquet(scratch_path(spark, "test/observed"))
    assert seen.rows == 5 and seen.counts == {"not_null_t_k": 2, "accepted_values_t_v": 2, "odd": 1}


def test_tests_on_keys_together_equal_each_apart(spark):
    tables = _tables(spark)
    got = {r["contract"]: r["failures"] for r in evaluate(tables.__getitem__, CHECKS).collect()}
    assert got == {"not_null_t_k": 2, "accepted_values_t_v": 2, "unique_t_k": 1, "relationships_t_v": 3, "not_null_u_k": 0}
    apart = evaluate(tables.__getitem__, CHECKS, stored_by_key=True)
    assert {r["contract"]: r["failures"] for r in apart.collect()} == got
    none = evaluate(lambda t: tables[t].limit(0), CHECKS)
    assert {r["failures"] for r in none.collect()} == {0} and none.count() == len(CHECKS)


def test_a_written_product_counts_its_rows_once(spark):
    names = ("silver_customers", "silver_orders", "silver_fx_daily", "silver_party", "fct_orders")
    p = Product.from_testdata(spark, SF, "sales").materialize(*names)
    checks = [c for c in K.SILVER_CHECKS + K.GOLD_CHECKS if c.table in names and c.test != "relationships"]
    told = {r["contract"]: r["failures"] for r in K.generic(p, checks).collect()}
    assert K.QUANTITY in p.observed and set(p.observed) - {K.QUANTITY} == {c.name for c in checks if c.test != "unique"}
    p.observed = {}
    assert told == {r["contract"]: r["failures"] for r in K.generic(p, checks).collect()}


def test_suite_has_few_exchanges(spark):
    p = Product.from_testdata(spark, SF, "sales").materialize(
        "silver_customers", "silver_orders", "silver_web_order_lines", "silver_fx_daily", "silver_party", "fct_orders", "fct_sales",
        "dim_product", "dim_date", "dim_country", "fct_daily_revenue", "fct_revenue_summary")
    df = K.suite(p)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(contract") == 2
    assert plan.count("Exchange ") <= 20, plan.count("Exchange ")
    assert df.where("not passed").count() == 0


def test_tables_stored_by_key_need_no_exchange(spark):
    feeds = _bucketed_feeds(spark, SF, 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = evaluate(feeds.__getitem__, _BUCKETED, stored_by_key=True)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan and "Exchange SinglePartition" in plan
    assert bucketed(spark.range(10).selectExpr("id % 3 AS k"), "k", 2).count() == 10


def test_half_a_build_is_never_seen(spark, tmp_path, monkeypatch):
    store = Store(spark, f"file://{tmp_path}/store")
    with pytest.raises(LookupError):
        store.tables()
    first = store.stage("one")
    for name, n in (("a", 3), ("b", 4)):
        spark.range(n).write.parquet(f"{first}/{name}")
    assert store.publish(first, ["a", "b"]) == 1

    def build(folder):
        spark.range(30).write.parquet(f"{folder}/a")
        bad = spark.range(5).withColumn("x", F.raise_error(F.lit("executor lost for good")))
        bad.write.parquet(f"{folder}/b")

    second = store.stage("two")
    with pytest.raises(Exception, match="executor lost"):
        build(second)
    assert {t: df.count() for t, df in store.tables().items()} == {"a": 3, "b": 4}
    with pytest.raises(ValueError, match="b is not written whole"):
        store.publish(second, ["a", "b"])
    assert store.versions() == [1]

    third = store.stage("three")
    for name, n in (("a", 5), ("b", 6)):
        spark.range(n).write.parquet(f"{third}/{name}")
    before = store.register("test_published")
    assert store.publish(third, ["a", "b"]) == 2
    assert {t: df.count() for t, df in bound(spark, before).items()} == {"a": 3, "b": 4}  # as registered
    assert {t: df.count() for t, df in bound(spark, store.register("test_published")).items()} == {"a": 5, "b": 6}
    assert store.tables(1)["a"].count() == 3
    # another writer that saw the same last version loses
    monkeypatch.setattr(store, "versions", lambda: [1])
    with pytest.raises(RuntimeError):
        store.publish(third, ["a", "b"])


def test_build_on_bound_names(spark, tmp_path):
    land(spark, SF, f"{tmp_path}/landing", "2026-07-01")
    store = Store(spark, f"file://{tmp_path}/store")
    run = Run(spark, store.stage())
    run_bronze(run, f"{tmp_path}/landing", "2026-07-01")
    run_silver(run)
    out = run_gold(run)
    assert "contract_failures" not in out["snapshot"]
    assert {c.name for c in K.SILVER_CHECKS + K.GOLD_CHECKS if c.test in ("not_null", "accepted_values")} <= set(run.observed)
    store.publish(run.root, [n for n in run.rows])
    tables = bound(spark, store.register("test_build"))
    again = Product(tables, spark)
    assert again.silver_customers.count() == tables["silver_customers"].count() > 0
    assert again.fct_revenue_summary.exceptAll(tables["fct_revenue_summary"].select(*again.fct_revenue_summary.columns)).count() == 0


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    from tessera.operators import contracts
    assert contracts.buckets_for(0) == contracts.buckets_for(8_000_000) == 8
    assert contracts.buckets_for(36_000_001) == 37
    monkeypatch.setattr(contracts, "BUCKET_ROWS", 500)
    feeds = _bucketed_feeds(spark, SF)
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert {len(df.inputFiles()) <= -(-lines // 500) for df in feeds.values()} == {True}
    assert len(feeds["bronze_pos_orders"].inputFiles()) > 8
