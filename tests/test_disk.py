"""What a query leaves on the disks while it runs: shuffle files go with the
write that made them, and written models with their last reader."""

import os
import time
from decimal import Decimal

from pyspark.sql import functions as F

from tessera.plans import catalog, gold
from tessera.plans.product import Product
from tessera.plans.snapshot import build_evidence
from tessera.session import DROP_SHUFFLES

SF = "/root/testdata/sf0.001"


def _shuffle_files(spark) -> set[str]:
    dirs = spark._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    return {f for top in dirs for _, _, names in os.walk(str(top)) for f in names if f.startswith("shuffle_")}


def _left(spark, before: set[str]) -> set[str]:
    for _ in range(40):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    return left


def test_materialized_models_leave_no_shuffle(spark):
    setting = spark.conf.get(DROP_SHUFFLES, None)
    p = Product.from_testdata(spark, SF).materialize("silver_customers")
    assert p.silver_customers.count() > 0
    assert spark.conf.get(DROP_SHUFFLES, None) == setting
    before = _shuffle_files(spark)
    Product.from_testdata(spark, SF).materialize("silver_customers", "silver_party")
    assert not _left(spark, before)


def test_builds_run_one_at_a_time(spark):
    """What is returned reads the builds' rows alone: no build, no shuffle."""
    df = catalog.QUERIES["reconcile_builds"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" not in plan and "sale_id" not in plan and "party_key" not in plan and "Exchange hashpartitioning" not in plan
    assert {r.build: r.verdict for r in df.collect()} == {
        "sales": "agrees", "lines": "agrees", "joins": "agrees", "lost_cancellations": "differs",
        "nothing_built": "no evidence", "not_run": "gap"}


def test_evidence_leaves_no_shuffle(spark):
    lines = spark.range(1000).select((F.col("id") % 50).alias("k"), F.lit("POS").alias("channel_system"))
    summary = lines.groupBy("k", "channel_system").agg(F.count(F.lit(1)).alias("sale_lines")).withColumns(
        {"revenue_usd": F.lit(Decimal("2")).cast("decimal(29,4)"), "cancelled_revenue_usd": F.lit(Decimal("0")).cast("decimal(29,4)")})
    sales = spark.createDataFrame([(Decimal("100"),)], "amount_usd decimal(19,4)")
    before = _shuffle_files(spark)
    out = build_evidence({"a": summary, "b": summary.where("k < 25")}, sales)
    assert not _left(spark, before)
    assert {r.build: (r.revenue_usd, r.sale_lines, r.failed) for r in out.collect()} == {
        "a": (Decimal("100"), 1000, ["both_selling_systems_reach_the_pack"]),
        "b": (Decimal("50"), 500, ["both_selling_systems_reach_the_pack", "revenue_summary_loses_no_revenue"])}


def test_dropped_model_is_deleted_and_built_again(spark):
    p = Product.from_testdata(spark, SF).materialize("silver_customers")
    path, n = p._written["silver_customers"], p.silver_customers.count()
    assert os.path.isdir(path)
    p.drop("silver_customers")
    assert not os.path.exists(path) and p.silver_customers.count() == n


def _lines_and_parties(spark):
    """Buyers that no, one and several parties answer to, and a party key that
    comes twice or is missing."""
    day, usd = F.lit("2026-07-02").cast("date"), "decimal(19,4)"
    lines = spark.createDataFrame(
        [("POS", "C1", "P1", False, 1), ("POS", "C1", "P2", False, 2), ("POS", "C2", "P1", False, 4), ("POS", "C9", "P1", False, 8),
         ("WEB", "a@x", "P1", True, 16), ("WEB", "b@x", "P2", False, 32), ("POS", None, "P1", False, 64)],
        "_sys string, _k string, product_id string, is_cancelled boolean, quantity bigint").select(
        "*", F.col("_k").alias("sale_id"), day.alias("order_date"), F.col("_sys").alias("channel_system"),
        F.col("quantity").cast(usd).alias("amount"), F.lit("USD").alias("currency"),
        F.lit(1).cast("decimal(19,6)").alias("rate_to_usd"), F.lit(False).alias("rate_is_carried"), F.col("quantity").cast(usd).alias("amount_usd"))
    party = spark.createDataFrame(
        [("email:a@x", "a@x", "C1", True, "new", "US"), ("email:a@x", "a@x", "C2", True, "value", "GB"),
         (None, "b@x", None, True, "premium", None), ("email:b@x", "b@x", None, True, None, "SG"), ("email:c@x", "c@x", "C1", False, "new", "US")],
        "party_key string, email string, pos_customer_id string, in_web boolean, marketing_segment string, country string")
    hierarchy = spark.createDataFrame([("P1", "Home", "Core")], "product_id string, department string, segment string")
    return lines, hierarchy, party


def test_lines_build_with_repeated_and_missing_party_keys(spark):
    lines, hierarchy, party = _lines_and_parties(spark)
    from_lines = gold.revenue_summary_from_lines(lines, hierarchy, party)
    from_fact = gold.revenue_summary(gold.fct_sales(lines, party), hierarchy, party)
    assert from_lines.count() and sorted(map(str, from_lines.collect())) == sorted(map(str, from_fact.collect()))


def test_groups_of_lines_are_shuffled_to_the_parties_once(spark):
    lines, hierarchy, party = _lines_and_parties(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = gold.revenue_summary_from_lines(lines, hierarchy, party)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.splitlines()
    keyed = [below for line, below in zip(lines, lines[1:]) if "Exchange hashpartitioning(party_key" in line]
    assert len(keyed) == 1 and " r#" not in keyed[0], plan   # the lookup's, not the groups' with their sums
