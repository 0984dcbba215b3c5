"""Hot keys: one buyer holding a third of all lines.

With broadcasts disabled and AQE's skew thresholds lowered to this tiny
size, the party lookup join in fct_sales is split by AQE (the final plan
marks the sort-merge join ``skew=true``), and results stay whole."""

from decimal import Decimal

from pyspark.sql import functions as F

from tessera.plans import gold


def _conf(spark, **kv):
    old = {k: spark.conf.get(k, None) for k in kv}
    for k, v in kv.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_buyer_is_split_and_kept_whole(spark):
    n = 30000
    lines = (spark.range(n)
             .withColumn("_sys", F.lit("POS"))
             .withColumn("_k", F.when(F.col("id") % 3 == 0, F.lit("C0"))
                              .otherwise(F.concat(F.lit("C"), (F.col("id") % 997 + 1).cast("string"))))
             .select("_sys", "_k",
                     F.col("id").cast("string").alias("sale_id"),
                     F.lit("P1").alias("product_id"),
                     F.current_date().alias("order_date"),
                     F.lit("POS").alias("channel_system"),
                     F.lit(False).alias("is_cancelled"),
                     F.lit(1).cast("bigint").alias("quantity"),
                     F.lit(Decimal("1.0000")).cast("decimal(19,4)").alias("amount"),
                     F.lit("USD").alias("currency"),
                     F.lit(Decimal("1")).cast("decimal(19,6)").alias("rate_to_usd"),
                     F.lit(False).alias("rate_is_carried"),
                     F.lit(Decimal("1.0000")).cast("decimal(19,4)").alias("amount_usd")))
    party = (spark.range(0, 998)
             .select(F.concat(F.lit("email:p"), F.col("id").cast("string")).alias("party_key"),
                     F.lit(None).cast("string").alias("email"),
                     F.concat(F.lit("C"), F.col("id").cast("string")).alias("pos_customer_id"),
                     F.lit(True).alias("in_pos"), F.lit(False).alias("in_web")))
    old = _conf(spark, **{
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    })
    try:
        sales = gold.fct_sales(lines, party).select("party_key", "sale_id")
        rows = sales.collect()
        assert len(rows) == n                                      # nothing dropped
        assert sum(r.party_key == "email:p0" for r in rows) == n // 3
        plan = sales._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan, plan
    finally:
        _restore(spark, old)


def test_hot_order_key_is_split(spark):
    """Line items of which one order holds a third: the order join of the
    adapter is split by adaptive execution, and no line is lost."""
    from tessera.sources.testdata import TestData
    n = 60000
    lines = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(2)).otherwise(F.col("id") % 5000 * 2).cast("long").alias("l_orderkey"),
        F.col("id").alias("l_partkey"), F.col("id").alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        F.lit(1.0).alias("l_quantity"), F.lit(2.0).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"),
        F.lit(0.0).alias("l_tax"), F.lit("N").alias("l_returnflag"))
    orders = spark.range(5000).select(
        (F.col("id") * 2).alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
        F.current_timestamp().alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority"))
    data = TestData(spark, "")
    data._tables = {"lineitem": lines, "orders": orders}
    old = _conf(spark, **{
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    try:
        df = data._lines.select("l_partkey", "o_custkey")
        assert len(df.collect()) == n
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        _restore(spark, old)
