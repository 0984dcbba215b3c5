"""Lineage read off the plan."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.plans.lineage import column_lineage, tables_read
from tessera.session import scratch_path


def _table(spark, name, df):
    path = scratch_path(spark, "test/lineage") + f"/{name}"
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_columns_come_from_scans(spark):
    a = _table(spark, "a", spark.createDataFrame([(1, "x", [1, 2])], "k int, s string, l array<int>"))
    b = _table(spark, "b", spark.createDataFrame([(1, 2.0)], "k int, v double"))

    def of(df):
        got = {}
        for c, t, s in column_lineage(df):
            got.setdefault(c, set()).add(f"{t}.{s}")
        return got

    assert of(a.select((F.col("k") + 1).alias("n"), F.lit(1).alias("one"), F.upper("s"))) == {"n": {"a.k"}, "upper(s)": {"a.s"}}
    joined = a.join(b, "k").groupBy("s").agg(F.sum(F.col("v") * F.col("k")).alias("total"), F.count(F.lit(1)).alias("rows"))
    assert of(joined) == {"s": {"a.s"}, "total": {"a.k", "b.v"}}
    assert tables_read(joined) == ["a", "b"]
    both = a.select("k", F.col("s").alias("t")).unionByName(b.select(F.col("k").alias("t"), F.lit(None).cast("int").alias("k")).withColumn("t", F.col("t").cast("string")))
    assert of(both) == {"k": {"a.k"}, "t": {"a.s", "b.k"}}
    assert of(a.select(F.explode("l").alias("x"), "s")) == {"x": {"a.l"}, "s": {"a.s"}}
    ranked = b.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy("v")))
    assert of(ranked)["r"] == {"b.k", "b.v"} and of(ranked)["v"] == {"b.v"}
    assert of(a.join(b, "k", "left_semi")) == {"k": {"a.k"}, "s": {"a.s"}, "l": {"a.l"}}
    assert of(spark.range(3).crossJoin(a.select("s"))) == {"s": {"a.s"}}
    assert of(a.alias("x").join(a.alias("y"), F.col("x.k") == F.col("y.k")).select(F.col("x.s").alias("p"), F.col("y.k").alias("q"))) == {"p": {"a.s"}, "q": {"a.k"}}
