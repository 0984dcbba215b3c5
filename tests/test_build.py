import pytest
from pyspark.sql import functions as F

from tessera.plans.build import Run, land, run_all, run_bronze, run_gold, run_silver
from tessera.plans.expected import EXPECTED
from tessera.session import scratch_path

SF = "/root/testdata/sf0.001"


def test_full_build_end_to_end(spark):
    import __spark_entry__ as entry
    out = run_all(spark, SF, scratch_path(spark, "test/build"), expected=EXPECTED["sf0.001"])
    b = out["bronze"]["rows"]
    assert b["bronze_pos_customers"] == out["bronze"]["metrics"]["bronze_pos_customers"] > 0
    assert out["bronze"]["metrics"]["web_orders_has_lines"] == 1
    assert out["bronze"]["metrics"]["bronze_web_orders_broken_records"] == 0
    s = out["silver"]["metrics"]
    assert s["party_matched"] + s["party_pos_only"] + s["party_web_only"] == s["silver_party"]
    snap = out["gold"]["snapshot"]
    assert "contract_failures" not in snap, snap
    assert len(snap["contracts"]) == 67  # 65 over rows, money types, the expected figures
    assert out["bronze"]["metrics"]["customer_column_names"].startswith("customer_id,name,email")
    assert out["bronze"]["metrics"]["bronze_web_orders_blank_columns"] == ""
    assert s["naive_case_sensitive_matches"] < s["party_matched"]
    # the written build publishes the same figures as the lazy query
    q = entry.queries()["product_snapshot"](spark, SF).collect()[0]
    assert snap["revenue_usd"] == str(q.revenue_usd) and snap["sale_lines"] == str(q.sale_lines)
    assert ("write", "fct_sales") in out["lineage"] and ("read", "fct_sales") in out["lineage"]
    reads = [n for kind, n in out["lineage"] if kind == "read"]
    gold = out["lineage"][out["lineage"].index(("write", "fct_orders")) - 3:]
    assert not any(n.startswith("bronze_") for kind, n in gold if kind == "read")
    assert "silver_fx_daily" in reads
    columns = out["column_lineage"]
    assert ("amount_usd", "silver_fx_daily", "rate_to_usd") in columns["fct_orders"]
    assert ("country", "silver_party", "country") in columns["dim_party"]
    assert set(columns) >= {"silver_party", "fct_sales", "fct_revenue_summary"}


def test_metrics_survive_a_failing_write(spark):
    run = Run(spark, "/proc/no/such/folder")
    df = spark.createDataFrame([("n", 3, None), ("t", None, "x")], "metric string, value bigint, text string")
    got = run.save_metrics(df, "metrics")
    assert got["n"] == 3 and got["t"] == "x" and got["metrics_table_not_written"]
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        run.save_metrics(df.withColumn("value", F.expr("1 / (value - value)").cast("bigint")), "metrics")


def test_unexpected_figure_is_a_failed_contract(spark, tmp_path):
    run = Run(spark, str(tmp_path))
    land(spark, SF, f"{tmp_path}/landing", "2026-07-01")
    run_bronze(run, f"{tmp_path}/landing", "2026-07-01")
    run_silver(run)
    snap = run_gold(run, {"sale_lines": "1", "revenue_usd": "x"})["snapshot"]
    assert snap["contract_failures"] == ["snapshot_publishes_the_expected_figures"]
    assert {r["figure"]: r["verdict"] for r in snap["unexpected_figures"]} == {"sale_lines": "differs", "revenue_usd": "not a number"}


def test_bronze_without_a_column_stops_the_build(spark, tmp_path, monkeypatch):
    import tessera.plans.build as b
    monkeypatch.setitem(b.BRONZE_CONTRACT, "bronze_ref_fx_rates", ["currency", "no_such_column"])
    run = Run(spark, str(tmp_path))
    land(spark, SF, f"{tmp_path}/landing", "2026-07-01")
    with pytest.raises(ValueError, match="bronze_ref_fx_rates.no_such_column"):
        run_bronze(run, f"{tmp_path}/landing", "2026-07-01")
