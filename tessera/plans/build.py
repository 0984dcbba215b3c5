"""The full build: landing -> bronze -> silver -> gold -> contracts -> snapshot,
written as tables under one root.

Every save records its row count with an ``Observation`` collected during
the write itself (one pass, not write-then-recount).  Lineage records a read
when a model first asks for the table, and every write.  Gold facts that feed
other gold models are written first and read back, so each is computed once.
Metrics are computed first; only writing their table is guarded, and a failure
of that is recorded, not raised.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.contracts import Observed, lacking_columns, money_type_offenders
from tessera.operators.profile import union_all
from tessera.plans import contract_suite
from tessera.plans.lineage import column_lineage
from tessera.plans.product import Product
from tessera.plans.profiles import bronze_metrics, silver_metrics
from tessera.plans.snapshot import against, figures, snapshot
from tessera.sources import landing, tolerant
from tessera.sources.testdata import LazyFeeds, TestData
from tessera.types import (BRONZE_CONTRACT, POS_CUSTOMERS_SCHEMA, POS_ORDERS_SCHEMA, WEB_CUSTOMER_DDL,
                           WEB_ORDER_DDL, WEB_PRODUCT_DDL)


@dataclass
class Run:
    spark: SparkSession
    root: str
    fmt: str = "parquet"
    lineage: list[tuple[str, str]] = field(default_factory=list)
    rows: dict[str, int] = field(default_factory=dict)
    observed: dict[str, int] = field(default_factory=dict)
    #: Of each table written: ``(column, source table, source column)``.
    columns: dict[str, list[tuple[str, str, str]]] = field(default_factory=dict)

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def save(self, df: DataFrame, name: str) -> int:
        """Write a table; its rows and row-level contracts are counted in the write."""
        seen = Observed(df, name, contract_suite.SILVER_CHECKS + contract_suite.GOLD_CHECKS, contract_suite.row_counts(name))
        seen.frame.write.format(self.fmt).mode("overwrite").save(self.path(name))
        n = seen.rows
        self.observed.update(seen.counts)
        self.columns[name] = column_lineage(df)
        self.lineage.append(("write", name))
        self.rows[name] = n
        return n

    def read(self, name: str) -> DataFrame:
        self.lineage.append(("read", name))
        return self.spark.read.format(self.fmt).load(self.path(name))

    def save_metrics(self, df: DataFrame, name: str) -> dict[str, int | str]:
        """Metrics are a handful of rows ``metric, value, text``: computed
        (a failure of that is raised), returned as a dict, and written as a
        table (a failure of that is part of what is returned)."""
        rows = df.collect()
        out = {r["metric"]: r["value"] if r["text"] is None else r["text"] for r in rows}
        try:
            (self.spark.createDataFrame(rows, df.schema).coalesce(1).write.format(self.fmt).mode("overwrite")
             .save(self.path(name)))
            self.lineage.append(("write", name))
        except Exception as exc:  # the tables that the metrics are about are written already
            out["metrics_table_not_written"] = str(exc)
        return out

    def tables(self, names) -> LazyFeeds:
        """Written tables by name, each opened, and noted as read, on first use."""
        return LazyFeeds({n: (lambda n=n: self.read(n)) for n in names})


class Recorded(Product):
    """A product whose written models are noted as read on first use."""

    def __init__(self, run: Run, bronze, written=(), **kw):
        super().__init__(bronze, run.spark, **kw)
        self._run = run
        self._written.update({n: run.path(n) for n in written})

    def __getattribute__(self, name):
        get = super().__getattribute__
        if name in Product.MODELS and name not in get("__dict__") and name in get("_written"):
            get("__dict__")[name] = get("_run").read(name)
        return get(name)


LANDING = {
    "bronze_pos_customers": ("pos/customers", "csv"),
    "bronze_pos_orders": ("pos/orders", "json_lines"),
    "bronze_web_customers": ("web/customers", "json_array"),
    "bronze_web_products": ("web/products", "json_array"),
    "bronze_web_orders": ("web/orders", "json_array"),
    "bronze_ref_fx_rates": ("reference/fx_rates", "parquet"),
    "bronze_ref_product_hierarchy": ("reference/product_hierarchy", "parquet"),
    "bronze_erp_customer_changes": ("erp/changes", "parquet"),
}
_DDL = {"bronze_web_customers": WEB_CUSTOMER_DDL, "bronze_web_products": WEB_PRODUCT_DDL,
        "bronze_web_orders": WEB_ORDER_DDL}


def land(spark: SparkSession, sf_dir: str, landing_dir: str, day: str) -> None:
    """Land the test-data feeds for ``day`` in each vendor's format."""
    for name, df in TestData(spark, sf_dir).bronze().items():
        sub, kind = LANDING[name]
        path = os.path.join(landing_dir, sub, day)
        {"csv": landing.write_csv, "json_lines": landing.write_json_lines,
         "json_array": landing.write_json_array_pages,
         "parquet": landing.write_parquet}[kind](df, path)


def read_landing(spark: SparkSession, landing_dir: str, day: str) -> dict[str, DataFrame]:
    """The feeds of ``day``; text feeds with what their declared columns have
    no place for (``sources.tolerant``)."""
    out = {}
    for name, (sub, kind) in LANDING.items():
        path = os.path.join(landing_dir, sub, day)
        if kind == "csv":
            out[name] = tolerant.read_csv(spark, path, POS_CUSTOMERS_SCHEMA)
        elif kind == "json_lines":
            out[name] = tolerant.read_json_lines(spark, path, POS_ORDERS_SCHEMA)
        elif kind == "json_array":
            out[name] = tolerant.read_json_pages(spark, path, _DDL[name])
        else:
            out[name] = landing.read_parquet(spark, path)
    return out


def run_bronze(run: Run, landing_dir: str, day: str) -> dict:
    feeds = read_landing(run.spark, landing_dir, day)
    for name, df in feeds.items():
        run.lineage.append(("read", f"landing/{LANDING[name][0]}/{day}"))
        run.save(tolerant.sound(df) if "_corrupt" in df.columns else df, name)
    # records that do not parse are kept beside the feeds, with their file
    texts = {n: df for n, df in feeds.items() if "_corrupt" in df.columns}
    run.save(union_all([df.where("_corrupt is not null").select(F.lit(n).alias("feed"), F.col("_file").alias("file"), F.col("_corrupt").alias("record"))
                        for n, df in texts.items()]), "bronze_broken_records")
    landed = {n: run.spark.read.format(run.fmt).load(run.path(n)).columns for n in feeds}
    lacking = lacking_columns(run.spark, BRONZE_CONTRACT, landed).collect()
    if lacking:
        raise ValueError("bronze lacks columns that silver reads: " + "; ".join(
            f"{r['table_name']}.{r['column_name']}" + ("" if r["table_landed"] else " (table not landed)") for r in lacking))
    names = run.spark.createDataFrame([(n,) for n in texts], "feed string")
    broken = (names.join(run.read("bronze_broken_records"), "feed", "left").groupBy("feed").agg(F.count("record").alias("value"))
              .select(F.concat("feed", F.lit("_broken_records")).alias("metric"), "value", F.lit(None).cast("string").alias("text")))
    metrics = run.save_metrics(union_all([bronze_metrics(run.tables(feeds)), broken]), "bronze_ingest_metrics")
    return {"rows": {n: run.rows[n] for n in feeds}, "metrics": metrics}


def run_silver(run: Run) -> dict:
    p = Product(run.tables(LANDING), run.spark)
    # accepted and quarantined orders share the latest-event pick: written once
    p.materialize("latest_orders", fmt=run.fmt, root=run.root)
    run.lineage.append(("write", "latest_orders"))
    for name in Product.SILVER:
        run.save(p.model(name), name)
    written = Recorded(run, run.tables(LANDING), Product.SILVER)
    metrics = run.save_metrics(silver_metrics(written), "silver_metrics")
    return {"rows": {n: run.rows[n] for n in Product.SILVER}, "metrics": metrics}


GOLD_ORDER = ["fct_orders", "fct_sales", "dim_customer", "dim_party", "dim_country",
              "dim_product", "dim_date", "fct_daily_revenue", "fct_revenue_summary"]


def run_gold(run: Run, expected: dict[str, str] | None = None) -> dict:
    """``expected``: the figures that the snapshot must publish, if known for
    the input; a figure that does not is a failed contract."""
    p = Recorded(run, {}, Product.SILVER, summary_from="sales")
    p.observed = run.observed
    for name in GOLD_ORDER:
        run.save(p.model(name), name)
        p.use(name, run.read(name), run.path(name))  # later models read the written table
    run.save(snapshot(p.fct_revenue_summary), "product_snapshot")
    published = run.read("product_snapshot")
    floats = money_type_offenders({t: run.read(t).schema for t in contract_suite.MONEY_TABLES})
    results = contract_suite.suite(p).unionByName(
        contract_suite.verdict(run.spark, "money_is_never_stored_as_float", len(floats)))
    wrong = []
    if expected:
        wanted = run.spark.createDataFrame(list(expected.items()), "figure string, value string")
        checked = against(figures(published), wanted).filter("verdict <> 'unasked'")
        run.save(checked, "expected_figures")
        wrong = [r.asDict() for r in run.read("expected_figures").filter("verdict <> 'equal'").collect()]
        results = results.unionByName(
            contract_suite.verdict(run.spark, "snapshot_publishes_the_expected_figures", len(wrong)))
    run.save(results, "contract_results")
    names = {r["contract"]: r["passed"] for r in run.read("contract_results").collect()}
    snap = {k: str(v) for k, v in published.collect()[0].asDict().items()}
    snap["contracts"] = sorted(names)
    if failures := sorted(n for n, passed in names.items() if not passed):
        snap["contract_failures"] = failures
    if wrong:
        snap["unexpected_figures"] = wrong
    return {"rows": {n: run.rows[n] for n in GOLD_ORDER}, "snapshot": snap}


def run_all(spark: SparkSession, sf_dir: str, root: str, day: str = "2026-07-01", expected: dict[str, str] | None = None) -> dict:
    """``expected``: the figures that the input's snapshot must publish, if they are known."""
    landing_dir = os.path.join(root, "landing")
    land(spark, sf_dir, landing_dir, day)
    run = Run(spark, os.path.join(root, "tables"))
    out = {"bronze": run_bronze(run, landing_dir, day), "silver": run_silver(run),
           "gold": run_gold(run, expected)}
    out["lineage"], out["column_lineage"] = run.lineage, run.columns
    return out


if __name__ == "__main__":
    import json
    import sys

    from tessera.session import get_spark, scratch_path
    spark = get_spark()
    root = sys.argv[2] if len(sys.argv) > 2 else scratch_path(spark, "build")
    print(json.dumps(run_all(spark, sys.argv[1], root), default=str, indent=1))
