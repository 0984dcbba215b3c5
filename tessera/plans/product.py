"""The product: every bronze, silver and gold model of one input, built lazily
and once (a model used by several others is the same DataFrame object)."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import gold, silver
from tessera.sources.testdata import TestData


class Product:
    """``summary_from``: whether the management summary is built from the
    sales fact (``sales``, e.g. a written one) or straight from the priced
    lines (``lines``)."""

    def __init__(self, bronze, spark: SparkSession | None = None, summary_from: str = "lines"):
        self.bronze = bronze
        self._spark = spark
        self.summary_from = summary_from
        self._written: dict[str, str] = {}
        #: Failures of contracts that were counted while their table was written.
        self.observed: dict[str, int] = {}

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, summary_from: str = "lines") -> "Product":
        """Bronze from the test-data adapter.  The FX reference feed -- a small
        file in production -- is landed once (written to the shared folder) so
        that its several readers scan a small table instead of re-deriving it
        from the orders."""
        p = cls(TestData(spark, sf_dir).bronze(), spark, summary_from)
        p._land_fx = True
        return p

    def _fx_bronze(self) -> dict[str, DataFrame]:
        """Bronze with the FX feed landed (written once, on first use)."""
        if getattr(self, "_land_fx", False):
            from tessera.session import scratch_path
            path = scratch_path(self.spark, "landing/reference/fx_rates")
            fx = self.bronze["bronze_ref_fx_rates"]
            fx.write.mode("overwrite").parquet(path)
            # read back with the schema just written: no footer-reading job
            self.bronze["bronze_ref_fx_rates"] = self.spark.read.schema(fx.schema).parquet(path)
            self._land_fx = False
        return self.bronze

    # silver -----------------------------------------------------------------
    @cached_property
    def latest_orders(self) -> DataFrame:
        return silver.latest_orders(self.bronze)

    @cached_property
    def silver_customers(self) -> DataFrame:
        return silver.customers(self.bronze)

    @cached_property
    def silver_orders(self) -> DataFrame:
        return silver.orders(self.bronze, self.latest_orders)

    @cached_property
    def silver_quarantine_orders(self) -> DataFrame:
        return silver.quarantine_orders(self.bronze, self.latest_orders)

    @cached_property
    def silver_web_customers(self) -> DataFrame:
        return silver.web_customers(self.bronze)

    @cached_property
    def silver_web_order_lines(self) -> DataFrame:
        return silver.web_order_lines(self.bronze)

    @cached_property
    def silver_product_hierarchy(self) -> DataFrame:
        return silver.product_hierarchy(self.bronze)

    @cached_property
    def silver_fx_daily(self) -> DataFrame:
        return silver.fx_daily(self._fx_bronze())

    @cached_property
    def silver_party(self) -> DataFrame:
        return silver.party(self.silver_customers, self.silver_web_customers)

    @cached_property
    def fx_broadcast(self) -> bool:
        """Is the dense FX grid small enough to broadcast?  Decided once, from
        a bound on its rows (computed from the quotes, not by building it).
        Rows are a few fixed-width columns, so their number bounds the bytes."""
        from tessera.operators.asof import carry_forward_rows
        from tessera.operators.joins import BROADCAST_MAX_ROWS
        if "silver_fx_daily" in self._written:
            return self.silver_fx_daily.limit(BROADCAST_MAX_ROWS + 1).count() <= BROADCAST_MAX_ROWS
        quotes = silver.fx_quotes(self._fx_bronze())
        return carry_forward_rows(quotes, "currency", "rate_date") <= BROADCAST_MAX_ROWS

    # gold -------------------------------------------------------------------
    @cached_property
    def fct_orders(self) -> DataFrame:
        return gold.fct_orders(self.silver_orders, self.silver_fx_daily, self.fx_broadcast)

    @cached_property
    def products_broadcast(self) -> bool:
        """Is the product hierarchy small enough to broadcast?"""
        from tessera.operators.joins import small_enough
        from tessera.session import shuffles_dropped
        with shuffles_dropped(self.spark):
            return small_enough(self.silver_product_hierarchy)

    @cached_property
    def sold_lines(self) -> DataFrame:
        return gold.sold_lines(self.silver_orders, self.silver_web_order_lines)

    @cached_property
    def sales_lines(self) -> DataFrame:
        return gold.sales_lines(self.sold_lines, self.silver_fx_daily, self.fx_broadcast)

    @cached_property
    def _dated_products(self) -> DataFrame:
        """Days and SKUs of the lines with a known buyer.  The FX join keeps
        every line and doubles none that a distinct would not fold, so it is
        left out; a written sales fact is read instead."""
        if "fct_sales" in self._written:
            return self.fct_sales
        return gold.bought(self.sold_lines, self.silver_party)

    @cached_property
    def fct_sales(self) -> DataFrame:
        return gold.fct_sales(self.sales_lines, self.silver_party)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return gold.dim_customer(self.silver_customers)

    @cached_property
    def dim_party(self) -> DataFrame:
        return gold.dim_party(self.silver_party)

    @cached_property
    def dim_country(self) -> DataFrame:
        return gold.dim_country(self.dim_party)

    @cached_property
    def dim_product(self) -> DataFrame:
        return gold.dim_product(self.silver_product_hierarchy, self._dated_products)

    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(self._dated_products)

    @cached_property
    def fct_daily_revenue(self) -> DataFrame:
        return gold.fct_daily_revenue(self.fct_orders, self.dim_customer)

    @cached_property
    def fct_revenue_summary(self) -> DataFrame:
        parts = (self.silver_product_hierarchy, self.dim_party, self.products_broadcast)
        if self.summary_from == "sales":
            return gold.revenue_summary(self.fct_sales, *parts)
        return gold.revenue_summary_from_lines(self.sales_lines, *parts)

    SILVER = ["silver_customers", "silver_orders", "silver_quarantine_orders",
              "silver_web_customers", "silver_web_order_lines", "silver_product_hierarchy",
              "silver_fx_daily", "silver_party"]
    GOLD = ["dim_customer", "dim_party", "dim_country", "dim_product", "dim_date",
            "fct_orders", "fct_sales", "fct_daily_revenue", "fct_revenue_summary"]

    MODELS = frozenset([*SILVER, *GOLD])

    #: Models that a model reads, if they are written.
    BUILT_ON = {
        "latest_orders": [], "silver_customers": [], "silver_web_customers": [], "silver_web_order_lines": [],
        "silver_product_hierarchy": [], "silver_fx_daily": [],
        "silver_orders": ["latest_orders"], "silver_quarantine_orders": ["latest_orders"],
        "silver_party": ["silver_customers", "silver_web_customers"],
        "fct_orders": ["silver_orders", "silver_fx_daily"],
        "sales_lines": ["silver_orders", "silver_web_order_lines", "silver_fx_daily"],
        "fct_sales": ["sales_lines", "silver_orders", "silver_web_order_lines", "silver_fx_daily", "silver_party"],
        "dim_customer": ["silver_customers"], "dim_party": ["silver_party"], "dim_country": ["dim_party", "silver_party"],
        "dim_product": ["silver_product_hierarchy", "fct_sales"], "dim_date": ["fct_sales"],
        "fct_daily_revenue": ["fct_orders", "dim_customer", "silver_customers"],
        "fct_revenue_summary": ["fct_sales", "dim_party", "silver_party", "silver_product_hierarchy"],
    }

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)

    @property
    def spark(self) -> SparkSession:
        if self._spark is None:
            self._spark = self.bronze[next(iter(self.bronze))].sparkSession
        return self._spark

    def materialize(self, *names: str, fmt: str = "parquet", root: str | None = None) -> "Product":
        """Write the named models once to the shared folder and read them back.

        For plans that consume a model several times (contracts, builds that
        are reconciled): each is computed once, later readers get a plain
        scan with column pruning and statistics, and a lost executor costs a
        re-read of the written table instead of the whole lineage.  Models
        are written before dependants are built, those that wait for none of
        the others side by side.  A table's row-level contracts are counted in
        its write.
        """
        from tessera.operators.contracts import Observed
        from tessera.plans.contract_suite import GOLD_CHECKS, SILVER_CHECKS, row_counts
        from tessera.session import scratch_path, shuffles_dropped
        todo = [n for n in names if n not in self._written]
        while todo:
            # models that wait for none of the others are written side by side
            ready = [n for n in todo if not any(d in todo for d in self.BUILT_ON.get(n, todo[:todo.index(n)]))]
            writes = []
            for name in ready:
                path = f"{root}/{name}" if root else scratch_path(self.spark, f"tables/{name}")
                df = self.model(name)
                writes.append((name, path, df, Observed(df, name, SILVER_CHECKS + GOLD_CHECKS, row_counts(name))))
            with shuffles_dropped(self.spark), ThreadPoolExecutor(max_workers=4) as pool:
                list(pool.map(lambda w: w[3].frame.write.mode("overwrite").format(fmt).save(w[1]), writes))
            for name, path, df, seen in writes:
                self.observed.update(seen.counts)
                self.use(name, self.spark.read.format(fmt).schema(df.schema).load(path), path)
            todo = [n for n in todo if n not in ready]
        return self

    def use(self, name: str, df: DataFrame, path: str) -> None:
        """Read model ``name`` from ``df``, which was written to ``path``."""
        self.__dict__[name] = df
        self._written[name] = path

    def drop(self, *names: str) -> "Product":
        """Delete what ``materialize`` wrote of models that no frame reads any
        more; asked for again, they are built again."""
        from tessera.session import drop_path
        for name in names:
            drop_path(self.spark, self._written.pop(name))
            del self.__dict__[name]
        return self
