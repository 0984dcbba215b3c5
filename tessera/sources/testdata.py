"""Test-data adapter: the driver's TPC-H-like tables -> bronze-shaped feeds.

The product ingests two selling systems (POS, web storefront) and reference
data.  The shared test tables carry no such dirt, so the adapter derives the
feeds deterministically, with expressions that mean the same in Spark and in
the SQL oracle (integer arithmetic only; no hashing, no double rounding):

* every customer is a POS customer; customers ``c_custkey % 50 = 0`` are
  landed twice (the copy's name is upper-cased: a vendor resend);
  customers ``c_custkey % 5 <> 0`` also hold a web account.
* every line item belongs to exactly one system: orders of a web account
  holder with an odd key go to the storefront, all others to the shops.
  One POS *event* per line item (``event_seq`` = line number, so several
  events per order and ties within an order); one web basket document per
  order, its line items in one ``lines`` array.
* parts ``p_partkey % 50 = 7`` are missing from the published hierarchy.
* FX quotes cover the order span +-7 days, business days only.

The row selections are the data model (which customer has which account,
which system an order went through) -- no row of the input is discarded to
make anything cheaper: every line item reaches exactly one system.
"""

from __future__ import annotations

from collections.abc import Callable, MutableMapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.types import MONEY

# ---------------------------------------------------------------------------
# FIXED VALUES of the adapter (mirrored by the oracle SQL)
# ---------------------------------------------------------------------------
COUNTRY_SPELLINGS = ["US", "USA", "U.S.", "United States", "GB", "GBR", "UK",
                     "U.K.", "United Kingdom", "SG", "SGP", "Singapore"]
CURRENCIES = ["USD", "GBP", "SGD", "EUR"]
SEGMENT_OF_MKTSEGMENT = {"AUTOMOBILE": "value", "BUILDING": "mainstream",
                         "FURNITURE": "premium", "HOUSEHOLD": "lapsed",
                         "MACHINERY": "new"}
# currency -> (first quote offset from lo, last quote offset from hi,
#              basis points of the base rate; USD is 1)
FX_QUOTE_PLAN = {"USD": (0, 0, 10000), "GBP": (0, -3, 12700),
                 "SGD": (0, 0, 7400), "EUR": (3, 0, 10800)}
FX_MARGIN_DAYS = 7
MONDAY = "1970-01-05"
# ---------------------------------------------------------------------------

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


# Schemas of the (read-only) test tables, inferred once per process and then
# declared, as a catalog table's stored schema would be: a parquet read
# without a schema runs a footer-reading job every time.
_SCHEMAS: dict[str, StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = _SCHEMAS.get(path)
    if schema is None:
        df = spark.read.parquet(path)
        _SCHEMAS[path] = df.schema
        return df
    return spark.read.schema(schema).parquet(path)


# The derivations are written as Spark SQL expressions (``selectExpr``): each
# feed is then a few calls to the JVM instead of one per Column node, which
# is most of the driver-side planning time of a query.  The expressions mean
# the same as the oracle's (integer arithmetic, explicit DOUBLE literals).
def _lit(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _array(values) -> str:
    return "array(" + ", ".join(_lit(v) for v in values) + ")"


def country_spelling(k: str) -> str:
    s = f"element_at({_array(COUNTRY_SPELLINGS)}, CAST({k} % 12 + 1 AS INT))"
    s = f"CASE WHEN {k} % 5 = 0 THEN lower({s}) ELSE {s} END"
    return f"CASE WHEN {k} % 7 = 0 THEN concat(' ', {s}, ' ') ELSE {s} END"


def pos_email(k: str) -> str:
    ks = f"CAST({k} AS STRING)"
    return (f"CASE WHEN {k} % 31 = 0 THEN CAST(NULL AS STRING) "
            f"WHEN {k} % 3 = 0 THEN concat(' User', {ks}, '@Example.COM ') "
            f"ELSE concat('user', {ks}, '@example.com') END")


def web_email(k: str) -> str:
    ks = f"CAST({k} AS STRING)"
    return (f"CASE WHEN {k} % 4 = 3 THEN concat('shopper', {ks}, '@example.com') "
            f"WHEN {k} % 7 = 0 THEN concat('user', {ks}, '@example.com') "
            f"ELSE concat('User', {ks}, '@Example.com') END")


def has_web_account(k: str) -> str:
    return f"{k} % 5 <> 0"


def _case(col: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {col} = {_lit(a)} THEN {_lit(b)}" for a, b in mapping.items())
    return f"CASE {whens} ELSE {_lit(default)} END"


def _key(prefix: str, col: str) -> str:
    return f"concat('{prefix}', CAST({col} AS STRING))"


@dataclass
class TestData:
    """Lazily built bronze feeds over one scale factor's tables."""

    spark: SparkSession
    sf_dir: str
    __test__ = False  # not a pytest class

    def table(self, name: str) -> DataFrame:
        """Each table is opened (listed, footer read) once per adapter; every
        feed that uses it starts from the same relation."""
        tables = self.__dict__.setdefault("_tables", {})
        if name not in tables:
            tables[name] = read_table(self.spark, self.sf_dir, name)
        return tables[name]

    @cached_property
    def _lines(self) -> DataFrame:
        """Line items with their order header, shared by both systems."""
        li = self.table("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            "l_extendedprice", "l_discount", "l_tax", "l_returnflag")
        o = self.table("orders").select(
            "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
        return li.join(o, li.l_orderkey == o.o_orderkey)

    # every line item is in exactly one system
    WEB_ORDER = f"o_orderkey % 2 = 1 AND {has_web_account('o_custkey')}"

    # -- POS ---------------------------------------------------------------
    def pos_customers(self) -> DataFrame:
        c = self.table("customer")

        def shape(rows: DataFrame, name: str) -> DataFrame:
            return rows.selectExpr(
                f"{_key('C', 'c_custkey')} AS customer_id",
                f"{name} AS name",
                f"{pos_email('c_custkey')} AS email",
                f"{country_spelling('c_custkey')} AS country",
                f"{_case('c_mktsegment', SEGMENT_OF_MKTSEGMENT, 'new')} AS marketing_segment",
                "CASE WHEN c_acctbal < 0 THEN 'basic' WHEN c_acctbal < 3000 THEN 'bronze' "
                "WHEN c_acctbal < 7000 THEN 'silver' ELSE 'gold' END AS loyalty_tier",
                "CAST(c_nationkey AS STRING) AS nation_key",
            )
        landed = shape(c, "c_name")
        resent = shape(c.filter("c_custkey % 50 = 0"), "upper(c_name)")
        return landed.unionByName(resent)

    def pos_orders(self) -> DataFrame:
        x = self._lines.filter(f"NOT ({self.WEB_ORDER})")
        m = "((l_orderkey + l_linenumber) % 40)"
        q = "CAST(floor(l_quantity) AS BIGINT)"
        return x.selectExpr(
            f"{_key('O', 'o_orderkey')} AS order_id",
            f"{_key('C', 'o_custkey')} AS customer_id",
            f"{_key('P', 'l_partkey')} AS product_id",
            "date_format(o_orderdate, 'yyyy-MM-dd') AS order_date",
            "CASE WHEN l_suppkey % 4 = 0 THEN 'kiosk' ELSE 'counter' END AS channel",
            f"{_key('S', 'l_suppkey')} AS store_id",
            f"element_at({_array(CURRENCIES)}, CAST(o_custkey % 4 + 1 AS INT)) AS currency",
            "l_discount AS discount_pct",
            "l_tax AS tax_rate",
            "CASE WHEN l_returnflag = 'R' THEN 0.0D ELSE 4.99D END AS shipping_fee",
            "CASE WHEN substring(o_orderpriority, 1, 1) IN ('1', '2') THEN 'card' ELSE 'cash' END "
            "AS payment_method",
            "l_returnflag = 'A' AS is_gift",
            "CASE WHEN l_discount >= 0.08D THEN 'PROMO8' END AS promo_code",
            f"CASE WHEN {m} = 0 THEN CAST(0 AS BIGINT) WHEN {m} = 1 THEN -{q} "
            f"WHEN {m} = 3 THEN CAST(NULL AS BIGINT) ELSE {q} END AS quantity",
            f"CASE WHEN {m} = 2 THEN CAST(NULL AS DOUBLE) ELSE l_extendedprice END AS unit_price",
            f"{_case('o_orderstatus', {'F': 'shipped', 'O': 'pending'}, 'error')} AS status",
            "CAST(l_linenumber AS BIGINT) AS event_seq",
        )

    # -- web storefront ------------------------------------------------------
    def web_customers(self) -> DataFrame:
        return self.table("customer").filter(has_web_account("c_custkey")).selectExpr(
            f"{web_email('c_custkey')} AS email",
            "c_name AS full_name",
            f"{country_spelling('c_custkey')} AS country",
            "concat('2019-', lpad(CAST(c_custkey % 12 + 1 AS STRING), 2, '0'), '-15T09:00:00Z') "
            "AS signup_ts",
        )

    def web_orders(self) -> DataFrame:
        """One basket document per order.  The lines are in line number order;
        line numbers repeat within an order, so the other line fields break
        ties (lines equal in all of them are interchangeable)."""
        line = (f"named_struct('line_no', CAST(l_linenumber AS INT), "
                f"'product_id', {_key('P', 'l_partkey')}, "
                f"'quantity', CAST(floor(l_quantity) AS INT), "
                f"'unit_price', CAST(l_extendedprice AS {MONEY}))")
        baskets = (self._lines.filter(self.WEB_ORDER)
                   .groupBy("o_orderkey", "o_custkey", "o_orderdate")
                   .agg(F.expr(f"array_sort(collect_list({line}))").alias("lines")))
        d = "date_format(o_orderdate, 'yyyy-MM-dd')"
        return baskets.selectExpr(
            f"{_key('W', 'o_orderkey')} AS web_order_id",
            f"{web_email('o_custkey')} AS email",
            f"CASE WHEN o_orderkey % 3 = 0 THEN concat({d}, 'T03:30:00+08:00') "
            f"ELSE concat({d}, 'T12:00:00+00:00') END AS placed_at",
            "CASE WHEN o_orderkey % 20 = 1 THEN 'cancelled' ELSE 'completed' END AS status",
            "lines",
        )

    def web_products(self) -> DataFrame:
        return self.table("part").selectExpr(
            f"{_key('P', 'p_partkey')} AS product_id",
            "p_name AS title",
            f"CAST(p_retailprice AS {MONEY}) AS list_price",
        )

    # -- reference data --------------------------------------------------------
    def product_hierarchy(self) -> DataFrame:
        return self.table("part").filter("p_partkey % 50 <> 7").selectExpr(
            f"{_key('P', 'p_partkey')} AS product_id",
            "p_name AS product_name",
            "p_type AS category",
            "CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'Essentials' "
            "WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'Home' ELSE 'Accessories' END AS department",
            "CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'Peripheral' ELSE 'Core' END AS segment",
            "p_retailprice AS list_price_usd",
        )

    def fx_rates(self) -> DataFrame:
        bounds = self.table("orders").selectExpr(
            f"date_sub(to_date(min(o_orderdate)), {FX_MARGIN_DAYS}) AS lo",
            f"date_add(to_date(max(o_orderdate)), {FX_MARGIN_DAYS}) AS hi")
        plan = "array(" + ", ".join(
            f"named_struct('currency', {_lit(c)}, 'a', {a}, 'b', {b}, 'bp', {bp})"
            for c, (a, b, bp) in FX_QUOTE_PLAN.items()) + ")"
        days = bounds.selectExpr("lo", "hi", f"explode({plan}) AS p").selectExpr(
            "p.currency AS currency", "p.bp AS bp",
            "explode(sequence(date_add(lo, p.a), date_add(hi, p.b))) AS rate_date")
        return days.filter(f"datediff(rate_date, DATE'{MONDAY}') % 7 < 5").selectExpr(
            "currency", "rate_date",
            "CASE WHEN currency = 'USD' THEN 1.0D "
            "ELSE CAST(bp + unix_date(rate_date) % 50 AS DOUBLE) / 10000.0D END AS rate_to_usd")

    # -- ERP change feed (landed and counted, read by no model) ---------------
    def erp_changes(self) -> DataFrame:
        return self.table("events").selectExpr(
            "event_id AS change_id",
            f"{_key('C', 'user_id')} AS customer_id",
            "CASE WHEN event_type = 'purchase' THEN 'I' WHEN event_type = 'error' THEN 'D' "
            "ELSE 'U' END AS op",
            "ts AS changed_at",
        )

    def bronze(self) -> "LazyFeeds":
        """All bronze feeds by their bronze table name, each built (planned)
        on first access only."""
        return LazyFeeds({
            "bronze_pos_customers": self.pos_customers,
            "bronze_pos_orders": self.pos_orders,
            "bronze_web_customers": self.web_customers,
            "bronze_web_products": self.web_products,
            "bronze_web_orders": self.web_orders,
            "bronze_ref_fx_rates": self.fx_rates,
            "bronze_ref_product_hierarchy": self.product_hierarchy,
            "bronze_erp_customer_changes": self.erp_changes,
        })


class LazyFeeds(MutableMapping):
    """name -> DataFrame, where each DataFrame is built on first lookup."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __setitem__(self, name: str, df: DataFrame) -> None:
        self._builders.setdefault(name, lambda: df)
        self._built[name] = df

    def __delitem__(self, name: str) -> None:
        self._builders.pop(name, None)
        self._built.pop(name, None)

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)
