"""The product's declared contracts: generic tests as data, singular tests as
DataFrames.  Each singular builder returns a small DataFrame computed by Spark
over the models; the suite folds everything into one row per contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.contracts import Check, evaluate, violations
from tessera.operators.profile import union_all
from tessera.types import (ACCEPTED_CHANNEL_SYSTEMS, ACCEPTED_COUNTRIES,
                           ACCEPTED_FISCAL_QUARTERS, ACCEPTED_MARKETING_SEGMENTS,
                           ACCEPTED_PRODUCT_SEGMENTS, UNALLOCATED, UNSEGMENTED)


def _nn(table, *cols):
    return [Check(table, c, "not_null") for c in cols]


def _uq(table, col):
    return [Check(table, col, "unique"), Check(table, col, "not_null")]


def _av(table, col, values):
    return Check(table, col, "accepted_values", tuple(values))


def _rel(table, col, to_table, to_col):
    return Check(table, col, "relationships", to_table=to_table, to_column=to_col)


# FIXED VALUES: the declared generic tests (12 silver, 48 gold).
SILVER_CHECKS = [
    *_uq("silver_customers", "customer_id"), *_nn("silver_customers", "country"),
    *_uq("silver_orders", "order_id"), *_nn("silver_orders", "amount", "quantity"),
    *_uq("silver_party", "party_key"),
    *_nn("silver_fx_daily", "rate_to_usd", "rate_is_carried"),
    *_nn("silver_web_order_lines", "amount"),
]

GOLD_CHECKS = [
    *_uq("dim_customer", "customer_id"),
    *_nn("dim_customer", "country"), _av("dim_customer", "country", ACCEPTED_COUNTRIES),
    *_nn("dim_customer", "marketing_segment"),
    _av("dim_customer", "marketing_segment", ACCEPTED_MARKETING_SEGMENTS),
    *_nn("dim_customer", "loyalty_tier"),
    *_uq("dim_date", "date_key"), *_nn("dim_date", "fiscal_year", "fiscal_quarter"),
    _av("dim_date", "fiscal_quarter", ACCEPTED_FISCAL_QUARTERS),
    *_uq("dim_product", "product_id"), *_nn("dim_product", "department", "product_segment"),
    _av("dim_product", "product_segment", ACCEPTED_PRODUCT_SEGMENTS),
    *_uq("fct_orders", "order_id"),
    *_nn("fct_orders", "customer_id"), _rel("fct_orders", "customer_id", "dim_customer", "customer_id"),
    *_nn("fct_orders", "product_id"), _rel("fct_orders", "product_id", "dim_product", "product_id"),
    *_nn("fct_orders", "amount", "currency", "amount_usd"),
    *_nn("fct_daily_revenue", "revenue"),
    *_uq("dim_country", "country"), _av("dim_country", "country", ACCEPTED_COUNTRIES),
    *_nn("dim_country", "country_name"),
    *_uq("dim_party", "party_key"),
    _av("dim_party", "marketing_segment", ACCEPTED_MARKETING_SEGMENTS),
    *_nn("fct_sales", "party_key"), _rel("fct_sales", "party_key", "dim_party", "party_key"),
    *_nn("fct_sales", "product_id"), _rel("fct_sales", "product_id", "dim_product", "product_id"),
    *_nn("fct_sales", "amount_usd", "channel_system"),
    _av("fct_sales", "channel_system", ACCEPTED_CHANNEL_SYSTEMS),
    *_nn("fct_revenue_summary", "revenue_usd", "sale_lines", "cancelled_revenue_usd",
         "fiscal_year_label", "customer_segment", "product_segment", "channel_system"),
]

MONEY_TABLES = ["dim_product", "fct_sales", "fct_orders", "fct_revenue_summary", "fct_daily_revenue"]


QUANTITY = "silver_orders_never_holds_a_non_positive_quantity"


def row_counts(table: str) -> dict[str, Column]:
    """Singular contracts that a row of ``table`` passes or fails alone."""
    q = F.col("quantity")
    return {QUANTITY: (q <= 0) | q.isNull()} if table == "silver_orders" else {}


def _told(spark: SparkSession, checks, observed: dict[str, int]) -> list[DataFrame]:
    rows = [(c.name, c.table, c.column, c.test, observed[c.name]) for c in checks]
    return [spark.createDataFrame(rows, "contract string, table_name string, column_name string, test string, failures bigint")] if rows else []


def generic(product, checks=None) -> DataFrame:
    """The declared tests; those that were counted while their table was
    written (``product.observed``) are not counted again."""
    checks = checks if checks is not None else SILVER_CHECKS + GOLD_CHECKS
    told = [c for c in checks if c.name in product.observed]
    asked = [c for c in checks if c.name not in product.observed]
    return union_all([*_told(product.spark, told, product.observed), *([evaluate(product.model, asked)] if asked else [])])


def relationships(product) -> DataFrame:
    """Each declared relationship with its orphan count."""
    rel = [c for c in GOLD_CHECKS if c.test == "relationships"]
    parents = product.fct_sales.sparkSession.createDataFrame(
        [(c.name, c.to_table, c.to_column) for c in rel],
        "contract string, parent_table string, parent_column string")
    return evaluate(product.model, rel).join(F.broadcast(parents), "contract").select(
        F.col("table_name").alias("child_table"), F.col("column_name").alias("child_column"),
        "parent_table", "parent_column", F.col("failures").alias("orphans"))


def quantity_positive(product) -> DataFrame:
    """silver_orders never holds a non-positive (or NULL) quantity."""
    q = F.col("quantity")
    return product.silver_orders.agg(
        F.count(F.lit(1)).alias("checked"),
        F.count_if((q <= 0) | q.isNull()).alias("violations"))


def quotes_unique(quotes: DataFrame) -> DataFrame:
    """One quote per currency and day, without which orders of that day fan
    out: ``keys`` and how many of them are quoted more than once."""
    per = (quotes.filter(F.col("currency").isNotNull() & F.col("rate_date").isNotNull())
           .groupBy("currency", "rate_date").agg(F.count(F.lit(1)).alias("n")))
    return per.agg(F.count(F.lit(1)).alias("keys"), F.count_if(F.col("n") > 1).alias("failures"))


PROBES = [
    ("no WEB revenue", "web_revenue"),
    ("no POS revenue", "pos_revenue"),
    ("no cancelled revenue", "cancelled_revenue"),
    ("unallocated product revenue vanished", "unallocated_revenue"),
    ("unsegmented customer revenue vanished", "unsegmented_revenue"),
    ("the pack covers only one fiscal quarter", "fiscal_quarters"),
]


def both_systems(product) -> DataFrame:
    """The six 'did the pack lose a cohort' probes in ONE aggregate; a probe
    fails when its figure is 0 (or, for quarters, below 2) -- or NULL, so an
    empty summary fails instead of passing silently."""
    s = product.fct_revenue_summary
    rev = F.col("revenue_usd")
    row = s.agg(
        F.sum(F.when(F.col("channel_system") == "WEB", rev).otherwise(0)).alias("web_revenue"),
        F.sum(F.when(F.col("channel_system") == "POS", rev).otherwise(0)).alias("pos_revenue"),
        F.sum("cancelled_revenue_usd").alias("cancelled_revenue"),
        F.sum(F.when(F.col("department") == UNALLOCATED, rev).otherwise(0)).alias("unallocated_revenue"),
        F.sum(F.when(F.col("customer_segment") == UNSEGMENTED, rev).otherwise(0)).alias("unsegmented_revenue"),
        F.countDistinct("fiscal_quarter_label").cast("decimal(29,4)").alias("fiscal_quarters"),
    )
    stacked = ", ".join(f"'{p}', CAST(`{c}` AS DECIMAL(29,4))" for p, c in PROBES)
    long = row.selectExpr(f"stack({len(PROBES)}, {stacked}) as (problem, figure)")
    fails = (F.when(F.col("problem") == PROBES[-1][0], F.col("figure") < 2)
              .otherwise(F.col("figure") == 0))
    return long.select("problem", "figure", F.coalesce(fails, F.lit(True)).alias("failed"))


def countries_resolve(product) -> DataFrame:
    """Every country in use (parties, customers, daily revenue) and whether
    dim_country holds it."""
    used = union_all([
        product.dim_party.select("country"),
        product.dim_customer.select("country"),
        product.fct_daily_revenue.select("country"),
    ]).filter(F.col("country").isNotNull()).distinct()
    dim = product.dim_country.select(F.col("country").alias("_dc"), F.lit(True).alias("_hit"))
    return (used.join(dim, F.col("country") == F.col("_dc"), "left")
                .select("country", F.coalesce("_hit", F.lit(False)).alias("resolves")))


def fiscal_not_calendar(product) -> DataFrame:
    d = product.dim_date
    late = F.col("calendar_month") >= 4
    return d.agg(
        F.count_if(late).alias("checked"),
        F.count_if(late & (F.col("fiscal_year") != F.col("calendar_year") + 1)).alias("violations"))


def revenue_conserved(product) -> DataFrame:
    """sum(detail amount_usd) == sum(net) + sum(cancelled), exactly and
    NULL-safely (an empty summary does not pass).  Two one-row aggregates
    combined by union + a second aggregate (no join)."""
    detail = product.fct_sales.agg(F.sum("amount_usd").cast("decimal(29,4)").alias("d"))
    summary = product.fct_revenue_summary.agg(
        (F.sum("revenue_usd") + F.sum("cancelled_revenue_usd")).cast("decimal(29,4)").alias("s"))
    both = (detail.select("d", F.lit(None).cast("decimal(29,4)").alias("s"))
                  .unionByName(summary.select(F.lit(None).cast("decimal(29,4)").alias("d"), "s")))
    r = both.agg(F.max("d").alias("detail_total"), F.max("s").alias("summary_total"))
    return r.select("detail_total", "summary_total",
                    F.col("detail_total").eqNullSafe(F.col("summary_total")).alias("conserved"))


def suite(product) -> DataFrame:
    """Every contract over the tables' rows, one row each: (contract, failures
    bigint, passed boolean).  What the build checks of the written tables
    themselves it adds with ``verdict``."""
    gen = generic(product).select("contract", "failures")
    seen = product.observed.get(QUANTITY)
    singular = [
        quantity_positive(product).select(F.lit(QUANTITY).alias("contract"), F.col("violations").alias("failures")) if seen is None
        else verdict(product.spark, QUANTITY, seen),
        both_systems(product).agg(F.count_if("failed").alias("failures")).select(
            F.lit("both_selling_systems_reach_the_pack").alias("contract"), "failures"),
        countries_resolve(product).agg(F.count_if(~F.col("resolves")).alias("failures")).select(
            F.lit("every_country_resolves_to_the_dimension").alias("contract"), "failures"),
        fiscal_not_calendar(product).select(
            F.lit("fiscal_year_is_not_the_calendar_year").alias("contract"),
            F.col("violations").alias("failures")),
        revenue_conserved(product).select(
            F.lit("revenue_summary_loses_no_revenue").alias("contract"),
            F.when(F.col("conserved"), 0).otherwise(1).alias("failures")),
    ]
    out = union_all([gen] + [s.select("contract", F.col("failures").cast("bigint")) for s in singular])
    return out.select("contract", F.col("failures").cast("bigint").alias("failures"),
                      (F.col("failures") == 0).alias("passed"))


def verdict(spark: SparkSession, contract: str, failures: int) -> DataFrame:
    """The row of a contract that was checked outside the suite."""
    return spark.createDataFrame([(contract, failures, failures == 0)],
                                 "contract string, failures bigint, passed boolean")


# Generic tests of the feeds as they land: these are broken on purpose.
BRONZE_CHECKS = [
    Check("bronze_pos_customers", "customer_id", "unique"),
    Check("bronze_pos_customers", "email", "not_null"),
    _av("bronze_pos_customers", "country", ACCEPTED_COUNTRIES),
    *_nn("bronze_pos_orders", "quantity", "unit_price"),
    Check("bronze_pos_orders", "order_id", "unique"),
    _rel("bronze_pos_orders", "product_id", "bronze_ref_product_hierarchy", "product_id"),
]


def offenders(model, checks=BRONZE_CHECKS) -> DataFrame:
    """The rows behind the counts: ``contract``, the offending ``value`` and
    the row as JSON text ``offender``."""
    return union_all([
        violations(model, c).select(F.lit(c.name).alias("contract"), F.col(c.column).cast("string").alias("value"),
                                    F.to_json(F.struct("*")).alias("offender")) for c in checks])
