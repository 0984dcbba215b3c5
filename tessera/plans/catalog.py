"""The registered queries: one per operator / model of the product.

Every query reads the scale factor's tables (through the test-data adapter)
and returns a DataFrame.  Those that land a feed or read one model several
times write it to scratch first; the rest is lazy.  ``ORACLE`` holds the DuckDB SQL each one is
checked against (omitted only where noted).
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.conform import usd_amount
from tessera.functions.dates import date_spine
from tessera.operators.asof import carry_forward, carry_forward_rows
from tessera.operators.contracts import evaluate
from tessera.operators.identity import cohorts, key_overlap
from tessera.operators.joins import BROADCAST_MAX_ROWS
from tessera.operators.profile import field_presence, union_all
from tessera.operators.quarantine import completeness
from tessera.plans import contract_suite as K
from tessera.plans import gold, oracle, silver
from tessera.plans.product import Product
from tessera.plans.profiles import bronze_metrics, silver_metrics
from tessera.plans.snapshot import (SLICERS, against, build_evidence, build_figures, figures, measures,
                                    measures_match_snapshot, reconcile, snapshot)
from tessera.session import scratch_path
from tessera.sources import landing
from tessera.sources.testdata import TestData
from tessera.types import POS_CUSTOMERS_SCHEMA, POS_ORDERS_SCHEMA, RATE, WEB_ORDER_DDL

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _p(spark, sf_dir) -> Product:
    return Product.from_testdata(spark, sf_dir)


def _ps(spark, sf_dir) -> Product:
    """For the summary family: the party table is read for the buyers and
    again for their segments, so it is written once (and the customers it
    scans three times)."""
    return _p(spark, sf_dir).materialize("silver_customers", "silver_party")


def _pm(spark, sf_dir, *models: str) -> Product:
    """For checks that read some models several times: those are written once,
    in dependency order, and the summary is built from the written sales fact
    where that is among them."""
    source = "sales" if "fct_sales" in models else "lines"
    return Product.from_testdata(spark, sf_dir, source).materialize(*models)


_SALES = ("silver_customers", "silver_fx_daily", "silver_party", "fct_sales")
_CHECKED = ("silver_customers", "silver_orders", "silver_web_order_lines", "silver_fx_daily", "silver_party",
            "fct_orders", "fct_sales", "dim_product", "dim_date", "dim_country", "fct_daily_revenue", "fct_revenue_summary")


W = oracle.with_ctes

# --- bronze: landing formats round-tripped through the readers -------------
@query("bronze_csv_scan", W("SELECT * FROM bronze_pos_customers", ["bronze_pos_customers"]))
def bronze_csv_scan(spark, sf_dir):
    path = scratch_path(spark, "landing/pos/customers")
    landing.write_csv(TestData(spark, sf_dir).pos_customers(), path)
    return landing.read_csv(spark, path, POS_CUSTOMERS_SCHEMA)


@query("bronze_json_lines", W("SELECT * FROM bronze_pos_orders", ["bronze_pos_orders"]))
def bronze_json_lines(spark, sf_dir):
    path = scratch_path(spark, "landing/pos/orders")
    landing.write_json_lines(TestData(spark, sf_dir).pos_orders(), path)
    return landing.read_json_lines(spark, path, POS_ORDERS_SCHEMA)


@query("bronze_stream_ingest", W("SELECT * FROM bronze_pos_orders", ["bronze_pos_orders"]))
def bronze_stream_ingest(spark, sf_dir):
    """The POS order feed landed in a day folder and ingested by the
    ``availableNow`` stream (checkpointed); returns the streamed bronze table."""
    import os

    from tessera.streaming import ingest_feed, read_ingested
    root = scratch_path(spark, "stream")
    feed = os.path.join(root, "landing/pos/orders")
    landing.write_json_lines(TestData(spark, sf_dir).pos_orders(), os.path.join(feed, "2026-07-01"))
    bronze = os.path.join(root, "bronze/pos_orders")
    ingest_feed(spark, feed, "json_lines", POS_ORDERS_SCHEMA, bronze, os.path.join(root, "checkpoint"))
    return read_ingested(spark, bronze, POS_ORDERS_SCHEMA)


_LINE_TEXT_SQL = ("line_no || ':' || product_id || ':' || quantity || ':' || unit_price")


@query("bronze_json_array", W(f"""
SELECT web_order_id, email, placed_at, status, CAST(count(*) AS INTEGER) AS n_lines,
       string_agg({_LINE_TEXT_SQL}, ',' ORDER BY line_no, product_id, quantity, unit_price) AS lines
FROM bronze_web_order_rows GROUP BY web_order_id, email, placed_at, status""", ["bronze_web_order_rows"]))
def bronze_json_array(spark, sf_dir):
    """The basket pages read back: every field of every line, in basket order."""
    path = scratch_path(spark, "landing/web/orders")
    landing.write_json_array_pages(TestData(spark, sf_dir).web_orders(), path)
    rows = landing.read_json_array(spark, path, WEB_ORDER_DDL)
    line = "concat_ws(':', l.line_no, l.product_id, l.quantity, l.unit_price)"
    return rows.select("web_order_id", "email", "placed_at", "status", F.size("lines").alias("n_lines"),
                       F.expr(f"array_join(transform(lines, l -> {line}), ',')").alias("lines"))


_BRONZE_METRICS_SQL = W("""
SELECT 'customer_column_names' AS metric, CAST(NULL AS BIGINT) AS value,
       'customer_id,name,email,country,marketing_segment,loyalty_tier,nation_key' AS text FROM (SELECT count(*) FROM bronze_pos_customers)
UNION ALL
SELECT t || '_blank_columns', NULL, coalesce(string_agg(t || '.' || c, ',' ORDER BY c) FILTER (blank), '') FROM (
  UNPIVOT (SELECT 'bronze_web_customers' AS t, count(email) = 0 AS email, count(full_name) = 0 AS full_name,
                  count(country) = 0 AS country, count(signup_ts) = 0 AS signup_ts FROM bronze_web_customers)
    ON email, full_name, country, signup_ts INTO NAME c VALUE blank
  UNION ALL
  UNPIVOT (SELECT 'bronze_web_products' AS t, count(product_id) = 0 AS product_id, count(title) = 0 AS title,
                  count(list_price) = 0 AS list_price FROM bronze_web_products)
    ON product_id, title, list_price INTO NAME c VALUE blank
  UNION ALL
  UNPIVOT (SELECT 'bronze_web_orders' AS t, count(web_order_id) = 0 AS web_order_id, count(email) = 0 AS email,
                  count(placed_at) = 0 AS placed_at, count(status) = 0 AS status, count(line_no) = 0 AS lines
           FROM bronze_web_order_rows) ON web_order_id, email, placed_at, status, lines INTO NAME c VALUE blank)
GROUP BY t
UNION ALL
SELECT metric, CAST(value AS BIGINT) AS value, CAST(NULL AS VARCHAR) AS text FROM (
  SELECT 'bronze_pos_customers' AS metric, count(*) AS value FROM bronze_pos_customers
  UNION ALL SELECT 'distinct_customers', count(DISTINCT customer_id) FROM bronze_pos_customers
  UNION ALL SELECT 'customer_columns', 7
  UNION ALL SELECT 'bronze_pos_orders', count(*) FROM bronze_pos_orders
  UNION ALL SELECT 'distinct_orders', count(DISTINCT order_id) FROM bronze_pos_orders
  UNION ALL SELECT 'bronze_web_customers', count(*) FROM bronze_web_customers
  UNION ALL SELECT 'bronze_web_products', count(*) FROM bronze_web_products
  UNION ALL SELECT 'bronze_web_orders', count(*) FROM bronze_web_orders
  UNION ALL SELECT 'web_orders_has_lines', 1
  UNION ALL SELECT 'shared_emails', count(*) FROM (
      SELECT email FROM bronze_web_customers WHERE email IS NOT NULL AND email <> ''
      INTERSECT SELECT email FROM bronze_pos_customers WHERE email IS NOT NULL AND email <> '')
  UNION ALL SELECT 'bronze_ref_fx_rates', count(*) FROM bronze_ref_fx_rates
  UNION ALL SELECT 'fx_currencies', count(DISTINCT currency) FROM bronze_ref_fx_rates
  UNION ALL SELECT 'fx_published_days', count(DISTINCT rate_date) FROM bronze_ref_fx_rates
  UNION ALL SELECT 'fx_calendar_span', max(rate_date) - min(rate_date) + 1 FROM bronze_ref_fx_rates
  UNION ALL SELECT 'bronze_ref_product_hierarchy', count(*) FROM bronze_ref_product_hierarchy
  UNION ALL SELECT 'departments', count(DISTINCT department) FROM bronze_ref_product_hierarchy
  UNION ALL SELECT 'bronze_erp_customer_changes', count(*) FROM bronze_erp_customer_changes
)""", ["bronze_pos_customers", "bronze_pos_orders", "bronze_web_customers", "bronze_web_products",
       "bronze_web_orders", "bronze_web_order_rows", "bronze_ref_fx_rates", "bronze_ref_product_hierarchy",
       "bronze_erp_customer_changes"])


@query("bronze_profile", _BRONZE_METRICS_SQL)
def bronze_profile(spark, sf_dir):
    """Bronze metrics: one aggregate per table, stacked to (metric, value)."""
    return bronze_metrics(TestData(spark, sf_dir).bronze())


def _presence_sql(table: str, cols: list[str], src: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS non_null, "
        f"count({c}) = 0 AS is_blank FROM {src}" for c in cols)


_WEB_CUSTOMER_FIELDS = ["email", "full_name", "country", "signup_ts"]
_WEB_PRODUCT_FIELDS = ["product_id", "title", "list_price"]
_WEB_ORDER_FIELDS = ["web_order_id", "email", "placed_at", "status"]


@query("blank_columns", W(" UNION ALL ".join([
        _presence_sql("bronze_web_customers", _WEB_CUSTOMER_FIELDS, "bronze_web_customers"),
        _presence_sql("bronze_web_products", _WEB_PRODUCT_FIELDS, "bronze_web_products"),
        _presence_sql("bronze_web_orders", _WEB_ORDER_FIELDS, "bronze_web_orders"),
        "SELECT 'bronze_web_orders', 'lines', CAST(count(*) AS BIGINT), count(*) = 0 "
        "FROM bronze_web_orders"]),
    ["bronze_web_customers", "bronze_web_products", "bronze_web_orders"]))
def blank_columns(spark, sf_dir):
    """Declared web fields that carry no value at all (one pass per table)."""
    t = TestData(spark, sf_dir)
    return union_all([
        field_presence(t.web_customers(), "bronze_web_customers", _WEB_CUSTOMER_FIELDS),
        field_presence(t.web_products(), "bronze_web_products", _WEB_PRODUCT_FIELDS),
        field_presence(t.web_orders(), "bronze_web_orders", _WEB_ORDER_FIELDS + ["lines"]),
    ])


# --- silver ----------------------------------------------------------------
@query("dedupe_latest", oracle.model("pos_latest"))
def dedupe_latest(spark, sf_dir):
    return _p(spark, sf_dir).latest_orders


for _name in ["silver_customers", "silver_orders", "silver_quarantine_orders",
              "silver_web_customers", "silver_web_order_lines", "silver_product_hierarchy",
              "silver_fx_daily", "silver_party"]:
    query(_name, oracle.model(_name))(
        (lambda n: lambda spark, sf_dir: _p(spark, sf_dir).model(n))(_name))


@query("quarantine_completeness", W("""
SELECT CAST(count(*) AS BIGINT) AS n_in,
       CAST(count(*) FILTER (WHERE NOT (quantity <= 0 OR unit_price IS NULL)) AS BIGINT) AS n_ok,
       CAST(count(*) FILTER (WHERE (quantity <= 0 OR unit_price IS NULL)) AS BIGINT) AS n_rejected,
       CAST(count(*) FILTER (WHERE (quantity <= 0 OR unit_price IS NULL) IS NULL) AS BIGINT) AS n_unclassified
FROM pos_latest""", ["pos_latest"]))
def quarantine_completeness(spark, sf_dir):
    return completeness(_p(spark, sf_dir).latest_orders, silver.quarantine_rules())


@query("date_spine", oracle.model("fx_calendar"))
def date_spine_q(spark, sf_dir):
    quotes = silver.fx_quotes(_p(spark, sf_dir)._fx_bronze())
    bounds = quotes.agg(F.min("rate_date").alias("lo"), F.max("rate_date").alias("hi"))
    return date_spine(bounds)


@query("asof_range_join", W("""
SELECT o.order_id, o.currency, CAST(o.order_date AS DATE) AS order_date,
       q.rate_date AS quoted_on, q.rate_to_usd
FROM silver_orders o
ASOF LEFT JOIN fx_quotes q ON q.currency = o.currency AND CAST(o.order_date AS DATE) >= q.rate_date
""", ["silver_orders", "fx_quotes"]))
def asof_range_join(spark, sf_dir):
    """Each accepted POS order with the latest quote on or before its day:
    the carried grid + an equi-join (linear), not a range join."""
    p = _p(spark, sf_dir)
    o = p.silver_orders.select("order_id", "currency", F.col("order_date").cast("date").alias("order_date"))
    return gold.priced(o, p.silver_fx_daily, F.col("order_date"), p.fx_broadcast, ("quoted_on", "rate_to_usd"))


# A quote feed with what a vendor gets wrong: quotes without a currency, one
# currency's quotes of 21 days sent twice (the resend a cent higher), and a
# currency whose quotes begin a year after the first orders.
oracle.cte("fx_dirty_sent", ["fx_quotes"], """
  SELECT CASE WHEN currency = 'EUR' AND (rate_date - DATE '1970-01-01') % 9 = 0 THEN NULL ELSE currency END AS currency,
         rate_date, rate_to_usd
  FROM fx_quotes WHERE NOT (currency = 'SGD' AND rate_date < (SELECT min(rate_date) FROM fx_quotes) + 365)
  UNION ALL
  SELECT currency, rate_date, CAST(rate_to_usd + 0.01 AS DECIMAL(19,6)) FROM fx_quotes
  WHERE currency = 'GBP' AND (rate_date - DATE '1970-01-01') % 7 < 3""")
oracle.cte("fx_dirty_daily", ["fx_dirty_sent"], """
  SELECT d.rate_date, d.currency, q.rate_to_usd, q.rate_date AS quoted_on, q.rate_date <> d.rate_date AS rate_is_carried
  FROM (SELECT day.rate_date, day.currency, sent.rate_date AS quoted_on
        FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS rate_date, currency
              FROM (SELECT min(rate_date) AS lo, max(rate_date) AS hi FROM fx_dirty_sent),
                   (SELECT DISTINCT currency FROM fx_dirty_sent WHERE currency IS NOT NULL)) day
        ASOF JOIN (SELECT DISTINCT currency, rate_date FROM fx_dirty_sent) sent
          ON sent.currency = day.currency AND day.rate_date >= sent.rate_date) d
  JOIN fx_dirty_sent q ON q.currency = d.currency AND q.rate_date = d.quoted_on""")
# The dirty feed of the uniqueness contract, whose last 60 days are missing too.
oracle.cte("fx_dirty_quotes", ["fx_quotes"], """
  SELECT CASE WHEN currency = 'EUR' AND (rate_date - DATE '1970-01-01') % 9 = 0 THEN NULL ELSE currency END AS currency,
         rate_date, rate_to_usd
  FROM fx_quotes WHERE NOT (currency = 'SGD' AND rate_date < (SELECT min(rate_date) FROM fx_quotes) + 365)
    AND rate_date <= (SELECT max(rate_date) FROM fx_quotes) - 60
  UNION ALL
  SELECT currency, rate_date, CAST(rate_to_usd + 0.01 AS DECIMAL(19,6)) FROM fx_quotes
  WHERE currency = 'GBP' AND (rate_date - DATE '1970-01-01') % 7 < 3 AND rate_date <= (SELECT max(rate_date) FROM fx_quotes) - 60""")


def _dirty_quotes(p: Product) -> DataFrame:
    q = silver.fx_quotes(p._fx_bronze())
    first = q.select(F.min("rate_date")).scalar()
    day = F.unix_date("rate_date")
    sent = q.filter(~((F.col("currency") == "SGD") & (F.col("rate_date") < F.date_add(first, 365)))).withColumn(
        "currency", F.when((F.col("currency") == "EUR") & (day % 9 == 0), None).otherwise(F.col("currency")))
    again = q.filter((F.col("currency") == "GBP") & (day % 7 < 3)).withColumn(
        "rate_to_usd", (F.col("rate_to_usd") + F.lit(Decimal("0.01"))).cast(RATE))
    return sent.unionByName(again)


@query("fx_dirty_carry", oracle.with_ctes("SELECT * FROM fx_dirty_daily", ["fx_dirty_daily"]))
def fx_dirty_carry(spark, sf_dir):
    """Quotes without a currency price nothing, a day quoted twice stays
    doubled on every day it is carried to, a late currency starts late."""
    return carry_forward(_dirty_quotes(_p(spark, sf_dir)), "currency", "rate_date", ["rate_to_usd"])


@query("fx_dirty_unpriced", oracle.with_ctes("""
SELECT o.currency, CAST(count(*) AS BIGINT) AS rows_out, CAST(count(fx.rate_to_usd) AS BIGINT) AS priced,
       CAST(count(*) FILTER (WHERE fx.rate_to_usd IS NULL) AS BIGINT) AS unpriced,
       CAST(sum(CAST(o.amount * fx.rate_to_usd AS DECIMAL(19,4))) AS DECIMAL(29,4)) AS amount_usd
FROM silver_orders o LEFT JOIN fx_dirty_daily fx
  ON fx.currency = o.currency AND fx.rate_date = CAST(o.order_date AS DATE)
GROUP BY o.currency""", ["silver_orders", "fx_dirty_daily"]))
def fx_dirty_unpriced(spark, sf_dir):
    """POS orders priced at the dirty feed: orders before their currency's
    first quote stay, without a rate; doubled quotes double their orders."""
    p = _p(spark, sf_dir)
    quotes = _dirty_quotes(p)
    daily = carry_forward(quotes, "currency", "rate_date", ["rate_to_usd"])
    small = carry_forward_rows(quotes, "currency", "rate_date") <= BROADCAST_MAX_ROWS
    o = p.silver_orders.select("currency", "amount", F.col("order_date").cast("date").alias("order_date"))
    j = gold.priced(o, daily, F.col("order_date"), small)
    return j.groupBy("currency").agg(
        F.count(F.lit(1)).alias("rows_out"), F.count("rate_to_usd").alias("priced"),
        F.count_if(F.col("rate_to_usd").isNull()).alias("unpriced"),
        F.sum(usd_amount("amount", "rate_to_usd")).cast("decimal(29,4)").alias("amount_usd"))


@query("contract_fx_unique", oracle.with_ctes("""
SELECT 'feed' AS quotes, CAST(count(*) AS BIGINT) AS keys, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS failures
FROM (SELECT currency, rate_date, count(*) AS n FROM fx_quotes GROUP BY currency, rate_date)
UNION ALL
SELECT 'dirty feed', CAST(count(*) AS BIGINT), CAST(count(*) FILTER (WHERE n > 1) AS BIGINT)
FROM (SELECT currency, rate_date, count(*) AS n FROM fx_dirty_quotes WHERE currency IS NOT NULL GROUP BY currency, rate_date)
""", ["fx_quotes", "fx_dirty_quotes"]))
def contract_fx_unique(spark, sf_dir):
    """One quote per currency and day: the feed, and the dirty feed, which breaks it."""
    p = _p(spark, sf_dir)
    feed = silver.fx_quotes(p._fx_bronze())
    last = feed.select(F.max("rate_date")).scalar()
    feeds = {"feed": feed, "dirty feed": _dirty_quotes(p).filter(F.col("rate_date") <= F.date_sub(last, 60))}
    return union_all([K.quotes_unique(q).select(F.lit(name).alias("quotes"), "keys", "failures")
                      for name, q in feeds.items()])


@query("party_cohorts", W("""
SELECT CAST(count(*) AS BIGINT) AS parties,
       CAST(count(*) FILTER (WHERE in_pos AND in_web) AS BIGINT) AS matched,
       CAST(count(*) FILTER (WHERE in_pos AND NOT in_web) AS BIGINT) AS pos_only,
       CAST(count(*) FILTER (WHERE NOT in_pos AND in_web) AS BIGINT) AS web_only,
       CAST(count(*) FILTER (WHERE email = '') AS BIGINT) AS no_email
FROM silver_party""", ["silver_party"]))
def party_cohorts(spark, sf_dir):
    return cohorts(_p(spark, sf_dir).silver_party)


@query("identity_match_lift", W("""
SELECT n.naive_matches, m.normalized_matches, m.normalized_matches - n.naive_matches AS lift
FROM (SELECT CAST(count(*) AS BIGINT) AS naive_matches FROM (
        SELECT email FROM bronze_pos_customers WHERE email IS NOT NULL AND email <> ''
        INTERSECT SELECT email FROM bronze_web_customers WHERE email IS NOT NULL AND email <> '')) n,
     (SELECT CAST(count(*) AS BIGINT) AS normalized_matches FROM silver_party WHERE in_pos AND in_web) m
""", ["bronze_pos_customers", "bronze_web_customers", "silver_party"]))
def identity_match_lift(spark, sf_dir):
    """Raw-spelling e-mail overlap vs matches after normalising."""
    p = _p(spark, sf_dir)
    naive = key_overlap(p.bronze["bronze_pos_customers"], p.bronze["bronze_web_customers"], "email")
    norm = p.silver_party.agg(F.count_if(F.col("in_pos") & F.col("in_web")).alias("normalized_matches"))
    both = union_all([
        naive.select(F.col("overlap").cast("bigint").alias("naive_matches"),
                     F.lit(None).cast("bigint").alias("normalized_matches")),
        norm.select(F.lit(None).cast("bigint").alias("naive_matches"),
                    F.col("normalized_matches").cast("bigint")),
    ]).agg(F.max("naive_matches").alias("naive_matches"),
           F.max("normalized_matches").alias("normalized_matches"))
    return both.select("naive_matches", "normalized_matches",
                       (F.col("normalized_matches") - F.col("naive_matches")).alias("lift"))


@query("silver_profile", W("""
SELECT metric, CAST(value AS BIGINT) AS value, CAST(NULL AS VARCHAR) AS text FROM (
  SELECT 'naive_case_sensitive_matches' AS metric, count(*) AS value FROM (
      SELECT email FROM bronze_web_customers WHERE email <> '' INTERSECT SELECT email FROM bronze_pos_customers)
  UNION ALL
  SELECT 'silver_customers' AS metric, count(*) AS value FROM silver_customers
  UNION ALL SELECT 'customer_columns', 6
  UNION ALL SELECT 'countries', count(DISTINCT country) FROM silver_customers
  UNION ALL SELECT 'missing_email', count(*) FILTER (WHERE email = '') FROM silver_customers
  UNION ALL SELECT 'silver_orders', count(*) FROM silver_orders
  UNION ALL SELECT 'silver_quarantine_orders', count(*) FROM silver_quarantine_orders
  UNION ALL SELECT 'silver_product_hierarchy', count(*) FROM silver_product_hierarchy
  UNION ALL SELECT 'silver_fx_daily', count(*) FROM silver_fx_daily
  UNION ALL SELECT 'fx_carried', count(*) FILTER (WHERE rate_is_carried) FROM silver_fx_daily
  UNION ALL SELECT 'fx_currencies', count(DISTINCT currency) FROM silver_fx_daily
  UNION ALL SELECT 'fx_calendar_days', count(DISTINCT rate_date) FROM silver_fx_daily
  UNION ALL SELECT 'silver_web_customers', count(*) FROM silver_web_customers
  UNION ALL SELECT 'silver_web_order_lines', count(*) FROM silver_web_order_lines
  UNION ALL SELECT 'web_first_day', min(order_date) - DATE '1970-01-01' FROM silver_web_order_lines
  UNION ALL SELECT 'web_last_day', max(order_date) - DATE '1970-01-01' FROM silver_web_order_lines
  UNION ALL SELECT 'silver_party', count(*) FROM silver_party
  UNION ALL SELECT 'party_matched', count(*) FILTER (WHERE in_pos AND in_web) FROM silver_party
  UNION ALL SELECT 'party_pos_only', count(*) FILTER (WHERE in_pos AND NOT in_web) FROM silver_party
  UNION ALL SELECT 'party_web_only', count(*) FILTER (WHERE NOT in_pos AND in_web) FROM silver_party
  UNION ALL SELECT 'party_no_email', count(*) FILTER (WHERE email = '') FROM silver_party
)""", ["silver_customers", "silver_orders", "silver_quarantine_orders", "silver_product_hierarchy",
       "silver_fx_daily", "silver_web_customers", "silver_web_order_lines", "silver_party",
       "bronze_pos_customers", "bronze_web_customers"]))
def silver_profile(spark, sf_dir):
    return silver_metrics(_p(spark, sf_dir))


@query("silver_countries", W("SELECT DISTINCT country FROM silver_customers", ["silver_customers"]))
def silver_countries(spark, sf_dir):
    """The set of conformed POS countries (a sorted set in the silver metrics):
    distinct rows, never gathered into one array."""
    return _p(spark, sf_dir).silver_customers.select("country").distinct().orderBy("country")


# --- gold ----------------------------------------------------------------------
for _name in Product.GOLD:
    if _name == "fct_revenue_summary":
        continue
    query(_name, oracle.model(_name))(
        (lambda n: lambda spark, sf_dir: _p(spark, sf_dir).model(n))(_name))


@query("fct_revenue_summary", oracle.model("fct_revenue_summary"))
def fct_revenue_summary(spark, sf_dir):
    return _ps(spark, sf_dir).fct_revenue_summary


@query("fx_left_unpriced", W("""
SELECT CAST(count(*) AS BIGINT) AS orders,
       CAST(count(rate_to_usd) AS BIGINT) AS priced,
       CAST(count(*) FILTER (WHERE rate_to_usd IS NULL) AS BIGINT) AS unpriced,
       CAST(count(*) FILTER (WHERE rate_is_carried) AS BIGINT) AS at_carried_rate
FROM fct_orders""", ["fct_orders"]))
def fx_left_unpriced(spark, sf_dir):
    o = _p(spark, sf_dir).fct_orders
    return o.agg(F.count(F.lit(1)).alias("orders"), F.count("rate_to_usd").alias("priced"),
                 F.count_if(F.col("rate_to_usd").isNull()).alias("unpriced"),
                 F.count_if("rate_is_carried").alias("at_carried_rate"))


@query("unpublished_skus", W("""
SELECT DISTINCT s.product_id FROM fct_sales s
WHERE s.product_id NOT IN (SELECT product_id FROM published)""", ["fct_sales", "published"]))
def unpublished_skus(spark, sf_dir):
    p = _p(spark, sf_dir)
    return gold.unpublished_skus(p._dated_products, p.silver_product_hierarchy)


@query("measures_by_slicer", W("""
SELECT CASE WHEN grouping(fiscal_year_label) = 0 THEN 'fiscal_year_label'
            WHEN grouping(customer_segment) = 0 THEN 'customer_segment'
            WHEN grouping(product_segment) = 0 THEN 'product_segment'
            ELSE 'channel_system' END AS slicer,
       coalesce(fiscal_year_label, customer_segment, product_segment, channel_system) AS member,
       CAST(sum(revenue_usd) AS DECIMAL(29,4)) AS revenue_usd,
       CAST(sum(cancelled_revenue_usd) AS DECIMAL(29,4)) AS cancelled_revenue_usd,
       CAST(sum(sale_lines) AS BIGINT) AS sale_lines
FROM fct_revenue_summary
GROUP BY GROUPING SETS ((fiscal_year_label), (customer_segment), (product_segment), (channel_system))
""", ["fct_revenue_summary"]))
def measures_by_slicer(spark, sf_dir):
    return measures(_ps(spark, sf_dir).fct_revenue_summary)


_SNAPSHOT_SQL = """
SELECT CAST(sum(revenue_usd) AS DECIMAL(29,4)) AS revenue_usd,
       CAST(sum(cancelled_revenue_usd) AS DECIMAL(29,4)) AS cancelled_revenue_usd,
       CAST(sum(sale_lines) AS BIGINT) AS sale_lines
FROM fct_revenue_summary"""


@query("product_snapshot", W(_SNAPSHOT_SQL, ["fct_revenue_summary"]))
def product_snapshot(spark, sf_dir):
    return snapshot(_ps(spark, sf_dir).fct_revenue_summary)


_PER_SLICER_SQL = "\n  UNION ALL ".join(
    f"SELECT '{s}' AS slicer, CAST(sum(r) AS DECIMAL(29,4)) AS revenue_usd, "
    f"CAST(sum(c) AS DECIMAL(29,4)) AS cancelled_revenue_usd, CAST(sum(n) AS BIGINT) AS sale_lines "
    f"FROM (SELECT {s}, sum(revenue_usd) AS r, sum(cancelled_revenue_usd) AS c, sum(sale_lines) AS n "
    f"FROM fct_revenue_summary GROUP BY {s})"
    for s in SLICERS)


@query("measures_match_snapshot", W(f"""
SELECT per.slicer, per.revenue_usd, per.cancelled_revenue_usd, per.sale_lines,
       snap.revenue_usd AS snapshot_revenue_usd,
       snap.cancelled_revenue_usd AS snapshot_cancelled_revenue_usd,
       snap.sale_lines AS snapshot_sale_lines,
       (per.revenue_usd IS NOT DISTINCT FROM snap.revenue_usd
        AND per.cancelled_revenue_usd IS NOT DISTINCT FROM snap.cancelled_revenue_usd
        AND per.sale_lines IS NOT DISTINCT FROM snap.sale_lines) AS agrees
FROM ({_PER_SLICER_SQL}) per, ({_SNAPSHOT_SQL}) snap""", ["fct_revenue_summary"]))
def measures_match_snapshot_query(spark, sf_dir):
    """K14: each measure, sliced by each slicer, adds up to its snapshot figure."""
    return measures_match_snapshot(_ps(spark, sf_dir).fct_revenue_summary)


# The figures of every build from the sales fact itself, not from a summary:
# the seeded build has lost the cancelled web lines, another has built nothing.
_RECONCILE_SQL = """
WITH detail AS (
  SELECT CAST(ifnull(sum(amount_usd) FILTER (NOT is_cancelled), 0) AS DECIMAL(29,4)) AS net,
         CAST(ifnull(sum(amount_usd) FILTER (is_cancelled), 0) AS DECIMAL(29,4)) AS cancelled,
         count(*) AS lines, count(*) FILTER (NOT is_cancelled) AS net_lines,
         count(DISTINCT channel_system) FILTER (NOT is_cancelled AND amount_usd <> 0) AS systems,
         CAST(sum(amount_usd) AS DECIMAL(29,4)) AS total FROM fct_sales),
published AS (
  SELECT unnest(['sales', 'lines', 'joins']) AS build, net AS revenue_usd, cancelled AS cancelled_revenue_usd,
         lines AS sale_lines, systems FROM detail
  UNION ALL SELECT 'lost_cancellations', net, CAST(0 AS DECIMAL(29,4)), net_lines, systems FROM detail
  UNION ALL SELECT 'nothing_built', NULL, NULL, NULL, 0)
SELECT p.build, p.revenue_usd, p.cancelled_revenue_usd, CAST(p.sale_lines AS BIGINT) AS sale_lines,
       CAST((p.systems < 2)::INT + (p.revenue_usd + p.cancelled_revenue_usd IS DISTINCT FROM d.total)::INT AS BIGINT)
         AS contract_failures, CAST(NULL AS VARCHAR) AS gap,
       ifnull(p.revenue_usd <> 0 OR p.cancelled_revenue_usd <> 0 OR p.sale_lines <> 0, false) AS has_evidence,
       ifnull((p.revenue_usd, p.cancelled_revenue_usd, p.sale_lines) = (d.net, d.cancelled, d.lines), false) AS agrees_with_base,
       CASE WHEN p.sale_lines IS NULL THEN 'no evidence' WHEN (p.cancelled_revenue_usd, p.sale_lines) <> (d.cancelled, d.lines) THEN 'differs'
            WHEN p.systems < 2 OR p.revenue_usd + p.cancelled_revenue_usd IS DISTINCT FROM d.total THEN 'failed contracts'
            ELSE 'agrees' END AS verdict
FROM published p, detail d
UNION ALL SELECT 'not_run', NULL, NULL, NULL, 0, 'no such engine here', false, false, 'gap'"""


@query("reconcile_builds", W("SELECT * FROM (" + _RECONCILE_SQL + ")", ["fct_sales"]))
def reconcile_builds(spark, sf_dir):
    """The three builds of the management summary must publish the same
    figures and pass their contracts; a build that lost lines, one that built
    nothing and one that names why it did not run must show.

    The priced lines are written once, for the build from lines and for the
    sales fact, and deleted before the builds from the fact run."""
    p = _pm(spark, sf_dir, "silver_customers", "silver_fx_daily", "silver_party", "sales_lines")
    product = (p.silver_product_hierarchy, p.dim_party, p.products_broadcast)
    lines = build_figures("lines", gold.revenue_summary_from_lines(p.sales_lines, *product))
    sales = p.materialize("fct_sales").drop("sales_lines").fct_sales
    builds = {
        "sales": gold.revenue_summary(sales, *product),
        "joins": gold.revenue_summary_joined(sales, p.dim_date, p.dim_product, p.dim_party),
        "lost_cancellations": gold.revenue_summary(sales.filter(~F.col("is_cancelled")), *product),
        "nothing_built": gold.revenue_summary(sales.filter(F.col("sale_id").isNull()), *product),
    }
    return reconcile(build_evidence(builds, sales, {"not_run": "no such engine here"}, run=[lines]), "sales")


@query("snapshot_figures", W("""
SELECT figure, value AS published, value AS wanted, 'equal' AS verdict FROM (
  UNPIVOT (SELECT CAST(CAST(ifnull(sum(amount_usd) FILTER (NOT is_cancelled), 0) AS DECIMAL(29,4)) AS VARCHAR) AS revenue_usd,
                  CAST(CAST(ifnull(sum(amount_usd) FILTER (is_cancelled), 0) AS DECIMAL(29,4)) AS VARCHAR) AS cancelled_revenue_usd,
                  CAST(count(*) AS VARCHAR) AS sale_lines FROM fct_sales)
    ON revenue_usd, cancelled_revenue_usd, sale_lines INTO NAME figure VALUE value)""", ["fct_sales"]))
def snapshot_figures(spark, sf_dir):
    """K12: what the snapshot publishes beside what the sales fact says it must."""
    p = _pm(spark, sf_dir, *_SALES)
    amount, gone = F.col("amount_usd"), F.col("is_cancelled")
    wanted = p.fct_sales.agg(
        F.coalesce(F.sum(F.when(~gone, amount)), F.lit(0)).cast("decimal(29,4)").alias("revenue_usd"),
        F.coalesce(F.sum(F.when(gone, amount)), F.lit(0)).cast("decimal(29,4)").alias("cancelled_revenue_usd"),
        F.count(F.lit(1)).alias("sale_lines"))
    return against(figures(snapshot(p.fct_revenue_summary)), figures(wanted))


# --- contracts -----------------------------------------------------------------
def _generic_sql(checks) -> tuple[str, list[str]]:
    parts, needs = [], set()
    for c in checks:
        needs.add(c.table)
        if c.test == "not_null":
            sql = f"SELECT count(*) FILTER (WHERE {c.column} IS NULL) FROM {c.table}"
        elif c.test == "accepted_values":
            vals = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in c.values)
            sql = (f"SELECT count(*) FILTER (WHERE {c.column} IS NOT NULL AND {c.column} NOT IN ({vals})) "
                   f"FROM {c.table}")
        elif c.test == "unique":
            sql = (f"SELECT count(*) FROM (SELECT {c.column} FROM {c.table} WHERE {c.column} IS NOT NULL "
                   f"GROUP BY {c.column} HAVING count(*) > 1)")
        else:
            needs.add(c.to_table)
            sql = (f"SELECT count(*) FROM {c.table} ch LEFT JOIN {c.to_table} pa "
                   f"ON ch.{c.column} = pa.{c.to_column} WHERE ch.{c.column} IS NOT NULL AND pa.{c.to_column} IS NULL")
        parts.append(f"SELECT '{c.name}' AS contract, '{c.table}' AS table_name, '{c.column}' AS column_name, "
                     f"'{c.test}' AS test, CAST(({sql}) AS BIGINT) AS failures")
    return "\n  UNION ALL ".join(parts), sorted(needs)


_GEN_SQL, _GEN_NEEDS = _generic_sql(K.SILVER_CHECKS + K.GOLD_CHECKS)


@query("contract_generic", W(_GEN_SQL, _GEN_NEEDS))
def contract_generic(spark, sf_dir):
    return K.generic(_pm(spark, sf_dir, *_CHECKED))


_REL = [c for c in K.GOLD_CHECKS if c.test == "relationships"]
_REL_SQL, _REL_NEEDS = _generic_sql(_REL)


@query("orphan_fk", W(
    "SELECT r.table_name AS child_table, r.column_name AS child_column, p.parent_table, p.parent_column, "
    f"r.failures AS orphans FROM ({_REL_SQL}) r JOIN (VALUES "
    + ", ".join(f"('{c.name}', '{c.to_table}', '{c.to_column}')" for c in _REL)
    + ") p(contract, parent_table, parent_column) ON p.contract = r.contract", _REL_NEEDS))
def orphan_fk(spark, sf_dir):
    return K.relationships(_pm(spark, sf_dir, *_SALES, "dim_product"))


@query("contract_quantity", W("""
SELECT CAST(count(*) AS BIGINT) AS checked,
       CAST(count(*) FILTER (WHERE quantity <= 0 OR quantity IS NULL) AS BIGINT) AS violations
FROM silver_orders""", ["silver_orders"]))
def contract_quantity(spark, sf_dir):
    return K.quantity_positive(_p(spark, sf_dir))


_PROBE_FIGURES = {
    "no WEB revenue": "sum(CASE WHEN channel_system = 'WEB' THEN revenue_usd ELSE 0 END)",
    "no POS revenue": "sum(CASE WHEN channel_system = 'POS' THEN revenue_usd ELSE 0 END)",
    "no cancelled revenue": "sum(cancelled_revenue_usd)",
    "unallocated product revenue vanished": "sum(CASE WHEN department = 'Unallocated' THEN revenue_usd ELSE 0 END)",
    "unsegmented customer revenue vanished":
        "sum(CASE WHEN customer_segment = 'Unsegmented' THEN revenue_usd ELSE 0 END)",
    "the pack covers only one fiscal quarter": "count(DISTINCT fiscal_quarter_label)",
}


@query("contract_both_systems", W(
    "SELECT problem, figure, coalesce(CASE WHEN problem = 'the pack covers only one fiscal quarter' "
    "THEN figure < 2 ELSE figure = 0 END, true) AS failed FROM ("
    + " UNION ALL ".join(f"SELECT '{p}' AS problem, CAST({e} AS DECIMAL(29,4)) AS figure FROM fct_revenue_summary"
                         for p, e in _PROBE_FIGURES.items()) + ")", ["fct_revenue_summary"]))
def contract_both_systems(spark, sf_dir):
    return K.both_systems(_ps(spark, sf_dir))


@query("orphan_countries", W("""
SELECT u.country, d.country IS NOT NULL AS resolves FROM (
  SELECT DISTINCT country FROM dim_party WHERE country IS NOT NULL
  UNION SELECT DISTINCT country FROM dim_customer WHERE country IS NOT NULL
  UNION SELECT DISTINCT country FROM fct_daily_revenue WHERE country IS NOT NULL) u
LEFT JOIN dim_country d ON d.country = u.country""", ["dim_party", "dim_customer", "fct_daily_revenue",
                                                      "dim_country"]))
def orphan_countries(spark, sf_dir):
    return K.countries_resolve(_p(spark, sf_dir).materialize("silver_customers", "silver_party"))


@query("contract_fiscal", W("""
SELECT CAST(count(*) FILTER (WHERE calendar_month >= 4) AS BIGINT) AS checked,
       CAST(count(*) FILTER (WHERE calendar_month >= 4 AND fiscal_year <> calendar_year + 1) AS BIGINT) AS violations
FROM dim_date""", ["dim_date"]))
def contract_fiscal(spark, sf_dir):
    return K.fiscal_not_calendar(_p(spark, sf_dir))


@query("contract_revenue_conserved", W("""
SELECT d.total AS detail_total, s.total AS summary_total, d.total IS NOT DISTINCT FROM s.total AS conserved
FROM (SELECT CAST(sum(amount_usd) AS DECIMAL(29,4)) AS total FROM fct_sales) d,
     (SELECT CAST(sum(revenue_usd) + sum(cancelled_revenue_usd) AS DECIMAL(29,4)) AS total
      FROM fct_revenue_summary) s""", ["fct_sales", "fct_revenue_summary"]))
def contract_revenue_conserved(spark, sf_dir):
    return K.revenue_conserved(_pm(spark, sf_dir, *_SALES))


_SINGULAR_SQL = f"""
  UNION ALL SELECT 'silver_orders_never_holds_a_non_positive_quantity',
    CAST((SELECT count(*) FROM silver_orders WHERE quantity <= 0 OR quantity IS NULL) AS BIGINT)
  UNION ALL SELECT 'both_selling_systems_reach_the_pack', CAST((SELECT
    (CASE WHEN coalesce(sum(CASE WHEN channel_system = 'WEB' THEN revenue_usd ELSE 0 END) = 0, true) THEN 1 ELSE 0 END)
  + (CASE WHEN coalesce(sum(CASE WHEN channel_system = 'POS' THEN revenue_usd ELSE 0 END) = 0, true) THEN 1 ELSE 0 END)
  + (CASE WHEN coalesce(sum(cancelled_revenue_usd) = 0, true) THEN 1 ELSE 0 END)
  + (CASE WHEN coalesce(sum(CASE WHEN department = 'Unallocated' THEN revenue_usd ELSE 0 END) = 0, true) THEN 1 ELSE 0 END)
  + (CASE WHEN coalesce(sum(CASE WHEN customer_segment = 'Unsegmented' THEN revenue_usd ELSE 0 END) = 0, true) THEN 1 ELSE 0 END)
  + (CASE WHEN count(DISTINCT fiscal_quarter_label) < 2 THEN 1 ELSE 0 END) FROM fct_revenue_summary) AS BIGINT)
  UNION ALL SELECT 'every_country_resolves_to_the_dimension', CAST((SELECT count(*) FROM (
      SELECT country FROM dim_party WHERE country IS NOT NULL UNION
      SELECT country FROM dim_customer WHERE country IS NOT NULL UNION
      SELECT country FROM fct_daily_revenue WHERE country IS NOT NULL) u
    WHERE u.country NOT IN (SELECT country FROM dim_country WHERE country IS NOT NULL)) AS BIGINT)
  UNION ALL SELECT 'fiscal_year_is_not_the_calendar_year',
    CAST((SELECT count(*) FROM dim_date WHERE calendar_month >= 4 AND fiscal_year <> calendar_year + 1) AS BIGINT)
  UNION ALL SELECT 'revenue_summary_loses_no_revenue', CAST((SELECT CASE WHEN
      (SELECT CAST(sum(amount_usd) AS DECIMAL(29,4)) FROM fct_sales) IS NOT DISTINCT FROM
      (SELECT CAST(sum(revenue_usd) + sum(cancelled_revenue_usd) AS DECIMAL(29,4)) FROM fct_revenue_summary)
    THEN 0 ELSE 1 END) AS BIGINT)"""


@query("contract_suite", W(
    "SELECT contract, failures, failures = 0 AS passed FROM ("
    + "SELECT contract, failures FROM (" + _GEN_SQL + ")" + _SINGULAR_SQL + ")",
    sorted(set(_GEN_NEEDS) | {"fct_revenue_summary", "fct_sales", "dim_date", "dim_party", "dim_customer",
                              "fct_daily_revenue", "dim_country", "silver_orders"})))
def contract_suite(spark, sf_dir):
    """All 60 declared tests and the 5 singular contracts over rows, one row each."""
    return K.suite(_pm(spark, sf_dir, *_CHECKED))


_BRONZE_GEN_SQL, _BRONZE_GEN_NEEDS = _generic_sql(K.BRONZE_CHECKS)


@query("contract_on_bronze", W(_BRONZE_GEN_SQL, _BRONZE_GEN_NEEDS))
def contract_on_bronze(spark, sf_dir):
    """The generic tests on the feeds as they land, which break every one of them."""
    t = TestData(spark, sf_dir).bronze()
    return evaluate(t.__getitem__, K.BRONZE_CHECKS)


def _offenders_sql() -> str:
    parts = []
    for c in K.BRONZE_CHECKS:
        where = {"not_null": f"{c.column} IS NULL", "unique": f"{c.column} IN (SELECT {c.column} FROM {c.table} GROUP BY 1 HAVING count(*) > 1)",
                 "accepted_values": f"{c.column} NOT IN ({', '.join(repr(v) for v in c.values)})",
                 "relationships": f"{c.column} NOT IN (SELECT {c.to_column} FROM {c.to_table})"}[c.test]
        parts.append(f"SELECT '{c.name}' AS contract, CAST({c.column} AS VARCHAR) AS value, count(*) AS n FROM {c.table} WHERE {where} GROUP BY ALL")
    return " UNION ALL ".join(parts)


@query("contract_offenders", W("SELECT contract, value, CAST(n AS BIGINT) AS offending_rows FROM (" + _offenders_sql() + ")", _BRONZE_GEN_NEEDS))
def contract_offenders(spark, sf_dir):
    """The offending rows of the tests above, counted per contract and value."""
    t = TestData(spark, sf_dir).bronze()
    return K.offenders(t.__getitem__).groupBy("contract", "value").agg(F.count("offender").alias("offending_rows"))


# further queries, registered by being imported
from tessera.plans import catalog_feeds  # noqa: E402, F401


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


__all__ = ["queries", "oracle_sql", "QUERIES", "ORACLE"]
