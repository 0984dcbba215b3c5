"""Registered queries on feeds that differ from what is declared, on times
that do not parse, as-of on timestamps, and stored builds that differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.asof_ranges import asof_join
from tessera.operators.contracts import bucketed, buckets_for, evaluate
from tessera.operators.profile import union_all
from tessera.operators.quarantine import routed
from tessera.operators.treediff import tree_difference
from tessera.plans import contract_suite as K
from tessera.plans import oracle, silver
from tessera.plans.catalog import query
from tessera.plans.lineage import column_lineage
from tessera.plans.product import Product
from tessera.plans.publish import Store, bound
from tessera.session import scratch_path
from tessera.sources import landing, tolerant
from tessera.sources.testdata import TestData
from tessera.types import POS_CUSTOMERS_SCHEMA, POS_ORDERS_SCHEMA

_COLUMNS = [f.name for f in POS_CUSTOMERS_SCHEMA.fields]


def _rescued() -> Column:
    return F.array_join(F.array_sort(F.transform(F.map_entries("_rescued"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",").alias("rescued")


def _version() -> Column:
    return F.regexp_extract("_file", "/(v[0-9])/", 1).alias("version")


# --- a customer feed in four shapes --------------------------------------------------
_BROKEN_NAME = "CAST(substr(customer_id, 2) AS BIGINT) % 8 = 3"


def _customer_versions(spark, sf_dir: str) -> str:
    """The POS customers, each in one of four file versions: as declared; in
    another order with further columns; without two columns; and unquoted, so
    that a name with a comma makes a line of one field too many."""
    path, n = scratch_path(spark, "landing/pos/customer_versions"), "CAST(substr(customer_id, 2) AS BIGINT)"
    customers = TestData(spark, sf_dir).pos_customers()

    def version(k: int) -> DataFrame:
        return customers.where(f"{n} % 4 = {k}")

    landing.write_csv(version(0), f"{path}/v0")
    landing.write_csv(version(1).selectExpr("email", "customer_id AS Customer_ID", f"{n} * 3 AS crm_score", "name", "country", "nation_key",
                                            "loyalty_tier", "marketing_segment", f"{n} % 9 = 1 AS opt_in"), f"{path}/v1")
    landing.write_csv(version(2).drop("loyalty_tier", "nation_key"), f"{path}/v2")
    named = version(3).withColumn("name", F.expr(f"CASE WHEN {_BROKEN_NAME} THEN concat(name, ', Ltd') ELSE name END"))
    landing.write_raw_csv(named.select(F.concat_ws(",", *[F.coalesce(c, F.lit("")) for c in _COLUMNS])), ",".join(_COLUMNS), f"{path}/v3")
    return path


oracle.cte("customer_versions", ["bronze_pos_customers"], f"""
  SELECT *, 'v' || (CAST(substr(customer_id, 2) AS BIGINT) % 4) AS version, CAST(substr(customer_id, 2) AS BIGINT) AS n,
         {_BROKEN_NAME} AS broken FROM bronze_pos_customers""")


@query("bronze_csv_tolerant", oracle.with_ctes("""
SELECT version, CASE WHEN NOT broken THEN customer_id END AS customer_id, CASE WHEN NOT broken THEN name END AS name,
       CASE WHEN NOT broken THEN email END AS email, CASE WHEN NOT broken THEN country END AS country,
       CASE WHEN NOT broken THEN marketing_segment END AS marketing_segment,
       CASE WHEN NOT broken AND version <> 'v2' THEN loyalty_tier END AS loyalty_tier,
       CASE WHEN NOT broken AND version <> 'v2' THEN nation_key END AS nation_key,
       CASE WHEN version = 'v1' THEN 'crm_score=' || (n * 3) || ',opt_in=' || (n % 9 = 1) END AS rescued,
       CASE WHEN broken THEN concat_ws(',', customer_id, name || ', Ltd', coalesce(email, ''), country, marketing_segment, loyalty_tier, nation_key) END
         AS corrupt
FROM customer_versions""", ["customer_versions"]))
def bronze_csv_tolerant(spark, sf_dir):
    """The four versions read together: no row, column or broken line is lost."""
    landed = tolerant.read_csv(spark, _customer_versions(spark, sf_dir), POS_CUSTOMERS_SCHEMA)
    return landed.select(_version(), *_COLUMNS, _rescued(), F.col("_corrupt").alias("corrupt"))


@query("landing_broken_lines", oracle.with_ctes("""
SELECT version, CAST(count(*) AS BIGINT) AS records, CAST(count(*) FILTER (WHERE broken) AS BIGINT) AS broken
FROM customer_versions GROUP BY version""", ["customer_versions"]))
def landing_broken_lines(spark, sf_dir):
    """Records and broken lines per file, summed per version of the feed."""
    landed = tolerant.read_csv(spark, _customer_versions(spark, sf_dir), POS_CUSTOMERS_SCHEMA)
    return (tolerant.broken_by_file(landed).groupBy(_version())
            .agg(F.sum("records").alias("records"), F.sum("broken").alias("broken")))


# --- an order feed that drifts ----------------------------------------------------------
def _drifted_orders(spark, sf_dir: str) -> str:
    """The POS orders as JSON lines: odd events as declared; even ones with
    quantities that are fractions, a nested field more and no status, and some
    of their lines cut off."""
    path = scratch_path(spark, "landing/pos/order_versions")
    orders = TestData(spark, sf_dir).pos_orders()
    landing.write_json_lines(orders.where("event_seq % 2 = 1"), f"{path}/v0")
    new = orders.where("event_seq % 2 = 0").withColumns({
        "quantity": F.expr("CAST(quantity + 0.5 AS DECIMAL(12,1))"),
        "Loyalty": F.expr("named_struct('points', event_seq * 10, 'tier', if(is_gift, 'gold', 'basic'))")}).drop("status")
    line = F.to_json(F.struct(*new.columns))
    cut = F.expr("CAST(substr(order_id, 2) AS BIGINT) % 25 = 0")
    new.select(F.when(cut, F.substring(line, 1, 40)).otherwise(line)).write.text(f"{path}/v1")
    return path


oracle.cte("order_versions", ["bronze_pos_orders"], """
  SELECT *, event_seq % 2 = 0 AS late, event_seq % 2 = 0 AND CAST(substr(order_id, 2) AS BIGINT) % 25 = 0 AS broken FROM bronze_pos_orders""")


@query("bronze_json_tolerant", oracle.with_ctes("""
SELECT CASE WHEN late THEN 'v1' ELSE 'v0' END AS version, order_id, NOT broken AS parsed,
       CASE WHEN NOT broken THEN event_seq END AS event_seq, CASE WHEN NOT broken THEN unit_price END AS unit_price,
       CASE WHEN NOT broken THEN is_gift END AS is_gift, CASE WHEN NOT late THEN quantity END AS quantity,
       CASE WHEN NOT late THEN status END AS status,
       CASE WHEN late AND NOT broken THEN 'loyalty={"points":' || (event_seq * 10) || ',"tier":"' || (CASE WHEN is_gift THEN 'gold' ELSE 'basic' END) || '"}'
            || coalesce(',quantity=' || CAST(quantity + 0.5 AS DECIMAL(12,1)), '') END AS rescued
FROM order_versions""", ["order_versions"]))
def bronze_json_tolerant(spark, sf_dir):
    """Both versions read together; the order of a cut line is found in its text."""
    landed = tolerant.read_json_lines(spark, _drifted_orders(spark, sf_dir), POS_ORDERS_SCHEMA)
    name = F.coalesce("order_id", F.regexp_extract("_corrupt", '"order_id":"([^"]*)"', 1))
    return landed.select(_version(), name.alias("order_id"), F.col("_corrupt").isNull().alias("parsed"), "event_seq", "unit_price",
                         "is_gift", "quantity", "status", _rescued())


@query("json_schema_drift", oracle.with_ctes("""
SELECT field, declared, observed, CASE WHEN declared IS NULL THEN 'new' WHEN observed IS NULL THEN 'absent' WHEN declared = observed THEN 'none'
       WHEN declared = 'integer' AND observed = 'fraction' THEN 'widened' ELSE 'changed' END AS drift
FROM (
  SELECT field, kind AS declared, CASE WHEN field = 'quantity' AND (SELECT count(quantity) FROM order_versions WHERE late AND NOT broken) > 0
                                       THEN 'fraction' WHEN filled THEN kind END AS observed
  FROM (
    SELECT unnest(['order_id', 'customer_id', 'product_id', 'order_date', 'channel', 'store_id', 'currency', 'discount_pct', 'tax_rate', 'shipping_fee',
                   'payment_method', 'is_gift', 'promo_code', 'quantity', 'unit_price', 'status', 'event_seq']) AS field,
           unnest(['text', 'text', 'text', 'text', 'text', 'text', 'text', 'fraction', 'fraction', 'fraction',
                   'text', 'boolean', 'text', 'integer', 'fraction', 'text', 'integer']) AS kind,
           unnest([count(order_id), count(customer_id), count(product_id), count(order_date), count(channel), count(store_id), count(currency),
                   count(discount_pct), count(tax_rate), count(shipping_fee), count(payment_method), count(is_gift), count(promo_code), count(quantity),
                   count(unit_price), count(status) FILTER (WHERE NOT late), count(event_seq)]) > 0 AS filled
    FROM order_versions WHERE NOT broken)
  UNION ALL
  SELECT unnest(['loyalty', 'loyalty.points', 'loyalty.tier']), NULL, unnest(['record', 'integer', 'text'])
  FROM (SELECT count(*) AS n FROM order_versions WHERE late AND NOT broken) WHERE n > 0)""", ["order_versions"]))
def json_schema_drift(spark, sf_dir):
    """What the order feed's records hold, against what is declared."""
    return tolerant.schema_drift(spark, _drifted_orders(spark, sf_dir), POS_ORDERS_SCHEMA)


# --- as-of on timestamps ---------------------------------------------------------------
_ASOF_KEY = "CASE WHEN event_id % 3 = 0 THEN CAST(0 AS BIGINT) ELSE user_id END"


@query("asof_events", f"""
WITH e AS (SELECT event_id, {_ASOF_KEY} AS k, ts, event_type, value FROM events),
     q AS (SELECT k, ts AS bought_at, max(value) AS price FROM e WHERE event_type = 'purchase' GROUP BY k, ts)
SELECT f.event_id, f.k, f.ts, q.bought_at, q.price
FROM (SELECT * FROM e WHERE event_type <> 'purchase') f ASOF LEFT JOIN q ON q.k = f.k AND f.ts >= q.bought_at""")
def asof_events(spark, sf_dir):
    """Every other event with the last purchase of its key at or before it, to
    the microsecond; one key has a third of all rows."""
    e = TestData(spark, sf_dir).table("events").selectExpr("event_id", f"{_ASOF_KEY} AS k", "ts", "event_type", "value")
    bought = e.where("event_type = 'purchase'").selectExpr("k", "ts AS bought_at", "value AS price")
    return asof_join(e.where("event_type <> 'purchase'").select("event_id", "k", "ts"), bought, "k", "ts", "bought_at", ["price"])


# --- days that do not parse, and the routed sink ------------------------------------------
_TIMES_SQL = """CASE WHEN n % 31 = 2 THEN NULL WHEN n % 31 = 3 THEN 'soon' WHEN n % 31 = 5 THEN substr(placed_at, 1, 19)
       WHEN n % 31 = 7 THEN '' WHEN n % 31 = 11 THEN '2026-13-45T00:00:00Z' ELSE placed_at END"""
_REASON_SQL = """CASE WHEN n % 31 IN (2, 7) THEN 'missing_time' WHEN n % 31 IN (3, 11) THEN 'unparseable_time'
       WHEN n % 31 = 5 THEN 'time_without_offset' ELSE 'accepted' END"""


@query("quarantine_web_times", oracle.with_ctes(f"""
SELECT verdict, CAST(count(*) AS BIGINT) AS lines, CAST(count(order_date) FILTER (WHERE verdict = 'accepted') AS BIGINT) AS dated,
       CAST(sum(amount) AS DECIMAL(29,4)) AS amount
FROM (SELECT *, {_REASON_SQL} AS verdict FROM (SELECT *, CAST(substr(web_order_id, 2) AS BIGINT) AS n FROM silver_web_order_lines))
GROUP BY verdict""", ["silver_web_order_lines"]))
def quarantine_web_times(spark, sf_dir):
    """A storefront feed with missing, broken and offset-less times: lines and
    amounts per verdict add up to all lines and their revenue."""
    baskets = TestData(spark, sf_dir).web_orders().withColumn("n", F.expr("CAST(substr(web_order_id, 2) AS BIGINT)"))
    baskets = baskets.withColumn("placed_at", F.expr(_TIMES_SQL)).drop("n")
    good, lost = silver.web_order_lines_checked({"bronze_web_orders": baskets})
    lines = good.select(F.lit("accepted").alias("verdict"), "order_date", "amount").unionByName(
        lost.select(F.col("quarantine_reason").alias("verdict"), F.lit(None).cast("date").alias("order_date"), "amount"))
    return lines.groupBy("verdict").agg(F.count(F.lit(1)).alias("lines"), F.count("order_date").alias("dated"),
                                        F.sum("amount").cast("decimal(29,4)").alias("amount"))


@query("quarantine_routed", oracle.with_ctes("""
SELECT verdict, CAST(count(*) AS BIGINT) AS orders, CAST(sum(quantity) AS BIGINT) AS units, CAST(count(unit_price) AS BIGINT) AS priced
FROM (SELECT *, CASE WHEN quantity <= 0 THEN 'non_positive_quantity' WHEN unit_price IS NULL THEN 'missing_unit_price'
                     WHEN quantity > 0 THEN 'accepted' ELSE 'unclassified' END AS verdict FROM pos_latest) GROUP BY verdict""", ["pos_latest"]))
def quarantine_routed(spark, sf_dir):
    """Latest orders written once by verdict; both sides are pruned reads of it."""
    table = routed(Product.from_testdata(spark, sf_dir).latest_orders, silver.quarantine_rules(), scratch_path(spark, "routed/orders"))
    ok, rest = table.where("verdict = 'accepted'"), table.where("verdict <> 'accepted'")
    return ok.unionByName(rest).groupBy("verdict").agg(
        F.count(F.lit(1)).alias("orders"), F.sum("quantity").alias("units"), F.count("unit_price").alias("priced"))


# --- two stored builds that differ -----------------------------------------------------------
@query("build_difference", oracle.with_ctes("""
SELECT order_id, quantity, unit_price, side, CAST(count(*) AS BIGINT) AS times FROM (
  SELECT order_id, quantity, unit_price, 'a' AS side FROM silver_orders WHERE CAST(substr(order_id, 2) AS BIGINT) % 997 = 1
  UNION ALL
  SELECT order_id, quantity + 1, unit_price, 'b' FROM silver_orders WHERE CAST(substr(order_id, 2) AS BIGINT) % 997 = 1
  UNION ALL
  SELECT order_id, quantity, unit_price, 'a' FROM silver_orders WHERE CAST(substr(order_id, 2) AS BIGINT) % 1499 = 2) GROUP BY ALL""", ["silver_orders"]))
def build_difference(spark, sf_dir):
    """Accepted orders of two stored runs, the second with some quantities
    changed and some orders missing: exactly those rows."""
    n, runs = "CAST(substr(order_id, 2) AS BIGINT)", []
    a = Product.from_testdata(spark, sf_dir).materialize("silver_orders").silver_orders
    b = a.where(f"{n} % 1499 <> 2").withColumn("quantity", F.expr(f"CASE WHEN {n} % 997 = 1 THEN quantity + 1 ELSE quantity END"))
    for run, df in (("a", a), ("b", b)):
        path = scratch_path(spark, f"runs/{run}/silver_orders")
        df.write.parquet(path)
        runs.append(spark.read.schema(df.schema).parquet(path))
    found = tree_difference(*runs, ["order_id"])
    return found.select("order_id", "quantity", "unit_price", "side", "times")


# --- stored tables: buckets, and builds published whole ------------------------------------
_BUCKETED = [c for c in K.BRONZE_CHECKS if c.test == "relationships" or (c.table, c.test) == ("bronze_pos_customers", "unique")]


@query("contract_bucketed", oracle.with_ctes("""
SELECT 'unique_bronze_pos_customers_customer_id' AS contract,
       CAST((SELECT count(*) FROM (SELECT customer_id FROM bronze_pos_customers GROUP BY 1 HAVING count(*) > 1)) AS BIGINT) AS failures
UNION ALL
SELECT 'relationships_bronze_pos_orders_product_id', CAST(count(*) AS BIGINT) FROM bronze_pos_orders
WHERE product_id NOT IN (SELECT product_id FROM bronze_ref_product_hierarchy)""",
    ["bronze_pos_customers", "bronze_pos_orders", "bronze_ref_product_hierarchy"]))
def contract_bucketed(spark, sf_dir):
    """Uniqueness and orphans on tables stored by the key: no row is exchanged."""
    return evaluate(_bucketed_feeds(spark, sf_dir).__getitem__, _BUCKETED, stored_by_key=True).select("contract", "failures")


def _bucketed_feeds(spark, sf_dir: str, buckets: int | None = None) -> dict[str, DataFrame]:
    t = TestData(spark, sf_dir)
    buckets = buckets or buckets_for(max(t.table(name).count() for name in ("customer", "lineitem", "part")))
    return {"bronze_pos_customers": bucketed(t.pos_customers(), "customer_id", buckets),
            "bronze_pos_orders": bucketed(t.pos_orders(), "product_id", buckets),
            "bronze_ref_product_hierarchy": bucketed(t.product_hierarchy(), "product_id", buckets)}


_PUBLISHED = ["bronze_web_customers", "bronze_web_orders", "bronze_pos_customers"]


@query("published_by_name", oracle.with_ctes("""
SELECT 'silver_customers' AS model, CAST(count(*) AS BIGINT) AS n FROM silver_customers
UNION ALL SELECT 'silver_web_customers', count(*) FROM silver_web_customers
UNION ALL SELECT 'silver_web_order_lines', count(*) FROM silver_web_order_lines""",
    ["silver_customers", "silver_web_customers", "silver_web_order_lines"]))
def published_by_name(spark, sf_dir):
    """A build published whole and read by its tables' bound names, while the
    next one, half written, is not seen."""
    feeds, store = TestData(spark, sf_dir).bronze(), Store(spark, scratch_path(spark, "store"))
    first = store.stage()
    for name in _PUBLISHED:
        feeds[name].write.parquet(f"{first}/{name}")
    store.publish(first, _PUBLISHED)
    feeds[_PUBLISHED[0]].limit(0).write.parquet(f"{store.stage()}/{_PUBLISHED[0]}")
    p = Product(bound(spark, store.register(f"tessera_{first.rsplit('/', 1)[-1]}")), spark)
    models = ["silver_customers", "silver_web_customers", "silver_web_order_lines"]
    return union_all([p.model(m).agg(F.count(F.lit(1)).alias("n")).select(F.lit(m).alias("model"), "n") for m in models])


# --- lineage ---------------------------------------------------------------------------------
_LINE = ["lineitem.l_extendedprice", "lineitem.l_linenumber", "lineitem.l_orderkey", "lineitem.l_partkey", "lineitem.l_quantity", "orders.o_orderkey"]
_DAY = ["orders.o_orderdate", "orders.o_orderkey"]
_SUMMARY_SOURCES = {
    "country": ["customer.c_custkey"], "customer_segment": ["customer.c_mktsegment"],
    "department": ["part.p_partkey", "part.p_type"], "product_segment": ["part.p_partkey", "part.p_type"],
    "fiscal_year": _DAY, "fiscal_year_label": _DAY, "fiscal_quarter": _DAY, "fiscal_quarter_label": _DAY,
    "units": _LINE, "revenue_usd": [*_LINE, "fx_rates.rate_to_usd"], "cancelled_revenue_usd": [*_LINE, "fx_rates.rate_to_usd"],
    "revenue_at_carried_rate": [*_LINE, "fx_rates.rate_to_usd", "fx_rates.rate_date"]}
_SOURCES_SQL = ", ".join(f"('{c}', '{s.split('.')[0]}', '{s.split('.')[1]}')" for c, ss in _SUMMARY_SOURCES.items() for s in ss)


@query("lineage_revenue_summary", oracle.with_ctes(f"""
SELECT output_column, source_table, source_column, n AS source_rows FROM (VALUES {_SOURCES_SQL}) v(output_column, source_table, source_column)
JOIN (SELECT 'lineitem' AS source_table, count(*) AS n FROM lineitem UNION ALL SELECT 'orders', count(*) FROM orders
      UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'part', count(*) FROM part
      UNION ALL SELECT 'fx_rates', count(*) FROM bronze_ref_fx_rates) USING (source_table)""", ["bronze_ref_fx_rates"]))
def lineage_revenue_summary(spark, sf_dir):
    """Where each column of the management summary comes from, by its plan,
    with the rows that the source has now."""
    p = Product.from_testdata(spark, sf_dir)
    found = spark.createDataFrame(column_lineage(p.fct_revenue_summary), "output_column string, source_table string, source_column string")
    t = TestData(spark, sf_dir)
    tables = {n: t.table(n) for n in ("lineitem", "orders", "customer", "part")} | {"fx_rates": p.bronze["bronze_ref_fx_rates"]}
    rows = union_all([df.agg(F.count(F.lit(1)).alias("source_rows")).select(F.lit(n).alias("source_table"), "source_rows") for n, df in tables.items()])
    return found.join(F.broadcast(rows), "source_table").select("output_column", "source_table", "source_column", "source_rows")
