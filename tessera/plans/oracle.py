"""DuckDB oracle SQL for the registered queries.

Written from the *definitions* (as-of joins for FX, EXCEPT for unpublished SKUs,
the calendar nine months on for the fiscal year, left and anti parts for the
parties ...) so that it checks the Spark plans rather than restating them.  Each query is a WITH clause over the raw test
tables: the adapter, then silver, then gold, as CTEs.
"""

from __future__ import annotations

from tessera.sources.testdata import (COUNTRY_SPELLINGS, CURRENCIES, FX_MARGIN_DAYS,
                                      FX_QUOTE_PLAN, MONDAY, SEGMENT_OF_MKTSEGMENT)
from tessera.types import COUNTRY, COUNTRY_NAME, ORDER_COLUMNS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(xs) -> str:
    return "[" + ", ".join(_q(x) for x in xs) + "]"


def spelling(k: str) -> str:
    s = f"{_list(COUNTRY_SPELLINGS)}[{k} % 12 + 1]"
    s5 = f"CASE WHEN {k} % 5 = 0 THEN lower({s}) ELSE {s} END"
    return f"CASE WHEN {k} % 7 = 0 THEN ' ' || {s5} || ' ' ELSE {s5} END"


def pos_email(k: str) -> str:
    return (f"CASE WHEN {k} % 31 = 0 THEN NULL WHEN {k} % 3 = 0 THEN ' User' || {k} || '@Example.COM ' "
            f"ELSE 'user' || {k} || '@example.com' END")


def web_email(k: str) -> str:
    return (f"CASE WHEN {k} % 4 = 3 THEN 'shopper' || {k} || '@example.com' "
            f"WHEN {k} % 7 = 0 THEN 'user' || {k} || '@example.com' "
            f"ELSE 'User' || {k} || '@Example.com' END")


def conform(col: str) -> str:
    whens = " ".join(f"WHEN {_q(a)} THEN {_q(b)}" for a, b in COUNTRY.items())
    return f"coalesce(CASE upper(trim({col})) {whens} END, upper(trim({col})))"


_SEG = " ".join(f"WHEN {_q(a)} THEN {_q(b)}" for a, b in SEGMENT_OF_MKTSEGMENT.items())


def _pos_customer_select(name_expr: str) -> str:
    return f"""SELECT 'C' || c_custkey AS customer_id, {name_expr} AS name,
        {pos_email('c_custkey')} AS email, {spelling('c_custkey')} AS country,
        CASE c_mktsegment {_SEG} ELSE 'new' END AS marketing_segment,
        CASE WHEN c_acctbal < 0 THEN 'basic' WHEN c_acctbal < 3000 THEN 'bronze'
             WHEN c_acctbal < 7000 THEN 'silver' ELSE 'gold' END AS loyalty_tier,
        CAST(c_nationkey AS VARCHAR) AS nation_key
      FROM customer"""


_FX_PLAN = ", ".join(f"({_q(c)}, {a}, {b}, {bp})" for c, (a, b, bp) in FX_QUOTE_PLAN.items())

# name -> (sql, dependencies)
CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = (sql, deps)


# --- adapter (bronze) --------------------------------------------------------
cte("b_lines", [], """
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_extendedprice,
         l.l_discount, l.l_tax, l.l_returnflag, o.o_orderkey, o.o_custkey, o.o_orderstatus,
         o.o_orderdate, o.o_orderpriority,
         (o.o_orderkey % 2 = 1 AND o.o_custkey % 5 <> 0) AS is_web
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")

cte("bronze_pos_customers", [], _pos_customer_select("c_name") + "\n  UNION ALL\n  "
    + _pos_customer_select("upper(c_name)") + " WHERE c_custkey % 50 = 0")

cte("bronze_pos_orders", ["b_lines"], f"""
  SELECT 'O' || o_orderkey AS order_id, 'C' || o_custkey AS customer_id, 'P' || l_partkey AS product_id,
    strftime(o_orderdate, '%Y-%m-%d') AS order_date,
    CASE WHEN l_suppkey % 4 = 0 THEN 'kiosk' ELSE 'counter' END AS channel,
    'S' || l_suppkey AS store_id,
    {_list(CURRENCIES)}[o_custkey % 4 + 1] AS currency,
    l_discount AS discount_pct, l_tax AS tax_rate,
    CASE WHEN l_returnflag = 'R' THEN CAST(0.0 AS DOUBLE) ELSE CAST(4.99 AS DOUBLE) END AS shipping_fee,
    CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'card' ELSE 'cash' END AS payment_method,
    (l_returnflag = 'A') AS is_gift,
    CASE WHEN l_discount >= CAST(0.08 AS DOUBLE) THEN 'PROMO8' END AS promo_code,
    CASE (l_orderkey + l_linenumber) % 40 WHEN 0 THEN CAST(0 AS BIGINT)
         WHEN 1 THEN -CAST(floor(l_quantity) AS BIGINT) WHEN 3 THEN CAST(NULL AS BIGINT)
         ELSE CAST(floor(l_quantity) AS BIGINT) END AS quantity,
    CASE WHEN (l_orderkey + l_linenumber) % 40 = 2 THEN CAST(NULL AS DOUBLE) ELSE l_extendedprice END AS unit_price,
    CASE o_orderstatus WHEN 'F' THEN 'shipped' WHEN 'O' THEN 'pending' ELSE 'error' END AS status,
    CAST(l_linenumber AS BIGINT) AS event_seq
  FROM b_lines WHERE NOT is_web""")

cte("bronze_web_customers", [], f"""
  SELECT {web_email('c_custkey')} AS email, c_name AS full_name, {spelling('c_custkey')} AS country,
    '2019-' || lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') || '-15T09:00:00Z' AS signup_ts
  FROM customer WHERE c_custkey % 5 <> 0""")

# the web baskets, flattened
cte("bronze_web_order_rows", ["b_lines"], f"""
  SELECT 'W' || o_orderkey AS web_order_id, {web_email('o_custkey')} AS email,
    CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || 'T03:30:00+08:00'
         ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T12:00:00+00:00' END AS placed_at,
    CASE WHEN o_orderkey % 20 = 1 THEN 'cancelled' ELSE 'completed' END AS status,
    CAST(l_linenumber AS INTEGER) AS line_no, 'P' || l_partkey AS product_id,
    CAST(floor(l_quantity) AS INTEGER) AS quantity,
    CAST(l_extendedprice AS DECIMAL(19,4)) AS unit_price
  FROM b_lines WHERE is_web""")

cte("bronze_web_orders", ["bronze_web_order_rows"], """
  SELECT DISTINCT web_order_id, email, placed_at, status FROM bronze_web_order_rows""")

cte("bronze_web_products", [], """
  SELECT 'P' || p_partkey AS product_id, p_name AS title,
         CAST(p_retailprice AS DECIMAL(19,4)) AS list_price FROM part""")

cte("bronze_ref_product_hierarchy", [], """
  SELECT 'P' || p_partkey AS product_id, p_name AS product_name, p_type AS category,
    CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'Essentials'
         WHEN p_type IN ('LARGE', 'MEDIUM') THEN 'Home' ELSE 'Accessories' END AS department,
    CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'Peripheral' ELSE 'Core' END AS segment,
    p_retailprice AS list_price_usd
  FROM part WHERE p_partkey % 50 <> 7""")

cte("bronze_ref_fx_rates", [], f"""
  SELECT currency, rate_date,
    CASE WHEN currency = 'USD' THEN CAST(1.0 AS DOUBLE)
         ELSE CAST(bp + (rate_date - DATE '1970-01-01') % 50 AS DOUBLE) / CAST(10000.0 AS DOUBLE) END AS rate_to_usd
  FROM (
    SELECT currency, bp, CAST(unnest(generate_series(lo + a, hi + b, INTERVAL 1 DAY)) AS DATE) AS rate_date
    FROM (SELECT CAST(min(o_orderdate) AS DATE) - {FX_MARGIN_DAYS} AS lo,
                 CAST(max(o_orderdate) AS DATE) + {FX_MARGIN_DAYS} AS hi FROM orders) b,
         (VALUES {_FX_PLAN}) p(currency, a, b, bp)
  ) WHERE (rate_date - DATE '{MONDAY}') % 7 < 5""")

cte("bronze_erp_customer_changes", [], """
  SELECT event_id AS change_id, 'C' || user_id AS customer_id,
    CASE WHEN event_type = 'purchase' THEN 'I' WHEN event_type = 'error' THEN 'D' ELSE 'U' END AS op,
    ts AS changed_at FROM events""")

# --- silver --------------------------------------------------------------------
_CUST_TIES = ", ".join(f"{c} ASC NULLS FIRST" for c in
                       ["name", "email", "country", "marketing_segment", "loyalty_tier"])
cte("silver_customers", ["bronze_pos_customers"], f"""
  SELECT customer_id, name, lower(trim(coalesce(email, ''))) AS email, {conform('country')} AS country,
         marketing_segment, loyalty_tier
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY {_CUST_TIES}) AS rn
        FROM bronze_pos_customers) WHERE rn = 1""")

_ORDER_TIES = ", ".join(f"{c} ASC NULLS FIRST" for c in ORDER_COLUMNS if c != "order_id")
cte("pos_latest", ["bronze_pos_orders"], f"""
  SELECT {', '.join(ORDER_COLUMNS)} FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY event_seq DESC NULLS LAST, {_ORDER_TIES}) AS rn
    FROM bronze_pos_orders) WHERE rn = 1""")

cte("silver_orders", ["pos_latest"], """
  SELECT order_id, customer_id, product_id, order_date, channel, store_id, currency, discount_pct,
         tax_rate, shipping_fee, payment_method, is_gift, promo_code, quantity, status, event_seq,
         CAST(unit_price AS DECIMAL(19,4)) AS unit_price,
         CAST(quantity * unit_price AS DECIMAL(19,4)) AS amount
  FROM pos_latest WHERE NOT (quantity <= 0 OR unit_price IS NULL)""")

cte("silver_quarantine_orders", ["pos_latest"], """
  SELECT order_id, customer_id, product_id, order_date, quantity, unit_price, status, event_seq,
         CASE WHEN quantity <= 0 THEN 'non_positive_quantity'
              WHEN unit_price IS NULL THEN 'missing_unit_price' END AS quarantine_reason
  FROM pos_latest WHERE (quantity <= 0 OR unit_price IS NULL)""")

cte("silver_web_customers", ["bronze_web_customers"], f"""
  SELECT lower(trim(email)) AS email, full_name, {conform('country')} AS country, signup_ts
  FROM bronze_web_customers""")

cte("silver_web_order_lines", ["bronze_web_order_rows"], """
  SELECT web_order_id, lower(trim(email)) AS email,
    CAST(DATE '1970-01-01' + CAST(floor(epoch(CAST(placed_at AS TIMESTAMPTZ)) / 86400) AS INTEGER) AS DATE) AS order_date,
    status, line_no, product_id, quantity, CAST(unit_price AS DECIMAL(19,4)) AS unit_price,
    CAST(quantity * unit_price AS DECIMAL(19,4)) AS amount, 'USD' AS currency
  FROM bronze_web_order_rows""")

cte("silver_product_hierarchy", ["bronze_ref_product_hierarchy"], """
  SELECT product_id, product_name, category, department, segment,
         CAST(list_price_usd AS DECIMAL(19,4)) AS list_price_usd
  FROM bronze_ref_product_hierarchy""")

cte("fx_quotes", ["bronze_ref_fx_rates"], """
  SELECT currency, rate_date, CAST(rate_to_usd AS DECIMAL(19,6)) AS rate_to_usd FROM bronze_ref_fx_rates""")

cte("fx_calendar", ["fx_quotes"], """
  SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS rate_date
  FROM (SELECT min(rate_date) AS lo, max(rate_date) AS hi FROM fx_quotes)""")

cte("silver_fx_daily", ["fx_quotes", "fx_calendar"], """
  SELECT day.rate_date, day.currency, quote.rate_to_usd, quote.rate_date AS quoted_on,
         quote.rate_date < day.rate_date AS rate_is_carried
  FROM (SELECT rate_date, currency FROM fx_calendar, (SELECT currency FROM fx_quotes GROUP BY currency)) day
  ASOF JOIN fx_quotes quote ON quote.currency = day.currency AND day.rate_date >= quote.rate_date""")

cte("silver_party", ["silver_customers", "silver_web_customers"], """
  SELECT key AS party_key, email, customer_id AS pos_customer_id, true AS in_pos,
         EXISTS (SELECT 1 FROM silver_web_customers a WHERE 'email:' || a.email = key) AS in_web,
         country, marketing_segment, loyalty_tier
  FROM (SELECT *, if(email = '', 'pos:' || customer_id, 'email:' || email) AS key FROM silver_customers)
  UNION ALL
  SELECT 'email:' || email, email, NULL, false, true, country, NULL, NULL
  FROM silver_web_customers a
  WHERE NOT EXISTS (SELECT 1 FROM silver_customers c WHERE c.email <> '' AND c.email = a.email)""")

# --- gold ------------------------------------------------------------------------
# days behind the calendar's end have no rate, however old the last quote is
cte("fct_orders", ["silver_orders", "silver_fx_daily"], """
  WITH dated AS (SELECT *, CAST(order_date AS DATE) AS rate_date FROM silver_orders)
  SELECT order_id, customer_id, product_id, order_date, channel, status, currency, quantity, unit_price, amount,
         rate_to_usd, rate_is_carried, CAST(amount * rate_to_usd AS DECIMAL(19,4)) AS amount_usd
  FROM dated LEFT JOIN silver_fx_daily USING (currency, rate_date)""")

cte("dim_party", ["silver_party"], """
  SELECT party_key, email, pos_customer_id, in_pos, in_web, country, marketing_segment, loyalty_tier
  FROM silver_party""")

cte("dim_customer", ["silver_customers"], """
  SELECT customer_id, name, email, country, marketing_segment, loyalty_tier FROM silver_customers""")

cte("fct_sales", ["fct_orders", "silver_party", "silver_web_order_lines", "silver_fx_daily"], """
  WITH shop AS (
    SELECT buyer.party_key, o.order_id AS sale_id, o.product_id, CAST(o.order_date AS DATE) AS order_date,
           'POS' AS channel_system, false AS is_cancelled, CAST(o.quantity AS BIGINT) AS quantity, o.amount,
           o.currency, o.rate_to_usd, o.rate_is_carried, o.amount_usd
    FROM silver_party buyer, fct_orders o WHERE buyer.pos_customer_id = o.customer_id),
  storefront AS (
    SELECT buyer.party_key, l.web_order_id AS sale_id, l.product_id, l.order_date, 'WEB' AS channel_system,
           l.status IS NOT DISTINCT FROM 'cancelled' AS is_cancelled, CAST(l.quantity AS BIGINT) AS quantity, l.amount,
           l.currency
    FROM silver_party buyer, silver_web_order_lines l WHERE buyer.in_web AND buyer.email = l.email)
  SELECT * FROM shop
  UNION ALL
  SELECT s.*, rate.rate_to_usd, rate.rate_is_carried, CAST(s.amount * rate.rate_to_usd AS DECIMAL(19,4))
  FROM storefront s LEFT JOIN silver_fx_daily rate ON rate.currency = s.currency AND rate.rate_date = s.order_date""")

cte("dim_country", ["dim_party"], " ".join([
    "SELECT country, CASE country",
    " ".join(f"WHEN {_q(a)} THEN {_q(b)}" for a, b in COUNTRY_NAME.items()),
    "ELSE country END AS country_name",
    "FROM (SELECT DISTINCT country FROM dim_party WHERE country IS NOT NULL)"]))

cte("published", ["silver_product_hierarchy"], """
  SELECT product_id, product_name, category, department, segment AS product_segment, list_price_usd
  FROM silver_product_hierarchy""")

cte("dim_product", ["published", "fct_sales"], """
  FROM published
  UNION ALL BY NAME
  SELECT product_id, 'Unpublished SKU' AS product_name, 'Unallocated' AS category, 'Unallocated' AS department,
         'Unallocated' AS product_segment, CAST(NULL AS DECIMAL(19,4)) AS list_price_usd
  FROM (SELECT product_id FROM fct_sales EXCEPT SELECT product_id FROM published)
  WHERE (SELECT count(*) = count(product_id) FROM published)""")

# the fiscal year starts in April: the calendar of nine months later
cte("dim_date", ["fct_sales"], """
  SELECT date_key, CAST(date_part('year', date_key) AS INTEGER) AS calendar_year,
         CAST(date_part('month', date_key) AS INTEGER) AS calendar_month,
         CAST(date_part('quarter', date_key) AS INTEGER) AS calendar_quarter,
         CAST(date_part('year', fiscal) AS INTEGER) AS fiscal_year,
         CAST(date_part('quarter', fiscal) AS INTEGER) AS fiscal_quarter,
         CAST(date_part('month', fiscal) AS INTEGER) AS fiscal_period,
         strftime(fiscal, 'FY%y') AS fiscal_year_label,
         strftime(fiscal, 'FY%y Q') || date_part('quarter', fiscal) AS fiscal_quarter_label
  FROM (SELECT order_date AS date_key, date_trunc('month', order_date) + INTERVAL 9 MONTH AS fiscal
        FROM fct_sales GROUP BY order_date)""")

cte("fct_daily_revenue", ["silver_orders", "silver_customers"], """
  FROM silver_orders JOIN silver_customers USING (customer_id)
  SELECT order_date, country, count(*) AS orders, CAST(sum(quantity) AS BIGINT) AS units,
         CAST(sum(amount) AS DECIMAL(29,4)) AS revenue
  GROUP BY ALL""")

cte("fct_revenue_summary", ["fct_sales", "dim_date", "dim_product", "silver_party"], """
  SELECT fiscal_year, fiscal_year_label, fiscal_quarter, fiscal_quarter_label, channel_system, department, product_segment,
         ifnull(buyer.marketing_segment, 'Unsegmented') AS customer_segment, ifnull(buyer.country, 'Unknown') AS country,
         count(*) AS sale_lines,
         CAST(ifnull(sum(quantity) FILTER (NOT is_cancelled), 0) AS BIGINT) AS units,
         CAST(ifnull(sum(amount_usd) FILTER (NOT is_cancelled), 0) AS DECIMAL(29,4)) AS revenue_usd,
         CAST(ifnull(sum(amount_usd) FILTER (is_cancelled), 0) AS DECIMAL(29,4)) AS cancelled_revenue_usd,
         CAST(ifnull(sum(amount_usd) FILTER (NOT is_cancelled AND rate_is_carried), 0) AS DECIMAL(29,4))
           AS revenue_at_carried_rate
  FROM fct_sales
  JOIN dim_date ON date_key = order_date
  JOIN dim_product USING (product_id)
  LEFT JOIN silver_party buyer USING (party_key)
  GROUP BY ALL""")


def with_ctes(body: str, needs: list[str]) -> str:
    """``WITH`` the CTEs ``needs`` (and their dependencies, in order) + body."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    parts = [f"{n} AS ({CTES[n][0]}\n)" for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body


def model(name: str) -> str:
    return with_ctes(f"SELECT * FROM {name}", [name])
