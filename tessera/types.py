"""Fixed values of the product, and the bronze column contract.

Everything in the block marked FIXED VALUES must stay exactly as written: the
gold figures, the contracts and the oracle all depend on these spellings.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the product definition; do not reorder or respell)
# ---------------------------------------------------------------------------
MONEY = "decimal(19,4)"
RATE = "decimal(19,6)"

# Country spellings the vendors send -> conformed ISO code.  Values not listed
# pass through as upper(trim(value)).
COUNTRY = {
    "US": "US",
    "USA": "US",
    "U.S.": "US",
    "UNITED STATES": "US",
    "GB": "GB",
    "GBR": "GB",
    "UK": "GB",
    "U.K.": "GB",
    "UNITED KINGDOM": "GB",
    "SG": "SG",
    "SGP": "SG",
    "SINGAPORE": "SG",
}

# Business names of the conformed countries (dim_country.country_name).
COUNTRY_NAME = {"US": "United States", "GB": "United Kingdom", "SG": "Singapore"}

# The financial year starts on 1 April.
FISCAL_YEAR_START_MONTH = 4

# Quarantine reasons, first matching rule wins.
REASON_NON_POSITIVE_QUANTITY = "non_positive_quantity"
REASON_MISSING_UNIT_PRICE = "missing_unit_price"

# Party keys.
POS_KEY_PREFIX = "pos:"
EMAIL_KEY_PREFIX = "email:"

# Members used at the reporting boundary.
UNPUBLISHED_PRODUCT_NAME = "Unpublished SKU"
UNALLOCATED = "Unallocated"
UNSEGMENTED = "Unsegmented"
UNKNOWN_COUNTRY = "Unknown"

# Accepted values of the gold contracts.
ACCEPTED_COUNTRIES = ["US", "GB", "SG"]
ACCEPTED_MARKETING_SEGMENTS = ["value", "mainstream", "premium", "lapsed", "new"]
ACCEPTED_PRODUCT_SEGMENTS = ["Core", "Peripheral", "Unallocated"]
ACCEPTED_CHANNEL_SYSTEMS = ["POS", "WEB"]
ACCEPTED_FISCAL_QUARTERS = [1, 2, 3, 4]

# Column-name fragments that mark a money column, and the type prefixes money
# may have.
MONEY_NAME_FRAGMENTS = ["amount", "price", "revenue", "rate_to"]
EXACT_NUMERIC_PREFIXES = ["decimal", "numeric"]

# Headline figures of a product snapshot.
SNAPSHOT_KEYS = ["revenue_usd", "cancelled_revenue_usd", "sale_lines"]

# Bronze as it lands.  The POS customer feed is CSV (all strings); the POS
# order feed is JSON lines (numbers land as long/double); the web feeds are
# pages of JSON arrays read with these DDLs; reference data is parquet.
POS_CUSTOMERS_SCHEMA = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in [
            "customer_id",
            "name",
            "email",
            "country",
            "marketing_segment",
            "loyalty_tier",
            "nation_key",
        ]
    ]
)

POS_ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("order_date", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("store_id", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("discount_pct", T.DoubleType()),
        T.StructField("tax_rate", T.DoubleType()),
        T.StructField("shipping_fee", T.DoubleType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("is_gift", T.BooleanType()),
        T.StructField("promo_code", T.StringType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("event_seq", T.LongType()),
    ]
)

WEB_CUSTOMER_DDL = "email string, full_name string, country string, signup_ts string"
WEB_PRODUCT_DDL = "product_id string, title string, list_price decimal(19,4)"
WEB_ORDER_DDL = (
    "web_order_id string, email string, placed_at string, status string, "
    "lines array<struct<line_no:int, product_id:string, quantity:int, "
    "unit_price:decimal(19,4)>>"
)

# Columns silver reads from each bronze table (the bronze column contract).
# Extra columns are allowed; names compare case-insensitively.
BRONZE_CONTRACT = {
    "bronze_pos_customers": [
        "customer_id",
        "name",
        "email",
        "country",
        "marketing_segment",
        "loyalty_tier",
    ],
    "bronze_pos_orders": [f.name for f in POS_ORDERS_SCHEMA.fields],
    "bronze_web_customers": ["email", "full_name", "country", "signup_ts"],
    "bronze_web_orders": ["web_order_id", "email", "placed_at", "status", "lines"],
    "bronze_ref_product_hierarchy": [
        "product_id",
        "product_name",
        "category",
        "department",
        "segment",
        "list_price_usd",
    ],
    "bronze_ref_fx_rates": ["currency", "rate_date", "rate_to_usd"],
}
# ---------------------------------------------------------------------------

#: The columns of a POS order event, as every layer that keeps them whole has them.
ORDER_COLUMNS = [f.name for f in POS_ORDERS_SCHEMA.fields]
