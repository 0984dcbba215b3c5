"""Silver: conform, de-duplicate, quarantine, carry FX forward, resolve identity.

Each builder takes the bronze frames (``dict`` by bronze table name) and
returns a lazy DataFrame; nothing here triggers a job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.conform import conform_country, money, norm_email, rate
from tessera.functions.dates import parsed_utc_date, utc_date
from tessera.operators.asof import carry_forward
from tessera.operators.dedupe import latest_by, one_per_key
from tessera.operators.identity import resolve_parties
from tessera.operators.quarantine import split
from tessera.types import ORDER_COLUMNS, REASON_MISSING_UNIT_PRICE, REASON_NON_POSITIVE_QUANTITY

def quarantine_rules():
    """(reason, predicate) in priority order; built per call (Columns need a
    live session)."""
    return [
        (REASON_NON_POSITIVE_QUANTITY, F.col("quantity") <= 0),
        (REASON_MISSING_UNIT_PRICE, F.col("unit_price").isNull()),
    ]


def customers(bronze: dict[str, DataFrame]) -> DataFrame:
    src = bronze["bronze_pos_customers"].select(
        "customer_id", "name", "email", "country", "marketing_segment", "loyalty_tier")
    one = one_per_key(src, ["customer_id"])
    return one.select(
        "customer_id",
        "name",
        norm_email("email", null_as_empty=True).alias("email"),
        conform_country("country").alias("country"),
        "marketing_segment",
        "loyalty_tier",
    )


def latest_orders(bronze: dict[str, DataFrame]) -> DataFrame:
    """The latest event per order by ``event_seq`` (not arrival order)."""
    src = bronze["bronze_pos_orders"].select(*ORDER_COLUMNS)
    return latest_by(src, ["order_id"], [F.col("event_seq").desc_nulls_last()])


def orders(bronze: dict[str, DataFrame], latest: DataFrame | None = None) -> DataFrame:
    latest = latest if latest is not None else latest_orders(bronze)
    ok, _ = split(latest, quarantine_rules())
    passthrough = [c for c in ORDER_COLUMNS if c != "unit_price"]
    return ok.select(
        *passthrough,
        money("unit_price").alias("unit_price"),
        money(F.col("quantity") * F.col("unit_price")).alias("amount"),
    )


def quarantine_orders(bronze: dict[str, DataFrame], latest: DataFrame | None = None) -> DataFrame:
    latest = latest if latest is not None else latest_orders(bronze)
    _, bad = split(latest, quarantine_rules())
    return bad.select("order_id", "customer_id", "product_id", "order_date", "quantity",
                      "unit_price", "status", "event_seq", "quarantine_reason")


def web_customers(bronze: dict[str, DataFrame]) -> DataFrame:
    return bronze["bronze_web_customers"].select(
        norm_email("email").alias("email"),
        "full_name",
        conform_country("country").alias("country"),
        "signup_ts",
    )


def web_order_lines(bronze: dict[str, DataFrame]) -> DataFrame:
    o = bronze["bronze_web_orders"]
    x = o.select("web_order_id", "email", "placed_at", "status", F.explode("lines").alias("line"))
    qty = F.col("line.quantity").cast("int")
    return x.select(
        "web_order_id",
        norm_email("email").alias("email"),
        utc_date("placed_at").alias("order_date"),
        "status",
        F.col("line.line_no").cast("int").alias("line_no"),
        F.col("line.product_id").alias("product_id"),
        qty.alias("quantity"),
        money("line.unit_price").alias("unit_price"),
        money(qty * F.col("line.unit_price")).alias("amount"),
        F.lit("USD").alias("currency"),
    )


def web_order_lines_checked(bronze: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``web_order_lines`` of the baskets whose time names a day, and the lines
    of the others with the raw time and the reason: no line leaves in silence."""
    o = bronze["bronze_web_orders"].withColumn("_day", parsed_utc_date("placed_at"))
    good = web_order_lines({"bronze_web_orders": o.where("_day.error is null")})
    bad = o.where("_day.error is not null")
    lost = web_order_lines({"bronze_web_orders": bad.withColumns(
        {"status": F.struct("status", "placed_at", F.col("_day.error").alias("error")), "placed_at": F.lit(None).cast("string")})})
    return good, lost.drop("order_date").withColumns(
        {"placed_at": F.col("status.placed_at"), "quarantine_reason": F.col("status.error"), "status": F.col("status.status")})


def product_hierarchy(bronze: dict[str, DataFrame]) -> DataFrame:
    return bronze["bronze_ref_product_hierarchy"].select(
        "product_id", "product_name", "category", "department", "segment",
        money("list_price_usd").alias("list_price_usd"))


def fx_quotes(bronze: dict[str, DataFrame]) -> DataFrame:
    return bronze["bronze_ref_fx_rates"].select(
        "currency",
        F.to_date("rate_date").alias("rate_date"),
        rate("rate_to_usd").alias("rate_to_usd"))


def fx_daily(bronze: dict[str, DataFrame]) -> DataFrame:
    """Dense daily FX from each currency's first quote to the last quote of
    any currency, the latest quote carried over days without one."""
    return carry_forward(fx_quotes(bronze), "currency", "rate_date", ["rate_to_usd"])


def party(silver_customers: DataFrame, silver_web_customers: DataFrame) -> DataFrame:
    pos = silver_customers.select("customer_id", "email", "country",
                                  "marketing_segment", "loyalty_tier")
    web = silver_web_customers.select("email", "country")
    return resolve_parties(pos, web)
