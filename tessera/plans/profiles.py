"""Bronze and silver metrics as (metric, value, text) rows, one aggregate per table;
``text`` holds the metrics that are text, ``value`` the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.profile import blank_fields, measured, metrics, union_all
from tessera.operators.setpass import KeySet, set_counts

WEB_FIELDS = {"bronze_web_customers": ["email", "full_name", "country", "signup_ts"],
              "bronze_web_products": ["product_id", "title", "list_price"],
              "bronze_web_orders": ["web_order_id", "email", "placed_at", "status", "lines"]}


def _sent(df: DataFrame) -> list[str]:
    """The feed's own columns: what the readers add begins with ``_``."""
    return [c for c in df.columns if not c.startswith("_")]


def _nonempty(column: str) -> Column:
    return F.when(F.col(column) != "", F.col(column))


def bronze_metrics(b: dict[str, DataFrame]) -> DataFrame:
    cust, orders = b["bronze_pos_customers"], b["bronze_pos_orders"]
    fx, hier = b["bronze_ref_fx_rates"], b["bronze_ref_product_hierarchy"]
    one = F.count(F.lit(1))
    blank = {t: {f"{t}_blank_columns": blank_fields(b[t], t, fields)} for t, fields in WEB_FIELDS.items()}
    keys = set_counts([
        KeySet("distinct_customers", cust, "customer_id"),
        KeySet("distinct_orders", orders, "order_id"),
        KeySet("shared_emails", b["bronze_web_customers"], _nonempty("email"), 0),
        KeySet("shared_emails", cust, _nonempty("email"), 1),
        KeySet("fx_currencies", fx, "currency"), KeySet("fx_published_days", fx, "rate_date"),
        KeySet("departments", hier, "department")])
    return union_all([
        keys.withColumn("text", F.lit(None).cast("string")),
        measured(cust, {"bronze_pos_customers": one, "customer_columns": F.lit(len(_sent(cust)))},
                 {"customer_column_names": F.lit(",".join(_sent(cust)))}),
        measured(orders, {"bronze_pos_orders": one}, {}),
        measured(b["bronze_web_customers"], {"bronze_web_customers": one}, blank["bronze_web_customers"]),
        measured(b["bronze_web_products"], {"bronze_web_products": one}, blank["bronze_web_products"]),
        measured(b["bronze_web_orders"], {
            "bronze_web_orders": one,
            "web_orders_has_lines": F.lit(int("lines" in b["bronze_web_orders"].columns))}, blank["bronze_web_orders"]),
        measured(fx, {"bronze_ref_fx_rates": one,
                      "fx_calendar_span": F.datediff(F.max("rate_date"), F.min("rate_date")) + 1}, {}),
        measured(hier, {"bronze_ref_product_hierarchy": one}, {}),
        measured(b["bronze_erp_customer_changes"], {"bronze_erp_customer_changes": one}, {}),
    ])


def silver_metrics(p) -> DataFrame:
    """``p``: a Product (or anything with the silver models as attributes)."""
    one = F.count(F.lit(1))
    pos, web = F.col("in_pos"), F.col("in_web")
    numbers = union_all([
        set_counts([
            KeySet("naive_case_sensitive_matches", p.bronze["bronze_pos_customers"], _nonempty("email"), 0),
            KeySet("naive_case_sensitive_matches", p.bronze["bronze_web_customers"], _nonempty("email"), 1),
            KeySet("countries", p.silver_customers, "country"),
            KeySet("fx_currencies", p.silver_fx_daily, "currency"), KeySet("fx_calendar_days", p.silver_fx_daily, "rate_date")]),
        metrics(p.silver_customers, {"silver_customers": one,
                                     "customer_columns": F.lit(len(p.silver_customers.columns)),
                                     "missing_email": F.count_if(F.col("email") == "")}),
        metrics(p.silver_orders, {"silver_orders": one}),
        metrics(p.silver_quarantine_orders, {"silver_quarantine_orders": one}),
        metrics(p.silver_product_hierarchy, {"silver_product_hierarchy": one}),
        metrics(p.silver_fx_daily, {"silver_fx_daily": one,
                                    "fx_carried": F.count_if("rate_is_carried")}),
        metrics(p.silver_web_customers, {"silver_web_customers": one}),
        metrics(p.silver_web_order_lines, {"silver_web_order_lines": one,
                                           "web_first_day": F.unix_date(F.min("order_date")),
                                           "web_last_day": F.unix_date(F.max("order_date"))}),
        metrics(p.silver_party, {"silver_party": one,
                                 "party_matched": F.count_if(pos & web),
                                 "party_pos_only": F.count_if(pos & ~web),
                                 "party_web_only": F.count_if(~pos & web),
                                 "party_no_email": F.count_if(F.col("email") == "")}),
    ])
    return numbers.withColumn("text", F.lit(None).cast("string"))
