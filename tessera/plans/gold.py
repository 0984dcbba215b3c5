"""Gold: the star schema and the management reporting aggregate.

Builders take already-built silver/gold DataFrames and stay lazy.  Where a
gold model is a function of columns the fact already carries, the fact is
not re-joined to a dimension built from itself (see ``revenue_summary``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.conform import usd_amount
from tessera.functions.dates import fiscal_columns, fiscal_labels
from tessera.operators.asof import asof_lookup
from tessera.types import (COUNTRY_NAME, UNALLOCATED, UNKNOWN_COUNTRY,
                           UNPUBLISHED_PRODUCT_NAME, UNSEGMENTED, MONEY)

SUM_MONEY = "decimal(29,4)"


def priced(df: DataFrame, fx: DataFrame, date_col, broadcast: bool,
           columns: tuple[str, ...] = ("rate_to_usd", "rate_is_carried")) -> DataFrame:
    """LEFT join to the dense FX grid on (currency, day): an unpriceable row
    is kept with NULL rate (and caught by the not-null contract).  The grid is
    days x currencies; ``broadcast`` says that its size was checked."""
    g = fx.select("currency", "rate_date", *columns).withColumnRenamed("currency", "_fx_currency")
    return asof_lookup(df, F.broadcast(g) if broadcast else g, "currency", date_col, "_fx_currency", "rate_date")


def fct_orders(silver_orders: DataFrame, fx: DataFrame, fx_broadcast: bool = False) -> DataFrame:
    o = silver_orders.select("order_id", "customer_id", "product_id", "order_date", "channel",
                             "status", "currency", "quantity", "unit_price", "amount")
    j = priced(o, fx, F.col("order_date").cast("date"), fx_broadcast)
    return j.select("order_id", "customer_id", "product_id", "order_date", "channel", "status",
                    "currency", "quantity", "unit_price", "amount", "rate_to_usd",
                    "rate_is_carried", usd_amount("amount", "rate_to_usd").alias("amount_usd"))


def party_lookup(party: DataFrame) -> DataFrame:
    """How each selling system names a party: POS by its customer id, the
    storefront by the e-mail of an account it knows (``in_web``).  One row per
    (system, key), built from ONE read of the party table."""
    pairs = F.array(
        F.struct(F.lit("POS").alias("_sys"), F.col("pos_customer_id").alias("_k")),
        F.struct(F.lit("WEB").alias("_sys"),
                 F.when(F.col("in_web"), F.col("email")).alias("_k")))
    return (party.select("party_key", F.explode(pairs).alias("_p"))
                 .select("party_key", "_p._sys", "_p._k")
                 .filter(F.col("_k").isNotNull()))


def sold_lines(silver_orders: DataFrame, web_lines: DataFrame) -> DataFrame:
    """Both selling systems at line grain, not priced and before identity:
    each line carries how its system names the buyer (``_sys``, ``_k``)."""
    pos = silver_orders.select(
        F.lit("POS").alias("_sys"),
        F.col("customer_id").alias("_k"),
        F.col("order_id").alias("sale_id"),
        "product_id",
        F.col("order_date").cast("date").alias("order_date"),
        F.lit("POS").alias("channel_system"),
        F.lit(False).alias("is_cancelled"),
        F.col("quantity").cast("bigint").alias("quantity"),
        "amount",
        "currency",
    )
    web = web_lines.select(
        F.lit("WEB").alias("_sys"),
        F.col("email").alias("_k"),
        F.col("web_order_id").alias("sale_id"),
        "product_id",
        "order_date",
        F.lit("WEB").alias("channel_system"),
        F.coalesce(F.col("status") == F.lit("cancelled"), F.lit(False)).alias("is_cancelled"),
        F.col("quantity").cast("bigint").alias("quantity"),
        "amount",
        "currency",
    )
    return pos.unionByName(web)


def sales_lines(sold: DataFrame, fx: DataFrame, fx_broadcast: bool = False) -> DataFrame:
    """``sold_lines`` priced in USD.  The POS side is ``fct_orders`` without
    its FX columns (a pure left join that does not change rows), so both
    systems share one FX join."""
    j = priced(sold, fx, F.col("order_date"), fx_broadcast)
    return j.withColumn("amount_usd", usd_amount("amount", "rate_to_usd"))


SALES_COLUMNS = ["party_key", "sale_id", "product_id", "order_date", "channel_system",
                 "is_cancelled", "quantity", "amount", "currency", "rate_to_usd",
                 "rate_is_carried", "amount_usd"]


def bought(lines: DataFrame, party: DataFrame) -> DataFrame:
    """Lines with their party: those whose buyer is known, once per party."""
    return lines.join(party_lookup(party), ["_sys", "_k"])


def fct_sales(lines: DataFrame, party: DataFrame) -> DataFrame:
    """Both selling systems at line grain, one currency; cancellations kept.

    Same rows as ``POS JOIN party ON pos_customer_id`` UNION ALL ``WEB JOIN
    party ON email AND in_web``: one join of the priced lines to the party
    lookup on (system, key)."""
    return bought(lines, party).select(*SALES_COLUMNS)


def dim_customer(silver_customers: DataFrame) -> DataFrame:
    return silver_customers.select("customer_id", "name", "email", "country",
                                   "marketing_segment", "loyalty_tier")


def dim_party(party: DataFrame) -> DataFrame:
    return party.select("party_key", "email", "pos_customer_id", "in_pos", "in_web",
                        "country", "marketing_segment", "loyalty_tier")


def dim_country(dim_party_df: DataFrame) -> DataFrame:
    present = dim_party_df.filter(F.col("country").isNotNull()).select("country").distinct()
    items = list(COUNTRY_NAME.items())
    name = F.when(F.col("country") == items[0][0], F.lit(items[0][1]))
    for code, label in items[1:]:
        name = name.when(F.col("country") == code, F.lit(label))
    return present.select("country", name.otherwise(F.col("country")).alias("country_name"))


def _published(hierarchy: DataFrame) -> DataFrame:
    return hierarchy.select("product_id", "product_name", "category", "department",
                            F.col("segment").alias("product_segment"), "list_price_usd")


def _published_has_null_id(hierarchy: DataFrame):
    """Scalar: does the published list hold a NULL id?  ``x NOT IN (list)``
    is never true then, so no SKU counts as unpublished."""
    return hierarchy.select(F.count_if(F.col("product_id").isNull()) > 0).scalar()


def unpublished_skus(sales: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """SKUs sold that the hierarchy does not publish -- ``NOT IN`` semantics
    as a plain anti join (shuffle-capable) plus the NULL-in-list rule,
    instead of a null-aware anti join, which Spark can only run broadcast."""
    sold = sales.select("product_id").filter(F.col("product_id").isNotNull()).distinct()
    pub = hierarchy.select(F.col("product_id").alias("_pub_id")).filter(F.col("_pub_id").isNotNull())
    missing = sold.join(pub, sold["product_id"] == pub["_pub_id"], "left_anti")
    return missing.filter(~_published_has_null_id(hierarchy))


def dim_product(hierarchy: DataFrame, sales: DataFrame) -> DataFrame:
    unpublished = unpublished_skus(sales, hierarchy).select(
        "product_id",
        F.lit(UNPUBLISHED_PRODUCT_NAME).alias("product_name"),
        F.lit(UNALLOCATED).alias("category"),
        F.lit(UNALLOCATED).alias("department"),
        F.lit(UNALLOCATED).alias("product_segment"),
        F.lit(None).cast(MONEY).alias("list_price_usd"),
    )
    return _published(hierarchy).unionByName(unpublished)


def dim_date(sales: DataFrame) -> DataFrame:
    days = sales.select(F.col("order_date").cast("date").alias("date_key")).distinct()
    cols = fiscal_columns("date_key")
    return days.select(
        "date_key",
        *[cols[c].alias(c) for c in ["calendar_year", "calendar_month", "calendar_quarter",
                                     "fiscal_year", "fiscal_quarter", "fiscal_period",
                                     "fiscal_year_label", "fiscal_quarter_label"]])


def fct_daily_revenue(fct_orders_df: DataFrame, dim_customer_df: DataFrame) -> DataFrame:
    """Orders, units and raw revenue per (order day, customer country).

    Orders are first summed per (day, customer) -- partial aggregation, so a
    customer holding a third of the orders is one row per day before the
    join -- then joined N:1 to the customer and summed per country (sums and
    counts compose exactly; a duplicated customer fans out both alike)."""
    pre = fct_orders_df.groupBy("order_date", "customer_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("quantity").alias("_u"), F.sum("amount").alias("_r"))
    c = dim_customer_df.select(F.col("customer_id").alias("_c_id"), "country")
    j = pre.join(c, F.col("customer_id") == F.col("_c_id"))
    return j.groupBy("order_date", "country").agg(
        F.sum("_n").cast("bigint").alias("orders"),
        F.sum("_u").cast("bigint").alias("units"),
        F.sum("_r").cast(SUM_MONEY).alias("revenue"),
    )


SUMMARY_KEYS = ["fiscal_year", "fiscal_year_label", "fiscal_quarter", "fiscal_quarter_label",
                "channel_system", "department", "product_segment", "customer_segment", "country"]


def _line_sums(df: DataFrame, keys: list[str]) -> DataFrame:
    """Line measures summed per ``keys`` (partial, map-side first)."""
    net = ~F.col("is_cancelled")
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(net, F.col("quantity")).otherwise(F.lit(0))).alias("u"),
        F.sum(F.when(net, F.col("amount_usd")).otherwise(F.lit(0))).alias("r"),
        F.sum(F.when(F.col("is_cancelled"), F.col("amount_usd")).otherwise(F.lit(0))).alias("c"),
        F.sum(F.when(net & F.col("rate_is_carried"), F.col("amount_usd")).otherwise(F.lit(0))).alias("k"))


FISCAL_KEYS = ["fiscal_year", "fiscal_quarter"]


def _rolled_up(lines: DataFrame, hierarchy: DataFrame, products_broadcast: bool) -> DataFrame:
    """Lines with what the summary keeps of their day and product: the fiscal
    quarter (the function that builds ``dim_date``) and the product rollup.

    The rollup is a LEFT join to the published hierarchy with 'Unallocated'
    for the rest -- exactly the members ``dim_product`` adds -- keeping the
    inner-join rules (NULL days and ids drop; a NULL published id means no SKU
    is unpublished, so those lines drop too)."""
    pub = hierarchy.select(F.col("product_id").alias("_pid"), F.col("department").alias("_dep"),
                           F.col("segment").alias("_seg"))
    fc = fiscal_columns("order_date")
    return (lines.filter(F.col("order_date").isNotNull() & F.col("product_id").isNotNull())
            .join(F.broadcast(pub) if products_broadcast else pub, F.col("product_id") == F.col("_pid"), "left")
            .filter(F.col("_pid").isNotNull() | ~_published_has_null_id(hierarchy))
            .withColumns({k: fc[k] for k in FISCAL_KEYS})
            .withColumns({"department": F.when(F.col("_pid").isNull(), UNALLOCATED).otherwise(F.col("_dep")),
                          "product_segment": F.when(F.col("_pid").isNull(), UNALLOCATED).otherwise(F.col("_seg"))}))


def _reported(groups: DataFrame) -> DataFrame:
    """Groups that carry their party's ``marketing_segment`` and ``_country`` ->
    the nine reporting keys.  The fiscal labels follow from the quarter, so the
    groups come without them."""
    j = groups.withColumns({
        "customer_segment": F.coalesce("marketing_segment", F.lit(UNSEGMENTED)),
        "country": F.coalesce("_country", F.lit(UNKNOWN_COUNTRY)),
        **fiscal_labels("fiscal_year", "fiscal_quarter")})
    return j.groupBy(*SUMMARY_KEYS).agg(
        F.sum("n").cast("bigint").alias("sale_lines"),
        F.sum("u").cast("bigint").alias("units"),
        F.sum("r").cast(SUM_MONEY).alias("revenue_usd"),
        F.sum("c").cast(SUM_MONEY).alias("cancelled_revenue_usd"),
        F.sum("k").cast(SUM_MONEY).alias("revenue_at_carried_rate"),
    )


def _segments(keyed: DataFrame, party: DataFrame) -> DataFrame:
    """Rows that carry ``party_key`` with what the summary keeps of the party."""
    pt = party.select(F.col("party_key").alias("_pk"), "marketing_segment", F.col("country").alias("_country"))
    return keyed.join(pt, F.col("party_key") == F.col("_pk"), "left")


GROUP_KEYS = [*FISCAL_KEYS, "channel_system", "department", "product_segment"]


def revenue_summary(sales: DataFrame, hierarchy: DataFrame, party: DataFrame,
                    products_broadcast: bool = False) -> DataFrame:
    """Revenue by fiscal period x channel x product rollup x customer segment,
    from the sales fact (e.g. a written ``fct_sales``).

    Same answer as ``sales JOIN dim_date JOIN dim_product LEFT JOIN dim_party``
    grouped by the nine keys, planned for volume: lines take their fiscal
    quarter and product rollup where they are (``products_broadcast``: the
    hierarchy's size was checked), then a map-side aggregate sums them per
    quarter, channel, rollup and buyer.  What is shuffled to the party join is
    bounded by buyers x quarters, not lines, and a hot buyer is collapsed.
    """
    groups = _line_sums(_rolled_up(sales, hierarchy, products_broadcast), [*GROUP_KEYS, "party_key"])
    return _reported(_segments(groups, party))


def revenue_summary_from_lines(lines: DataFrame, hierarchy: DataFrame, party: DataFrame,
                               products_broadcast: bool = False) -> DataFrame:
    """The same summary straight from the priced lines (``sales_lines``): they
    are summed per quarter, rollup and buyer as the selling system names them,
    (``_sys`` is the line's channel) and only these groups meet the party lookup.  Equal to
    ``revenue_summary(fct_sales(lines, party), ...)``: the lookup join is N:1
    per group exactly as per line (a duplicated key fans out sums and counts
    alike).  The lookup is joined to the parties first, so the groups are
    shuffled to it alone and not a second time to the parties."""
    groups = _line_sums(_rolled_up(lines, hierarchy, products_broadcast), [*GROUP_KEYS, "_k"])
    groups = groups.withColumn("_sys", F.col("channel_system"))
    return _reported(groups.join(_segments(party_lookup(party), party), ["_sys", "_k"]))


def revenue_summary_joined(sales: DataFrame, dim_date_df: DataFrame, dim_product_df: DataFrame,
                           dim_party_df: DataFrame) -> DataFrame:
    """The summary planned the textbook way (line-grain joins to the three
    dimensions, then one aggregate).  Kept as a second build that
    ``reconcile`` compares with ``revenue_summary``."""
    cancelled = F.col("is_cancelled")
    net = ~cancelled
    carried = net & F.col("rate_is_carried")
    d = dim_date_df.select(F.col("date_key").alias("_dk"), "fiscal_year", "fiscal_year_label",
                           "fiscal_quarter", "fiscal_quarter_label")
    p = dim_product_df.select(F.col("product_id").alias("_pid"), "department", "product_segment")
    pt = dim_party_df.select(F.col("party_key").alias("_pk"), "marketing_segment",
                             F.col("country").alias("_country"))
    j = (sales.join(d, F.col("order_date") == F.col("_dk"))
              .join(p, F.col("product_id") == F.col("_pid"))
              .join(pt, F.col("party_key") == F.col("_pk"), "left")
              .withColumn("customer_segment", F.coalesce("marketing_segment", F.lit(UNSEGMENTED)))
              .withColumn("country", F.coalesce("_country", F.lit(UNKNOWN_COUNTRY))))
    return j.groupBy(*SUMMARY_KEYS).agg(
        F.count(F.lit(1)).cast("bigint").alias("sale_lines"),
        F.sum(F.when(net, F.col("quantity")).otherwise(F.lit(0))).cast("bigint").alias("units"),
        F.sum(F.when(net, F.col("amount_usd")).otherwise(F.lit(0))).cast(SUM_MONEY).alias("revenue_usd"),
        F.sum(F.when(cancelled, F.col("amount_usd")).otherwise(F.lit(0))).cast(SUM_MONEY)
         .alias("cancelled_revenue_usd"),
        F.sum(F.when(carried, F.col("amount_usd")).otherwise(F.lit(0))).cast(SUM_MONEY)
         .alias("revenue_at_carried_rate"),
    )
