"""Mart models: dimensions, facts, finance and marketing rollups.

These are pure functions (DataFrames in, DataFrame out).  Writing them out
with partitioning and clustering is the job of ``tidemart.sinks``; the
incremental form of the facts is ``tidemart.operators.upsert``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.aggregates import agg_with_distinct_count
from tidemart.functions.expressions import (
    ltv_segment,
    money_ratio,
    ts_literal,
)
from tidemart.functions.numeric import NUMERIC, with_product
from tidemart.plans.intermediate import filter_revenue_orders
from tidemart.plans.staging import BUILT_AT, with_line_columns

FCT_ORDERS_COLUMNS = (
    "order_sk", "order_id", "customer_sk", "customer_id", "customer_email",
    "customer_country", "customer_tier", "order_status", "currency",
    "order_total_amount", "items_net_amount", "items_gross_amount",
    "line_item_count", "total_quantity", "distinct_product_count",
    "has_total_mismatch", "placed_at", "updated_at", "order_date", BUILT_AT,
)

FCT_ORDER_ITEMS_COLUMNS = (
    "order_item_sk", "order_id", "line_item_id", "product_id", "customer_id",
    "order_date", "quantity", "unit_price", "discount_pct", "line_gross_amount",
    "line_net_amount", BUILT_AT,
)


def dim_product(stg_products: DataFrame, as_of: str) -> DataFrame:
    return stg_products.select(
        "product_sk", "product_id", "sku", "product_name", "description",
        "category", "list_price", "is_active", "updated_at",
        ts_literal(as_of).alias(BUILT_AT),
    )


def dim_customer(lifetime: DataFrame, as_of: str) -> DataFrame:
    return lifetime.select(
        "customer_sk", "customer_id", "email", "country", "tier",
        "customer_created_at",
        F.to_date("customer_created_at").alias("customer_created_date"),
        "lifetime_order_count", "lifetime_gross_revenue", "avg_order_value",
        "first_order_at", "last_order_at", "active_days",
        "days_since_last_order", "recency_segment",
        ts_literal(as_of).alias(BUILT_AT),
    )


def customer_ltv(dim_cust: DataFrame, as_of: str) -> DataFrame:
    return dim_cust.select(
        "customer_sk", "customer_id", "email", "country", "tier",
        "recency_segment", "customer_created_at", "first_order_at",
        "last_order_at", "days_since_last_order", "lifetime_order_count",
        "lifetime_gross_revenue", "avg_order_value",
        ltv_segment("lifetime_gross_revenue").alias("ltv_segment"),
        ts_literal(as_of).alias(BUILT_AT),
    )


def fct_orders(enriched: DataFrame, as_of: str) -> DataFrame:
    """Full (first-run) form of the order fact."""
    return enriched.withColumn(BUILT_AT, ts_literal(as_of)).select(*FCT_ORDERS_COLUMNS)


def fct_order_items(stg_items: DataFrame, stg_orders: DataFrame, as_of: str) -> DataFrame:
    """Lines JOIN orders (inner: an orphan line is dropped)."""
    j = _lines_of_orders(stg_items, stg_orders)
    return j.withColumn(BUILT_AT, ts_literal(as_of)).select(*FCT_ORDER_ITEMS_COLUMNS)


def fct_order_items_of_lines(lines: DataFrame, stg_orders: DataFrame, as_of: str) -> DataFrame:
    """The same from ``order_lines``: the join shuffles what the surrogate key
    and the amounts are computed from, and they are computed behind it."""
    j = with_line_columns(_lines_of_orders(lines, stg_orders))
    return j.withColumn(BUILT_AT, ts_literal(as_of)).select(*FCT_ORDER_ITEMS_COLUMNS)


def _lines_of_orders(lines: DataFrame, stg_orders: DataFrame) -> DataFrame:
    i = lines.alias("i")
    o = stg_orders.select("order_id", "order_date", "customer_id").alias("o")
    j = i.join(o, F.col("i.order_id") == F.col("o.order_id"), "inner")
    return j.select(*[F.col(f"i.`{c}`").alias(c) for c in lines.columns if c not in ("order_date", "customer_id")],
                    F.col("o.order_date").alias("order_date"), F.col("o.customer_id").alias("customer_id"))


def revenue_ledger(fct: DataFrame, as_of: str) -> DataFrame:
    """Daily revenue at (date, currency, country, tier); NULL keys group
    together.  ``cancelled_revenue`` is always 0 because cancelled orders are
    filtered out first — kept as the reference defines it."""
    orders = filter_revenue_orders(fct)
    amt = F.col("order_total_amount")
    zero = F.lit(0).cast(NUMERIC)
    keys = [
        ("revenue_date", F.col("order_date")),
        ("currency", F.col("currency")),
        ("customer_country", F.col("customer_country")),
        ("customer_tier", F.col("customer_tier")),
    ]
    out = agg_with_distinct_count(
        orders,
        keys,
        sums={
            "gross_revenue": amt,
            "net_revenue": F.col("items_net_amount"),
            "delivered_revenue": F.when(F.col("order_status") == "delivered", amt).otherwise(zero),
            "cancelled_revenue": F.when(F.col("order_status") == "cancelled", amt).otherwise(zero),
        },
        counts={"order_count": F.lit(1), "__amount_n": amt},
        distinct_col="customer_id",
        distinct_alias="unique_customer_count",
    )
    return out.select(
        "revenue_date", "currency", "customer_country", "customer_tier", "order_count",
        "unique_customer_count", "gross_revenue", "net_revenue",
        money_ratio("gross_revenue", "__amount_n").alias("avg_order_value"),
        "delivered_revenue", "cancelled_revenue", ts_literal(as_of).alias(BUILT_AT),
    )


# --- session funnel ---------------------------------------------------------
#
# The reference joins every session to every revenue order of the same
# customer and day and then aggregates, so an order counts once per session
# of that customer-day.  The same numbers come from two pre-aggregations and
# a many-to-one join, without materialising session x order pairs:
#   * orders -> one row per (customer, day) with the day's revenue;
#   * sessions -> one row per (day, source, device, customer) with the
#     session count and duration sums (a hot customer collapses map-side);
#   * revenue of a row = session count x day revenue (exact decimal).
# Each (day, source, device) group then has one row per distinct customer,
# so distinct counts become plain counts.

_FUNNEL_KEYS = ("funnel_date", "traffic_source", "device_type")


def _customer_day_revenue(revenue_orders: DataFrame) -> DataFrame:
    return (
        revenue_orders.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id", "order_date")
        .agg(F.sum("order_total_amount").alias("day_revenue"))
    )


def _session_customer_rows(stg_sessions: DataFrame, revenue_orders: DataFrame) -> DataFrame:
    per_customer = stg_sessions.groupBy(
        F.col("session_date").alias("funnel_date"), "traffic_source", "device_type", "customer_id"
    ).agg(
        F.count(F.lit(1)).alias("n_sessions"),
        F.sum("session_duration_seconds").alias("duration_sum"),
        F.count("session_duration_seconds").alias("duration_n"),
    )
    day = _customer_day_revenue(revenue_orders).alias("d")
    s = per_customer.alias("s")
    j = s.join(
        day,
        (F.col("s.customer_id") == F.col("d.customer_id"))
        & (F.col("s.funnel_date") == F.col("d.order_date")),
        "left",
    )
    rows = j.select(
        *[F.col(f"s.{k}").alias(k) for k in _FUNNEL_KEYS],
        F.col("s.customer_id").alias("customer_id"),
        "n_sessions",
        "duration_sum",
        "duration_n",
        F.col("d.customer_id").isNotNull().alias("converted"),
        F.col("d.day_revenue").alias("day_revenue"),
    )
    return with_product(rows, "revenue", F.col("day_revenue"), F.col("n_sessions")).drop("day_revenue")


def _funnel_aggregates(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*_FUNNEL_KEYS).agg(
        F.sum("n_sessions").alias("session_count"),
        F.count("customer_id").alias("authenticated_customer_count"),
        F.try_divide(F.sum("duration_sum").cast("double"), F.sum("duration_n")).alias(
            "avg_session_duration_seconds"
        ),
        F.count(F.when(F.col("converted"), F.col("customer_id"))).alias("converting_customers"),
        F.coalesce(F.sum("revenue"), F.lit(0).cast(NUMERIC)).alias("gross_revenue"),
    )


def daily_sessions(stg_sessions: DataFrame) -> DataFrame:
    """Per (day, source, device): sessions, distinct customers (NULL ignored),
    mean duration (open sessions ignored)."""
    per_customer = stg_sessions.groupBy(
        F.col("session_date").alias("funnel_date"), "traffic_source", "device_type", "customer_id"
    ).agg(
        F.count(F.lit(1)).alias("n_sessions"),
        F.sum("session_duration_seconds").alias("duration_sum"),
        F.count("session_duration_seconds").alias("duration_n"),
    )
    return per_customer.groupBy(*_FUNNEL_KEYS).agg(
        F.sum("n_sessions").alias("session_count"),
        F.count("customer_id").alias("authenticated_customer_count"),
        F.try_divide(F.sum("duration_sum").cast("double"), F.sum("duration_n")).alias(
            "avg_session_duration_seconds"
        ),
    )


def daily_conversions(stg_sessions: DataFrame, revenue_orders: DataFrame) -> DataFrame:
    """Per (day, source, device): distinct converting customers and the
    session-weighted revenue of their same-day orders (0 when none)."""
    agg = _funnel_aggregates(_session_customer_rows(stg_sessions, revenue_orders))
    return agg.select(*_FUNNEL_KEYS, "converting_customers", "gross_revenue")


def session_funnel(stg_sessions: DataFrame, revenue_orders: DataFrame, as_of: str) -> DataFrame:
    """Daily sessions and conversions by source and device.

    ``revenue_orders`` has customer_id, order_date, order_total_amount (paid,
    shipped or delivered orders).  Conversion columns are NULL for a group
    with a NULL key, as the reference's equality join of the two rollups
    leaves them unmatched.
    """
    agg = _funnel_aggregates(_session_customer_rows(stg_sessions, revenue_orders))
    keys_present = F.col("funnel_date").isNotNull() & F.col("traffic_source").isNotNull() & F.col(
        "device_type"
    ).isNotNull()
    conv = F.when(keys_present, F.col("converting_customers"))
    rev = F.when(keys_present, F.col("gross_revenue"))
    return agg.select(
        *_FUNNEL_KEYS,
        "session_count",
        "authenticated_customer_count",
        "avg_session_duration_seconds",
        conv.alias("converting_customers"),
        rev.alias("gross_revenue"),
        F.try_divide(conv.cast("double"), F.col("authenticated_customer_count")).alias("conversion_rate"),
        money_ratio(rev, conv).alias("avg_order_value"),
        ts_literal(as_of).alias(BUILT_AT),
    )


def fct_revenue_orders(fct: DataFrame) -> DataFrame:
    """The funnel's order side taken from the order fact."""
    return filter_revenue_orders(fct).select("customer_id", "order_date", "order_total_amount")
