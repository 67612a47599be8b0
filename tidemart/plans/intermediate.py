"""Intermediate (ephemeral) models: order-grain and customer-grain rollups.

They are plain functions returning lazy DataFrames, so a mart that uses one
gets it inlined into its own plan and Catalyst optimises across the boundary
(a filter on the mart reaches the raw scan; unused aggregates are pruned).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.derived import digest, without_digests
from tidemart.functions.expressions import (
    exact_avg,
    is_revenue_status,
    recency_segment,
    total_mismatch_flag,
    ts_literal,
)
from tidemart.plans.staging import BUILT_AT


def filter_revenue_orders(orders: DataFrame, status_col: str = "order_status") -> DataFrame:
    """Orders whose status is paid, shipped or delivered."""
    return orders.filter(is_revenue_status(status_col))


def order_items_rollup(stg_items: DataFrame) -> DataFrame:
    """Per order: line count, quantity, gross and net amount, distinct products.

    One scan and two groupings: the sums by (order, product), then by order,
    where each row is one distinct product.  Both combine map-side, and a hot
    order spreads over its products in the first shuffle.  The NULL order id
    is a group of its own, as in SQL.
    """
    sums = ("quantity", "line_gross_amount", "line_net_amount")
    by_product = stg_items.groupBy("order_id", "product_id").agg(
        F.count(F.lit(1)).alias("lines"), *(F.sum(c).alias(c) for c in sums)
    )
    kind = by_product.schema
    whole = {c: F.sum(c).cast(kind[c].dataType) for c in sums}
    return by_product.groupBy("order_id").agg(
        F.sum("lines").alias("line_item_count"),
        whole["quantity"].alias("total_quantity"),
        whole["line_gross_amount"].alias("gross_amount_from_items"),
        whole["line_net_amount"].alias("net_amount_from_items"),
        F.count("product_id").alias("distinct_product_count"),
    )


def int_orders_enriched(
    stg_orders: DataFrame, stg_items: DataFrame, stg_customers: DataFrame, as_of: str
) -> DataFrame:
    """Order grain: orders LEFT JOIN item rollup LEFT JOIN customers.

    ``customer_id`` is taken from the customer side, so an order of an unknown
    customer carries a NULL customer_id (and NULL customer attributes).
    Join strategy is left to AQE: the customer side is broadcast only when its
    measured shuffle size is under the broadcast threshold; otherwise a
    sort-merge join with skew splitting of hot customers.

    The lines are shuffled once, by their order: both groupings of the rollup
    and the join find them there.  The orders' surrogate keys are computed
    anew behind the joins.
    """
    orders = without_digests(stg_orders)
    o = orders.alias("o")
    lines = stg_items.filter(F.col("order_id").isNotNull()).select(
        "order_id", "product_id", "quantity", "line_gross_amount", "line_net_amount")
    oi = order_items_rollup(lines.repartition("order_id")).alias("oi")
    c = stg_customers.select(
        "customer_id", "customer_sk", "email", "country", "tier"
    ).alias("c")
    joined = o.join(oi, F.col("o.order_id") == F.col("oi.order_id"), "left").join(
        c, F.col("o.customer_id") == F.col("c.customer_id"), "left"
    )
    return joined.select(
        digest("order_sk", orders.columns, "o").alias("order_sk"),
        F.col("o.order_id").alias("order_id"),
        F.col("o.order_status").alias("order_status"),
        F.col("o.currency").alias("currency"),
        F.col("o.total_amount").alias("order_total_amount"),
        F.col("oi.net_amount_from_items").alias("items_net_amount"),
        F.col("oi.gross_amount_from_items").alias("items_gross_amount"),
        F.col("oi.line_item_count").alias("line_item_count"),
        F.col("oi.total_quantity").alias("total_quantity"),
        F.col("oi.distinct_product_count").alias("distinct_product_count"),
        total_mismatch_flag(F.col("o.total_amount"), F.col("oi.net_amount_from_items")).alias(
            "has_total_mismatch"
        ),
        F.col("o.placed_at").alias("placed_at"),
        F.col("o.updated_at").alias("updated_at"),
        F.col("o.order_date").alias("order_date"),
        F.col("c.customer_sk").alias("customer_sk"),
        F.col("c.customer_id").alias("customer_id"),
        F.col("c.email").alias("customer_email"),
        F.col("c.country").alias("customer_country"),
        F.col("c.tier").alias("customer_tier"),
        ts_literal(as_of).alias(BUILT_AT),
    )


def customer_rollup(stg_orders: DataFrame, as_of: str) -> DataFrame:
    """Per customer over revenue orders: count, revenue, average, first and
    last order, active days and days since the last order (as of ``as_of``)."""
    revenue = filter_revenue_orders(stg_orders)
    as_of_date = F.to_date(ts_literal(as_of))
    agg = revenue.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("lifetime_order_count"),
        F.sum("total_amount").alias("lifetime_gross_revenue"),
        exact_avg("total_amount").alias("avg_order_value"),
        F.min("placed_at").alias("first_order_at"),
        F.max("placed_at").alias("last_order_at"),
    )
    return agg.select(
        "*",
        F.datediff(F.to_date("last_order_at"), F.to_date("first_order_at"))
        .cast("bigint")
        .alias("active_days"),
        F.datediff(as_of_date, F.to_date("last_order_at")).cast("bigint").alias("days_since_last_order"),
    )


def int_customer_lifetime_metrics(
    stg_customers: DataFrame, stg_orders: DataFrame, as_of: str
) -> DataFrame:
    """Customer grain: customers LEFT JOIN the rollup; no revenue -> 0."""
    c = stg_customers.alias("c")
    p = customer_rollup(stg_orders, as_of).alias("p")
    joined = c.join(p, F.col("c.customer_id") == F.col("p.customer_id"), "left")
    days = F.col("p.days_since_last_order")
    return joined.select(
        F.col("c.customer_sk").alias("customer_sk"),
        F.col("c.customer_id").alias("customer_id"),
        F.col("c.email").alias("email"),
        F.col("c.country").alias("country"),
        F.col("c.tier").alias("tier"),
        F.col("c.created_at").alias("customer_created_at"),
        F.coalesce(F.col("p.lifetime_order_count"), F.lit(0).cast("bigint")).alias(
            "lifetime_order_count"
        ),
        F.coalesce(F.col("p.lifetime_gross_revenue"), F.lit(0)).alias("lifetime_gross_revenue"),
        F.col("p.avg_order_value").alias("avg_order_value"),
        F.col("p.first_order_at").alias("first_order_at"),
        F.col("p.last_order_at").alias("last_order_at"),
        F.col("p.active_days").alias("active_days"),
        days.alias("days_since_last_order"),
        recency_segment(days).alias("recency_segment"),
        ts_literal(as_of).alias(BUILT_AT),
    )
