"""Second (and third) versions of test inputs for the stateful operators.

The incremental facts need a target built earlier and a later batch; the
snapshots need changed versions of the customer and product tables.  All are
derived from the models over the driver's tables, so they scale with them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.expressions import ts_literal
from tidemart.functions.numeric import NUMERIC
from tidemart.plans.graph import ModelGraph
from tidemart.plans.staging import BUILT_AT

# Fixed values of the test scenarios (shared with the oracle SQL).
BATCH1_AS_OF = "2001-01-01 00:00:00"
BATCH1_BEFORE = dt.date(2001, 1, 1)
BATCH2_AS_OF = "2001-08-02 00:00:00"
SNAPSHOT_1 = "2001-01-01 00:00:00"
SNAPSHOT_2 = "2001-02-01 00:00:00"
SNAPSHOT_3 = "2001-03-01 00:00:00"
NEW_KEY_OFFSET = 1_000_000


def orders_batch1(g: ModelGraph) -> DataFrame:
    """fct_orders as first built on 2001-01-01: orders placed before 2001."""
    return g.fct_orders.filter(F.col("order_date") < F.lit(BATCH1_BEFORE)).withColumn(
        BUILT_AT, ts_literal(BATCH1_AS_OF)
    )


def orders_batch2(g: ModelGraph) -> DataFrame:
    """All orders as of 2001-08-02; every 20th order was delivered late with
    a corrected total, and the customer country changed (it must not
    overwrite the first-seen value of a matched order)."""
    hit = F.col("order_id") % 20 == 0
    return (
        g.fct_orders.withColumn("order_status", F.when(hit, F.lit("delivered")).otherwise(F.col("order_status")))
        .withColumn(
            "order_total_amount",
            F.when(hit, F.col("order_total_amount") + 1).otherwise(F.col("order_total_amount")).cast(NUMERIC),
        )
        .withColumn("updated_at", F.when(hit, ts_literal(BATCH2_AS_OF)).otherwise(F.col("updated_at")))
        .withColumn("customer_country", F.lit("ZZ"))
        .withColumn(BUILT_AT, ts_literal(BATCH2_AS_OF))
    )


def items_batch1(g: ModelGraph) -> DataFrame:
    return g.fct_order_items.filter(F.col("order_date") < F.lit(BATCH1_BEFORE)).withColumn(
        BUILT_AT, ts_literal(BATCH1_AS_OF)
    )


def items_batch2(g: ModelGraph) -> DataFrame:
    """All lines as of 2001-08-02; first lines of every 20th order got one
    more unit, and every 50th order moved to the next day (its lines change
    date partition)."""
    more = (F.col("order_id") % 20 == 0) & (F.col("line_item_id") % 10 == 1)
    moved = F.col("order_id") % 50 == 0
    return (
        g.fct_order_items.withColumn("quantity", F.when(more, F.col("quantity") + 1).otherwise(F.col("quantity")))
        .withColumn("order_date", F.when(moved, F.date_add("order_date", 1)).otherwise(F.col("order_date")))
        .withColumn(BUILT_AT, ts_literal(BATCH2_AS_OF))
    )


def items_batch1_undated(g: ModelGraph) -> DataFrame:
    """Batch 1 with every 70th order still without a date: its lines lie in the
    NULL partition; the later batch dates a few of them."""
    undated = F.col("order_id") % 70 == 0
    return items_batch1(g).withColumn("order_date", F.when(~undated, F.col("order_date")))


def drifted_history(history: DataFrame) -> DataFrame:
    """A damaged history: closed rows of every third customer end 40 days late."""
    late = F.col("customer_id") % 3 == 0
    return history.withColumn(
        "valid_to", F.when(late, F.timestamp_add("DAY", F.lit(40), F.col("valid_to"))).otherwise(F.col("valid_to")))


def _with_new_keys(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """``new`` rows, copies of ``old`` ones, under keys of their own: NEW_KEY_OFFSET
    above the old row's, or above all of these where ``old`` has that key already."""
    top = old.agg(F.max(key)).first()[0] or 0
    beyond = (top // NEW_KEY_OFFSET + 2) * NEW_KEY_OFFSET
    taken = old.filter(F.col(key) > NEW_KEY_OFFSET).select((F.col(key) - NEW_KEY_OFFSET).alias(key), F.lit(beyond).alias("__beyond"))
    shifted = F.col(key) + F.coalesce(F.col("__beyond"), F.lit(NEW_KEY_OFFSET))
    return new.join(taken.distinct(), key, "left").withColumn(key, shifted).select(*new.columns)


def customers_v1(g: ModelGraph) -> DataFrame:
    from tidemart.operators.scd2 import CUSTOMER_SNAPSHOT_COLUMNS

    return g.stg_customers.select(*CUSTOMER_SNAPSHOT_COLUMNS)


def customers_v2(g: ModelGraph) -> DataFrame:
    """Every 50th customer deleted, country to NULL for id%10=2, tier to
    platinum for id%10=1, updated_at only for id%10=3, and new customers."""
    c = customers_v1(g)
    cid = F.col("customer_id")
    kept = c.filter(cid % 50 != 0).select(
        "customer_id",
        "email",
        F.when(cid % 10 == 2, F.lit(None).cast("string")).otherwise(F.col("country")).alias("country"),
        F.when(cid % 10 == 1, F.lit("platinum")).otherwise(F.col("tier")).alias("tier"),
        "created_at",
        F.when(cid % 10 == 3, F.timestamp_add("DAY", F.lit(1), F.col("updated_at")))
        .otherwise(F.col("updated_at"))
        .alias("updated_at"),
    )
    new = c.filter(cid % 100 == 5).select(
        "customer_id",
        F.concat(F.lit("new"), F.col("email")).alias("email"),
        "country",
        "tier",
        "created_at",
        "updated_at",
    )
    return kept.unionByName(_with_new_keys(new, c, "customer_id"))


def customers_v3(g: ModelGraph) -> DataFrame:
    """v2 without every 7th customer, plus the customers deleted in v2
    coming back with their original rows."""
    v2 = customers_v2(g).filter(F.col("customer_id") % 7 != 0)
    back = customers_v1(g).filter(F.col("customer_id") % 50 == 0)
    return v2.unionByName(back)


def products_v1(g: ModelGraph) -> DataFrame:
    from tidemart.operators.scd2 import PRODUCT_SNAPSHOT_COLUMNS

    return g.stg_products.select(*PRODUCT_SNAPSHOT_COLUMNS)


def products_v2(g: ModelGraph) -> DataFrame:
    """Name, price and active-flag changes, a description-only change (not a
    check column), deletions and new products."""
    p = products_v1(g)
    pid = F.col("product_id")
    kept = p.filter(pid % 25 != 0).select(
        "product_id",
        "sku",
        F.when(pid % 10 == 1, F.concat(F.col("product_name"), F.lit(" v2")))
        .otherwise(F.col("product_name"))
        .alias("product_name"),
        F.when(pid % 10 == 4, F.concat(F.col("description"), F.lit(" (revised)")))
        .otherwise(F.col("description"))
        .alias("description"),
        "category",
        F.when(pid % 10 == 2, F.col("list_price") + 1).otherwise(F.col("list_price")).cast(NUMERIC)
        .alias("list_price"),
        F.when(pid % 10 == 3, ~F.col("is_active")).otherwise(F.col("is_active")).alias("is_active"),
        F.when(pid % 10 == 4, F.timestamp_add("DAY", F.lit(1), F.col("updated_at")))
        .otherwise(F.col("updated_at"))
        .alias("updated_at"),
    )
    new = p.filter(pid % 100 == 7).select(
        "product_id",
        F.concat(F.lit("NEW-"), F.col("sku")).alias("sku"),
        "product_name",
        "description",
        "category",
        "list_price",
        "is_active",
        "updated_at",
    )
    return kept.unionByName(_with_new_keys(new, p, "product_id"))
