"""Staging models: typed, renamed, normalised views of the raw tables.

Each model filters on the *raw* key first (an uncastable key therefore
survives as a NULL id) and then projects.  Both are narrow operations: no
shuffle, and Catalyst pushes ``IS NOT NULL`` into the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.expressions import (
    initcap_trim,
    lower_trim,
    safe_cast,
    surrogate_key,
    trim_all,
    ts_literal,
    upper_trim,
)
from tidemart.functions.numeric import NUMERIC, difference, with_product

# Name of the column every model stamps with its build time (``as_of``).
BUILT_AT = "_built_at"


def stg_orders(raw: DataFrame, as_of: str) -> DataFrame:
    placed = safe_cast("placed_at", "TIMESTAMP")
    return raw.filter(F.col("order_id").isNotNull()).select(
        safe_cast("order_id", "INT64").alias("order_id"),
        safe_cast("customer_id", "INT64").alias("customer_id"),
        surrogate_key(["order_id"]).alias("order_sk"),
        lower_trim("order_status").alias("order_status"),
        upper_trim("currency").alias("currency"),
        safe_cast("total_amount", "NUMERIC").alias("total_amount"),
        placed.alias("placed_at"),
        safe_cast("updated_at", "TIMESTAMP").alias("updated_at"),
        F.to_date(placed).alias("order_date"),
        safe_cast("_loaded_at", "TIMESTAMP").alias("_loaded_at"),
        ts_literal(as_of).alias(BUILT_AT),
    )


def stg_customers(raw: DataFrame, as_of: str) -> DataFrame:
    return raw.filter(F.col("customer_id").isNotNull()).select(
        safe_cast("customer_id", "INT64").alias("customer_id"),
        surrogate_key(["customer_id"]).alias("customer_sk"),
        lower_trim("email").alias("email"),
        initcap_trim("first_name").alias("first_name"),
        initcap_trim("last_name").alias("last_name"),
        upper_trim("country").alias("country"),
        lower_trim("tier").alias("tier"),
        safe_cast("created_at", "TIMESTAMP").alias("created_at"),
        safe_cast("updated_at", "TIMESTAMP").alias("updated_at"),
        safe_cast("_loaded_at", "TIMESTAMP").alias("_loaded_at"),
        ts_literal(as_of).alias(BUILT_AT),
    )


def stg_products(raw: DataFrame, as_of: str) -> DataFrame:
    return raw.filter(F.col("product_id").isNotNull()).select(
        safe_cast("product_id", "INT64").alias("product_id"),
        surrogate_key(["product_id"]).alias("product_sk"),
        trim_all("sku").alias("sku"),
        trim_all("name").alias("product_name"),
        trim_all("description").alias("description"),
        lower_trim("category").alias("category"),
        safe_cast("price", "NUMERIC").alias("list_price"),
        F.coalesce(safe_cast("is_active", "BOOL"), F.lit(True)).alias("is_active"),
        safe_cast("updated_at", "TIMESTAMP").alias("updated_at"),
        safe_cast("_loaded_at", "TIMESTAMP").alias("_loaded_at"),
        ts_literal(as_of).alias(BUILT_AT),
    )


def _typed_lines(raw: DataFrame, *more: Column) -> DataFrame:
    return raw.filter(F.col("order_id").isNotNull() & F.col("line_item_id").isNotNull()).select(
        safe_cast("order_id", "INT64").alias("order_id"),
        safe_cast("line_item_id", "INT64").alias("line_item_id"),
        safe_cast("product_id", "INT64").alias("product_id"),
        safe_cast("quantity", "INT64").alias("quantity"),
        safe_cast("unit_price", "NUMERIC").alias("unit_price"),
        F.coalesce(safe_cast("discount", "NUMERIC"), F.lit(0).cast(NUMERIC)).alias("discount_pct"),
        safe_cast("_loaded_at", "TIMESTAMP").alias("_loaded_at"),
        *more,
    )


def _with_amounts(lines: DataFrame) -> DataFrame:
    lines = with_product(lines, "line_gross_amount", F.col("unit_price"), F.col("quantity"))
    lines = lines.withColumn("__left", difference(F.lit(1), F.col("discount_pct")))
    return with_product(lines, "line_net_amount", F.col("line_gross_amount"), F.col("__left"))


def order_lines(raw: DataFrame) -> DataFrame:
    """Typed lines that are still narrow, for a join: ``with_line_columns`` adds the
    surrogate key and the amounts behind it.  The key is one of the raw texts; they
    are kept where they aren't what the typed number would print as."""
    def odd(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.when(~text.eqNullSafe(safe_cast(c, "INT64").cast("string")), text).alias(f"__{c}_text")

    return _typed_lines(raw, odd("order_id"), odd("line_item_id"))


def with_line_columns(lines: DataFrame) -> DataFrame:
    """The columns of ``stg_order_items`` that ``order_lines`` left out."""
    texts = [F.coalesce(F.col(f"__{c}_text"), F.col(c).cast("string")) for c in ("order_id", "line_item_id")]
    return _with_amounts(lines.withColumn("order_item_sk", surrogate_key(texts)))


def stg_order_items(raw: DataFrame, as_of: str) -> DataFrame:
    """Typed lines with their amounts.  A number that doesn't fit its type is NULL (a discount: none), an amount
    that doesn't fit is NULL; the data tests ``fits_type`` and ``computed`` report both."""
    lines = _with_amounts(_typed_lines(raw, surrogate_key(["order_id", "line_item_id"]).alias("order_item_sk"),
                                       ts_literal(as_of).alias(BUILT_AT)))
    return lines.select(
        "order_id", "line_item_id", "product_id", "order_item_sk", "quantity", "unit_price", "discount_pct",
        "line_gross_amount", "line_net_amount", "_loaded_at", BUILT_AT,
    )


def stg_sessions(raw: DataFrame, as_of: str) -> DataFrame:
    started = safe_cast("started_at", "TIMESTAMP")
    ended = safe_cast("ended_at", "TIMESTAMP")
    return raw.filter(F.col("session_id").isNotNull()).select(
        safe_cast("session_id", "STRING").alias("session_id"),
        safe_cast("customer_id", "INT64").alias("customer_id"),
        surrogate_key(["session_id"]).alias("session_sk"),
        lower_trim("device_type").alias("device_type"),
        lower_trim("traffic_source").alias("traffic_source"),
        lower_trim("referrer_host").alias("referrer_host"),
        started.alias("started_at"),
        ended.alias("ended_at"),
        F.to_date(started).alias("session_date"),
        F.timestamp_diff("SECOND", started, ended).alias("session_duration_seconds"),
        safe_cast("_loaded_at", "TIMESTAMP").alias("_loaded_at"),
        ts_literal(as_of).alias(BUILT_AT),
    )


STAGING_MODELS = {
    "orders": stg_orders,
    "customers": stg_customers,
    "products": stg_products,
    "order_items": stg_order_items,
    "sessions": stg_sessions,
}

