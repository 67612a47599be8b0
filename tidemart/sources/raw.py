"""Readers for the five raw e-commerce source tables.

Source columns are declared by name only; types are enforced by the staging
models through ``safe_cast``.  A reader selects exactly the declared columns so
the scan reads nothing else (``ReadSchema`` in the plan lists only them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Declared columns of each raw table, in source order.
RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "orders": (
        "order_id", "customer_id", "order_status", "currency", "total_amount",
        "placed_at", "updated_at", "_loaded_at",
    ),
    "customers": (
        "customer_id", "email", "first_name", "last_name", "country", "tier",
        "created_at", "updated_at", "_loaded_at",
    ),
    "order_items": (
        "order_id", "line_item_id", "product_id", "quantity", "unit_price",
        "discount", "_loaded_at",
    ),
    "products": (
        "product_id", "sku", "name", "description", "category", "price",
        "is_active", "updated_at", "_loaded_at",
    ),
    "sessions": (
        "session_id", "customer_id", "device_type", "traffic_source",
        "referrer_host", "started_at", "ended_at", "_loaded_at",
    ),
}

# Freshness column of every raw table.
LOADED_AT_FIELD = "_loaded_at"


def read_raw(spark: SparkSession, path: str, table: str, fmt: str = "parquet") -> DataFrame:
    """Read one raw table from ``path`` (a directory or table location)."""
    cols = RAW_COLUMNS[table]
    return spark.read.format(fmt).load(path).select(*cols)
