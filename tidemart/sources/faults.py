"""Faults planted into the raw test tables, so that every data test has
something to find: wrong statuses and tiers, negative amounts, discounts of
100 % and more, numbers near and beyond the width of their types, missing
keys and dates, repeated rows.  By key, so that they
grow with the tables; the oracle plants the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _every(n: int, key: str) -> Column:
    return F.col(key).cast("bigint") % n == 0


def _plant(df: DataFrame, key: str, faults: dict[str, list[tuple[int, str | None]]], twice: int | None) -> DataFrame:
    """``faults``: column -> [(n, value)], the value for every n-th key; every
    ``twice``-th row appears a second time."""
    cols = []
    for field in df.schema.fields:
        value = F.col(field.name)
        for n, fault in reversed(faults.get(field.name, [])):
            value = F.when(_every(n, key), F.lit(fault).cast(field.dataType)).otherwise(value)
        cols.append(value.alias(field.name))
    if twice is None:
        return df.select(*cols)
    copies = F.when(_every(twice, key), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.select(*cols, F.explode(copies).alias("__copy")).drop("__copy")


def faulty(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "orders": _plant(raw["orders"], "order_id", {
            "order_id": [(211, None)],
            "order_status": [(97, "Lost")],
            "total_amount": [(89, "-5.00")],
            "placed_at": [(223, None)],
        }, twice=101),
        "order_items": _plant(raw["order_items"], "order_id", {
            "line_item_id": [(227, None)],
            "quantity": [(83, "-3"), (151, "1000000000000"), (157, "99999999999999999999"), (163, "1000000000000")],
            "unit_price": [(131, "1000000000"), (137, "0.0000004"), (139, "123456789012345678901234567890123"),
                           (163, "900000000000000000.123456789"), (149, "12345678901234.000000015")],
            "discount": [(79, "1.5"), (73, "150"), (167, "1000"), (149, "0.333333333")],
        }, twice=103),
        "customers": _plant(raw["customers"], "customer_id", {
            "email": [(113, None), (53, "shared@example.com")],
            "country": [(47, None)],
            "tier": [(43, "tin")],
        }, twice=None),
        "products": _plant(raw["products"], "product_id", {
            "sku": [(59, "SKU-0")],
            "price": [(61, "-1.25")],
        }, twice=67),
        "sessions": _plant(raw["sessions"], "session_id", {"started_at": [(127, None)]}, twice=109),
    }
