"""Snapshot job: publish SCD2 history tables.

History is partitioned by the month its rows were closed (``valid_to``);
open rows live in the NULL partition.  A run reads only the open partition
and the partition of the current month, applies the snapshot, and replaces
just those two partitions.  Closed history is never read or rewritten again,
so a run costs about the size of the dimension, not of its whole history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.scd2 import (
    CUSTOMER_CHECK_COLUMNS,
    CUSTOMER_SNAPSHOT_COLUMNS,
    PRODUCT_CHECK_COLUMNS,
    PRODUCT_SNAPSHOT_COLUMNS,
    VALID_TO,
    scd2_apply,
)
from tidemart.sinks.versioned import VersionedTable

HISTORY_GRAIN = "month"


def history_table(spark: SparkSession, root: str) -> VersionedTable:
    return VersionedTable(spark, root, partition_by=VALID_TO, grain=HISTORY_GRAIN)


def run_snapshot(
    table: VersionedTable,
    current: DataFrame,
    key: str,
    as_of: str,
    check_cols: Sequence[str] | None = None,
    invalidate_hard_deletes: bool = True,
) -> int:
    """Apply one snapshot run to a history table; returns the new version."""
    if not table.exists():
        return table.overwrite(scd2_apply(None, current, key, as_of, check_cols, invalidate_hard_deletes))
    part = table.partition_col
    month = dt.date.fromisoformat(as_of[:10]).replace(day=1)
    hist = table.read()
    open_rows = hist.filter(F.col(part).isNull()).drop(part)
    closed_this_month = hist.filter(F.col(part) == F.lit(month)).drop(part)
    applied = scd2_apply(open_rows, current, key, as_of, check_cols, invalidate_hard_deletes)
    # rows closed by this run fall in ``month``; keep that month's earlier
    # closures, which are part of the partition being replaced
    content = applied.unionByName(closed_this_month)
    return table.replace_partitions(content, [None, month])


def snapshot_customers(table: VersionedTable, stg_customers: DataFrame, as_of: str) -> int:
    return run_snapshot(
        table, stg_customers.select(*CUSTOMER_SNAPSHOT_COLUMNS), "customer_id", as_of, CUSTOMER_CHECK_COLUMNS
    )


def snapshot_products(table: VersionedTable, stg_products: DataFrame, as_of: str) -> int:
    return run_snapshot(
        table, stg_products.select(*PRODUCT_SNAPSHOT_COLUMNS), "product_id", as_of, PRODUCT_CHECK_COLUMNS
    )
