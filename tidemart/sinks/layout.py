"""Table layout: layer routing, partitioned + clustered parquet writes,
column comments, and age-based partition expiry.

Clustering is expressed as range partitioning on (partition column, cluster
columns) followed by a sort inside each task: files then hold narrow,
sorted ranges of the cluster columns and parquet row-group min/max
statistics skip most of them for a filter on those columns.  Range
partitioning samples the data first, so a date holding a third of all rows
is split over many tasks by its cluster columns instead of landing in one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Layers of the warehouse and the targets that use bare layer names.
LAYERS = ("bronze", "silver", "gold", "snapshots", "reference", "audit")
CLEAN_LAYER_TARGETS = ("prod", "staging")


def schema_name(layer: str | None, target_name: str, default_schema: str) -> str:
    """Schema (database) of a model: no layer -> the default schema; in the
    prod and staging targets the layer name itself; else
    ``<default>_<layer>`` so developers do not collide."""
    if layer is None:
        return default_schema
    layer = layer.strip()
    if target_name in CLEAN_LAYER_TARGETS:
        return layer
    return f"{default_schema}_{layer}"


def table_path(root: str, schema: str, table: str) -> str:
    return f"{root.rstrip('/')}/{schema}/{table}"


def with_partition_column(df: DataFrame, column: str, grain: str = "day") -> tuple[DataFrame, str]:
    """Add the partition column for ``grain`` (``day`` uses the column as is;
    ``month`` adds ``<column>_month`` = first day of the month)."""
    if grain == "day":
        return df, column
    if grain not in ("month", "year"):
        raise ValueError(grain)
    name = f"{column}_{grain}"
    return df.withColumn(name, F.trunc(F.col(column), grain)), name


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column descriptions as column metadata (kept in the parquet
    schema Spark writes)."""
    for col, text in comments.items():
        if col in df.columns:
            df = df.withMetadata(col, {"comment": text})
    return df


def clustered(df: DataFrame, partition_col: str | None, cluster_by: Sequence[str] = (),
              num_partitions: int | None = None) -> DataFrame:
    keys = ([partition_col] if partition_col else []) + list(cluster_by)
    if not keys:
        return df
    out = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    return out.sortWithinPartitions(*keys)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: str | None = None,
    grain: str = "day",
    cluster_by: Sequence[str] = (),
    mode: str = "overwrite",
    comments: dict[str, str] | None = None,
    num_partitions: int | None = None,
) -> str | None:
    """Write ``df`` as parquet at ``path``; returns the physical partition
    column (or None)."""
    part_col = None
    if partition_by:
        df, part_col = with_partition_column(df, partition_by, grain)
    if comments:
        df = with_comments(df, comments)
    df = clustered(df, part_col, cluster_by, num_partitions)
    writer = df.write.mode(mode)
    if part_col:
        writer = writer.partitionBy(part_col)
    writer.parquet(path)
    return part_col


def expire_partitions(spark: SparkSession, path: str, partition_col: str, older_than) -> list[str]:
    """Delete ``partition_col=<date>`` directories strictly older than
    ``older_than`` (a date); returns the removed directory names.  Only the
    directory listing is read, no data."""
    import datetime as dt

    from tidemart.sinks.fs import delete, list_dirs

    removed = []
    for name in list_dirs(spark, path):
        if not name.startswith(f"{partition_col}="):
            continue
        try:
            value = dt.date.fromisoformat(name.split("=", 1)[1])
        except ValueError:
            continue
        if value < older_than:
            delete(spark, f"{path.rstrip('/')}/{name}")
            removed.append(name)
    return removed
