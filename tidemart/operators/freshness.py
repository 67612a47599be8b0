"""Source freshness, last refresh per mart, and cost per model.

Freshness is one ``max(loaded_at)`` aggregate per source (each a single
partial-aggregate pass over its table), stacked with ``unionByName`` and
classified against ``as_of``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.functions.expressions import ts_literal

# Freshness thresholds of the raw sources, in hours.
WARN_AFTER_HOURS = 6
ERROR_AFTER_HOURS = 24


def source_freshness(
    sources: dict[str, DataFrame],
    as_of: str,
    loaded_at: str = "_loaded_at",
    warn_after_hours: float = WARN_AFTER_HOURS,
    error_after_hours: float = ERROR_AFTER_HOURS,
) -> DataFrame:
    """(source, max_loaded_at, age_in_seconds, status) per source; status is
    ``error`` past the error threshold, ``warn`` past the warn threshold,
    else ``pass``.  A source with no rows has a NULL age and status error."""
    now = ts_literal(as_of)
    parts = [
        df.agg(F.max(loaded_at).alias("max_loaded_at")).select(F.lit(name).alias("source"), "max_loaded_at")
        for name, df in sources.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), now)
    status = (
        F.when(F.col("age_in_seconds").isNull(), F.lit("error"))
        .when(F.col("age_in_seconds") > int(error_after_hours * 3600), F.lit("error"))
        .when(F.col("age_in_seconds") > int(warn_after_hours * 3600), F.lit("warn"))
        .otherwise(F.lit("pass"))
    )
    return out.withColumn("age_in_seconds", age).withColumn("status", status)


def stale_sources(freshness: DataFrame) -> DataFrame:
    """Sources in warn or error state."""
    return freshness.filter(F.col("status").isin("warn", "error"))


def freshness_exit_code(freshness: DataFrame) -> int:
    """1 when any source is in error, else 0 (collects one aggregate row)."""
    n_err = freshness.agg(F.count_if(F.col("status") == "error").alias("n")).first()["n"]
    return 1 if n_err else 0


def last_refresh(marts: dict[str, DataFrame], stamp: str = "_built_at") -> DataFrame:
    """When was each mart last built: (model, last_built_at, row_count)."""
    parts = [
        df.agg(F.max(stamp).alias("last_built_at"), F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("model"), "last_built_at", "row_count"
        )
        for name, df in marts.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Query-log cost report: price per TiB billed, and the pattern that pulls the
# model name out of the query comment "<tool>-<version> | <invocation> | <model> */".
PRICE_PER_TIB_USD = 5
MODEL_COMMENT_PATTERN = r"\| ([a-z_]+)\s*\*/"
TOOL_COMMENT_MARKER = "%tidemart-%"


def cost_per_model(query_log: DataFrame, as_of: str, lookback_days: int = 1,
                   marker: str = TOOL_COMMENT_MARKER) -> DataFrame:
    """Cost in USD per model over the last ``lookback_days`` from a query log
    with columns creation_time, job_type, query, total_bytes_billed; only
    queries whose text matches the ``marker`` LIKE pattern (the build tool's
    query comment) count.  Sorted by cost, highest first."""
    since = F.timestamp_add("DAY", F.lit(-lookback_days), ts_literal(as_of))
    recent = query_log.filter(
        (F.col("creation_time") >= since)
        & (F.col("job_type") == "QUERY")
        & F.col("query").like(marker)
    )
    per_model = recent.groupBy(
        F.regexp_extract("query", MODEL_COMMENT_PATTERN, 1).alias("model_name")
    ).agg((F.sum("total_bytes_billed") / F.pow(F.lit(1024.0), 4) * PRICE_PER_TIB_USD).alias("cost_usd"))
    return per_model.orderBy(F.desc("cost_usd"))
