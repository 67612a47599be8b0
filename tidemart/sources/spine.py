"""Daily date spine (one row per day, both bounds inclusive)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bounds of the semantic layer's spine.
SPINE_START = "2022-01-01"
SPINE_END = "2030-12-31"


def time_spine(
    spark: SparkSession,
    start: str | dt.date = SPINE_START,
    end: str | dt.date = SPINE_END,
    num_partitions: int | None = None,
) -> DataFrame:
    """``date_day`` for every day in [start, end].

    Generated from ``spark.range`` over the day offsets so the rows are
    produced in parallel rather than as one exploded array.
    """
    start_d = dt.date.fromisoformat(str(start))
    end_d = dt.date.fromisoformat(str(end))
    n_days = (end_d - start_d).days + 1
    offsets = spark.range(0, max(n_days, 0), numPartitions=num_partitions)
    return offsets.select(
        F.date_add(F.lit(start_d), F.col("id").cast("int")).alias("date_day")
    )


def spine_between(start: Column, end: Column) -> Column:
    """Array of dates from ``start`` to ``end`` (for bounds held in columns)."""
    return F.sequence(start, end, F.expr("INTERVAL 1 DAY"))


def dense_daily(spark: SparkSession, daily: DataFrame, date_col: str, fill: dict) -> DataFrame:
    """Left-join a daily series onto the spine of its own date range so that
    missing days appear with ``fill`` values (the semantic layer's time-spine join).

    The bounds are one aggregate row; the spine is the exploded date sequence
    between them (its length is bounded by the calendar span, not by the row
    count) and the join is an equi-join on the date.
    """
    bounds = daily.agg(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    days = bounds.select(F.explode(spine_between(F.col("lo"), F.col("hi"))).alias("date_day"))
    out = days.join(daily.withColumnRenamed(date_col, "date_day"), "date_day", "left")
    return out.fillna(fill)
