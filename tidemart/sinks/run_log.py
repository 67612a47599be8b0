"""Run log: one row per build, appended to a table partitioned by the
run's start date.  Answers "when did mart X last refresh?" and keeps the
history of builds; old date partitions expire after ``RUN_LOG_RETENTION_DAYS``.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

RUN_LOG_RETENTION_DAYS = 180
RUN_LOG_SCHEMA = StructType(
    [
        StructField("invocation_id", StringType(), False),
        StructField("started_at", TimestampNTZType(), False),
        StructField("completed_at", TimestampNTZType(), True),
        StructField("target_name", StringType(), True),
        StructField("models_run", LongType(), True),
        StructField("success", BooleanType(), True),
        StructField("version", StringType(), True),
    ]
)


def log_run(
    spark: SparkSession,
    path: str,
    started_at: dt.datetime,
    completed_at: dt.datetime | None,
    target_name: str,
    models_run: int,
    success: bool,
    version: str,
    invocation_id: str | None = None,
) -> str:
    """Append one run row; returns the invocation id."""
    inv = invocation_id or str(uuid.uuid4())
    row = [(inv, started_at, completed_at, target_name, int(models_run), bool(success), version)]
    df = spark.createDataFrame(row, RUN_LOG_SCHEMA).withColumn("started_date", F.to_date("started_at"))
    df.coalesce(1).write.mode("append").partitionBy("started_date").parquet(path)
    return inv


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def expire_run_log(spark: SparkSession, path: str, today: dt.date,
                   retention_days: int = RUN_LOG_RETENTION_DAYS) -> list[str]:
    from tidemart.sinks.layout import expire_partitions

    return expire_partitions(spark, path, "started_date", today - dt.timedelta(days=retention_days))
