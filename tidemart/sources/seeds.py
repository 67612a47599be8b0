"""CSV seed ``country_regions`` (ISO-2 country code -> region, sub-region).

The seed is loaded with an explicit all-string schema; no model joins it.  It
is 23 rows, so a join against it may use ``F.broadcast`` (size bound proven
by the file itself).
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

SEED_DIR = Path(__file__).resolve().parent / "seed_data"
COUNTRY_REGIONS_CSV = SEED_DIR / "country_regions.csv"

COUNTRY_REGIONS_SCHEMA = StructType(
    [
        StructField("country_code", StringType(), True),
        StructField("region_name", StringType(), True),
        StructField("sub_region", StringType(), True),
    ]
)


def load_country_regions(spark: SparkSession, path: str | None = None) -> DataFrame:
    return (
        spark.read.schema(COUNTRY_REGIONS_SCHEMA)
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(str(path or COUNTRY_REGIONS_CSV))
    )
