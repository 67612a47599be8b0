"""Raw e-commerce inputs derived from the driver's TPC-H-style tables.

The analytics layer reads five raw tables (orders, customers, products,
order_items, sessions) whose columns arrive as text.  The test tables have a
different shape, so each raw table is a projection of one of them with dirty
values planted on purpose: padding and mixed case, an uncastable quantity, an
unknown customer, orphan lines, a NULL discount, anonymous and open sessions.
The same mapping is written as SQL for the DuckDB oracle.

Every function is a lazy projection of a full table scan; Catalyst prunes the
unused columns at the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions.expressions import ts_literal

# Fixed values of the test mapping (must equal the oracle SQL).
# Two-letter country codes picked by nation key modulo 23.
COUNTRY_CODES = (
    "US", "CA", "MX", "BR", "AR", "GB", "DE", "FR", "IT", "ES", "NL", "SE",
    "IN", "CN", "JP", "KR", "SG", "AU", "NZ", "ZA", "EG", "AE", "SA",
)
CUSTOMERS_LOADED_AT = "2001-08-01 20:00:00"
PRODUCTS_LOADED_AT = "2001-08-01 12:00:00"
ORDERS_LOADED_AT = "2001-08-01 23:00:00"
ORDER_ITEMS_LOADED_AT = "2001-08-01 02:00:00"
SESSIONS_LOADED_AT = "2001-07-30 00:00:00"
# Default "now" of every model built on the test data.
DEFAULT_AS_OF = "2001-08-02 00:00:00"

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _add_days(ts, days):
    return F.timestamp_add("DAY", days, ts)


def _loaded(stamp: str, key):
    """Rows were loaded within the five hours up to ``stamp``."""
    return F.timestamp_add("HOUR", -(key % 5), ts_literal(stamp))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    country = F.lower(F.get(F.array(*map(F.lit, COUNTRY_CODES)), F.col("c_nationkey") % len(COUNTRY_CODES)))
    tier = (
        F.when(key % 4 == 0, "Bronze")
        .when(key % 4 == 1, "SILVER ")
        .when(key % 4 == 2, "gold")
        .otherwise("Platinum")
    )
    return c.select(
        key.cast("string").alias("customer_id"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit("@EXAMPLE.com ")).alias("email"),
        F.concat(F.lit(" "), F.col("c_mktsegment")).alias("first_name"),
        F.concat(F.lit("CUSTOMER"), key.cast("string")).alias("last_name"),
        country.alias("country"),
        tier.alias("tier"),
        _add_days(ts_literal("1994-01-01 00:00:00"), key % 365).alias("created_at"),
        _add_days(ts_literal("1995-01-01 00:00:00"), key % 30).alias("updated_at"),
        _loaded(CUSTOMERS_LOADED_AT, key).alias("_loaded_at"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    size5 = F.col("p_size") % 5
    is_active = (
        F.when(size5 == 0, F.lit(None).cast("string"))
        .when(size5 == 1, "false")
        .when(size5 == 2, "abc")
        .otherwise("true")
    )
    return p.select(
        key.cast("string").alias("product_id"),
        F.concat(F.lit(" SKU-"), key.cast("string")).alias("sku"),
        F.concat(F.col("p_name"), F.lit(" ")).alias("name"),
        F.col("p_type").alias("description"),
        F.concat(F.lit(" "), F.col("p_brand")).alias("category"),
        F.col("p_retailprice").cast("string").alias("price"),
        is_active.alias("is_active"),
        _add_days(ts_literal("1995-01-01 00:00:00"), key % 30).alias("updated_at"),
        _loaded(PRODUCTS_LOADED_AT, key).alias("_loaded_at"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    st, prio = F.col("o_orderstatus"), F.col("o_orderpriority")
    status = (
        F.when(st == "F", " Delivered")
        .when((st == "O") & (prio == "5-LOW"), "CANCELLED")
        .when(st == "O", "shipped ")
        .when(prio == "1-URGENT", "Placed")
        .otherwise("PAID")
    )
    currency = F.when(cust % 3 == 0, "usd").when(cust % 3 == 1, " eur").otherwise("GBP")
    placed = F.col("o_orderdate")
    return o.select(
        key.cast("string").alias("order_id"),
        F.when(key % 400 == 7, F.lit("-1")).otherwise(cust.cast("string")).alias("customer_id"),
        status.alias("order_status"),
        currency.alias("currency"),
        F.col("o_totalprice").cast("string").alias("total_amount"),
        placed.alias("placed_at"),
        _add_days(placed, key % 10).alias("updated_at"),
        _loaded(ORDERS_LOADED_AT, key).alias("_loaded_at"),
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items; (order, line number) is not unique in the test lineitem, so
    the line id is made from line number, ship day, supplier and part."""
    li = read_table(spark, sf_dir, "lineitem")
    key = F.col("l_orderkey")
    day = F.datediff(F.col("l_shipdate"), F.lit("1990-01-01").cast("date")).cast("bigint")
    line_no = F.col("l_linenumber") + 10 * (day + 10_000 * (F.col("l_suppkey") + 1_000_000 * F.col("l_partkey")))
    return li.select(
        F.when(key % 500 == 3, -key).otherwise(key).cast("string").alias("order_id"),
        line_no.cast("string").alias("line_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.when(key % 700 == 5, F.lit("abc"))
        .otherwise(F.col("l_quantity").cast("bigint").cast("string"))
        .alias("quantity"),
        F.floor(F.col("l_extendedprice") / F.col("l_quantity"))
        .cast("bigint")
        .cast("string")
        .alias("unit_price"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
        .otherwise(F.col("l_discount").cast("string"))
        .alias("discount"),
        _loaded(ORDER_ITEMS_LOADED_AT, key).alias("_loaded_at"),
    )


def raw_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").filter(F.col("event_type") != "purchase")
    eid = F.col("event_id")
    device = F.when(eid % 3 == 0, "Mobile").when(eid % 3 == 1, " desktop").otherwise("TABLET")
    ended = F.when(eid % 7 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
        F.timestamp_add("SECOND", F.floor(F.col("value")).cast("bigint"), F.col("ts"))
    )
    return e.select(
        eid.cast("string").alias("session_id"),
        F.when(eid % 10 == 0, F.lit(None).cast("string"))
        .otherwise(F.col("user_id").cast("string"))
        .alias("customer_id"),
        device.alias("device_type"),
        F.when(eid % 97 == 0, F.lit(None).cast("string"))
        .otherwise(F.upper(F.col("event_type")))
        .alias("traffic_source"),
        F.concat(F.lit("Ref"), (eid % 5).cast("string"), F.lit(".Example.com")).alias("referrer_host"),
        F.col("ts").alias("started_at"),
        ended.alias("ended_at"),
        _loaded(SESSIONS_LOADED_AT, eid).alias("_loaded_at"),
    )


def funnel_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue orders for the session funnel.  Test order dates (1995-2001)
    never meet session dates (2024), so purchase events stand in for the
    paid/shipped/delivered orders on the funnel's order side."""
    e = read_table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return e.select(
        F.col("user_id").alias("customer_id"),
        F.to_date(F.col("ts")).alias("order_date"),
        F.col("value").cast("decimal(18,4)").alias("order_total_amount"),
    )


RAW_BUILDERS = {
    "customers": raw_customers,
    "products": raw_products,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "sessions": raw_sessions,
}


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: build(spark, sf_dir) for name, build in RAW_BUILDERS.items()}
