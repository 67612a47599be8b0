import datetime as dt

from pyspark.sql import functions as F

from tidemart.sinks.versioned import VersionedTable
from tidemart.sources import testdata
from tidemart.streaming.foreach_batch import latest_per_key, start_order_fact_stream

from helpers import SF_SMALL, rows


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, "a", dt.datetime(2024, 1, 1)), (1, "b", dt.datetime(2024, 1, 3)), (2, "c", dt.datetime(2024, 1, 2))],
        "k bigint, v string, ts timestamp_ntz",
    )
    assert rows(latest_per_key(df, "k", "ts")) == [(1, "b", dt.datetime(2024, 1, 3)), (2, "c", dt.datetime(2024, 1, 2))]


def test_order_fact_stream_two_batches(spark, tmp_path):
    raw = testdata.raw_tables(spark, SF_SMALL)
    orders = raw["orders"]
    land = str(tmp_path / "landing")
    key = F.col("order_id").cast("bigint")
    orders.filter(key % 2 == 0).write.parquet(f"{land}/batch=1")
    table = VersionedTable(spark, str(tmp_path / "fct_orders"), "order_date", "month")
    ckpt = str(tmp_path / "ckpt")
    as_of = lambda b: "2001-08-02 00:00:00"
    q = start_order_fact_stream(spark, land, raw["order_items"], raw["customers"], table, ckpt, as_of)
    q.awaitTermination(300)
    assert table.read().count() == orders.filter(key % 2 == 0).count()
    # second landing: the odd orders plus a status change for some even ones
    changed = orders.filter(key % 4 == 0).withColumn("order_status", F.lit("DELIVERED")).withColumn(
        "updated_at", F.lit(dt.datetime(2001, 8, 1)))
    orders.filter(key % 2 == 1).unionByName(changed).write.parquet(f"{land}/batch=2")
    q = start_order_fact_stream(spark, land, raw["order_items"], raw["customers"], table, ckpt, as_of)
    q.awaitTermination(300)
    fct = table.read()
    assert fct.count() == orders.count()
    assert fct.filter((F.col("order_id") % 4 == 0) & (F.col("order_status") != "delivered")).count() == 0
    assert fct.select("order_sk").distinct().count() == orders.count()


def test_stream_checkpoint_location_is_stable(spark):
    from tidemart.session import checkpoint_dir, shared_dir

    configured = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == configured           # same across application restarts
    assert configured.rstrip("/") in checkpoint_dir(spark)  # RDD checkpoints below it (path is qualified)


def test_latest_per_key_without_time(spark):
    df = spark.createDataFrame(
        [(1, "a", None), (1, "b", dt.datetime(2024, 1, 3)), (2, "c", None)], "k bigint, v string, ts timestamp_ntz")
    assert rows(latest_per_key(df, "k", "ts")) == [(1, "b", dt.datetime(2024, 1, 3)), (2, "c", None)]


def test_late_older_version_changes_nothing(spark, tmp_path):
    from tidemart.streaming.foreach_batch import order_fact_batch

    raw = testdata.raw_tables(spark, SF_SMALL)
    table = VersionedTable(spark, str(tmp_path / "fct_orders"), "order_date", "month")
    first = raw["orders"].filter(F.col("order_id").cast("bigint") % 50 == 0)
    as_of = "2001-08-02 00:00:00"
    order_fact_batch(first, raw["order_items"], raw["customers"], table, as_of)
    before = rows(table.read(), "order_sk", "order_status", "updated_at")
    older = first.withColumn("order_status", F.lit("placed")).withColumn(
        "updated_at", F.timestamp_add("DAY", F.lit(-1), F.col("updated_at")))
    order_fact_batch(older, raw["order_items"], raw["customers"], table, as_of)
    assert rows(table.read(), "order_sk", "order_status", "updated_at") == before
