import datetime as dt

from pyspark.sql import functions as F

from tidemart.sinks.layout import expire_partitions, schema_name, write_table
from tidemart.sinks.run_log import expire_run_log, log_run, read_run_log
from tidemart.sources.seeds import load_country_regions
from tidemart.sources.spine import time_spine


def test_layer_routing():
    assert schema_name(None, "dev", "dev_me") == "dev_me"
    assert schema_name("gold", "prod", "dev_me") == "gold"
    assert schema_name(" silver ", "staging", "x") == "silver"
    assert schema_name("gold", "dev", "dev_me") == "dev_me_gold"


def test_seed_and_spine(spark):
    seed = load_country_regions(spark)
    assert seed.count() == 23 and seed.select("country_code").distinct().count() == 23
    assert seed.filter(F.col("region_name").isNull()).count() == 0
    spine = time_spine(spark)
    assert spine.count() == 3287
    r = spine.agg(F.min("date_day"), F.max("date_day")).first()
    assert (r[0], r[1]) == (dt.date(2022, 1, 1), dt.date(2030, 12, 31))


def test_partitioned_clustered_write_prunes(spark, tmp_path):
    df = spark.range(0, 1000).select(
        F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 60).cast("int")).alias("d"),
        (F.col("id") % 7).alias("c"), F.col("id"))
    path = str(tmp_path / "t")
    part = write_table(df, path, partition_by="d", grain="month", cluster_by=["c"],
                       comments={"c": "cluster column"})
    assert part == "d_month"
    back = spark.read.parquet(path)
    assert back.schema["c"].metadata.get("comment") == "cluster column"
    q = back.filter((F.col("d_month") == F.lit(dt.date(2024, 2, 1))) & (F.col("c") == 3))
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "d_month" in plan and "PushedFilters: [IsNotNull(c), EqualTo(c,3)]" in plan
    assert q.count() == df.filter((F.col("d") >= "2024-02-01") & (F.col("c") == 3)).count()


def test_run_log_append_and_expiry(spark, tmp_path):
    path = str(tmp_path / "run_log")
    log_run(spark, path, dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 1, 2), "prod", 7, True, "v1")
    log_run(spark, path, dt.datetime(2024, 9, 1, 1), None, "prod", 3, False, "v1")
    assert read_run_log(spark, path).count() == 2
    removed = expire_run_log(spark, path, dt.date(2024, 9, 2))
    assert removed == ["started_date=2024-01-01"]
    assert [r.models_run for r in read_run_log(spark, path).collect()] == [3]
    assert expire_partitions(spark, path, "started_date", dt.date(2000, 1, 1)) == []


def test_build_persists_column_comments(spark, tmp_path):
    from tidemart.plans.build import BuildConfig, build_testdata, read_mart

    cfg = BuildConfig(warehouse=str(tmp_path / "wh"), fact_grain="month", run_tests=False)
    build_testdata(spark, "/root/testdata/sf0.001", cfg)
    ltv = read_mart(spark, cfg, "customer_ltv")
    assert "whale" in ltv.schema["ltv_segment"].metadata.get("comment", "")
    assert read_mart(spark, cfg, "fct_orders").count() > 0


def test_shuffle_partition_sizing(spark):
    from tidemart.session import plan_bytes, shuffle_partitions_for, size_shuffles

    assert shuffle_partitions_for(100 * 1024**4) == 409_600
    assert shuffle_partitions_for(1000 * 1024**4) == 4_096_000  # no ceiling
    assert shuffle_partitions_for(10 * 1024**4) == 40_960
    assert shuffle_partitions_for(50 * 1024**2) == 8
    files = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    assert 0 < plan_bytes(files) < 1024**2
    assert plan_bytes(spark.createDataFrame([(1,)], "x int")) < 2**62
    before = spark.conf.get("spark.sql.shuffle.partitions")
    assert size_shuffles(spark, [files]) == int(before)


def test_build_sizes_its_shuffles(spark, tmp_path, monkeypatch):
    from tidemart.plans import build as B

    called = []
    monkeypatch.setattr(B, "size_shuffles", lambda s, inputs: called.append(len(list(inputs))))
    B.build_testdata(spark, "/root/testdata/sf0.001", B.BuildConfig(
        warehouse=str(tmp_path / "wh"), fact_grain="month", run_tests=False, run_snapshots=False))
    assert called == [5]


def test_run_log_records_failed_build(spark, tmp_path):
    import pytest

    from tidemart.plans.build import BuildConfig, build
    from tidemart.sinks.run_log import read_run_log
    from tidemart.sources import testdata

    raw = testdata.raw_tables(spark, "/root/testdata/sf0.001")
    raw["sessions"] = raw["sessions"].drop("started_at")  # broken input: session model cannot resolve
    cfg = BuildConfig(warehouse=str(tmp_path / "wh"), fact_grain="month", run_tests=False)
    with pytest.raises(Exception):
        build(spark, raw, "2001-08-02 00:00:00", cfg)
    log = read_run_log(spark, str(tmp_path / "wh" / "analytics_audit" / "run_log")).collect()
    assert len(log) == 1 and log[0].success is False and log[0].models_run >= 2
