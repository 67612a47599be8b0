import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemart.operators.upsert import (
    DuplicateKeyError,
    incremental_upsert,
    lookback_filter,
    merge_frames,
)
from tidemart.sinks.versioned import VersionedTable, upsert_partitions

from helpers import rows

MARTS = ("fct_orders", "fct_order_items", "dim_customer", "dim_product", "revenue_ledger", "customer_ltv", "session_funnel")

SCHEMA = "k bigint, status string, country string, d date, ts timestamp_ntz"
D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 5)


def test_merge_matched_unmatched_and_update_list(spark):
    target = spark.createDataFrame([(1, "placed", "US", D1, T0), (2, "paid", "FR", D1, T0)], SCHEMA)
    source = spark.createDataFrame([(2, "shipped", "ZZ", D2, T1), (3, "paid", "ZZ", D2, T1)], SCHEMA)
    out = merge_frames(target, source, "k", ["status", "ts"])
    assert rows(out) == [
        (1, "placed", "US", D1, T0),           # untouched target row
        (2, "shipped", "FR", D1, T1),          # matched: status/ts updated, country/date first-seen
        (3, "paid", "ZZ", D2, T1),             # inserted whole
    ]


def test_merge_all_columns_when_no_list(spark):
    target = spark.createDataFrame([(1, "placed", "US", D1, T0)], SCHEMA)
    source = spark.createDataFrame([(1, "paid", "FR", D3, T1)], SCHEMA)
    assert rows(merge_frames(target, source, "k")) == [(1, "paid", "FR", D3, T1)]


def test_duplicate_source_key_raises(spark):
    target = spark.createDataFrame([(1, "placed", "US", D1, T0)], SCHEMA)
    source = spark.createDataFrame([(2, "a", "x", D1, T1), (2, "b", "x", D1, T1)], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        incremental_upsert(target, source, "k")


def test_rerun_changes_nothing(spark):
    target = spark.createDataFrame([(1, "placed", "US", D1, T0), (2, "paid", "FR", D1, T0)], SCHEMA)
    source = spark.createDataFrame([(2, "shipped", "ZZ", D2, T1), (3, "paid", "ZZ", D2, T1)], SCHEMA)
    once = merge_frames(target, source, "k", ["status", "ts"])
    twice = merge_frames(once, source, "k", ["status", "ts"])
    assert rows(once) == rows(twice)


def test_lookback_filter_and_empty_target(spark):
    target = spark.createDataFrame([(1, "x", "US", D1, dt.datetime(2024, 1, 10))], SCHEMA)
    source = spark.createDataFrame(
        [(1, "a", "x", D1, dt.datetime(2024, 1, 6)), (2, "b", "x", D1, dt.datetime(2024, 1, 8))], SCHEMA
    )
    kept = lookback_filter(source, target, "ts", "ts", days=3)
    assert [r.k for r in kept.collect()] == [2]  # strictly after 2024-01-07
    empty = spark.createDataFrame([], SCHEMA)
    assert lookback_filter(source, empty, "ts", "ts").count() == 2  # first run loads all


def test_versioned_upsert_moves_rows_between_partitions(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "fct"), partition_by="d")
    t.overwrite(spark.createDataFrame(
        [(1, "a", "US", D1, T0), (2, "b", "US", D1, T0), (3, "c", "US", D2, T0)], SCHEMA))
    v1_paths = t.manifest()["paths"]
    # key 2 moves from D1 to D3 (all columns updated); D2 untouched
    upsert_partitions(t, spark.createDataFrame([(2, "b2", "US", D3, T1)], SCHEMA), "k", None)
    m = t.manifest()
    assert m["version"] == 2
    assert m["paths"][str(D2)] == v1_paths[str(D2)]          # untouched partition kept in place
    assert m["paths"][str(D1)] != v1_paths[str(D1)]          # rewritten
    assert rows(t.read()) == [(1, "a", "US", D1, T0), (2, "b2", "US", D3, T1), (3, "c", "US", D2, T0)]
    # moving the last row out of a partition drops it from the manifest
    upsert_partitions(t, spark.createDataFrame([(1, "a", "US", D2, T1)], SCHEMA), "k", None)
    assert str(D1) not in t.manifest()["paths"]
    assert rows(t.read().select("k", "d")) == [(1, D2), (2, D3), (3, D2)]


def test_versioned_read_prunes_partitions(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "fct"), partition_by="d")
    t.overwrite(spark.createDataFrame([(1, "a", "US", D1, T0), (3, "c", "US", D2, T0)], SCHEMA))
    df = t.read().filter(F.col("d") == F.lit(D2))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan and "= 2024-01-02" in plan
    assert [r.k for r in df.collect()] == [3]


def test_full_refresh_equals_incremental(spark):
    """A target holding stale versions of the batch's rows, merged with the
    batch (all columns), equals the table rebuilt in full from the final
    state."""
    full = spark.createDataFrame([(1, "a", "US", D1, T0), (2, "b2", "FR", D2, T1), (3, "c", "DE", D3, T1)], SCHEMA)
    stale = full.filter("k <= 2").withColumn("status", F.when(F.col("k") == 2, "old").otherwise(F.col("status")))
    batch = full.filter("k >= 2")
    assert rows(merge_frames(stale, batch, "k")) == rows(full)


def test_build_incremental_rerun_equals_full(spark, tmp_path):
    from tidemart.plans.build import BuildConfig, build_testdata, read_mart

    cfg = BuildConfig(warehouse=str(tmp_path / "wh"), fact_grain="month", run_log=False)
    build_testdata(spark, "/root/testdata/sf0.001", cfg)
    full = {m: rows(read_mart(spark, cfg, m)) for m in ("fct_orders", "fct_order_items")}
    v = build_testdata(spark, "/root/testdata/sf0.001", cfg)
    assert v["fct_orders"] == 2
    for m in full:
        assert rows(read_mart(spark, cfg, m)) == full[m]


def test_incremental_build_matches_full_build_after_changes(spark, tmp_path):
    """Later raw batch: some orders change status, sessions arrive late.  The
    incremental build (fact MERGE, ledger and funnel recomputed only where
    orders or sessions changed) must give the same rows as a full build of the
    changed raw data (load stamps aside), and the same facts in the manifests."""
    import datetime as dt

    from tidemart.plans.build import BuildConfig, _table, build, read_mart, refreshed
    from tidemart.sources import testdata

    sf = "/root/testdata/sf0.001"
    raw1 = testdata.raw_tables(spark, sf)
    key = F.col("order_id").cast("bigint")
    hit = key % 7 == 0
    raw2 = dict(raw1)
    raw2["orders"] = raw1["orders"].withColumn(
        "order_status", F.when(hit, F.lit("cancelled")).otherwise(F.col("order_status"))
    ).withColumn("updated_at", F.when(hit, F.lit(dt.datetime(2001, 8, 4))).otherwise(F.col("updated_at")))
    late = raw1["sessions"].filter("session_id % 11 = 0").withColumn("session_id", F.concat(F.lit("late-"), "session_id")).withColumn(
        "_loaded_at", F.lit(dt.datetime(2001, 8, 4)).cast("timestamp_ntz"))
    raw2["sessions"] = raw1["sessions"].unionByName(late)
    # Sessions on the days of orders, so that the funnel's revenue comes from the fact.
    for raw in (raw1, raw2):
        raw["sessions"] = raw["sessions"].withColumn("started_at", F.expr("started_at - INTERVAL 25 YEARS"))
    funnel = None
    as1, as2 = "2001-08-02 00:00:00", "2001-08-05 00:00:00"

    inc = BuildConfig(warehouse=str(tmp_path / "inc"), fact_grain="month", run_log=False, run_tests=False)
    build(spark, raw1, as1, inc, funnel)
    build(spark, raw2, as2, inc, funnel)
    full = BuildConfig(warehouse=str(tmp_path / "full"), fact_grain="month", run_log=False, run_tests=False)
    build(spark, raw2, as2, full, funnel)
    for m in ("fct_orders", "revenue_ledger", "session_funnel"):
        assert _table(spark, inc, m).observed() == _table(spark, full, m).observed() != {}
        assert _table(spark, inc, m).maximum("_built_at") == read_mart(spark, inc, m).agg(F.max("_built_at")).first()[0]
        a = read_mart(spark, inc, m).drop("_built_at")
        b = read_mart(spark, full, m).drop("_built_at")
        assert rows(a) == rows(b), m
    seen = refreshed(spark, inc)
    assert {r.model: r.row_count for r in seen.collect()} == {m: read_mart(spark, inc, m).count() for m in MARTS}
    assert "FileScan" not in seen._jdf.queryExecution().executedPlan().toString()
    assert read_mart(spark, inc, "fct_orders").filter(hit & (F.col("order_status") != "cancelled")).count() == 0


def test_vacuum_keeps_recent_versions(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "dim"))
    for i in range(4):
        t.overwrite(spark.createDataFrame([(i, "a", "US", D1, T0)], SCHEMA))
    removed = t.vacuum(keep_versions=2)
    assert sorted(removed) == ["version=1", "version=2"]
    assert t.versions() == [3, 4]
    assert [r.k for r in t.read().collect()] == [3]


def test_unpartitioned_upsert(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "dim"))
    t.overwrite(spark.createDataFrame([(1, "a", "US", D1, T0), (2, "b", "US", D1, T0)], SCHEMA))
    upsert_partitions(t, spark.createDataFrame([(2, "c", "FR", D2, T1)], SCHEMA), "k", ["status"])
    assert rows(t.read(), "k", "status", "country") == [(1, "a", "US"), (2, "c", "US")]


def test_failed_publish_keeps_previous_version(spark, tmp_path, monkeypatch):
    """A job that dies after writing data but before its manifest lands
    leaves readers on the previous version; a rerun succeeds."""
    t = VersionedTable(spark, str(tmp_path / "fct"), partition_by="d")
    t.overwrite(spark.createDataFrame([(1, "a", "US", D1, T0), (2, "b", "US", D2, T0)], SCHEMA))
    before = rows(t.read())

    def boom(*_a, **_k):
        raise RuntimeError("executor lost before publish")

    monkeypatch.setattr(VersionedTable, "_publish", boom)
    with pytest.raises(RuntimeError):
        upsert_partitions(t, spark.createDataFrame([(2, "c", "US", D2, T1)], SCHEMA), "k", None)
    monkeypatch.undo()
    assert t.current_version() == 1 and rows(t.read()) == before
    upsert_partitions(t, spark.createDataFrame([(2, "c", "US", D2, T1)], SCHEMA), "k", None)
    assert rows(t.read(), "k", "status") == [(1, "a"), (2, "c")]


def test_checkpoint_dir_comes_from_session_conf(spark):
    from tidemart.session import checkpoint_dir

    configured = spark.conf.get("spark.checkpoint.dir")
    first = checkpoint_dir(spark)
    assert first.startswith(configured) or configured in first
    assert checkpoint_dir(spark) == first  # set once, reused


def test_checkpoint_dir_fallback_only_when_unset():
    import pytest

    from tidemart import session as S

    class Ctx:
        def __init__(self, master):
            self.dir, self.master = None, master

        def getCheckpointDir(self):
            return self.dir

        def setCheckpointDir(self, d):
            self.dir = d

    class Conf(dict):
        def get(self, key, default=None):
            return dict.get(self, key) or default

    class Fake:
        def __init__(self, value, master="local[2]"):
            self.sparkContext = Ctx(master)
            self.conf = Conf({"spark.checkpoint.dir": value, "spark.sql.warehouse.dir": "file:/shared/wh"})

    assert S.checkpoint_dir(Fake("hdfs://shared/ckpt", "yarn")) == "hdfs://shared/ckpt"
    assert S.checkpoint_dir(Fake(None)) == "file:/shared/wh/_checkpoints"
    with pytest.raises(RuntimeError):
        S.checkpoint_dir(Fake(None, "yarn"))


def _versioned(spark, tmp_path, rows):
    from tidemart.sinks.versioned import VersionedTable

    table = VersionedTable(spark, str(tmp_path / "t"), partition_by="d")
    table.overwrite(spark.createDataFrame(rows, "k int, d date, country string, v int"), unique_key="k")
    return table


def test_upsert_keeps_the_null_partition(spark, tmp_path):
    import datetime as dt

    from tidemart.sinks.versioned import upsert_partitions

    day = dt.date(2001, 1, 1)
    table = _versioned(spark, tmp_path, [(1, None, "US", 1), (2, None, "CA", 2), (3, day, "MX", 3)])
    batch = spark.createDataFrame([(1, None, "ZZ", 10)], "k int, d date, country string, v int")
    upsert_partitions(table, batch, "k", ["v", "d"])
    assert sorted(map(tuple, table.read().collect())) == [(1, None, "US", 10), (2, None, "CA", 2), (3, day, "MX", 3)]
    moved = spark.createDataFrame([(1, day, "ZZ", 11)], "k int, d date, country string, v int")
    upsert_partitions(table, moved, "k", ["v", "d"])
    assert sorted(map(tuple, table.read().collect())) == [(1, day, "US", 11), (2, None, "CA", 2), (3, day, "MX", 3)]


def test_first_load_rejects_duplicates_and_stray_partitions_raise(spark, tmp_path):
    import datetime as dt

    import pytest

    from tidemart.operators.upsert import DuplicateKeyError

    day = dt.date(2001, 1, 1)
    with pytest.raises(DuplicateKeyError):
        _versioned(spark, tmp_path / "a", [(1, day, "US", 1), (1, day, "US", 2)])
    table = _versioned(spark, tmp_path / "b", [(1, day, "US", 1)])
    rows = spark.createDataFrame([(2, dt.date(2001, 1, 2), "US", 2)], "k int, d date, country string, v int")
    with pytest.raises(ValueError):
        table.replace_partitions(rows, [day])


def test_two_writers_of_one_manifest(spark, tmp_path):
    import pytest

    from tidemart.sinks import fs

    fs.write_text(spark, str(tmp_path / "1.json"), "first")
    with pytest.raises(OSError):
        fs.write_text(spark, str(tmp_path / "1.json"), "second")
    assert fs.read_text(spark, str(tmp_path / "1.json")) == "first"


def test_build_after_an_empty_first_build(spark, tmp_path):
    from tidemart.plans.build import BuildConfig, build, read_mart
    from tidemart.sources import testdata

    sf = "/root/testdata/sf0.001"
    raw, cfg = testdata.raw_tables(spark, sf), BuildConfig(
        warehouse=str(tmp_path / "wh"), fact_grain="month", run_tests=False, run_snapshots=False, run_log=False)
    build(spark, {**raw, "orders": raw["orders"].limit(0)}, testdata.DEFAULT_AS_OF, cfg, testdata.funnel_orders(spark, sf))
    assert read_mart(spark, cfg, "fct_orders").count() == 0
    build(spark, raw, testdata.DEFAULT_AS_OF, cfg, testdata.funnel_orders(spark, sf))
    assert read_mart(spark, cfg, "fct_orders").count() == 1500
    assert read_mart(spark, cfg, "fct_order_items").count() > 0


def test_vacuum_removes_superseded_partitions_of_a_live_version(spark, tmp_path):
    import datetime as dt

    from tidemart.sinks import fs

    def day(n, v):
        return spark.createDataFrame([(n, dt.date(2024, 1, n), v)], "k bigint, d date, v string")

    t = VersionedTable(spark, str(tmp_path / "t"), "d")
    t.overwrite(day(1, "a").unionByName(day(2, "a")))
    for v in "bcd":
        t.replace_partitions(day(1, v), [dt.date(2024, 1, 1)])
    assert t.vacuum(keep_versions=1, keep_hours=1) == []      # a reader may still be on any of them
    removed = t.vacuum(keep_versions=1)
    assert "version=1/d=2024-01-01" in removed and "version=2" in removed
    assert fs.list_dirs(spark, f"{t.root}/version=1") == ["d=2024-01-02"]
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(1, "d"), (2, "a")]


def test_changed_orders_filter_the_item_scan(spark):
    """The lines of an incremental run are filtered by the changed orders before any shuffle."""
    from tidemart.plans.graph import ModelGraph
    from tidemart.session import runtime_filters

    g = ModelGraph.from_testdata(spark, "/root/testdata/sf0.001")
    changed = g.stg_orders.filter(F.col("updated_at") > F.lit("2001-07-29").cast("timestamp_ntz")).select("order_id")
    lines = g.stg_order_items.select("order_id", "quantity").join(changed, "order_id", "left_semi")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with runtime_filters(spark):
            plan = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "might_contain" in plan
    filtered = plan[plan.index("might_contain"):]
    assert "Exchange" in plan[:plan.index("might_contain")] and "lineitem" in filtered


def test_facts_of_a_version_follow_replaced_partitions(spark, tmp_path):
    """Counts, rows and maxima in the manifest, after a maximum went with its partition too; the description is kept."""
    frame = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    t = VersionedTable(spark, str(tmp_path / "t"), "d", counts={"no status": F.count_if(F.col("status").isNull())},
                       maxima=("ts", "d"), description="orders of a test")
    late = dt.datetime(2024, 3, 1, 12, 30, 0, 250000)
    t.overwrite(frame((1, None, "US", D1, T0), (2, "a", "US", D2, late), (3, None, "US", D3, T1)))
    assert t.observed() == {"no status": 2, "rows": 3} and t.maximum("ts") == late and t.maximum("d") == D3
    t.replace_partitions(frame((2, None, "US", D2, T0), (4, "x", "US", D2, T0)), [D2])
    assert t.observed() == {"no status": 3, "rows": 4} and t.maximum("ts") == T1 and t.maximum("d") == D3
    t.replace_partitions(frame((9, "z", "US", D1, T0)).limit(0), [D3])
    assert t.observed() == {"no status": 2, "rows": 3} and t.maximum("ts") == T0 and t.maximum("d") == D2
    t.replace_partitions(frame((5, "z", "US", None, late)), [None])
    assert t.observed() == {"no status": 2, "rows": 4} and t.maximum("ts") == late
    assert t.manifest()["description"] == "orders of a test"
    other = VersionedTable(spark, t.root, "d", counts={"paid": F.count_if(F.col("status") == "paid")}, maxima=("ts",))
    assert other.observed() == {} and other.maximum("ts") == late  # published by another definition
    other.replace_partitions(frame((1, "paid", "US", D1, T0)), [D1])
    assert other.observed() == {"paid": 1, "rows": 4}
    empty = VersionedTable(spark, str(tmp_path / "e"), maxima=("ts",))
    empty.overwrite(frame((1, None, "US", D1, T0)).limit(0))
    assert empty.observed() == {"rows": 0} and empty.maximum("ts") is None
