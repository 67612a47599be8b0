"""What lies on disk while tables are built and merged."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import SF_SMALL, rows
from tidemart.functions.derived import with_digests, without_digests
from tidemart.functions.expressions import surrogate_key
from tidemart.plans import build as B
from tidemart.plans.catalog import QUERIES
from tidemart.plans.graph import ModelGraph
from tidemart.session import SHUFFLE_CLEANUP, shuffles_released
from tidemart.sinks import key_index
from tidemart.sinks.versioned import VersionedTable, upsert_partitions

DAYS = [dt.date(2024, m, 1) for m in range(1, 7)]


def test_digests_do_not_travel_and_come_back(spark):
    df = spark.createDataFrame([(1, 2, None, None), (3, None, "own", None), (None, 5, "", "x")],
                               "order_id bigint, line_item_id bigint, order_sk string, order_item_sk string")
    digest = surrogate_key(["order_id", "line_item_id"])
    df = df.unionByName(df.select("order_id", "line_item_id", surrogate_key(["order_id"]).alias("order_sk"), digest.alias("order_item_sk")))
    narrow = without_digests(df)
    assert not {"order_sk", "order_item_sk"} & set(narrow.columns)
    assert narrow.filter("__odd_order_sk IS NULL AND __odd_order_item_sk IS NULL").count() == 3
    back = with_digests(narrow, df.schema)
    assert back.columns == df.columns and rows(back) == rows(df)


def test_shuffles_are_released_within_the_block_only(spark):
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    with shuffles_released(spark):
        with shuffles_released(spark):
            assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(SHUFFLE_CLEANUP, None) == before


def test_first_load_leaves_its_table_only(spark, tmp_path, monkeypatch):
    """The fact is computed before its version is written, and its files are gone once it is."""
    from tidemart.session import checkpoint_dir
    from tidemart.sinks import fs

    tables = lambda: set(fs.list_dirs(spark, f"{checkpoint_dir(spark)}/tables"))
    before = tables()
    seen = []
    monkeypatch.setattr(VersionedTable, "_new_index", lambda self, *a, f=VersionedTable._new_index: seen.append(tables()) or f(self, *a))
    cfg = B.BuildConfig(str(tmp_path / "wh"), fact_grain="year", run_tests=False, run_log=False)
    g = ModelGraph.from_testdata(spark, SF_SMALL)
    table = B._table(spark, cfg, "fct_order_items")
    B._first_load(g, "fct_order_items", table)
    assert seen == [before] and tables() == before
    assert table.read().drop(table.partition_col).exceptAll(g.fct_order_items).count() == 0
    assert table.read().count() == g.fct_order_items.count() > 0
    assert all(".zstd." in f for f in next(iter(spark.read.parquet(p).inputFiles() for p in table.manifest()["paths"].values())))


@pytest.mark.parametrize("update_columns", [None, ("v",)])
def test_sliced_versions_equal_plain_ones(spark, tmp_path, monkeypatch, update_columns):
    """Null keys, repeated target keys, rows without a day, rows that move between partitions."""
    schema = "k string, v bigint, d date"
    rng = random.Random(7)
    first = [(f"k{i % 50}" if i % 9 else None, i, rng.choice([*DAYS, None])) for i in range(60)]
    batch = [(f"k{i}", 1000 + i, rng.choice([*DAYS, None])) for i in range(0, 70, 3)] + [(None, 2000, DAYS[0])]
    got = {}
    for size in (10**6, 7):
        monkeypatch.setattr("tidemart.sinks.versioned.SLICE_ROWS", size)
        t = VersionedTable(spark, str(tmp_path / str(size)), "d", "month", index_key="k", maxima=("d",))
        t.overwrite(spark.createDataFrame(first, schema), stored=True)
        assert rows(t.read().select("k", "v", "d")) == sorted(first, key=lambda r: tuple((x is None, str(x)) for x in r))
        if size == 7:
            assert len(t.slices(t.read())) > 2
        upsert_partitions(t, spark.createDataFrame(batch, schema), "k", update_columns)
        m = t.manifest()
        got[size] = rows(t.read()), m["counts"], m["maxima"], sorted(m["paths"])
    assert got[7] == got[10**6]


def test_long_keys_are_indexed_by_hash(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "d", index_key="k")
    keys = [f"{i:064d}" for i in range(40)]
    t.overwrite(spark.createDataFrame([(k, 1, DAYS[i % 6]) for i, k in enumerate(keys)], "k string, v bigint, d date"))
    facts = t.manifest()["keys"]
    with key_index.KeyIndex(spark, facts["path"], "k", "d", facts["buckets"]).entries() as entries:
        assert entries.agg(F.max(F.length("k"))).first()[0] <= 16 and entries.count() == 40
    upsert_partitions(t, spark.createDataFrame([(keys[3], 2, DAYS[5]), ("x" * 64, 3, DAYS[0])], "k string, v bigint, d date"), "k")
    assert rows(t.read().filter("v > 1")) == [(keys[3], 2, DAYS[5]), ("x" * 64, 3, DAYS[0])] and t.read().count() == 41


def test_order_lines_are_shuffled_once_and_keys_not_at_all(spark):
    plan = ModelGraph.from_testdata(spark, SF_SMALL).fct_orders._jdf.queryExecution().executedPlan().toString()
    shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert shuffles and not any("product_id" in s or "order_sk" in s for s in shuffles)
    assert any("hashpartitioning(order_id" in s for s in shuffles)


def test_dq_summary_shuffles_nothing_when_it_is_read(spark):
    summary = QUERIES["dq_summary"](spark, SF_SMALL)
    assert "Exchange" not in summary._jdf.queryExecution().executedPlan().toString()
    assert all("/dq-summary-" in f for f in summary.inputFiles())
