"""The index of keys and partitions that upserts look up."""

import datetime as dt
import random

from helpers import rows
from tidemart.sinks import fs, key_index
from tidemart.sinks.versioned import VersionedTable, upsert_partitions

SCHEMA = "k string, v bigint, d date"
DAYS = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(6)]


def _batches(seed=3):
    """A first load and batches of new, changed, moved and repeated rows; some without a day."""
    rng = random.Random(seed)
    state = {f"k{i}": (f"k{i}", i, rng.choice([*DAYS, None])) for i in range(40)}
    out = [list(state.values())]
    for n in range(3):
        keys = rng.sample(sorted(state), 6) + [f"n{n}-{i}" for i in range(3)]
        batch = [(k, 100 * n + i, rng.choice([*DAYS, None])) for i, k in enumerate(keys)]
        state.update({r[0]: r for r in batch})
        out.append(batch)
    return out, state


def test_indexed_upserts_equal_the_plain_merge(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemart.sinks.versioned.MAX_APPENDS", 1)
    batches, state = _batches()
    tables = [VersionedTable(spark, str(tmp_path / n), "d", index_key=k) for n, k in (("indexed", "k"), ("plain", None))]
    for t in tables:
        t.overwrite(spark.createDataFrame(batches[0], SCHEMA))
        for batch in batches[1:]:
            upsert_partitions(t, spark.createDataFrame(batch, SCHEMA), "k")
    expected = sorted(state.values())
    order = lambda r: r[0]
    for t in tables:
        assert sorted(map(tuple, t.read().select("k", "v", "d").collect()), key=order) == sorted(expected, key=order)
    indexed, plain = tables
    assert "keys" in indexed.manifest() and "keys" not in plain.manifest()
    # every row's partition is listed, after appends and after the index was written anew
    facts = indexed.manifest()["keys"]
    with key_index.KeyIndex(spark, facts["path"], "k", "d", facts["buckets"]).entries() as entries:
        listed = {tuple(r) for r in entries.collect()}
    assert {(k, d) for k, _, d in expected} <= listed
    assert indexed.manifest()["keys"]["path"] != f"{indexed.root}/keys/1"
    indexed.vacuum(keep_versions=1)
    assert fs.list_dirs(spark, f"{indexed.root}/keys") == [indexed.manifest()["keys"]["path"].rsplit("/", 1)[1]]
    upsert_partitions(indexed, spark.createDataFrame([("k0", -1, DAYS[0])], SCHEMA), "k")
    assert indexed.read().filter("k = 'k0'").select("v").first()[0] == -1


def test_lookup_shuffles_the_batch_only(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "d", index_key="k")
    t.overwrite(spark.createDataFrame(_batches()[0][0], SCHEMA))
    index = t.key_index("k")
    batch = spark.createDataFrame([("k1", 1, DAYS[0])], SCHEMA).checkpoint()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with index.entries() as entries:
            plan = index.matches(entries, batch)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1
    scan = plan.index("FileScan parquet")
    assert "Exchange" not in plan[:scan] and "Bucketed: true" in plan


def test_tables_without_an_index_get_one(spark, tmp_path):
    first = _batches()[0][0]
    VersionedTable(spark, str(tmp_path / "t"), "d").overwrite(spark.createDataFrame(first, SCHEMA))
    t = VersionedTable(spark, str(tmp_path / "t"), "d", index_key="k")
    upsert_partitions(t, spark.createDataFrame([("k2", -2, DAYS[5])], SCHEMA), "k")
    assert t.manifest()["keys"]["appends"] == 1
    assert rows(t.read().filter("k = 'k2'").select("k", "v", "d")) == [("k2", -2, DAYS[5])]
    assert t.read().count() == len(first)
    # partitions replaced without keys: the version has no index, the next upsert makes one
    t.replace_partitions(spark.createDataFrame([("new", 7, DAYS[5])], SCHEMA), [DAYS[5]])
    assert "keys" not in t.manifest()
    upsert_partitions(t, spark.createDataFrame([("new", 8, DAYS[0])], SCHEMA), "k")
    assert rows(t.read().filter("k = 'new'").select("v", "d")) == [(8, DAYS[0])]


def test_buckets_grow_with_the_keys():
    assert key_index.buckets_for(0) == 8
    assert key_index.buckets_for(10**9) * key_index.BUCKET_KEYS >= 10**9
