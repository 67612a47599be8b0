"""What the tests and facts shuffle, and rows under keys that are taken."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from tidemart.operators import quality as Q
from tidemart.operators import upsert as U
from tidemart.plans import marts as M
from tidemart.plans import staging as S
from tidemart.plans.graph import ModelGraph
from tidemart.sources import revisions as R

AS_OF = "2024-01-02 00:00:00"


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _graph(spark):
    """Lines whose ids are written in several ways, some of unknown orders or without a product."""
    items = [(o, n, p, "2", "1.50", "0.1") for o, n, p in [("1", "1", "10"), (" 1", "2", None), ("01", "3", "x"), ("2", "+4", "11"),
                                                            ("9", "5", "10"), ("abc", "6", "10"), (None, "7", "10"), ("2", None, "10"), ("3", "y", "12")]]
    orders = [("1", "5"), ("2", "6"), ("3", "7"), ("abc", "5")]
    raw = {
        "order_items": spark.createDataFrame(items, "order_id string, line_item_id string, product_id string, quantity string, unit_price string, discount string")
        .withColumn("_loaded_at", F.lit(AS_OF).cast("timestamp_ntz")),
        "orders": spark.createDataFrame(orders, "order_id string, customer_id string").select(
            "*", F.lit("paid").alias("order_status"), F.lit("USD").alias("currency"), F.lit("1").alias("total_amount"),
            *[F.lit(AS_OF).cast("timestamp_ntz").alias(c) for c in ("placed_at", "updated_at", "_loaded_at")]),
    }
    return ModelGraph(raw, AS_OF)


@pytest.mark.parametrize("model, key, new", [("products", "product_id", 7), ("customers", "customer_id", 5)])
def test_new_rows_get_keys_of_their_own(spark, model, key, new):
    """A table whose keys reach beyond the offset has the shifted keys already."""
    ids = [new, new + 100, new + 1_000_000, 3_000_001]
    other = "sku string, product_name string, description string, category string, list_price decimal(38,9), is_active boolean" \
        if model == "products" else "email string, country string, tier string, created_at timestamp_ntz"
    n = other.count(",") - (1 if model == "products" else 0)  # the comma of decimal(38,9)
    old = spark.createDataFrame([(i, *[None] * (n + 1), None) for i in ids], f"{key} bigint, {other}, updated_at timestamp_ntz")
    g = ModelGraph({}, AS_OF)
    setattr(g, f"stg_{model}", old)
    got = sorted(r[0] for r in getattr(R, f"{model}_v2")(g).select(key).collect())
    assert got == sorted([*ids, new + 100 + R.NEW_KEY_OFFSET, new + 5_000_000, new + 1_000_000 + R.NEW_KEY_OFFSET])


def test_many_repeated_hashes_are_broadcast_as_bitmaps(spark, monkeypatch):
    rng = random.Random(5)
    data = [(rng.randrange(400), rng.choice(["a", None, f"t{rng.randrange(300)}"])) for _ in range(500)]
    df = spark.createDataFrame(data, "id bigint, name string")
    specs = [Q.CheckSpec("m", "unique", "id"), Q.CheckSpec("m", "unique", "name"), Q.CheckSpec("m", "unique_combination", "id,name")]
    want = rows(Q.duplicate_keys({"m": df}, specs))
    assert len(want) > 100
    monkeypatch.setattr(Q, "BROADCAST_HASHES", 0)
    for bits in (1, 16):
        monkeypatch.setattr(Q, "BITS_PER_HASH", bits)
        found = Q.duplicate_keys({"m": df}, specs)
        assert rows(found) == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_only_relationships_with_orphans_are_looked_up(spark):
    g = _graph(spark)
    specs = [Q.CheckSpec("fct_order_items", "relationships", "product_id", {"to": "p", "field": "id"}),
             Q.CheckSpec("fct_order_items", "relationships", "order_id", {"to": "o", "field": "id"})]
    models = {"fct_order_items": g.fct_order_items, "p": spark.createDataFrame([(10,)], "id bigint"),
              "o": spark.createDataFrame([(1,), (2,), (3,)], "id bigint")}
    found = Q.orphan_keys(models, specs)
    assert [r[2:3] + r[4:] for r in rows(found)] == [("product_id", "11"), ("product_id", "12")]
    assert _optimized(found).count("Join Inner") == 1  # no look-up for the order ids


def test_line_facts_are_computed_behind_the_join(spark):
    g = _graph(spark)
    assert rows(g.fct_order_items) == rows(M.fct_order_items(g.stg_order_items, g.stg_orders, AS_OF))
    assert rows(S.with_line_columns(g.order_lines).select("order_item_sk", "line_net_amount")) == rows(
        g.stg_order_items, "order_item_sk", "line_net_amount")
    plan = _optimized(g.fct_order_items)
    assert "sha2" in plan[:plan.index("Join Inner")] and "sha2" not in plan[plan.index("Join Inner"):]


def test_null_tests_reach_below_joins(spark):
    g = _graph(spark)
    specs = [Q.CheckSpec("fct_order_items", "not_null", c) for c in ("order_id", "product_id")]
    found = Q.failing_rows({"fct_order_items": g.fct_order_items}, specs)
    assert [r[:3] for r in rows(found)] == [("fct_order_items", "not_null", "product_id")] * 2
    plan = _optimized(found)
    assert "isnull" in plan[plan.index("Join Inner"):]


def test_orphan_report_joins_order_ids_only(spark):
    rng = random.Random(7)
    lines = [(rng.choice([None, *range(60)]), rng.randrange(5), f"s{rng.randrange(99)}") for _ in range(600)]
    orders = [(rng.choice([None, *range(10, 70)]), rng.choice(["paid", "cancelled", None])) for _ in range(90)]
    items = spark.createDataFrame(lines, "order_id bigint, line_item_id bigint, order_item_sk string")
    o = spark.createDataFrame(orders, "order_id bigint, order_status string")
    want = []
    for line in lines:
        own = [s for k, s in orders if k is not None and k == line[0]]
        want += [line] * (sum(s == "cancelled" for s in own) if own else 1)
    want = sorted(want, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))[:100]
    found = Q.no_orphaned_order_items(items, o)
    assert [tuple(r) for r in found.collect()] == want
    assert _optimized(found).count("Join LeftSemi") == 2


def test_unique_keys_are_counted_by_hash(spark, monkeypatch):
    unique = spark.createDataFrame([(f"k{i}",) for i in range(30)] + [(None,)], "k string")
    U.assert_unique_keys(unique, "k")
    for key in ("k7", None):
        with pytest.raises(U.DuplicateKeyError):
            U.assert_unique_keys(unique.union(spark.createDataFrame([(key,)], "k string")), "k")
    seen = []
    hashed = lambda c: seen.append(c) or F.length(F.coalesce(F.col(c), F.lit("")))
    monkeypatch.setattr(U.F, "xxhash64", hashed)
    for most in (1, 100):  # equal hashes of unequal keys
        monkeypatch.setattr(U, "HASHES_LOOKED_UP", most)
        U.assert_unique_keys(unique, "k")
        with pytest.raises(U.DuplicateKeyError):
            U.assert_unique_keys(unique.union(spark.createDataFrame([("k29",)], "k string")), "k")
    assert seen
