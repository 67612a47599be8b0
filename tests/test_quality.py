from decimal import Decimal

from tidemart.operators import quality as Q

from helpers import rows


def test_generic_tests(spark):
    df = spark.createDataFrame(
        [(1, "paid", Decimal("5"), "a"), (2, None, Decimal("-1"), "a"), (2, "bogus", None, None), (None, "paid", Decimal("0"), "b")],
        "k bigint, status string, amt decimal(18,4), email string",
    )
    assert rows(Q.not_null(df, "k"), "status") == [("paid",)]
    assert rows(Q.non_negative(df, "amt"), "k") == [(2,)]             # NULL passes
    assert rows(Q.values_in_set(df, "status", ["paid"]), "k") == [(2,)]  # NULL status passes
    assert rows(Q.unique(df, "k")) == [(2, 2)]                         # NULL key ignored
    assert rows(Q.unique(df, "email")) == [("a", 2)]
    assert rows(Q.unique_combination(df, ["k", "email"])) == []
    assert rows(Q.within_range(df, "amt", 0, 4), "k") == [(1,), (2,)]


def test_relationships_ignores_null_child_keys(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None)], "id bigint, parent bigint")
    parent = spark.createDataFrame([(10,)], "pid bigint")
    assert rows(Q.relationships(child, "parent", parent, "pid"), "id") == [(2,)]


def test_orphan_report_is_first_100_by_key(spark):
    items = spark.createDataFrame(
        [(i, 1, f"sk{i}") for i in range(300)], "order_id bigint, line_item_id bigint, order_item_sk string"
    )
    orders = spark.createDataFrame(
        [(i, "cancelled" if i % 3 == 0 else "paid") for i in range(0, 300, 2)], "order_id bigint, order_status string"
    )
    out = [r.order_id for r in Q.no_orphaned_order_items(items, orders).collect()]
    expected = [i for i in range(300) if i % 2 == 1 or i % 3 == 0][:100]
    assert out == expected


def test_revenue_reconciliation_flags_drift(spark):
    ledger = spark.createDataFrame([(Decimal("10.00"),), (Decimal("5.00"),)], "gross_revenue decimal(28,4)")
    fct = spark.createDataFrame(
        [("paid", Decimal("10.00")), ("delivered", Decimal("5.02")), ("cancelled", Decimal("99"))],
        "order_status string, order_total_amount decimal(18,4)",
    )
    r = Q.revenue_reconciliation(ledger, fct).collect()
    assert len(r) == 1 and r[0].delta == Decimal("-0.0200")
    ok = spark.createDataFrame([("paid", Decimal("15.005"))], "order_status string, order_total_amount decimal(18,4)")
    assert Q.revenue_reconciliation(ledger, ok).count() == 0


def test_dq_summary_on_models(graph_small, spark):
    from tidemart.plans.catalog import _Models

    s = Q.dq_summary(_Models(graph_small), Q.DECLARED_TESTS, graph_small.as_of)
    got = {(r.model, r.test_name, r.column_name): (r.failing_rows, r.status) for r in s.collect()}
    assert len(got) == len(Q.DECLARED_TESTS)
    assert got[("stg_orders", "unique", "order_id")] == (0, "pass")
    # orders of an unknown customer have no customer_sk in the fact
    n, status = got[("fct_orders", "not_null", "customer_sk")]
    assert n > 0 and status == "fail"
    assert got[("stg_order_items", "relationships", "order_id")][1] == "fail"


def test_every_kind_of_test_finds_its_planted_faults(spark):
    from tidemart.plans.catalog import _Models
    from tidemart.plans.graph import ModelGraph

    from helpers import SF_SMALL

    g = ModelGraph.from_faulty_testdata(spark, SF_SMALL)
    failed = {(r.model, r.test_name) for r in Q.dq_summary(_Models(g), Q.DECLARED_TESTS, g.as_of).collect()
              if r.status == "fail"}
    assert {("raw_orders", "not_null"), ("raw_orders", "values_in_set"), ("raw_order_items", "non_negative"),
            ("raw_order_items", "unique_combination"), ("stg_customers", "values_in_set"), ("stg_products", "unique"),
            ("fct_order_items", "discount_below_one"), ("stg_order_items", "no_orphaned_order_items")} <= failed


def test_colliding_hashes_are_no_duplicates(spark):
    """Uniqueness with all hashes in one to three buckets: only equal keys count."""
    df = spark.createDataFrame([(i, f"e{i}", i % 4 or None) for i in range(50)] + [(7, "e7", 9), (8, None, None), (8, None, None)],
                               "id bigint, email string, part bigint")
    specs = [Q.CheckSpec("m", "unique", "id"), Q.CheckSpec("m", "unique", "email"), Q.CheckSpec("m", "unique_combination", "email,part")]
    want = [("m", "unique", "email", "e7", 2), ("m", "unique", "id", "7", 2), ("m", "unique", "id", "8", 3),
            ("m", "unique_combination", "email,part", "", 2)]
    for buckets in (1, 3, None):
        assert rows(Q.duplicate_keys({"m": df}, specs, buckets)) == want
    clean = spark.range(10).withColumnRenamed("id", "k")
    assert Q.duplicate_keys({"m": clean}, [Q.CheckSpec("m", "unique", "k")]).count() == 0


def test_uniqueness_shuffles_hashes_only(spark):
    df = spark.createDataFrame([("a" * 50, "b")], "email string, other string")
    plan = Q._tested_keys({"m": df}, [Q.CheckSpec("m", "unique", "email")], None, whole=False)
    assert dict(plan.dtypes) == {"tag": "smallint", "h": "bigint"}


def test_orphans_of_all_relationships_at_once(spark):
    child = spark.createDataFrame([(1, 10, "x"), (2, 11, None), (3, None, "y"), (4, 11, "x")], "order_sk int, parent bigint, name string")
    parent = spark.createDataFrame([(10, "x"), (None, None)], "pid bigint, pname string")
    specs = [Q.CheckSpec("fct_orders", "relationships", "parent", {"to": "p", "field": "pid"}),
             Q.CheckSpec("fct_orders", "relationships", "name", {"to": "p", "field": "pname"})]
    models = {"fct_orders": child, "p": parent}
    got = rows(Q.orphan_keys(models, specs))
    assert got == [("fct_orders", "relationships", "name", "3", "y"), ("fct_orders", "relationships", "parent", "2", "11"),
                   ("fct_orders", "relationships", "parent", "4", "11")]
    summary = {r.column_name: r.failing_rows for r in Q.dq_summary(models, specs).collect()}
    assert summary == {"parent": 2, "name": 1}
    plan = Q._relation_keys(models, specs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_row_tests_counted_while_writing(spark, tmp_path):
    """Counts observed by the writing job equal those of a scan, and the summary uses them without one."""
    from tidemart.plans.graph import ModelGraph

    from helpers import SF_SMALL

    g = ModelGraph.from_faulty_testdata(spark, SF_SMALL)
    names = ("stg_orders", "stg_customers", "stg_order_items")
    scanned = {m: g.model(m).agg(*[c.alias(k.replace(":", "_")) for k, c in Q.row_counts(m).items()]).first() for m in names}
    observed = g.materialize(*names, count=Q.row_counts)
    for m in names:
        assert list(observed[m].values()) == list(scanned[m]) and sum(observed[m].values()) > 0
    specs = [s for s in Q.DECLARED_TESTS if s.model in names and s.test in Q.ROW_TESTS]
    summary = Q.dq_summary({}, specs, observed=observed)
    assert {f"{r.model}:{r.test_name}:{r.column_name}": r.failing_rows for r in summary.collect()} == {
        f"{m}:{k}": n for m in names for k, n in observed[m].items()}
    assert "FileScan" not in summary._jdf.queryExecution().executedPlan().toString()
