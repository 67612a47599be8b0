import datetime as dt

from pyspark.sql import functions as F

from tidemart.operators.scd2 import overlapping_periods, scd2_apply

from helpers import rows

SCHEMA = "id bigint, email string, country string, note string"
A1, A2, A3, A4 = "2024-01-01 00:00:00", "2024-02-01 00:00:00", "2024-03-01 00:00:00", "2024-04-01 00:00:00"
T = dt.datetime.fromisoformat


def _hist(spark, runs, check=("email", "country")):
    h = None
    for data, as_of in runs:
        h = scd2_apply(h, spark.createDataFrame(data, SCHEMA), "id", as_of, list(check) if check else None)
        h = spark.createDataFrame(h.collect(), h.schema)  # materialise like a published version
    return h


def test_first_load_opens_every_row(spark):
    h = _hist(spark, [([(1, "a", "US", "x"), (2, "b", None, "y")], A1)])
    assert rows(h, "id", "valid_from", "valid_to") == [(1, T(A1), None), (2, T(A1), None)]
    assert h.select("scd_id").distinct().count() == 2


def test_change_null_to_value_delete_and_return(spark):
    v1 = [(1, "a", "US", "x"), (2, "b", None, "y"), (3, "c", "FR", "z")]
    v2 = [(1, "a", "US", "changed-note-only"), (2, "b", "DE", "y")]          # 2: NULL->DE, 3 deleted
    v3 = [(1, "a", "US", "x"), (2, "b", "DE", "y"), (3, "c", "FR", "z")]      # 3 returns
    h = _hist(spark, [(v1, A1), (v2, A2), (v3, A3)])
    got = rows(h, "id", "country", "note", "valid_from", "valid_to")
    assert got == [
        (1, "US", "x", T(A1), None),              # unchecked column change: no new version, row untouched
        (2, "DE", "y", T(A2), None),
        (2, None, "y", T(A1), T(A2)),
        (3, "FR", "z", T(A1), T(A2)),             # invalidated by the hard delete
        (3, "FR", "z", T(A3), None),              # returned after deletion: new row
    ]
    assert overlapping_periods(h, "id").count() == 0


def test_rerun_is_idempotent(spark):
    v1 = [(1, "a", "US", "x"), (2, "b", None, "y")]
    v2 = [(1, "a2", "US", "x")]
    h2 = _hist(spark, [(v1, A1), (v2, A2)])
    h3 = scd2_apply(h2, spark.createDataFrame(v2, SCHEMA), "id", A4, ["email", "country"])
    assert rows(h2) == rows(h3)


def test_check_all_columns_by_default(spark):
    h = _hist(spark, [([(1, "a", "US", "x")], A1), ([(1, "a", "US", "y")], A2)], check=None)
    assert h.filter(F.col("valid_to").isNull()).first()["note"] == "y"
    assert h.count() == 2


def test_no_hard_delete_invalidation_option(spark):
    h1 = scd2_apply(None, spark.createDataFrame([(1, "a", "US", "x")], SCHEMA), "id", A1, ["email"])
    h2 = scd2_apply(h1, spark.createDataFrame([], SCHEMA), "id", A2, ["email"], invalidate_hard_deletes=False)
    assert rows(h2, "id", "valid_to") == [(1, None)]


def test_snapshot_job_rewrites_only_open_and_current_month(spark, tmp_path):
    from tidemart.plans.snapshots import history_table, run_snapshot

    t = history_table(spark, str(tmp_path / "snap"))
    cur = lambda data: spark.createDataFrame(data, SCHEMA)
    run_snapshot(t, cur([(1, "a", "US", "x"), (2, "b", "FR", "y"), (3, "c", "DE", "z")]), "id", A1, ["email", "country"])
    run_snapshot(t, cur([(1, "a2", "US", "x"), (2, "b", "FR", "y"), (3, "c", "DE", "z")]), "id", A2, ["email", "country"])
    feb_path = t.manifest()["paths"]["2024-02-01"]
    # a second run in March and a third one later in March keep both closures
    run_snapshot(t, cur([(1, "a2", "US", "x"), (2, "b", "FR", "y")]), "id", A3, ["email", "country"])
    run_snapshot(t, cur([(1, "a2", "US", "x")]), "id", "2024-03-15 00:00:00", ["email", "country"])
    m = t.manifest()
    assert m["paths"]["2024-02-01"] == feb_path          # closed history untouched
    h = t.read()
    assert rows(h, "id", "email", "valid_from", "valid_to") == [
        (1, "a", T(A1), T(A2)),
        (1, "a2", T(A2), None),
        (2, "b", T(A1), T("2024-03-15 00:00:00")),
        (3, "c", T(A1), T(A3)),
    ]
    assert overlapping_periods(h.drop("valid_to_month"), "id").count() == 0


def test_null_keys_are_not_snapshotted(spark):
    v = [(1, "a", "US", "x"), (None, "z", "US", "x")]
    h1 = scd2_apply(None, spark.createDataFrame(v, SCHEMA), "id", A1, ["email"])
    h2 = scd2_apply(h1, spark.createDataFrame(v, SCHEMA), "id", A2, ["email"])
    assert rows(h2, "id", "valid_to") == [(1, None)]


def test_period_overlaps_detects_bad_history(spark):
    from tidemart.operators.scd2 import period_overlaps

    good = _hist(spark, [([(1, "a", "US", "x")], A1), ([(1, "b", "US", "x")], A2)])
    assert period_overlaps(good, "id").count() == 0
    bad = spark.createDataFrame(
        [(1, "s1", T(A1), None), (1, "s2", T(A2), None), (2, "s3", T(A1), T(A3)), (2, "s4", T(A2), None)],
        "id bigint, scd_id string, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    assert sorted(r.scd_id for r in period_overlaps(bad, "id").collect()) == ["s2", "s4"]


def test_duplicate_keys_and_earlier_snapshots_are_refused(spark):
    import pytest

    from tidemart.operators.scd2 import scd2_apply
    from tidemart.operators.upsert import DuplicateKeyError

    one = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(DuplicateKeyError):
        scd2_apply(None, one.unionByName(one), "k", "2001-01-02 00:00:00")
    history = scd2_apply(None, one, "k", "2001-01-02 00:00:00")
    with pytest.raises(ValueError):
        scd2_apply(history, one, "k", "2001-01-01 00:00:00")
