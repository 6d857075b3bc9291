"""Seeded detector scenarios (the reference's controlled simulations)."""
import datetime as dt

from pyspark.sql import functions as F

from innspark.operators import monitor as M

TEST_DATE = dt.date(2026, 8, 3)


def _volume_history(spark, table, today_value, baseline=1000, noise=20, weeks=8):
    dow = TEST_DATE.isoweekday() % 7
    rows = [("_simulation", table, TEST_DATE - dt.timedelta(weeks=i), baseline + (i % 3 - 1) * (noise // 2), dow)
            for i in range(1, weeks + 1)]
    rows.append(("_simulation", table, TEST_DATE, today_value, dow))
    return rows


def _score(spark, rows):
    df = spark.createDataFrame(rows, "schema_name string, table_name string, snapshot_date date, "
                                     "row_count long, day_of_week int")
    z = M.rolling_z(df, ["schema_name", "table_name", "day_of_week"], "snapshot_date", "row_count", 8)
    return {r.table_name: r for r in z.where(F.col("snapshot_date") == TEST_DATE).collect()}


def test_volume_scenarios(spark):
    rows = (_volume_history(spark, "volume_normal_case", 1005) + _volume_history(spark, "volume_spike_case", 2500)
            + _volume_history(spark, "volume_drop_case", 100))
    out = _score(spark, rows)
    assert out["volume_normal_case"].severity is None
    assert out["volume_spike_case"].severity == "critical"
    assert out["volume_drop_case"].severity == "critical"
    assert out["volume_normal_case"].history_points == 8


def test_insufficient_history_and_flat_history(spark):
    rows = _volume_history(spark, "short", 5000, weeks=2)
    out = _score(spark, rows)
    assert out["short"].status == "insufficient_history" and out["short"].severity is None
    flat = _volume_history(spark, "flat", 1001, noise=0)  # identical history -> stdev 1e-9
    assert _score(spark, flat)["flat"].severity == "critical"


def test_freshness_scenarios(spark):
    snap = spark.createDataFrame(
        [("_simulation", "bookings", TEST_DATE, "x", None, 10.0), ("_simulation", "guests", TEST_DATE, "x", None, 120.0),
         ("_simulation", "payroll", TEST_DATE, "x", None, 50 * 24.0)],
        "schema_name string, table_name string, snapshot_date date, freshness_column string, "
        "latest_value timestamp, lag_hours double")
    got = {r.table_name: r.severity for r in M.freshness_alerts(snap, spark).collect()}
    assert got == {"guests": "critical", "payroll": "warning"}


def test_dirty_drift_bootstrap_and_rolling(spark):
    keys = ["schema_name", "table_name", "column_name"]
    boot = spark.createDataFrame([("s", "t", "c", 30.0)], "schema_name string, table_name string, "
                                                          "column_name string, bootstrap_pct double")
    # days 1-3: bootstrap mode; 60.0 is outside 30 +- 50 % -> warning only
    vals = [31.0, 60.0] + [30.0 + (0.2 if d % 2 else -0.2) for d in range(12)] + [45.0]
    hist = [("s", "t", "c", dt.date(2024, 1, d + 1), v) for d, v in enumerate(vals)]
    df = spark.createDataFrame(hist, "schema_name string, table_name string, column_name string, "
                                     "snapshot_date date, dirty_pct double")
    out = {r.snapshot_date.day: r for r in M.drift_with_bootstrap(df, keys, "snapshot_date", "dirty_pct",
                                                                   boot).collect()}
    assert out[1].mode == "bootstrap" and out[1].severity is None
    assert out[2].mode == "bootstrap" and out[2].severity == "warning"
    assert out[3].mode == "bootstrap" and out[3].severity is None
    assert out[15].mode == "rolling" and out[15].severity == "critical"   # window = days 3..14
    assert out[14].severity is None


def test_outlier_drift(spark):
    rows = [("s", "t", "c", dt.date(2024, 1, d), n, 1000) for d, n in
            [(1, 10), (2, 11), (3, 9), (4, 10), (5, 10), (6, 90)]]
    df = spark.createDataFrame(rows, "schema_name string, table_name string, column_name string, "
                                     "snapshot_date date, outlier_count long, row_count long")
    out = {r.snapshot_date.day: r.severity for r in M.outlier_drift(df).collect()}
    assert out[6] == "critical" and out[5] is None


def test_schema_drift_and_acknowledge(spark):
    base = spark.createDataFrame([("s", "t", "a", "string", True, 1), ("s", "t", "b", "int", True, 2),
                                  ("s", "t", "c", "int", True, 3)],
                                 "schema_name string, table_name string, column_name string, data_type string, "
                                 "is_nullable boolean, ordinal_position int")
    cur = spark.createDataFrame([("s", "t", "a", "string", True, 1), ("s", "t", "b", "bigint", True, 2),
                                 ("s", "t", "guest_email", "string", True, 3), ("s", "t", "note", "string", True, 4)],
                                "schema_name string, table_name string, column_name string, data_type string, "
                                "is_nullable boolean, ordinal_position int")
    ev = {(r.column_name, r.drift_type): r.severity for r in M.schema_diff(base, cur).collect()}
    assert ev == {("b", "type_changed"): "normal", ("c", "column_removed"): "normal",
                  ("guest_email", "column_added"): "high", ("note", "column_added"): "normal"}
    pending = M.schema_diff(base, cur)
    assert M.schema_diff(base, cur, pending).count() == 0        # still pending: not raised twice
    new_base = M.acknowledge(base, cur, spark.createDataFrame([("s", "t")], "schema_name string, table_name string"))
    assert M.schema_diff(new_base, cur).count() == 0              # gone after acknowledge


def test_root_cause_groups_to_deepest_ancestor(spark):
    edges = spark.createDataFrame(M.STAGE_EDGES, "titik_id int, depends_on_titik_id int")
    alerts = spark.createDataFrame(
        [("mart_cleaned", "dbt_test_failure", TEST_DATE), ("mart_aggregated", "warehouse_volume_anomaly", TEST_DATE),
         ("mart_aggregated", "dbt_test_failure", TEST_DATE), ("mart_cleaned", "serving_swap_slow", TEST_DATE)],
        "schema_name string, alert_type string, snapshot_date date")
    runs = spark.createDataFrame([(2, "transform", "failure", dt.datetime(2026, 8, 3, 1), "s2")],
                                 "titik_id int, workflow_name string, status string, started_at timestamp, "
                                 "step_name string")
    tests = spark.createDataFrame([], "layer string, test_name string, status string, captured_at timestamp")
    ev = M.stage_events(alerts, runs, tests, TEST_DATE)
    assert sorted({r.titik_id for r in ev.collect()}) == [2, 3, 6, 7, 9]
    rc = {r.titik_id: (r.root_titik_id, r.is_root) for r in M.root_cause(ev, edges).collect()}
    assert all(root == 2 for root, _ in rc.values())
    assert rc[2] == (2, True) and rc[7] == (2, False)


def test_parity_and_dependency_gap(spark):
    log = spark.createDataFrame(
        [("mart", "a", "synced", dt.datetime(2026, 8, 1)), ("mart", "a", "mismatch_aborted", dt.datetime(2026, 8, 2)),
         ("mart", "b", "mismatch_aborted", dt.datetime(2026, 8, 1)), ("mart", "b", "synced", dt.datetime(2026, 8, 2))],
        "dataset_name string, table_name string, status string, synced_at timestamp")
    assert [r.table_name for r in M.parity_mismatches(log).collect()] == ["a"]
    runs = spark.createDataFrame(
        [(1, "success", dt.datetime(2026, 8, 3, 1), dt.datetime(2026, 8, 3, 2)),
         (2, "success", dt.datetime(2026, 8, 3, 3), dt.datetime(2026, 8, 3, 4)),
         (3, "success", dt.datetime(2026, 8, 3, 3, 30), dt.datetime(2026, 8, 3, 5))],
        "titik_id int, status string, started_at timestamp, completed_at timestamp")
    edges = spark.createDataFrame(M.STAGE_EDGES, "titik_id int, depends_on_titik_id int")
    gaps = {(r.titik_id, r.depends_on_titik_id) for r in M.dependency_gaps(runs, edges, TEST_DATE).collect()}
    assert gaps == {(3, 2)}      # stage 3 started before stage 2 completed
    latest = {r.titik_id: r.ran_today for r in M.latest_run_per_stage(runs, TEST_DATE).collect()}
    assert latest == {1: True, 2: True, 3: True}


def test_orphans_and_rule_counts(spark):
    st = M.storage_snapshot(spark.createDataFrame(
        [("s", "a", TEST_DATE), ("s", "a__old", TEST_DATE), ("s", "b__old", TEST_DATE)],
        "schema_name string, table_name string, snapshot_date date"))
    a = M.orphan_alerts(st).collect()
    assert len(a) == 1 and a[0].orphan_count == 2 and a[0].detail == "s.a__old, s.b__old"


def test_dashboard_panels(spark):
    alerts = M.alert_rows(spark, [
        ("s", "a", "volume_anomaly", "critical", "x", TEST_DATE, dt.datetime(2026, 8, 3, 1), False),
        ("s", "b", "freshness_delay", "warning", "y", TEST_DATE, dt.datetime(2026, 8, 3, 2), False),
        ("s", "c", "volume_anomaly", "warning", "z", TEST_DATE - dt.timedelta(days=1), None, False)])
    act = M.panel_active_alerts(alerts, TEST_DATE).collect()
    assert [r.table_name for r in act] == ["a", "b"]
    assert [r.table_name for r in M.panel_volume_alerts(alerts).collect()] == ["a", "c"]
    dq = spark.createDataFrame([("s", "t", TEST_DATE, True), ("s", "t", TEST_DATE, False),
                                ("s", "t", TEST_DATE - dt.timedelta(days=1), False)],
                               "schema_name string, table_name string, run_date date, success boolean")
    r = M.panel_dq_last_run(dq).collect()
    assert (r[0].passed, r[0].failed) == (1, 1)
    assert M.panel_dq_failures(dq).count() == 1
    hist = spark.createDataFrame([("s", "t", "c", TEST_DATE - dt.timedelta(days=1), 5, 100),
                                  ("s", "t", "c", TEST_DATE, 7, 100)],
                                 "schema_name string, table_name string, column_name string, snapshot_date date, "
                                 "outlier_count long, row_count long")
    assert M.panel_latest_outlier(hist).first().outlier_pct == 7.0
    counts = M.alert_rule_counts(alerts, spark.createDataFrame([("pending",), ("acknowledged",)], "status string"),
                                 TEST_DATE).first()
    assert (counts.alerts_last_day, counts.pending_drift) == (2, 1)


def test_keyed_rolling_detectors(spark):
    base = dt.datetime(2026, 8, 1)
    sync = spark.createDataFrame(
        [("mart", "t", "synced", base + dt.timedelta(hours=h), float(900 + (h % 3) * 10)) for h in range(8)]
        + [("mart", "t", "synced", base + dt.timedelta(hours=9), 10518.7)],
        "dataset_name string, table_name string, status string, synced_at timestamp, swap_duration_ms double")
    last = M.swap_duration_anomaly(sync).orderBy(F.desc("synced_at")).first()
    assert last.severity == "critical" and last.history_points == 8
    conn = spark.createDataFrame([(base + dt.timedelta(minutes=5 * i), c) for i, c in
                                  enumerate([2, 3, 2, 3, 2, 3, 2, 3, 30])],
                                 "snapshot_time timestamp, active_connection_count int")
    assert M.connection_spike(conn).orderBy(F.desc("snapshot_time")).first().severity == "critical"
    runs = spark.createDataFrame([(5, base + dt.timedelta(days=i), d) for i, d in
                                  enumerate([60, 62, 61, 59, 60, 61, 600])],
                                 "titik_id int, started_at timestamp, duration_seconds int")
    assert M.sensor_duration_anomaly(runs).orderBy(F.desc("started_at")).first().severity == "critical"
    hist = spark.createDataFrame(
        [("raw", "t", TEST_DATE - dt.timedelta(weeks=i), 1000 + i, 1) for i in range(1, 9)]
        + [("raw", "t", TEST_DATE, 10000, 1)],
        "dataset_name string, table_name string, snapshot_date date, row_count long, day_of_week int")
    assert M.warehouse_volume_anomaly(hist).orderBy(F.desc("snapshot_date")).first().severity == "critical"


def test_dq_results_feed_the_panels(mart):
    res = mart["dq_results"]
    last = {(r.schema_name, r.table_name): (r.passed, r.failed) for r in M.panel_dq_last_run(res).collect()}
    assert len(last) == 23
    assert sum(f for _, f in last.values()) == res.where(~F.col("success")).count()
