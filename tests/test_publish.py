import datetime as dt

import pytest
from pyspark.sql import functions as F

from innspark.plans import publish as P
from innspark.plans import storage
from innspark.plans.storage import Store
from innspark.sources.extract import ExtractSpec, cursors, run_extract

NOW = dt.datetime(2026, 8, 3, 6, 0)


def live(spark, base, name):
    return Store(spark, base).read(name)


def test_gated_publish_blocks_planted_failure(mart, tmp_base):
    names = ["dim_room_type", "dim_channel"]
    ok = P.publish(mart, names, tmp_base, gate=P.not_null_gate({"dim_room_type": ["room_type_id"]}))
    assert ok["published"] == names
    rows = live(mart.spark, tmp_base, "dim_room_type").count()
    # plant a failure: a gate column that is null in every staged row
    planted = P.not_null_gate({"dim_channel": ["channel_name"], "dim_room_type": ["room_type_id"]})

    def bad_gate(staged):
        staged = dict(staged)
        staged["dim_channel"] = staged["dim_channel"].withColumn("channel_name", F.lit(None).cast("string"))
        return planted(staged)
    res = P.publish(mart, names, tmp_base, gate=bad_gate)
    assert res["published"] == [] and res["failed_checks"] == 1
    assert live(mart.spark, tmp_base, "dim_room_type").count() == rows   # live untouched


def test_select_exclude_and_ml_isolation():
    facts = P.select_models(["fact_*"])
    assert "fact_revenue_room_type_daily" in facts
    assert "fact_ml_occupancy_forecast_property_room_type" in facts  # explicitly selected by glob
    core = P.select_models()
    assert "fact_ml_occupancy_forecast_property_room_type" not in core
    assert "dim_room" not in P.select_models(exclude=["dim_room*"])
    assert P.select_models(["tag:ml"]) == ["fact_ml_occupancy_forecast_property_room_type"]


def test_export_parity_swap_and_abort(mart, tmp_base):
    spark = mart.spark
    df = mart["dim_channel"]
    path, served = f"{tmp_base}/serving/dim_channel", lambda: live(spark, f"{tmp_base}/serving", "dim_channel")
    r1 = P.export_with_parity(df, path, "mart_aggregated", "dim_channel", NOW)
    assert r1["status"] == "synced" and r1["source_row_count"] == r1["target_row_count"]
    r2 = P.export_with_parity(df, path, "mart_aggregated", "dim_channel", NOW)
    assert r2["status"] == "synced" and r2["old_table_status"] == "kept"
    before = served().count()

    def lossy(path):  # a writer that drops a row: parity must abort the swap
        df.limit(max(before - 1, 0)).write.mode("overwrite").parquet(path)
    r3 = P.export_with_parity(df, path, "mart_aggregated", "dim_channel", NOW, write=lossy)
    assert r3["status"] == "mismatch_aborted"
    assert served().count() == before
    # the aborted copy is gone; the first one waits for its readers
    assert len(Store(spark, f"{tmp_base}/serving").unused()) == 1
    log = P.sync_log_rows(spark, [r1, r2, r3])
    assert log.where(F.col("status") == "mismatch_aborted").count() == 1


def test_snapshot_append_is_idempotent_per_day(mart, tmp_base):
    from innspark.plans.registry import Mart
    path = f"{tmp_base}/pace"
    for day in (dt.date(1998, 8, 2), dt.date(1998, 8, 3), dt.date(1998, 8, 3)):
        P.append_snapshot(Mart(mart.spark, mart.sf_dir, as_of=day)["fact_revenue_pace_booking_snapshot"], path)
    hist = mart.spark.read.parquet(path)
    per_day = {r.snapshot_date: r.n for r in hist.groupBy("snapshot_date").agg(F.count("*").alias("n")).collect()}
    one = Mart(mart.spark, mart.sf_dir, as_of=dt.date(1998, 8, 3))["fact_revenue_pace_booking_snapshot"].count()
    assert per_day[dt.date(1998, 8, 3)] == one      # re-run replaced, not duplicated
    assert set(per_day) == {dt.date(1998, 8, 2), dt.date(1998, 8, 3)}


def test_incremental_extract_strict_and_overlap(spark, tmp_base):
    spec, store = ExtractSpec("reservation_revenue", "bookings", "booking_id", key="booking_id"), Store(spark, tmp_base)
    src1 = spark.createDataFrame([("BK01", 1), ("BK02", 2)], "booking_id string, v int")
    assert run_extract(store, src1, spec, NOW) == {"table": "bookings", "rows": 2, "mode": "overwrite", "cursor": "BK02"}
    src2 = spark.createDataFrame([("BK01", 1), ("BK02", 2), ("BK03", 3)], "booking_id string, v int")
    r = run_extract(store, src2, spec, NOW)
    assert r["rows"] == 1 and r["mode"] == "append" and r["cursor"] == "BK03"
    version = store.manifest()["version"]
    assert run_extract(store, src2, spec, NOW)["rows"] == 0
    assert store.manifest()["version"] == version            # nothing new: nothing committed
    assert store.read("bookings").count() == 3
    # a late row with an equal cursor value: strict '>' misses it, overlap catches it once
    dspec = ExtractSpec("s", "events", "d", key="id")
    e1 = spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "id int, d date")
    run_extract(store, e1, dspec, NOW)
    e2 = e1.unionByName(spark.createDataFrame([(3, dt.date(2024, 1, 2))], "id int, d date"))
    assert run_extract(store, e2, dspec, NOW)["rows"] == 0
    assert run_extract(store, e2, dspec, NOW, overlap=True)["rows"] == 1
    assert run_extract(store, e2, dspec, NOW, overlap=True)["rows"] == 0
    got = {(r.schema_name, r.table_name, r.last_cursor) for r in cursors(store).collect()}
    assert got == {("reservation_revenue", "bookings", "BK03"), ("s", "events", "2024-01-02")}


def test_partition_table_and_serving_layout(mart, tmp_base):
    path = f"{tmp_base}/fnb_tx"
    P.partition_table(mart["fnb_transactions"], "transaction_datetime", path)
    df = live(mart.spark, tmp_base, "fnb_tx")
    assert "partition_date" in df.columns and df.count() == mart["fnb_transactions"].count()
    lay = P.serving_layout(mart["fact_fnb_outlet_daily"], "outlet_id", "period_date", partitions=4)
    assert lay.rdd.getNumPartitions() <= 4 and lay.count() == mart["fact_fnb_outlet_daily"].count()


def test_read_run_results(spark, tmp_base):
    import json
    import os
    import tempfile
    doc = {"results": [{"unique_id": "test.hotel.not_null_bookings_booking_id.abc", "status": "pass",
                        "execution_time": 0.5, "failures": 0},
                       {"unique_id": "test.hotel.unique_guests_guest_id.def", "status": "fail",
                        "execution_time": 1.5, "failures": 3}]}
    d = tempfile.mkdtemp(prefix="innspark-rr-", dir="/tmp")
    p = os.path.join(d, "run_results.json")
    with open(p, "w") as fh:
        json.dump(doc, fh)
    rows = P.read_run_results(spark, p, "mart_cleaned", NOW).collect()
    assert [(r.test_name, r.status, r.failures) for r in rows] == [
        ("not_null_bookings_booking_id", "pass", 0), ("unique_guests_guest_id", "fail", 3)]


def test_views_read_published_tables(mart, tmp_base):
    from innspark.plans.registry import Mart
    names = ["dim_property", "dim_room_type", "fact_revenue_room_type_daily"]
    assert P.publish(mart, names, tmp_base)["published"] == names
    served = Mart(mart.spark, mart.sf_dir, published=tmp_base)
    files = served["v_revenue_room_type_daily"].inputFiles()
    assert any("data/fact_revenue_room_type_daily" in f for f in files)
    assert not any(f.endswith("orders.parquet") for f in files)
    a = sorted(tuple(r) for r in served["v_revenue_room_type_daily"].collect())
    b = sorted(tuple(r) for r in mart["v_revenue_room_type_daily"].collect())
    assert a == b


def test_declared_mart_tests(mart):
    from innspark.operators import dq
    tests = dq.mart_tests(["fact_revenue_room_type_daily", "fact_fnb_outlet_daily"])
    kinds = {(t.model, t.kind, t.column) for t in tests}
    assert ("fact_revenue_room_type_daily", "relationships", "property_id") in kinds
    assert ("fact_fnb_outlet_daily", "relationships", "outlet_id") in kinds
    res = {(r.model, r.test, r.detail): r.failures for r in dq.run_mart_tests(mart, tests).collect()}
    nulls = mart["fact_fnb_outlet_daily"].where(F.col("outlet_id").isNull()).count()
    assert res[("fact_fnb_outlet_daily", "not_null", "outlet_id")] == nulls
    assert res[("fact_fnb_outlet_daily", "relationships", "outlet_id -> dim_outlet.outlet_id")] == 0


def test_a_failed_commit_leaves_the_published_version(mart, tmp_base, monkeypatch):
    names = ["dim_property", "dim_room_type", "fact_revenue_room_type_daily"]
    assert P.publish(mart, names, tmp_base)["version"] == 1
    before = {n: sorted(map(str, live(mart.spark, tmp_base, n).collect())) for n in names}

    def failing(*_args):
        raise OSError("planted")

    real = storage._write_new
    monkeypatch.setattr(storage, "_write_new", failing)
    changed = mart.with_frame("dim_property", mart["dim_property"].limit(2))
    with pytest.raises(OSError):
        P.publish(changed, names, tmp_base)
    monkeypatch.setattr(storage, "_write_new", real)
    after = {n: sorted(map(str, live(mart.spark, tmp_base, n).collect())) for n in names}
    assert after == before


def test_a_subset_takes_the_ids_of_live_dimensions(mart, tmp_base):
    P.publish(mart, ["dim_room_type"], tmp_base)
    types = live(mart.spark, tmp_base, "dim_room_type")
    wanted = {r.room_type_id + 100 for r in types.collect()}
    Store(mart.spark, tmp_base).replace(types.withColumn("room_type_id", F.col("room_type_id") + 100), "dim_room_type")
    P.publish(mart, ["fact_revenue_room_type_daily"], tmp_base)
    ids = live(mart.spark, tmp_base, "fact_revenue_room_type_daily").select("room_type_id").distinct()
    assert {r[0] for r in ids.collect()} <= wanted


def test_export_by_table_and_domain():
    assert len(P.export_tables()) == 23 + 27 + 50
    assert P.export_tables("dim_room") == {"dim_room": "mart_aggregated"}
    assert set(P.export_tables(domain="fnb")) >= {"fact_fnb_outlet_daily", "fact_fnb_waste_daily"}
    with pytest.raises(KeyError):
        P.export_tables("no_such_table")


def test_reliable_shared_inputs_cut_lineage(spark):
    from innspark.plans.registry import Mart
    m = Mart(spark, "/root/testdata/sf0.001").persist_shared(("bookings",), reliable=True)
    plan = m["bookings"]._jdf.queryExecution().optimizedPlan().toString()
    assert "orders" not in plan                      # reads the checkpoint, not the source
    assert m["fact_revenue_channel_daily"].count() > 0


def test_ml_readiness(mart):
    from innspark.operators import ml
    preds = mart["ml_predictions"]
    at = ml.default_scored_at(mart.as_of)
    assert ml.is_ready(preds, ml.MODEL_NAME, at + dt.timedelta(minutes=30))
    assert not ml.is_ready(preds, ml.MODEL_NAME, at + dt.timedelta(minutes=120))
    assert not ml.is_ready(preds, "other_model", at)


def test_publish_mart_with_rule_gate(spark, tmp_base):
    from innspark.plans.registry import Mart
    m = Mart(spark, "/root/testdata/sf0.001")
    res = P.publish_mart(m, tmp_base, select=["dim_property", "dim_event_type", "tag:spa_event"])
    # the spa facts and their dimensions pass the grain and key tests, so all are published
    assert res["failed_checks"] == 0 and "fact_spa_daily" in res["published"]
    assert live(spark, tmp_base, "fact_spa_daily").count() == m["fact_spa_daily"].count()


def test_export_serving_layout_and_parity(mart, tmp_base):
    log = P.export_serving(mart, f"{tmp_base}/serving", NOW, tables=["fact_spa_daily", "staff_shifts"])
    rows = {r.table_name: r for r in log.collect()}
    assert {r.status for r in rows.values()} == {"synced"}
    assert rows["staff_shifts"].dataset_name == "mart_cleaned"
    served = live(mart.spark, f"{tmp_base}/serving", "fact_spa_daily")
    assert served.count() == rows["fact_spa_daily"].source_row_count


def test_register_and_analyze_published(mart, tmp_base):
    import uuid
    names = ["dim_room_type", "dim_channel"]
    P.publish(mart, names, tmp_base)
    db = f"mart_{uuid.uuid4().hex[:6]}"
    tables = P.register_published(mart.spark, tmp_base, names, database=db)
    stats = mart.spark.sql(f"DESCRIBE TABLE EXTENDED {tables[0]}").where("col_name = 'Statistics'").first()
    assert stats is not None and "rows" in stats.data_type
    assert mart.spark.table(tables[0]).count() == mart["dim_room_type"].count()
    Store(mart.spark, tmp_base).replace(mart["dim_room_type"].limit(1), "dim_room_type")
    P.register_published(mart.spark, tmp_base, names, database=db)  # moves on to the new version
    assert mart.spark.table(tables[0]).count() == 1
    mart.spark.sql(f"DROP DATABASE {db} CASCADE")
