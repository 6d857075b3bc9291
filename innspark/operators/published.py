"""Registered runs of the publishing operators (A6, A8, A10, A12) over the test tables:
what a reader of the store sees afterwards."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from innspark.operators.facts_reservation import _pace_sql
from innspark.plans import publish as P
from innspark.plans.registry import DEFAULT_AS_OF, Mart, model
from innspark.plans.storage import Store
from innspark.session import scratch_dir


def _base(m, name: str) -> str:
    return scratch_dir(m.spark, f"{name}-{uuid.uuid4().hex}")


@model("publish_partitioned_transactions", "ops", """SELECT *, cast(transaction_datetime AS date) AS partition_date
FROM fnb_transactions""", tags=("publish",))
def publish_partitioned_transactions(m):
    """The transactions, rewritten by day, as they are read back."""
    base = _base(m, "partitioned")
    P.partition_table(m["fnb_transactions"], "transaction_datetime", f"{base}/fnb_transactions")
    return Store(m.spark, base).read("fnb_transactions")


PACE_DAYS = tuple(DEFAULT_AS_OF + dt.timedelta(days=k) for k in range(3))


@model("publish_pace_history", "ops", "\nUNION ALL BY NAME\n".join(
    f"(SELECT * FROM ({_pace_sql(f'date {chr(39)}{d.isoformat()}{chr(39)}')}))" for d in PACE_DAYS), tags=("publish",))
def publish_pace_history(m):
    """Three days of booking pace appended to a history, the second one twice."""
    path = _base(m, "pace") + "/history"
    for day in (*PACE_DAYS, PACE_DAYS[1]):
        P.append_snapshot(Mart(m.spark, m.sf_dir, as_of=day)["fact_revenue_pace_booking_snapshot"], path)
    return m.spark.read.parquet(path)


@model("publish_gated_rooms", "ops", "SELECT room_type_id, room_type_name FROM dim_room_type", tags=("publish",))
def publish_gated_rooms(m):
    """A publish, then one whose gate fails on a planted null: the first one stays live."""
    base = _base(m, "gated")
    gate = P.not_null_gate({"dim_room_type": ["room_type_id"]})
    P.publish(m, ["dim_room_type"], base, gate=gate)
    broken = m.with_frame("dim_room_type", m["dim_room_type"].withColumn("room_type_id", F.lit(None).cast("bigint")))
    if P.publish(broken, ["dim_room_type"], base, gate=gate)["published"]:
        raise AssertionError("the gate let a null key through")
    return Store(m.spark, base).read("dim_room_type").select("room_type_id", "room_type_name")


@model("publish_export_log", "ops", """SELECT 'mart_aggregated' AS dataset_name, 'fact_spa_daily' AS table_name, s.status,
  r.n AS source_row_count, r.n - s.lost AS target_row_count, s.old_table_status
FROM (SELECT count(*) AS n FROM fact_spa_daily) r, (VALUES ('synced', 0, 'n/a'), ('mismatch_aborted', 1, NULL),
  ('synced', 0, 'kept')) AS s(status, lost, old_table_status)""", tags=("publish",))
def publish_export_log(m):
    """The sync log of an export, one whose writer loses a row, and one more."""
    at = dt.datetime.combine(m.as_of, dt.time(6, 0))
    df = m["fact_spa_daily"]
    path = _base(m, "export") + "/fact_spa_daily"
    first = df.orderBy("property_id", "period_date").select("property_id", "period_date").first()

    def lossy(to: str) -> None:
        df.where(~((F.col("property_id") == first[0]) & (F.col("period_date") == first[1]))).write.parquet(to)

    rows = [P.export_with_parity(df, path, "mart_aggregated", "fact_spa_daily", at, write=w) for w in (None, lossy, None)]
    return P.sync_log_rows(m.spark, rows).select("dataset_name", "table_name", "status", "source_row_count",
                                                 "target_row_count", "old_table_status")
