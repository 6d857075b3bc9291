"""Registered pipeline-observability queries (H14-H21) over logs of the test data.

The logs are shaped from ``events`` into the schemas that the operators of
``monitor`` expect: runs of the ten pipeline stages, table syncs, alerts and
connection samples. The operators do all of the work.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from innspark.functions import exprs as X
from innspark.operators import monitor as M
from innspark.plans.registry import model
from innspark.sources.fixtures import read_base

LOG_DATE = dt.date(2024, 1, 1)  # the first day of the logs
STAGES = 10  # of the pipeline

# log -> columns over ``events``, in SQL that Spark and DuckDB both accept
LOGS = {
    "log_runs": (
        f"cast(user_id % {STAGES} + 1 as int) AS titik_id", "event_type AS workflow_name", "ts AS started_at",
        "ts + cast(value as int) * interval '1' second AS completed_at",
        "case when event_type = 'error' then 'failure' else 'success' end AS status",
        "cast(floor(value) as bigint) AS duration_seconds"),
    "log_syncs": (
        "case when user_id % 2 = 0 then 'mart_cleaned' else 'mart_aggregated' end AS dataset_name",
        "'table_' || cast(user_id as string) AS table_name",
        "case when event_type = 'error' then 'mismatch_aborted' else 'synced' end AS status",
        "event_id AS source_row_count",
        "case when event_type = 'error' then event_id - 1 else event_id end AS target_row_count",
        "case when event_type = 'error' then null else round(value, 2) end AS swap_duration_ms", "ts AS synced_at"),
    "log_alerts": (
        "case event_type when 'error' then 'warehouse_volume_anomaly' when 'signup' then 'dbt_test_failure' "
        "when 'purchase' then 'serving_swap_slow' when 'click' then 'reverse_etl_mismatch' "
        "else 'ml_output_freshness_delay' end AS alert_type",
        "case user_id % 3 when 0 then 'raw_production' when 1 then 'mart_cleaned' else 'mart_aggregated' end "
        "AS schema_name",
        "case when value > 20 then 'critical' else 'warning' end AS severity",
        "'event ' || cast(event_id as string) AS detail", "event_id % 50 = 0 AS is_simulated", "ts AS created_at",
        "cast(ts as date) AS snapshot_date"),
    "log_tests": (
        "case user_id % 3 when 0 then 'mart_cleaned' when 1 then 'mart_aggregated' else 'source' end AS layer",
        "'test_' || cast(user_id as string) AS test_name",
        "case event_type when 'error' then 'fail' when 'click' then 'error' else 'pass' end AS status",
        "ts AS captured_at"),
}


def _log(name: str):
    columns = LOGS[name]
    model(name, "log", f"SELECT {', '.join(columns)} FROM events", tags=("log",))(
        lambda m: read_base(m.spark, m.sf_dir, "events").selectExpr(*columns))


for _name in LOGS:
    _log(_name)

_EDGES = ", ".join(f"({a}, {b})" for a, b in M.STAGE_EDGES)
_DAY = f"DATE '{LOG_DATE.isoformat()}'"


def _edges(m):
    return m.spark.createDataFrame(M.STAGE_EDGES, "titik_id int, depends_on_titik_id int")


@model("monitor_parity_mismatches", "ops", """SELECT dataset_name, table_name, source_row_count, target_row_count, synced_at
FROM (SELECT *, row_number() OVER (PARTITION BY dataset_name, table_name ORDER BY synced_at DESC) AS newest FROM log_syncs) s
WHERE newest = 1 AND status = 'mismatch_aborted'""", tags=("monitor",))
def monitor_parity_mismatches(m):
    """Tables whose latest sync aborted on a count mismatch."""
    return M.parity_mismatches(m["log_syncs"]).select(
        "dataset_name", "table_name", "source_row_count", "target_row_count", "synced_at")


@model("monitor_dependency_gaps", "ops", f"""SELECT s.titik_id, e.needs AS depends_on_titik_id, s.first_start
FROM (SELECT titik_id, min(started_at) AS first_start FROM log_runs WHERE cast(started_at AS date) = {_DAY}
      GROUP BY titik_id) s
JOIN (VALUES {_EDGES}) AS e(stage, needs) ON e.stage = s.titik_id
WHERE NOT EXISTS (SELECT 1 FROM log_runs r WHERE r.titik_id = e.needs AND r.status = 'success'
                  AND r.completed_at < s.first_start)""", tags=("monitor",))
def monitor_dependency_gaps(m):
    """Stages that started on the log's first day before a stage they need was done."""
    return M.dependency_gaps(m["log_runs"], _edges(m), LOG_DATE).select(
        "titik_id", "depends_on_titik_id", "first_start")


@model("monitor_latest_runs", "ops", f"""SELECT titik_id, r.workflow_name, r.started_at, r.status, r.duration_seconds,
  cast(r.started_at AS date) = {_DAY} AS ran_today
FROM (SELECT titik_id, max_by(x, started_at) AS r FROM log_runs x GROUP BY titik_id) latest""", tags=("monitor",))
def monitor_latest_runs(m):
    """The most recent run of every stage."""
    return M.latest_run_per_stage(m["log_runs"], LOG_DATE).select(
        "titik_id", "workflow_name", "started_at", "status", "duration_seconds", "ran_today")


_MAPPED = " ".join(f"WHEN alert_type = '{a}'" + (f" AND schema_name = '{s}'" if s else "") + f" THEN {k}"
                   for a, s, k in M.ALERT_STAGE)


@model("monitor_daily_stage_events", "ops", f"""SELECT * FROM (
  SELECT CASE {_MAPPED} END AS titik_id, 'alert' AS event_source, alert_type || ': ' || detail AS detail, severity,
    created_at AS event_at, is_simulated, snapshot_date AS event_date FROM log_alerts
  UNION ALL SELECT titik_id, 'pipeline_run', 'stage ' || cast(titik_id AS varchar) || ' failed: ' || workflow_name,
    'critical', started_at, false, cast(started_at AS date) FROM log_runs WHERE status = 'failure'
  UNION ALL SELECT CASE layer WHEN 'mart_cleaned' THEN 3 WHEN 'mart_aggregated' THEN 7 END, 'dbt_test', test_name,
    'critical', captured_at, false, cast(captured_at AS date) FROM log_tests
    WHERE status IN ('fail', 'error')) e WHERE titik_id IS NOT NULL""", tags=("monitor",))
def monitor_daily_stage_events(m):
    """H17 for every day: alerts, failed runs and failed tests by pipeline stage."""
    return M.daily_stage_events(m["log_alerts"], m["log_runs"], m["log_tests"])


@model("monitor_stage_events", "ops", f"""SELECT * EXCLUDE (event_date) FROM monitor_daily_stage_events
WHERE event_date = {_DAY}""", tags=("monitor",))
def monitor_stage_events(m):
    """The events of the log's first day."""
    return M.stage_events(m["log_alerts"], m["log_runs"], m["log_tests"], LOG_DATE)


@model("monitor_root_causes", "ops", f"""WITH RECURSIVE edge(stage, needs) AS (VALUES {_EDGES}),
hit AS (SELECT DISTINCT event_date, titik_id FROM monitor_daily_stage_events),
paths AS (
  SELECT event_date, titik_id, [titik_id] AS path FROM hit
  UNION ALL SELECT p.event_date, p.titik_id, list_append(p.path, edge.needs) FROM paths p
    JOIN edge ON edge.stage = p.path[-1] JOIN hit ON hit.titik_id = edge.needs AND hit.event_date = p.event_date),
longest AS (
  SELECT event_date, titik_id, path[-1] AS root, len(path) - 1 AS depth FROM paths
  QUALIFY row_number() OVER (PARTITION BY event_date, titik_id ORDER BY len(path) DESC, path[-1]) = 1)
SELECT event_date, titik_id, root AS root_titik_id, cast(depth AS int) AS depth, root = titik_id AS is_root
FROM longest""", tags=("monitor",))
def monitor_root_causes(m):
    """For each day, the deepest upstream stage with an event of every stage with
    one; all of the day's events count."""
    return M.root_cause(m["monitor_daily_stage_events"], _edges(m), by=("event_date",))


def _scores(df, *columns: str):
    return X.finish(df.select(*columns, "history_points", "z_score", "severity", "status", "baseline_mean",
                              "baseline_stdev"))


@model("monitor_sensor_duration", "ops", M.rolling_z_sql(
    "(SELECT * FROM log_runs WHERE titik_id = 5)", ["titik_id"], "started_at", "duration_seconds", M.VOLUME_WINDOW,
    "titik_id, started_at, duration_seconds"), tags=("monitor",))
def monitor_sensor_duration(m):
    """Run durations of the ML sensor stage against its previous runs."""
    out = M.sensor_duration_anomaly(m["log_runs"])
    return _scores(out.withColumn("duration_seconds", F.col("duration_seconds").cast("bigint")),
                   "titik_id", "started_at", "duration_seconds")


@model("monitor_swap_duration", "ops", M.rolling_z_sql(
    "(SELECT * FROM log_syncs WHERE swap_duration_ms IS NOT NULL)", ["dataset_name", "table_name"], "synced_at",
    "swap_duration_ms", M.VOLUME_WINDOW, "dataset_name, table_name, synced_at, swap_duration_ms", digits=2, scale=100),
       tags=("monitor",))
def monitor_swap_duration(m):
    """Swap durations of each table against its previous swaps."""
    return _scores(M.swap_duration_anomaly(m["log_syncs"]), "dataset_name", "table_name", "synced_at",
                   "swap_duration_ms")


_SAMPLES = """(SELECT 'serving' AS series, date_trunc('hour', started_at) AS snapshot_time,
  count(*) AS active_connection_count FROM log_runs GROUP BY 1, 2)"""


@model("monitor_connection_spike", "ops", M.rolling_z_sql(
    _SAMPLES, ["series"], "snapshot_time", "active_connection_count", M.VOLUME_WINDOW,
    "snapshot_time, active_connection_count"), tags=("monitor",))
def monitor_connection_spike(m):
    """Runs started in each hour, as connection samples, against the samples before."""
    samples = m["log_runs"].groupBy(F.date_trunc("hour", "started_at").cast("timestamp_ntz").alias("snapshot_time")
                                    ).agg(F.count(F.lit(1)).alias("active_connection_count"))
    return _scores(M.connection_spike(samples), "snapshot_time", "active_connection_count")


# ---------------------------------------------------------------------------
# Dashboard panels over the logs (a panel's limit is its feature)
# ---------------------------------------------------------------------------
def _alerts(m):
    """The alert log in its own schema (H32): the series is the alert's table."""
    return m["log_alerts"].select("schema_name", F.col("alert_type").alias("table_name"), "alert_type", "severity",
                                  "detail", "snapshot_date", F.col("created_at").alias("triggered_at"), "is_simulated")


@model("monitor_panel_active_alerts", "ops", f"""SELECT schema_name, alert_type AS table_name, alert_type, severity, detail,
  snapshot_date, created_at AS triggered_at, is_simulated,
  cast(CASE severity WHEN 'critical' THEN 1 WHEN 'warning' THEN 2 ELSE 3 END AS bigint) AS priority
FROM log_alerts WHERE snapshot_date = {_DAY} ORDER BY priority, triggered_at DESC, table_name LIMIT 50""",
       tags=("monitor",))
def monitor_panel_active_alerts(m):
    return X.finish(M.panel_active_alerts(_alerts(m), LOG_DATE))


@model("monitor_panel_alerts_by_root", "ops", """SELECT c.root_titik_id, count(*) AS event_count
FROM monitor_daily_stage_events e JOIN monitor_root_causes c USING (event_date, titik_id) GROUP BY c.root_titik_id""",
       tags=("monitor",))
def monitor_panel_alerts_by_root(m):
    """Events of all days by the root cause of their stage on that day."""
    roots = m["monitor_root_causes"].select("event_date", "titik_id", "root_titik_id")
    return X.finish(M.panel_alerts_by_root(m["monitor_daily_stage_events"].join(roots, ["event_date", "titik_id"])))


@model("monitor_panel_stage_status", "ops", """SELECT titik_id, status, started_at, ran_today FROM monitor_latest_runs""",
       tags=("monitor",))
def monitor_panel_stage_status(m):
    return M.panel_stage_status(m["log_runs"], LOG_DATE)


@model("monitor_panel_gate_last_run", "ops", """SELECT t.layer, t.captured_at,
  cast(count_if(t.status = 'pass') AS bigint) AS passed, cast(count_if(t.status <> 'pass') AS bigint) AS failed
FROM log_tests t WHERE NOT EXISTS (SELECT 1 FROM log_tests n WHERE n.layer = t.layer AND n.captured_at > t.captured_at)
GROUP BY ALL""", tags=("monitor",))
def monitor_panel_gate_last_run(m):
    return M.panel_gate_last_run(m["log_tests"])


@model("monitor_panel_swap_top", "ops", """SELECT dataset_name, table_name, swap_duration_ms FROM log_syncs
ORDER BY swap_duration_ms DESC NULLS LAST, table_name, dataset_name LIMIT 30""", tags=("monitor",))
def monitor_panel_swap_top(m):
    """The slowest swaps."""
    return M.panel_swap_top(m["log_syncs"]).select("dataset_name", "table_name", "swap_duration_ms")


@model("monitor_alert_rule_counts", "ops", f"""SELECT
  (SELECT count(*) FROM log_alerts WHERE snapshot_date = {_DAY}) AS alerts_last_day,
  (SELECT count(*) FROM monitor_schema_drift WHERE status = 'pending') AS pending_drift""", tags=("monitor",))
def monitor_alert_rule_counts(m):
    """What the two alert rules count."""
    return M.alert_rule_counts(_alerts(m), m["monitor_schema_drift"], LOG_DATE)
