"""Monitoring, profiling and anomaly detection.

Every detector is one set-based query over all series at once: snapshots are
aggregations, baselines are window frames partitioned by series (a series
holds one row per snapshot day, never raw rows), and alerts are filters.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innspark.functions import exprs as X
from innspark.plans.registry import DEFAULT_AS_OF, model

# Monitored tables with their freshness signal and cadence.
# (schema, table, priority, freshness column, column kind, cadence)
MON_TABLES = [
    ("corporate_master", "properties", "Sedang", None, None, None),
    ("corporate_master", "employees", "Tinggi", "hire_date", "text_ddmmyyyy_mixed", "daily"),
    ("corporate_master", "guests", "Tinggi", "registered_date", "date", "daily"),
    ("corporate_master", "role_permissions", "Tinggi", None, None, None),
    ("reservation_revenue", "bookings", "Tinggi", "booking_date", "date", "daily"),
    ("reservation_revenue", "daily_occupancy", "Sedang", "date", "date", "daily"),
    ("reservation_revenue", "pricing_history", "Sedang", "date", "date", "daily"),
    ("fnb_operations", "fnb_outlets", "Rendah", None, None, None),
    ("fnb_operations", "recipe_bom", "Sedang", None, None, None),
    ("fnb_operations", "ingredient_price_history", "Sedang", "date", "date", "daily"),
    ("fnb_operations", "fnb_transactions", "Tinggi", "transaction_datetime", "date", "daily"),
    ("fnb_operations", "fnb_waste_log", "Sedang", "date", "date", "daily"),
    ("fnb_operations", "fnb_inventory", "Rendah", None, None, None),
    ("facility_maintenance", "rooms", "Sedang", None, None, None),
    ("facility_maintenance", "housekeeping_log", "Sedang", "date", "date", "daily"),
    ("facility_maintenance", "maintenance_tickets", "Sedang", "reported_date", "date", "daily"),
    ("spa_event", "venues", "Rendah", None, None, None),
    ("spa_event", "spa_bookings", "Sedang", "booking_date", "date", "daily"),
    ("spa_event", "event_bookings", "Sedang", None, None, None),
    ("hr_finance", "staff_shifts", "Tinggi", "date", "date", "daily"),
    ("hr_finance", "employee_performance", "Rendah", "review_period", "text_period_semester", "semesterly"),
    ("hr_finance", "payroll", "Tinggi", "period", "text_period_month", "monthly"),
    ("hr_finance", "financial_summary", "Sedang", "period", "text_period_month", "monthly"),
]
# Freshness thresholds (warning, critical) in hours per cadence.
FRESHNESS_THRESHOLDS_HOURS = {"daily": (48, 96), "monthly": (45 * 24, 60 * 24), "semesterly": (200 * 24, 220 * 24)}
# Detector constants.
VOLUME_WINDOW = 8
DRIFT_WINDOW = 12
MIN_HISTORY_POINTS = 3
WARNING_SIGMA = 2
CRITICAL_SIGMA = 3
BOOTSTRAP_RELATIVE_TOLERANCE = 0.5
IQR_K = 1.5
# Dirty-by-design columns (schema, table, column, predicate, bootstrap %).
DIRTY_COLUMNS = [
    ("corporate_master", "guests", "email", "email IS NULL OR email = ''", 4.0),
    ("corporate_master", "guests", "phone", "phone IS NULL OR phone = ''", 3.0),
    ("corporate_master", "employees", "role_title", "role_title IS NULL OR role_title = ''", 2.0),
    ("corporate_master", "employees", "department",
     "department NOT IN ('Housekeeping','F&B','Revenue','Spa&Event','Facility','HR','Finance','Corporate')", 2.65),
    ("fnb_operations", "fnb_transactions", "guest_id", "guest_id IS NULL OR guest_id = ''", 31.0),
    ("spa_event", "spa_bookings", "guest_id", "guest_id IS NULL OR guest_id = ''", 21.0),
    ("facility_maintenance", "maintenance_tickets", "room_id", "room_id IS NULL OR room_id = ''", 28.0),
    ("facility_maintenance", "maintenance_tickets", "parts_replaced", "parts_replaced IS NULL OR parts_replaced = ''",
     52.0),
]
# Business value columns watched with Tukey fences (schema, table, column, row filter).
VALUE_COLUMNS = [
    ("reservation_revenue", "bookings", "total_amount", "status IN ('completed','confirmed')"),
    ("fnb_operations", "fnb_transactions", "total_price", None),
    ("facility_maintenance", "maintenance_tickets", "cost", None),
    ("hr_finance", "payroll", "net_salary", None),
    ("spa_event", "spa_bookings", "price", "status IN ('completed','confirmed')"),
    ("spa_event", "event_bookings", "total_revenue", "status IN ('completed','confirmed')"),
]

_AS_OF = DEFAULT_AS_OF.isoformat()


def _union(parts):
    return X.union_all(parts)


def _dow(c):
    """Day of week with Sunday = 0."""
    return (F.dayofweek(c) - 1).cast("int")


# ---------------------------------------------------------------------------
# H1 volume snapshot / H13 layered volume
# ---------------------------------------------------------------------------
def volume_snapshot(t, snapshot_date: dt.date, tables=MON_TABLES, prefix="src_") -> DataFrame:
    d = F.lit(snapshot_date)
    return _union([t[f"{prefix}{tb}"].agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(sc).alias("schema_name"), F.lit(tb).alias("table_name"), d.alias("snapshot_date"),
        "row_count", _dow(d).alias("day_of_week")) for sc, tb, *_ in tables])


def layer_volume(t, layers: dict[str, list[str]], snapshot_date: dt.date) -> DataFrame:
    """Row counts of every table of every layer. A table's layers are counted at once,
    sharing their shuffles, one table after another (``exprs.union_apart``)."""
    d = F.lit(snapshot_date)
    places: dict[str, list] = {}
    for layer, names in layers.items():
        for name in names:
            places.setdefault(name.removeprefix("src_"), []).append((layer, name))
    return X.union_apart(_union([t[name].agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(layer).alias("dataset_name"), F.lit(name).alias("table_name"), d.alias("snapshot_date"),
        "row_count", _dow(d).alias("day_of_week")) for layer, name in of]) for of in places.values())


@model("monitor_volume_snapshot", "ops", "\nUNION ALL\n".join(
    f"SELECT '{sc}' AS schema_name, '{tb}' AS table_name, DATE '{_AS_OF}' AS snapshot_date, count(*) AS row_count, "
    f"cast(dayofweek(DATE '{_AS_OF}') AS bigint) AS day_of_week FROM src_{tb}" for sc, tb, *_ in MON_TABLES),
    tags=("monitor",))
def monitor_volume_snapshot(m):
    return X.finish(volume_snapshot(m, m.as_of))


# ---------------------------------------------------------------------------
# H2 freshness snapshot, H5 freshness alerts
# ---------------------------------------------------------------------------
def _latest_signal(df: DataFrame, column: str, kind: str) -> DataFrame:
    c = F.col(column)
    if kind == "date":
        return df.agg(F.max(c).cast("timestamp_ntz").alias("latest_value"))
    if kind == "text_ddmmyyyy_mixed":
        parsed = X.parse_mixed_date(F.trim(c))
        return df.where(c.isNotNull() & (c != "")).agg(F.max(parsed).cast("timestamp_ntz").alias("latest_value"))
    top = df.where(c.isNotNull()).agg(F.max(c).alias("__p"))
    if kind == "text_period_month":
        return top.select(F.last_day(F.to_date("__p", "yyyy-MM")).cast("timestamp_ntz").alias("latest_value"))
    if kind == "text_period_semester":
        y = F.substring("__p", 1, 4).cast("int")
        end = F.when(F.substring("__p", 6, 2) == "S1", F.make_date(y, F.lit(6), F.lit(30))) \
            .otherwise(F.make_date(y, F.lit(12), F.lit(31)))
        return top.select(end.cast("timestamp_ntz").alias("latest_value"))
    raise ValueError(kind)


def freshness_snapshot(t, snapshot_date: dt.date, now: dt.datetime, tables=MON_TABLES, prefix="src_"):
    parts = []
    now_s = F.lit(now).cast("timestamp_ntz").cast("timestamp").cast("long")
    for sc, tb, _prio, colname, kind, _cad in tables:
        if colname is None:
            continue
        sig = _latest_signal(t[f"{prefix}{tb}"], colname, kind)
        lag = X.dround((now_s - F.col("latest_value").cast("timestamp").cast("long")) / 3600.0, 1)
        parts.append(sig.select(F.lit(sc).alias("schema_name"), F.lit(tb).alias("table_name"),
                                F.lit(snapshot_date).alias("snapshot_date"), F.lit(colname).alias("freshness_column"),
                                "latest_value", lag.alias("lag_hours")))
    return _union(parts)


def _fresh_sql(sc, tb, colname, kind):
    if kind == "date":
        latest = f"cast(max({colname}) AS timestamp)"
        src = f"src_{tb}"
    elif kind == "text_ddmmyyyy_mixed":
        latest = (f"cast(max(CASE WHEN trim({colname}) LIKE '%/%' THEN cast(strptime(trim({colname}), '%d/%m/%Y') AS date)"
                  f" ELSE cast(strptime(trim({colname}), '%Y-%m-%d') AS date) END) AS timestamp)")
        src = f"src_{tb} WHERE {colname} IS NOT NULL AND {colname} != ''"
    elif kind == "text_period_month":
        latest = f"cast(last_day(cast(strptime(max({colname}), '%Y-%m') AS date)) AS timestamp)"
        src = f"src_{tb}"
    else:
        latest = (f"cast(CASE WHEN substr(max({colname}), 6, 2) = 'S1' THEN make_date(cast(substr(max({colname}), 1, 4) "
                  f"AS int), 6, 30) ELSE make_date(cast(substr(max({colname}), 1, 4) AS int), 12, 31) END AS timestamp)")
        src = f"src_{tb}"
    return (f"SELECT '{sc}' AS schema_name, '{tb}' AS table_name, DATE '{_AS_OF}' AS snapshot_date, "
            f"'{colname}' AS freshness_column, {latest} AS latest_value, "
            f"round((epoch(TIMESTAMP '{_AS_OF} 00:00:00') - epoch({latest})) / 3600.0, 1) AS lag_hours FROM {src}")


FRESHNESS_SQL = "\nUNION ALL\n".join(_fresh_sql(sc, tb, c, k) for sc, tb, _p, c, k, _cd in MON_TABLES if c)


def _now(m):
    return dt.datetime.combine(m.as_of, dt.time(0, 0))


@model("monitor_freshness_snapshot", "ops", FRESHNESS_SQL, tags=("monitor",))
def monitor_freshness_snapshot(m):
    return freshness_snapshot(m, m.as_of, _now(m))


def thresholds_frame(spark) -> DataFrame:
    rows = [(k, float(w), float(c)) for k, (w, c) in FRESHNESS_THRESHOLDS_HOURS.items()]
    return spark.createDataFrame(rows, "cadence string, warning_h double, critical_h double")


def freshness_alerts(snap: DataFrame, spark, tables=MON_TABLES) -> DataFrame:
    """H5: lag against the cadence's (warning, critical) hour thresholds."""
    cad = spark.createDataFrame([(tb, cd) for _s, tb, _p, _c, _k, cd in tables if cd],
                                "table_name string, cadence string")
    j = snap.join(F.broadcast(cad), "table_name").join(F.broadcast(thresholds_frame(spark)), "cadence")
    sev = (F.when(F.col("lag_hours") >= F.col("critical_h"), "critical")
           .when(F.col("lag_hours") >= F.col("warning_h"), "warning"))
    return (j.withColumn("severity", sev).where(F.col("severity").isNotNull())
            .select("schema_name", "table_name", F.lit("freshness").alias("alert_type"), "severity",
                    F.concat(F.lit("lag "), F.col("lag_hours").cast("string"), F.lit("h >= "),
                             F.when(F.col("severity") == "critical", F.col("critical_h"))
                             .otherwise(F.col("warning_h")).cast("string"), F.lit("h")).alias("detail"),
                    "snapshot_date"))


_CAD_VALUES = ", ".join(f"('{tb}', '{cd}')" for _s, tb, _p, _c, _k, cd in MON_TABLES if cd)
_THR_VALUES = ", ".join(f"('{k}', {float(w)}, {float(c)})" for k, (w, c) in FRESHNESS_THRESHOLDS_HOURS.items())


@model("monitor_freshness_alerts", "ops", f"""WITH j AS (
  SELECT s.*, th.warning_h, th.critical_h,
    CASE WHEN s.lag_hours >= th.critical_h THEN 'critical' WHEN s.lag_hours >= th.warning_h THEN 'warning' END AS severity
  FROM monitor_freshness_snapshot s
  JOIN (VALUES {_CAD_VALUES}) AS c(table_name, cadence) ON s.table_name = c.table_name
  JOIN (VALUES {_THR_VALUES}) AS th(cadence, warning_h, critical_h) ON c.cadence = th.cadence)
SELECT schema_name, table_name, 'freshness' AS alert_type, severity,
  'lag ' || cast(lag_hours AS varchar) || 'h >= ' ||
    cast(CASE WHEN severity = 'critical' THEN critical_h ELSE warning_h END AS varchar) || 'h' AS detail,
  snapshot_date
FROM j WHERE severity IS NOT NULL""", tags=("monitor",))
def monitor_freshness_alerts(m):
    return freshness_alerts(m["monitor_freshness_snapshot"], m.spark)


# ---------------------------------------------------------------------------
# Generic rolling detectors
# ---------------------------------------------------------------------------
def rolling_z(df: DataFrame, keys: list[str], order: str, value: str, n: int,
              min_points: int = MIN_HISTORY_POINTS, warn: float = WARNING_SIGMA,
              crit: float = CRITICAL_SIGMA, digits: int = 1, scale: int = 1) -> DataFrame:
    """Score each point against the ``n`` points before it in its series:
    population stddev (0 -> 1e-9), |z| >= crit critical, >= warn warning,
    fewer than ``min_points`` -> insufficient_history.

    Values are fixed-point (``value * scale`` is integral: counts, or
    percentages with two decimals), so the frame sums are exact decimals and
    mean/variance come from sum, sum of squares and count — the same bits on
    every engine and every partitioning, so threshold decisions never flip on
    floating-point summation order."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-n, -1)
    xi = F.round(F.col(value) * scale).cast("decimal(38,0)")
    out = (df.withColumn("__x", xi)
           .withColumn("__s1", F.sum("__x").over(w)).withColumn("__s2", F.sum(F.col("__x") * F.col("__x")).over(w))
           .withColumn("history_points", F.count("__x").over(w)))
    cnt = F.col("history_points")
    mean = F.col("__s1").cast("double") / cnt
    var = (cnt * F.col("__s2") - F.col("__s1") * F.col("__s1")).cast("double") / (cnt * cnt)
    out = out.withColumn("__mean", mean).withColumn("__sd", F.sqrt(var))
    sd_eff = F.when(F.coalesce(F.col("__sd"), F.lit(0.0)) == 0, F.lit(1e-9 * scale)).otherwise(F.col("__sd"))
    z = (F.col("__x").cast("double") - F.col("__mean")) / sd_eff
    enough = cnt >= min_points
    shift = digits - (len(str(scale)) - 1)
    return (out.withColumn("z_score", F.when(enough, X.dround(z, 2)))
            .withColumn("severity", F.when(enough & (F.abs(z) >= crit), "critical")
                        .when(enough & (F.abs(z) >= warn), "warning"))
            .withColumn("status", F.when(enough, "evaluated").otherwise("insufficient_history"))
            .withColumn("baseline_mean", F.when(enough, X.dround("__mean", shift) / scale))
            .withColumn("baseline_stdev", F.when(enough, X.dround(sd_eff, shift) / scale))
            .drop("__x", "__s1", "__s2", "__mean", "__sd"))


BLOCK_ROWS = 50_000


def rolling_z_blocks(df: DataFrame, keys: list[str], order: str, value: str, n: int,
                     block_rows: int = BLOCK_ROWS, **options) -> DataFrame:
    """``rolling_z`` over raw rows, of which one series may hold any share.

    Rows are numbered within their series (``exprs.numbered_rows``) and windowed in
    blocks of ``block_rows`` consecutive ones; the last ``n`` of a block are also the
    halo of the next block, whose frames they complete, and are dropped there. A task's
    largest group is a block and its halo, however long the series."""
    rows = X.numbered_rows(df, keys, order)
    own = F.floor(F.col("__pos") / block_rows)
    last = F.pmod(F.col("__pos"), F.lit(block_rows)) >= block_rows - n
    rows = (rows.withColumn("__own", own)
            .withColumn("__block", F.explode(F.when(last, F.array("__own", F.col("__own") + 1))
                                             .otherwise(F.array("__own")))))
    scored = rolling_z(rows, [*keys, "__block"], "__pos", value, min(n, block_rows), **options)
    return scored.where("__block = __own").drop("__block", "__own", "__pos")


def rolling_z_sql(src: str, keys: list[str], order: str, value: str, n: int, cols: str, digits: int = 1,
                  scale: int = 1) -> str:
    part = ", ".join(keys)
    w = f"OVER (PARTITION BY {part} ORDER BY {order} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    shift = digits - (len(str(scale)) - 1)
    return f"""WITH a AS (SELECT *, cast(round({value} * {scale}) AS DECIMAL(38,0)) AS xi FROM {src}),
b AS (SELECT *, sum(xi) {w} AS s1, sum(xi * xi) {w} AS s2, count(xi) {w} AS history_points FROM a),
c AS (SELECT *, cast(s1 AS double) / history_points AS mu,
  sqrt(cast(history_points * s2 - s1 * s1 AS double) / (history_points * history_points)) AS sd0,
  history_points >= {MIN_HISTORY_POINTS} AS ok FROM b),
d AS (SELECT *, CASE WHEN coalesce(sd0, 0) = 0 THEN {1e-9 * scale} ELSE sd0 END AS sd FROM c),
z AS (SELECT *, (cast(xi AS double) - mu) / sd AS zz FROM d)
SELECT {cols}, history_points,
  CASE WHEN ok THEN round(zz, 2) END AS z_score,
  CASE WHEN ok AND abs(zz) >= {CRITICAL_SIGMA} THEN 'critical' WHEN ok AND abs(zz) >= {WARNING_SIGMA} THEN 'warning' END AS severity,
  CASE WHEN ok THEN 'evaluated' ELSE 'insufficient_history' END AS status,
  CASE WHEN ok THEN round(mu, {shift}) / {scale} END AS baseline_mean,
  CASE WHEN ok THEN round(sd, {shift}) / {scale} END AS baseline_stdev
FROM z"""


# daily volume series of the dated tables: the row count per business day
DATED_TABLES = [(sc, tb, c) for sc, tb, _p, c, k, _cd in MON_TABLES if k == "date"]


def daily_volume(t, tables=DATED_TABLES, prefix="src_") -> DataFrame:
    return _union([t[f"{prefix}{tb}"].groupBy(F.to_date(c).alias("snapshot_date"))
                   .agg(F.count(F.lit(1)).alias("row_count"))
                   .select(F.lit(sc).alias("schema_name"), F.lit(tb).alias("table_name"), "snapshot_date",
                           "row_count", _dow(F.col("snapshot_date")).alias("day_of_week"))
                   for sc, tb, c in tables])


DAILY_VOLUME_SQL = "\nUNION ALL\n".join(
    f"SELECT '{sc}' AS schema_name, '{tb}' AS table_name, cast({c} AS date) AS snapshot_date, count(*) AS row_count, "
    f"cast(dayofweek(cast({c} AS date)) AS bigint) AS day_of_week FROM src_{tb} GROUP BY 3"
    for sc, tb, c in DATED_TABLES)


@model("monitor_daily_volume", "ops", DAILY_VOLUME_SQL, tags=("monitor",))
def monitor_daily_volume(m):
    return X.finish(daily_volume(m))


@model("monitor_volume_anomaly", "ops", rolling_z_sql(
    "monitor_daily_volume", ["schema_name", "table_name", "day_of_week"], "snapshot_date", "row_count",
    VOLUME_WINDOW, "schema_name, table_name, snapshot_date, day_of_week, row_count"), tags=("monitor",))
def monitor_volume_anomaly(m):
    """H4: each day's volume against the previous 8 same-weekday days."""
    return X.finish(rolling_z(m["monitor_daily_volume"], ["schema_name", "table_name", "day_of_week"],
                              "snapshot_date", "row_count", VOLUME_WINDOW))


# ---------------------------------------------------------------------------
# H3 current status
# ---------------------------------------------------------------------------
def current_status(volume: DataFrame, fresh: DataFrame) -> DataFrame:
    keys = ["schema_name", "table_name"]
    latest = volume.groupBy(*keys).agg(
        F.max("snapshot_date").alias("as_of_date"),
        F.max_by("row_count", "snapshot_date").alias("rows_today"),
        F.max_by("day_of_week", "snapshot_date").alias("__dow"))
    hist = volume.select(*keys, F.col("snapshot_date").alias("__d"), F.col("day_of_week").alias("__hd"),
                         F.col("row_count").alias("__rc"))
    base = (latest.join(hist, keys, "left")
            .where(F.col("__d").isNull() | ((F.col("__hd") == F.col("__dow")) & (F.col("__d") < F.col("as_of_date"))))
            .groupBy(*keys).agg(X.dround(F.avg("__rc"), 1).alias("baseline_mean"),
                                X.dround(F.stddev_pop("__rc"), 1).alias("baseline_stdev"),
                                F.count("__rc").alias("baseline_points")))
    lf = fresh.groupBy(*keys).agg(F.max_by("freshness_column", "snapshot_date").alias("freshness_column"),
                                  F.max_by("latest_value", "snapshot_date").alias("last_data_event_at"),
                                  F.max_by("lag_hours", "snapshot_date").alias("freshness_lag_hours"))
    out = latest.join(base, keys, "left").join(lf, keys, "left")
    pct = F.when((F.col("baseline_points") >= 3) & (F.col("baseline_mean") > 0),
                 X.dround((F.col("rows_today") - F.col("baseline_mean")) / F.col("baseline_mean") * 100, 1))
    return out.select(*keys, "as_of_date", "rows_today", "baseline_mean", "baseline_stdev",
                      F.coalesce("baseline_points", F.lit(0)).alias("baseline_points"),
                      pct.alias("pct_diff_from_baseline"),
                      F.when(F.coalesce("baseline_points", F.lit(0)) < 3, "insufficient_history")
                      .otherwise("ok").alias("baseline_status"),
                      "freshness_column", "last_data_event_at", "freshness_lag_hours")


@model("monitor_current_status", "ops", """WITH lv AS (
  SELECT schema_name, table_name, max(snapshot_date) AS as_of_date, arg_max(row_count, snapshot_date) AS rows_today,
    arg_max(day_of_week, snapshot_date) AS dow FROM monitor_daily_volume GROUP BY 1, 2),
b AS (SELECT lv.schema_name, lv.table_name, round(avg(h.row_count), 1) AS baseline_mean,
    round(stddev_pop(h.row_count), 1) AS baseline_stdev, count(h.row_count) AS baseline_points
  FROM lv LEFT JOIN monitor_daily_volume h ON h.schema_name = lv.schema_name AND h.table_name = lv.table_name
    AND h.day_of_week = lv.dow AND h.snapshot_date < lv.as_of_date GROUP BY 1, 2),
lf AS (SELECT schema_name, table_name, arg_max(freshness_column, snapshot_date) AS freshness_column,
    arg_max(latest_value, snapshot_date) AS last_data_event_at, arg_max(lag_hours, snapshot_date) AS freshness_lag_hours
  FROM monitor_freshness_snapshot GROUP BY 1, 2)
SELECT lv.schema_name, lv.table_name, lv.as_of_date, lv.rows_today, b.baseline_mean, b.baseline_stdev,
  coalesce(b.baseline_points, 0) AS baseline_points,
  CASE WHEN b.baseline_points >= 3 AND b.baseline_mean > 0
    THEN round((lv.rows_today - b.baseline_mean) / b.baseline_mean * 100, 1) END AS pct_diff_from_baseline,
  CASE WHEN coalesce(b.baseline_points, 0) < 3 THEN 'insufficient_history' ELSE 'ok' END AS baseline_status,
  lf.freshness_column, lf.last_data_event_at, lf.freshness_lag_hours
FROM lv LEFT JOIN b ON b.schema_name = lv.schema_name AND b.table_name = lv.table_name
LEFT JOIN lf ON lf.schema_name = lv.schema_name AND lf.table_name = lv.table_name""", tags=("monitor",))
def monitor_current_status(m):
    return X.finish(current_status(m["monitor_daily_volume"], m["monitor_freshness_snapshot"]))


# ---------------------------------------------------------------------------
# H6 dirty proportion, H7 dirty drift
# ---------------------------------------------------------------------------
def dirty_proportion(t, snapshot_date, columns=DIRTY_COLUMNS, prefix="src_") -> DataFrame:
    by_table: dict[tuple, list] = {}
    for sc, tb, c, pred, _b in columns:
        by_table.setdefault((sc, tb), []).append((c, pred))
    parts = []
    for (sc, tb), cols in by_table.items():
        one = t[f"{prefix}{tb}"].agg(F.count(F.lit(1)).alias("__n"),
                                     *[F.count_if(F.expr(p)).alias(f"__d{i}") for i, (_c, p) in enumerate(cols)])
        rows = [F.struct(F.lit(c).alias("column_name"), F.col("__n").alias("total_rows"),
                         F.col(f"__d{i}").alias("dirty_rows")) for i, (c, _p) in enumerate(cols)]
        parts.append(one.select(F.lit(sc).alias("schema_name"), F.lit(tb).alias("table_name"),
                                F.inline(F.array(*rows))))
    out = _union(parts)
    return out.select("schema_name", "table_name", "column_name", F.lit(snapshot_date).alias("snapshot_date"),
                      "total_rows", "dirty_rows",
                      X.dround(F.when(F.col("total_rows") > 0, F.col("dirty_rows") * 100.0 / F.col("total_rows"))
                              .otherwise(0.0), 2).alias("dirty_pct"))


@model("monitor_dirty_proportion", "ops", "\nUNION ALL\n".join(
    f"SELECT '{sc}' AS schema_name, '{tb}' AS table_name, '{c}' AS column_name, DATE '{_AS_OF}' AS snapshot_date, "
    f"count(*) AS total_rows, cast(count_if({p}) AS bigint) AS dirty_rows, "
    f"round(CASE WHEN count(*) > 0 THEN count_if({p}) * 100.0 / count(*) ELSE 0.0 END, 2) AS dirty_pct FROM src_{tb}"
    for sc, tb, c, p, _b in DIRTY_COLUMNS), tags=("monitor",))
def monitor_dirty_proportion(m):
    return dirty_proportion(m, m.as_of)


def drift_with_bootstrap(history: DataFrame, keys: list[str], order: str, value: str, bootstrap: DataFrame,
                         n: int = DRIFT_WINDOW) -> DataFrame:
    """H7: rolling z over the previous ``n`` snapshots; while fewer than 3
    exist, a +-50 % band around the bootstrap value (warning only)."""
    z = rolling_z(history, keys, order, value, n, digits=2, scale=100)
    z = z.join(F.broadcast(bootstrap), keys, "left")
    lo = F.col("bootstrap_pct") * (1 - BOOTSTRAP_RELATIVE_TOLERANCE)
    hi = F.col("bootstrap_pct") * (1 + BOOTSTRAP_RELATIVE_TOLERANCE)
    boot = F.col("status") == "insufficient_history"
    return (z.withColumn("mode", F.when(boot, "bootstrap").otherwise("rolling"))
            .withColumn("severity", F.when(boot, F.when((F.col(value) < lo) | (F.col(value) > hi), "warning"))
                        .otherwise(F.col("severity"))))


# daily dirty share of the dated dirty columns (a series derived from the data)
DIRTY_DAILY = [("corporate_master", "guests", "email", "registered_date"),
               ("corporate_master", "guests", "phone", "registered_date"),
               ("fnb_operations", "fnb_transactions", "guest_id", "transaction_datetime"),
               ("spa_event", "spa_bookings", "guest_id", "booking_date"),
               ("facility_maintenance", "maintenance_tickets", "room_id", "reported_date"),
               ("facility_maintenance", "maintenance_tickets", "parts_replaced", "reported_date")]


def _dirty_pred(tb, c):
    return next(p for _s, t2, c2, p, _b in DIRTY_COLUMNS if t2 == tb and c2 == c)


def _bootstrap(tb, c):
    return next(b for _s, t2, c2, _p, b in DIRTY_COLUMNS if t2 == tb and c2 == c)


def daily_dirty(t, series=DIRTY_DAILY, prefix="src_") -> DataFrame:
    return _union([t[f"{prefix}{tb}"].groupBy(F.to_date(dcol).alias("snapshot_date"))
                   .agg(X.dround(F.count_if(F.expr(_dirty_pred(tb, c))) * 100.0 / F.count(F.lit(1)), 2)
                        .alias("dirty_pct"))
                   .select(F.lit(sc).alias("schema_name"), F.lit(tb).alias("table_name"),
                           F.lit(c).alias("column_name"), "snapshot_date", "dirty_pct")
                   for sc, tb, c, dcol in series])


_DD_SQL = "\nUNION ALL\n".join(
    f"SELECT '{sc}' AS schema_name, '{tb}' AS table_name, '{c}' AS column_name, cast({d} AS date) AS snapshot_date, "
    f"round(count_if({_dirty_pred(tb, c)}) * 100.0 / count(*), 2) AS dirty_pct FROM src_{tb} GROUP BY 4"
    for sc, tb, c, d in DIRTY_DAILY)
_BOOT_VALUES = ", ".join(f"('{sc}', '{tb}', '{c}', cast({_bootstrap(tb, c)} AS double))"
                        for sc, tb, c, _d in DIRTY_DAILY)


@model("monitor_dirty_drift", "ops", f"""WITH h AS ({_DD_SQL}),
r AS ({rolling_z_sql('h', ['schema_name', 'table_name', 'column_name'], 'snapshot_date', 'dirty_pct', DRIFT_WINDOW,
                     'schema_name, table_name, column_name, snapshot_date, dirty_pct', digits=2, scale=100)})
SELECT r.schema_name, r.table_name, r.column_name, r.snapshot_date, r.dirty_pct, r.history_points, r.z_score,
  CASE WHEN r.status = 'insufficient_history' THEN
    CASE WHEN r.dirty_pct < bt.b * {1 - BOOTSTRAP_RELATIVE_TOLERANCE} OR r.dirty_pct > bt.b * {1 + BOOTSTRAP_RELATIVE_TOLERANCE}
      THEN 'warning' END ELSE r.severity END AS severity,
  r.status, r.baseline_mean, r.baseline_stdev, bt.b AS bootstrap_pct,
  CASE WHEN r.status = 'insufficient_history' THEN 'bootstrap' ELSE 'rolling' END AS mode
FROM r LEFT JOIN (VALUES {_BOOT_VALUES}) AS bt(schema_name, table_name, column_name, b)
  ON r.schema_name = bt.schema_name AND r.table_name = bt.table_name AND r.column_name = bt.column_name""",
       tags=("monitor",))
def monitor_dirty_drift(m):
    boot = m.spark.createDataFrame([(sc, tb, c, float(_bootstrap(tb, c))) for sc, tb, c, _d in DIRTY_DAILY],
                                   "schema_name string, table_name string, column_name string, bootstrap_pct double")
    keys = ["schema_name", "table_name", "column_name"]
    return X.finish(drift_with_bootstrap(daily_dirty(m), keys, "snapshot_date", "dirty_pct", boot))


# ---------------------------------------------------------------------------
# H8 value anomaly (Tukey fences), H9 outlier-share drift
# ---------------------------------------------------------------------------
def value_anomaly(t, snapshot_date, columns=VALUE_COLUMNS, prefix="src_") -> DataFrame:
    """Exact interpolated quartiles and the values outside q1 - k*iqr .. q3 + k*iqr.

    All columns are counted by value in one pass each and ranged together; the
    quartiles and, from the same counts, the outliers follow without another scan
    of the tables."""
    keys = ["schema_name", "table_name", "column_name"]
    parts = []
    for sc, tb, c, flt in columns:
        df = t[f"{prefix}{tb}"]
        df = df.where(flt) if flt else df
        parts.append(df.select(F.lit(sc).alias("schema_name"), F.lit(tb).alias("table_name"),
                               F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")))
    values = X.union_all(parts)
    rows = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))  # nulls count as rows
    counted = X.counted_values(values, keys, "v")
    q = X.percentiles_of(counted, keys, [0.25, 0.5, 0.75]).select(
        *keys, *[F.col("percentiles")[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))])
    q = (q.withColumn("iqr", F.col("q3") - F.col("q1"))
         .withColumn("lower_fence", F.col("q1") - IQR_K * F.col("iqr"))
         .withColumn("upper_fence", F.col("q3") + IQR_K * F.col("iqr")))
    outside = counted.join(q, keys).where((F.col("value") < F.col("lower_fence"))
                                          | (F.col("value") > F.col("upper_fence")))
    outliers = outside.groupBy(*keys).agg(F.sum("n").alias("outlier_count"))
    # a column without rows still has its line
    all_columns = t.spark.createDataFrame([c[:3] for c in columns], ", ".join(f"{k} string" for k in keys))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return (all_columns.join(q, keys, "left").join(rows, keys, "left").join(outliers, keys, "left")
            .select(*keys, F.lit(snapshot_date).alias("snapshot_date"), "q1", "median", "q3", "iqr", "lower_fence",
                    "upper_fence", zero("outlier_count"), zero("row_count")))


def _value_sql(sc, tb, c, flt):
    """One line of the snapshot, from the sorted values themselves."""
    keep = f" WHERE {flt}" if flt else ""
    return f"""SELECT '{sc}' AS schema_name, '{tb}' AS table_name, '{c}' AS column_name,
  DATE '{_AS_OF}' AS snapshot_date, f.q1, f.median, f.q3, f.iqr, f.low AS lower_fence, f.high AS upper_fence,
  cast(count_if(v.x < f.low OR v.x > f.high) AS bigint) AS outlier_count, cast(count(v.present) AS bigint) AS row_count
FROM (SELECT q[1] AS q1, q[2] AS median, q[3] AS q3, q[3] - q[1] AS iqr, q[1] - {IQR_K} * (q[3] - q[1]) AS low,
        q[3] + {IQR_K} * (q[3] - q[1]) AS high
      FROM (SELECT quantile_cont(cast({c} AS double), [0.25, 0.5, 0.75]) AS q FROM src_{tb}{keep}) a) f
LEFT JOIN (SELECT cast({c} AS double) AS x, 1 AS present FROM src_{tb}{keep}) v ON true
GROUP BY f.q1, f.median, f.q3, f.iqr, f.low, f.high"""


@model("monitor_value_anomaly", "ops", "\nUNION ALL\n".join(_value_sql(*v) for v in VALUE_COLUMNS), tags=("monitor",))
def monitor_value_anomaly(m):
    return X.finish(value_anomaly(m, m.as_of))


def outlier_drift(history: DataFrame, n: int = DRIFT_WINDOW) -> DataFrame:
    """H9: outlier share of each snapshot against the previous ``n`` snapshots."""
    h = history.where(F.col("row_count") > 0).withColumn(
        "outlier_pct", F.col("outlier_count") * 100.0 / F.col("row_count"))
    h = h.withColumn("outlier_pct", X.dround("outlier_pct", 3))
    return rolling_z(h, ["schema_name", "table_name", "column_name"], "snapshot_date", "outlier_pct", n, digits=3,
                     scale=1000)


# ---------------------------------------------------------------------------
# H10/H11 schema drift against an approved baseline
# ---------------------------------------------------------------------------
# Column-name fragments that make a schema change high severity.
SENSITIVE_KEYWORDS = [
    "password", "passwd", "secret", "token", "api_key", "apikey", "credential",
    "nik", "ktp", "passport", "paspor", "ssn", "ssn_", "national_id",
    "email", "phone", "telepon", "no_hp", "hp_number", "whatsapp",
    "salary", "gaji", "credit_card", "kartu_kredit", "rekening", "bank_account", "account_number", "iban", "cvv", "pin",
    "medical", "kesehatan", "diagnosis",
]


def schema_frame(spark, schema_name: str, table_name: str, df: DataFrame) -> DataFrame:
    """Column metadata of a DataFrame (name, type, nullability, position)."""
    rows = [(schema_name, table_name, f.name, f.dataType.simpleString(), f.nullable, i + 1)
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "schema_name string, table_name string, column_name string, "
                                       "data_type string, is_nullable boolean, ordinal_position int")


def schema_diff(baseline: DataFrame, current: DataFrame, pending: DataFrame | None = None) -> DataFrame:
    """Added / removed / type-changed columns vs the approved baseline; events
    already pending are not raised twice; sensitive names are high severity."""
    keys = ["schema_name", "table_name", "column_name"]
    b = baseline.select(*keys, F.col("data_type").alias("__bt"))
    c = current.select(*keys, F.col("data_type").alias("__ct"))
    j = b.join(c, keys, "full_outer")
    kind = (F.when(F.col("__bt").isNull(), "column_added").when(F.col("__ct").isNull(), "column_removed")
            .when(F.col("__bt") != F.col("__ct"), "type_changed"))
    sens = reduce(lambda a, k: a | F.lower("column_name").contains(k), SENSITIVE_KEYWORDS, F.lit(False))
    ev = (j.withColumn("drift_type", kind).where(F.col("drift_type").isNotNull())
          .select(*keys, "drift_type",
                  F.concat_ws(" -> ", F.coalesce("__bt", F.lit("(none)")), F.coalesce("__ct", F.lit("(none)")))
                  .alias("detail"),
                  F.when(sens, "high").otherwise("normal").alias("severity"),
                  F.lit("pending").alias("status")))
    if pending is not None:
        ev = ev.join(pending.where(F.col("status") == "pending").select(*keys, "drift_type"),
                     keys + ["drift_type"], "left_anti")
    return ev


def acknowledge(baseline: DataFrame, current: DataFrame, tables: DataFrame) -> DataFrame:
    """The new approved baseline — current columns for acknowledged tables,
    the old baseline for every other table (idempotent)."""
    keys = ["schema_name", "table_name"]
    keep = baseline.join(tables.select(*keys), keys, "left_anti")
    return keep.unionByName(current.join(tables.select(*keys), keys, "left_semi"))


# ---------------------------------------------------------------------------
# H12 column profiling
# ---------------------------------------------------------------------------
def profile(df: DataFrame, table_name: str, exact_distinct: bool = True) -> DataFrame:
    """Scalar stats of every column in ONE aggregation; distinct values, case-variant
    groups per text column and full-row duplicates as grouped counts.

    The rows are dealt out first, since a small file, one split, may hold many of them;
    an entry is one column's value, so that a task groups narrow rows."""
    from pyspark.sql import types as T
    df = df.repartition(F.xxhash64(*df.columns))
    n = F.count(F.lit(1))
    aggs, rows = [n.alias("__n")], []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f.name)
        aggs.append(F.count_if(c.isNull()).alias(f"__nul{i}"))
        if not exact_distinct:
            aggs.append(F.approx_count_distinct(c).alias(f"__dis{i}"))
        is_text = isinstance(f.dataType, T.StringType)
        is_num = isinstance(f.dataType, (T.IntegerType, T.LongType, T.DoubleType, T.DecimalType, T.ShortType))
        aggs.append(F.count_if(c != F.trim(c)).alias(f"__ws{i}") if is_text else F.lit(None).cast("long")
                    .alias(f"__ws{i}"))
        aggs.append(F.min(c).cast("string").alias(f"__min{i}") if not isinstance(f.dataType, T.BooleanType)
                    else F.lit(None).cast("string").alias(f"__min{i}"))
        aggs.append(F.max(c).cast("string").alias(f"__max{i}") if not isinstance(f.dataType, T.BooleanType)
                    else F.lit(None).cast("string").alias(f"__max{i}"))
        aggs.append(F.count_if(c < 0).alias(f"__neg{i}") if is_num else F.lit(None).cast("long").alias(f"__neg{i}"))
        rows.append(F.struct(F.lit(f.name).alias("column_name"),
                             X.dround(F.col(f"__nul{i}") * 100.0 / F.col("__n"), 2).alias("null_pct"),
                             (F.lit(None) if exact_distinct else F.col(f"__dis{i}")).cast("long").alias("distinct_count"),
                             F.col(f"__ws{i}").alias("whitespace_count"),
                             F.col(f"__min{i}").alias("min_value"), F.col(f"__max{i}").alias("max_value"),
                             F.col(f"__neg{i}").alias("negative_count")))
    scalar = df.agg(*aggs).select(F.lit(table_name).alias("table_name"), F.col("__n").alias("row_count"),
                                  F.inline(F.array(*rows)))
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    counted = df.columns if exact_distinct else text_cols
    out = scalar
    if counted:
        # values that are equal are equal as text too (a zero has no sign)
        text = lambda f: (F.col(f.name) + 0 if isinstance(f.dataType, (T.DoubleType, T.FloatType))
                          else F.col(f.name)).cast("string")
        entries = df.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column_name"), text(df.schema[c]).alias("value")) for c in counted])))
        by_value = entries.where("value IS NOT NULL").groupBy("column_name", "value").agg(F.lit(1).alias("one"))
        by_fold = by_value.groupBy("column_name", F.lower(F.trim("value")).alias("fold")).agg(
            F.count(F.lit(1)).alias("values"))
        by_column = by_fold.groupBy("column_name").agg(
            F.sum("values").alias("__distinct"), F.count_if(F.col("values") > 1).alias("__variants"))
        out = out.join(by_column, "column_name", "left")
    else:
        out = out.select("*", *[F.lit(None).cast("long").alias(c) for c in ("__distinct", "__variants")])
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    variants = F.when(F.col("column_name").isin(text_cols), zero("__variants")) if text_cols else F.lit(None).cast("long")
    out = out.select("column_name", *[c for c in scalar.columns if c not in ("column_name", "distinct_count")],
                     zero("__distinct").alias("distinct_count") if exact_distinct else "distinct_count",
                     variants.alias("case_variant_groups"))
    out = out.select("column_name", *[c for c in scalar.columns if c != "column_name"], "case_variant_groups")
    dups = (df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__c")).where("__c > 1")
            .agg(F.count(F.lit(1))))  # groups of equal rows
    return out.withColumn("duplicate_rows", dups.scalar())


def profile_sql(src: str, table_name: str, columns: list[tuple[str, str]]) -> str:
    """DuckDB text of ``profile(..., exact_distinct=True)`` for (column, kind)
    pairs, kind in text / number / other."""
    allc = ", ".join(c for c, _ in columns)
    dup = (f"(SELECT count(*) AS dup FROM (SELECT count(*) AS k FROM {src} "
           f"GROUP BY {allc} HAVING count(*) > 1) d) dd")
    parts = []
    for c, kind in columns:
        ws = f"count_if({c} != trim({c}))" if kind == "text" else "cast(NULL AS bigint)"
        neg = f"count_if({c} < 0)" if kind == "number" else "cast(NULL AS bigint)"
        cv = (f"(SELECT count(*) AS cv FROM (SELECT lower(trim({c})) AS k FROM {src} WHERE {c} IS NOT NULL "
              f"GROUP BY 1 HAVING count(DISTINCT {c}) > 1) g) cc" if kind == "text"
              else "(SELECT cast(NULL AS bigint) AS cv) cc")
        parts.append(
            f"SELECT '{table_name}' AS table_name, s.n AS row_count, '{c}' AS column_name, "
            f"round(cast(s.nul AS double) * 100.0 / s.n, 2) AS null_pct, s.dist AS distinct_count, "
            f"s.ws AS whitespace_count, s.mn AS min_value, s.mx AS max_value, s.neg AS negative_count, "
            f"cc.cv AS case_variant_groups, dd.dup AS duplicate_rows FROM "
            f"(SELECT count(*) AS n, count_if({c} IS NULL) AS nul, count(DISTINCT {c}) AS dist, {ws} AS ws, "
            f"cast(min({c}) AS varchar) AS mn, cast(max({c}) AS varchar) AS mx, {neg} AS neg FROM {src}) s, "
            f"{cv}, {dup}")
    return "\nUNION ALL\n".join(parts)


# the raw guest table's columns and their kinds (adapter schema)
_GUEST_PROFILE = [("guest_id", "text"), ("full_name", "text"), ("email", "text"), ("phone", "text"),
                  ("nationality", "text"), ("loyalty_tier", "text"), ("registered_date", "other")]


@model("monitor_profile_guests", "ops", profile_sql("src_guests", "guests", _GUEST_PROFILE), tags=("monitor",))
def monitor_profile_guests(m):
    """H12 on the raw guest table (duplicates and case variants kept on
    purpose), with exact distinct counts as in the reference; pass
    ``exact_distinct=False`` for HyperLogLog counts on very large tables."""
    return X.finish(profile(m["src_guests"], "guests", exact_distinct=True))


# ---------------------------------------------------------------------------
# H14-H18 pipeline observability over run/sync logs and the stage DAG
# ---------------------------------------------------------------------------
def parity_mismatches(sync_log: DataFrame) -> DataFrame:
    """The latest sync of each table, where it aborted on a count mismatch."""
    keys = ["dataset_name", "table_name"]
    latest = sync_log.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in sync_log.columns if c not in keys]),
                                                  "synced_at").alias("__l"))
    return latest.select(*keys, "__l.*").where(F.col("status") == "mismatch_aborted")


def dependency_gaps(run_log: DataFrame, edges: DataFrame, run_date) -> DataFrame:
    """A stage that started on ``run_date`` without a successful run of
    each stage it depends on completing before that start."""
    today = run_log.where(F.to_date("started_at") == F.lit(run_date))
    starts = today.groupBy("titik_id").agg(F.min("started_at").alias("first_start"))
    need = starts.join(edges.select("titik_id", "depends_on_titik_id"), "titik_id")
    ok = run_log.where(F.col("status") == "success").select(
        F.col("titik_id").alias("depends_on_titik_id"), F.col("completed_at").alias("__done"))
    satisfied = need.join(ok, "depends_on_titik_id").where(F.col("__done") < F.col("first_start")) \
        .select("titik_id", "depends_on_titik_id").distinct()
    return need.join(satisfied, ["titik_id", "depends_on_titik_id"], "left_anti")


def latest_run_per_stage(run_log: DataFrame, run_date) -> DataFrame:
    """Most recent run of every stage and whether it ran on ``run_date``."""
    latest = run_log.groupBy("titik_id").agg(F.max_by(F.struct(*[c for c in run_log.columns if c != "titik_id"]),
                                                      "started_at").alias("__l"))
    return (latest.select("titik_id", "__l.*")
            .withColumn("ran_today", F.to_date("started_at") == F.lit(run_date)))


# Fixed values: (alert type, schema or None for any, pipeline stage it belongs to).
ALERT_STAGE = [
    ("warehouse_volume_anomaly", "raw_production", 1), ("warehouse_volume_anomaly", "mart_cleaned", 2),
    ("warehouse_volume_anomaly", "mart_aggregated", 6), ("dbt_test_failure", "mart_cleaned", 3),
    ("dbt_test_failure", "mart_aggregated", 7), ("ml_output_incomplete_scoring", None, 4),
    ("ml_output_freshness_delay", None, 5), ("serving_swap_slow", "mart_aggregated", 8),
    ("serving_swap_slow", "mart_cleaned", 9), ("reverse_etl_mismatch", None, 10),
    ("serving_swap_orphan_table", None, 10), ("pipeline_dependency_gap", None, 1),
]
# The stage dependency edges (stage, depends on).
STAGE_EDGES = [(2, 1), (3, 2), (4, 2), (5, 4), (6, 2), (6, 5), (7, 6), (8, 6), (9, 2), (10, 8), (10, 9)]


def stage_of_alert():
    m = None
    for a, sch, st in ALERT_STAGE:
        cond = F.col("alert_type") == a
        if sch is not None:
            cond = cond & (F.col("schema_name") == sch)
        m = F.when(cond, st) if m is None else m.when(cond, st)
    return m


def stage_events(alerts: DataFrame, runs: DataFrame, tests: DataFrame, as_of) -> DataFrame:
    """The day's events per stage (``daily_stage_events`` of that day)."""
    return daily_stage_events(alerts, runs, tests).where(F.col("event_date") == F.lit(as_of)).drop("event_date")


def daily_stage_events(alerts: DataFrame, runs: DataFrame, tests: DataFrame) -> DataFrame:
    """Events of every day per stage: mapped alerts, failed runs, failed tests, each
    with its day, severity, time, detail and whether it was simulated. Logs without these
    columns give nulls (a failure is critical and not simulated)."""
    def own(df: DataFrame, column: str, kind: str) -> F.Column:
        return F.col(column) if column in df.columns else F.lit(None).cast(kind)

    says = F.col("alert_type")
    if "detail" in alerts.columns:
        says = F.concat(says, F.lit(": "), F.col("detail"))
    a = alerts.select(
        stage_of_alert().alias("titik_id"), F.lit("alert").alias("event_source"), says.alias("detail"),
        own(alerts, "severity", "string").alias("severity"),
        own(alerts, "created_at", "timestamp_ntz").alias("event_at"),
        own(alerts, "is_simulated", "boolean").alias("is_simulated"),
        F.col("snapshot_date").cast("date").alias("event_date"))
    failed = [F.lit("critical").alias("severity")]
    r = runs.where(F.col("status") == "failure").select(
        "titik_id", F.lit("pipeline_run").alias("event_source"),
        F.concat(F.lit("stage "), F.col("titik_id").cast("string"), F.lit(" failed: "), F.col("workflow_name"))
        .alias("detail"), *failed, F.col("started_at").alias("event_at"), F.lit(False).alias("is_simulated"),
        F.to_date("started_at").alias("event_date"))
    t = tests.where(F.col("status").isin("fail", "error")).select(
        F.when(F.col("layer") == "mart_cleaned", 3).when(F.col("layer") == "mart_aggregated", 7).alias("titik_id"),
        F.lit("dbt_test").alias("event_source"), F.col("test_name").alias("detail"), *failed,
        F.col("captured_at").alias("event_at"), F.lit(False).alias("is_simulated"),
        F.to_date("captured_at").alias("event_date"))
    return a.unionByName(r).unionByName(t).where(F.col("titik_id").isNotNull())


def root_cause(events: DataFrame, edges: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """For every stage with an event, climb to upstream stages that also
    have an event; the deepest such ancestor is the root (ties: smallest id). With ``by``
    (e.g. the event's day) each of its values is a climb of its own.

    Events are first reduced to the distinct stages of each ``by`` value. The climb joins
    the frontier with the edges until it is empty, however deep the graph; a frontier
    that outlives the number of edges is a cycle and raises, naming where."""
    by = list(by)
    ev = events.select(*by, "titik_id").distinct().checkpoint()
    e = (edges.select(F.col("titik_id").alias("cur"), F.col("depends_on_titik_id").alias("__up"))
         .join(ev.withColumnRenamed("titik_id", "__up"), "__up"))
    longest = edges.count()
    frontier = ev.select(*by, F.col("titik_id").alias("start"), F.col("titik_id").alias("cur"),
                         F.lit(0).alias("depth"))
    reach, depth = frontier, 0
    while not (step := X.null_safe_join(frontier, e, [*by, "cur"], "inner").select(
            *by, "start", F.col("__up").alias("cur"), (F.col("depth") + 1).alias("depth")).distinct()
            .checkpoint()).isEmpty():
        depth += 1
        if depth > longest:
            where = [tuple(r) for r in step.select(*by, "start").distinct().limit(5).collect()]
            raise ValueError(f"the dependency graph has a cycle, met from {where}")
        reach, frontier = reach.unionByName(step), step
    best = reach.groupBy(*by, "start").agg(F.max(F.struct("depth", (-F.col("cur")).alias("neg"))).alias("__b"))
    return best.select(*by, F.col("start").alias("titik_id"), (-F.col("__b.neg")).alias("root_titik_id"),
                       F.col("__b.depth").alias("depth"),
                       ((-F.col("__b.neg")) == F.col("start")).alias("is_root"))


# ---------------------------------------------------------------------------
# H22-H24 ML output health
# ---------------------------------------------------------------------------
ML_FRESHNESS_HOURS = (48, 96)


@model("monitor_ml_freshness", "ops", f"""SELECT model_name, max(scored_at) AS latest_scored_at,
  round((epoch(TIMESTAMP '{_AS_OF} 00:00:00') - epoch(max(scored_at))) / 3600.0, 1) AS lag_hours,
  CASE WHEN round((epoch(TIMESTAMP '{_AS_OF} 00:00:00') - epoch(max(scored_at))) / 3600.0, 1) >= {ML_FRESHNESS_HOURS[1]}
    THEN 'critical' WHEN round((epoch(TIMESTAMP '{_AS_OF} 00:00:00') - epoch(max(scored_at))) / 3600.0, 1) >= {ML_FRESHNESS_HOURS[0]}
    THEN 'warning' END AS severity
FROM ml_predictions GROUP BY 1""", tags=("monitor", "ml"))
def monitor_ml_freshness(m):
    """Lag of the newest score per model against 48 h / 96 h."""
    now_s = F.lit(_now(m)).cast("timestamp_ntz").cast("timestamp").cast("long")
    g = m["ml_predictions"].groupBy("model_name").agg(F.max("scored_at").alias("latest_scored_at"))
    lag = X.dround((now_s - F.col("latest_scored_at").cast("timestamp").cast("long")) / 3600.0, 1)
    g = g.withColumn("lag_hours", lag)
    return g.withColumn("severity", F.when(F.col("lag_hours") >= ML_FRESHNESS_HOURS[1], "critical")
                        .when(F.col("lag_hours") >= ML_FRESHNESS_HOURS[0], "warning"))


@model("monitor_ml_completeness", "ops", """WITH ex AS (
  SELECT DISTINCT property_id || ':' || cast(room_type_id AS varchar) AS entity_id FROM fact_revenue_room_type_daily
  WHERE period_date = (SELECT max(period_date) FROM fact_revenue_room_type_daily)),
sc AS (SELECT DISTINCT entity_id FROM ml_predictions)
SELECT ex.entity_id AS missing_entity_id, 'critical' AS severity FROM ex
WHERE ex.entity_id NOT IN (SELECT entity_id FROM sc)""", tags=("monitor", "ml"))
def monitor_ml_completeness(m):
    """Entities present at the latest feature snapshot that were not scored."""
    return missing_scores(m["fact_revenue_room_type_daily"], m["ml_predictions"])


def missing_scores(features: DataFrame, predictions: DataFrame) -> DataFrame:
    last = features.select(F.max("period_date")).scalar()
    expected = features.where(F.col("period_date") == last).select(
        F.concat(F.col("property_id"), F.lit(":"), F.col("room_type_id").cast("string")).alias("entity_id")).distinct()
    scored = predictions.select("entity_id").distinct()
    return expected.join(scored, "entity_id", "left_anti").select(
        F.col("entity_id").alias("missing_entity_id"), F.lit("critical").alias("severity"))


@model("monitor_ml_completeness_with_gap", "ops", """SELECT DISTINCT property_id || ':' || cast(room_type_id AS varchar)
  AS missing_entity_id, 'critical' AS severity FROM fact_revenue_room_type_daily f
WHERE NOT EXISTS (SELECT 1 FROM fact_revenue_room_type_daily later WHERE later.period_date > f.period_date)
  AND NOT EXISTS (SELECT 1 FROM ml_predictions p WHERE p.entity_id NOT LIKE 'P02:%'
                  AND p.entity_id = f.property_id || ':' || cast(f.room_type_id AS varchar))""", tags=("monitor", "ml"))
def monitor_ml_completeness_with_gap(m):
    """H23 where the scores of property P02 didn't arrive."""
    return missing_scores(m["fact_revenue_room_type_daily"], m["ml_predictions"].where("entity_id not like 'P02:%'"))


@model("monitor_ml_model_version", "ops", f"""WITH v AS (
  SELECT model_name, model_version, min(scored_at) AS first_scored_at, max(scored_at) AS last_scored_at,
    count(*) AS prediction_count FROM ml_predictions GROUP BY 1, 2)
SELECT *, cast(date_diff('day', cast(first_scored_at AS date), DATE '{_AS_OF}') AS bigint) AS days_since_first_score,
  last_scored_at = max(last_scored_at) OVER (PARTITION BY model_name) AS is_most_recent FROM v""",
       tags=("monitor", "ml"))
def monitor_ml_model_version(m):
    """Per model version: first/last score, volume, age, most-recent flag."""
    v = m["ml_predictions"].groupBy("model_name", "model_version").agg(
        F.min("scored_at").alias("first_scored_at"), F.max("scored_at").alias("last_scored_at"),
        F.count(F.lit(1)).alias("prediction_count"))
    # one row per model version: the per-model max is a small window
    v = v.withColumn("__latest", F.max("last_scored_at").over(Window.partitionBy("model_name")))
    return v.select("model_name", "model_version", "first_scored_at", "last_scored_at", "prediction_count",
                    F.datediff(F.lit(m.as_of), F.to_date("first_scored_at")).cast("bigint")
                    .alias("days_since_first_score"),
                    (F.col("last_scored_at") == F.col("__latest")).alias("is_most_recent"))


def drift_dataset_canary(spark) -> DataFrame:
    """Databases whose name suggests drift / ML-monitoring data (informational)."""
    names = [d.name for d in spark.catalog.listDatabases()]
    df = spark.createDataFrame([(n,) for n in names], "database_name string")
    return df.where(F.lower("database_name").contains("drift") | F.lower("database_name").contains("ml_monitoring"))


# ---------------------------------------------------------------------------
# H26-H27 storage, H28-H31 governed-query performance
# ---------------------------------------------------------------------------
def orphan_alerts(storage: DataFrame) -> DataFrame:
    """One alert per snapshot listing every orphaned (``__old``) table."""
    o = storage.where(F.col("is_orphan"))
    return o.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("orphan_count"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws(".", "schema_name", "table_name"))), ", ")
        .alias("detail")).withColumn("alert_type", F.lit("orphan_table")).withColumn("severity", F.lit("warning"))


def storage_snapshot(tables: DataFrame) -> DataFrame:
    """Size and orphan flag per served table (``__old`` leftovers of swaps)."""
    return tables.withColumn("is_orphan", F.col("table_name").endswith("__old"))


@model("monitor_latency_percentiles", "ops", """SELECT
  round(quantile_cont(duration_ms, 0.5), 6) AS p50_ms, round(quantile_cont(duration_ms, 0.95), 6) AS p95_ms,
  round(quantile_cont(duration_ms, 0.99), 6) AS p99_ms, count(duration_ms) AS sample_count
FROM src_chatbot_query_log WHERE duration_ms IS NOT NULL""", tags=("monitor",))
def monitor_latency_percentiles(m):
    """p50/p95/p99 of request durations (nulls excluded)."""
    d = m["src_chatbot_query_log"].select(F.lit(0).alias("all"), "duration_ms")
    q = X.exact_percentiles(d, ["all"], "duration_ms", [0.5, 0.95, 0.99])
    return X.finish(q.select(*[F.col("percentiles")[i].alias(c) for i, c in enumerate(("p50_ms", "p95_ms", "p99_ms"))],
                             F.col("n").alias("sample_count")))


SLOWEST_N = 20


@model("monitor_slowest_requests", "ops", f"""SELECT role_title, domain, view_name, status, duration_ms, requested_at
FROM src_chatbot_query_log WHERE duration_ms IS NOT NULL
ORDER BY duration_ms DESC, requested_at, view_name LIMIT {SLOWEST_N}""", tags=("monitor",))
def monitor_slowest_requests(m):
    """The N slowest requests (top-k: a bounded sort per task, then merge)."""
    return (m["src_chatbot_query_log"].where(F.col("duration_ms").isNotNull())
            .orderBy(F.desc("duration_ms"), "requested_at", "view_name").limit(SLOWEST_N)
            .select("role_title", "domain", "view_name", "status", "duration_ms", "requested_at"))


@model("monitor_daily_requests", "ops", """SELECT cast(requested_at AS date) AS request_date, count(*) AS request_count,
  cast(count_if(status = 'denied') AS bigint) AS denied_count, round(count_if(status = 'denied') * 100.0 / count(*), 2) AS denied_pct
FROM src_chatbot_query_log GROUP BY 1""", tags=("monitor",))
def monitor_daily_requests(m):
    """Daily request volume and denied share."""
    q = m["src_chatbot_query_log"]
    return q.groupBy(F.to_date("requested_at").alias("request_date")).agg(
        F.count(F.lit(1)).alias("request_count"), F.count_if(F.col("status") == "denied").alias("denied_count"),
        X.dround(F.count_if(F.col("status") == "denied") * 100.0 / F.count(F.lit(1)), 2).alias("denied_pct"))


QUERY_STATS_TOP = 10


@model("monitor_query_stats", "ops", f"""SELECT view_name, domain, count(*) AS calls,
  round(avg(duration_ms), 6) AS mean_ms, round(max(duration_ms), 6) AS max_ms
FROM src_chatbot_query_log GROUP BY 1, 2 ORDER BY calls DESC, view_name, domain LIMIT {QUERY_STATS_TOP}""",
       tags=("monitor",))
def monitor_query_stats(m):
    """Most-called governed queries with mean/max duration (top-k report)."""
    g = m["src_chatbot_query_log"].groupBy("view_name", "domain").agg(
        F.count(F.lit(1)).alias("calls"), F.avg("duration_ms").alias("mean_ms"), F.max("duration_ms").alias("max_ms"))
    return X.finish(g.orderBy(F.desc("calls"), "view_name", "domain").limit(QUERY_STATS_TOP))


@model("monitor_request_rate_z", "ops", rolling_z_sql(
    "(SELECT domain, cast(requested_at AS date) AS request_date, count(*) AS request_count FROM src_chatbot_query_log "
    "GROUP BY 1, 2)", ["domain"], "request_date", "request_count", VOLUME_WINDOW,
    "domain, request_date, request_count"), tags=("monitor",))
def monitor_request_rate_z(m):
    """H19-H21 detector on a data-derived series: daily governed requests per
    domain against the previous 8 days (no weekday filter)."""
    s = (m["src_chatbot_query_log"].groupBy("domain", F.to_date("requested_at").alias("request_date"))
         .agg(F.count(F.lit(1)).alias("request_count")))
    return X.finish(rolling_z(s, ["domain"], "request_date", "request_count", VOLUME_WINDOW))


# ---------------------------------------------------------------------------
# H33-H35 dashboard panels over the alert log
# ---------------------------------------------------------------------------
# Alert priority order on the dashboard (lower sorts first).
PRIORITY = {"critical": 1, "warning": 2}


def panel_active_alerts(alerts: DataFrame, as_of, limit: int = 50) -> DataFrame:
    sev = F.when(F.col("severity") == "critical", 1).when(F.col("severity") == "warning", 2).otherwise(3)
    return (alerts.where(F.col("snapshot_date") == F.lit(as_of)).withColumn("priority", sev)
            .orderBy("priority", F.desc_nulls_last("triggered_at"), "table_name").limit(limit))


def panel_alerts_by_root(events_with_root: DataFrame) -> DataFrame:
    return events_with_root.groupBy("root_titik_id").agg(F.count(F.lit(1)).alias("event_count"))


def alert_rule_counts(alerts: DataFrame, drift: DataFrame, as_of) -> DataFrame:
    """Last-day alert count and pending drift count as one row."""
    a = alerts.where(F.col("snapshot_date") == F.lit(as_of)).agg(F.count(F.lit(1)).alias("alerts_last_day"))
    d = drift.where(F.col("status") == "pending").agg(F.count(F.lit(1)))
    return a.select("alerts_last_day", d.scalar().alias("pending_drift"))


# ---------------------------------------------------------------------------
# H32 alert log, H33/H34 dashboard panels (all over monitoring tables)
# ---------------------------------------------------------------------------
ALERT_LOG_SCHEMA = ("schema_name string, table_name string, alert_type string, severity string, detail string, "
                    "snapshot_date date, triggered_at timestamp, is_simulated boolean")


def alert_rows(spark, rows: list[tuple]) -> DataFrame:
    """Alerts in the log's fixed schema (append-only table)."""
    return spark.createDataFrame(rows, ALERT_LOG_SCHEMA)


def _latest_per(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Latest row per key as a partial aggregation (max of an ordered struct)."""
    rest = [c for c in df.columns if c not in keys and c != order]
    s = df.groupBy(*keys).agg(F.max(F.struct(order, *rest)).alias("__l"))
    return s.select(*keys, "__l.*")


def panel_pending_drift(drift: DataFrame) -> DataFrame:
    return drift.where(F.col("status") == "pending").groupBy("schema_name", "table_name").agg(
        F.count(F.lit(1)).alias("pending_events"), F.max("severity").alias("max_severity"))


def panel_status_by_priority(status: DataFrame, spark, tables=MON_TABLES) -> DataFrame:
    pr = spark.createDataFrame([(s, t, p) for s, t, p, *_ in tables], "schema_name string, table_name string, "
                                                                       "priority string")
    return (status.join(F.broadcast(pr), ["schema_name", "table_name"], "left")
            .groupBy("priority", "baseline_status").agg(F.count(F.lit(1)).alias("tables")))


def panel_dq_last_run(results: DataFrame) -> DataFrame:
    """Pass/fail per table on each table's latest DQ run."""
    last = results.groupBy("schema_name", "table_name").agg(F.max("run_date").alias("run_date"))
    r = results.join(last, ["schema_name", "table_name", "run_date"])
    return r.groupBy("schema_name", "table_name", "run_date").agg(
        F.count_if(F.col("success")).alias("passed"), F.count_if(~F.col("success")).alias("failed"))


def panel_dq_failures(results: DataFrame) -> DataFrame:
    last = results.groupBy("schema_name", "table_name").agg(F.max("run_date").alias("run_date"))
    return results.join(last, ["schema_name", "table_name", "run_date"]).where(~F.col("success"))


def panel_latest_dirty(history: DataFrame) -> DataFrame:
    return _latest_per(history, ["schema_name", "table_name", "column_name"], "snapshot_date")


def panel_latest_outlier(history: DataFrame) -> DataFrame:
    latest = _latest_per(history, ["schema_name", "table_name", "column_name"], "snapshot_date")
    return latest.withColumn("outlier_pct", X.dround(F.col("outlier_count") * 100.0 / F.col("row_count"), 3))


def panel_stage_status(run_log: DataFrame, run_date) -> DataFrame:
    return latest_run_per_stage(run_log, run_date).select("titik_id", "status", "started_at", "ran_today")


def panel_gate_last_run(tests: DataFrame) -> DataFrame:
    last = tests.groupBy("layer").agg(F.max("captured_at").alias("captured_at"))
    return tests.join(last, ["layer", "captured_at"]).groupBy("layer", "captured_at").agg(
        F.count_if(F.col("status") == "pass").alias("passed"),
        F.count_if(F.col("status").isin("fail", "error")).alias("failed"))


def panel_volume_alerts(alerts: DataFrame, limit: int = 20) -> DataFrame:
    return (alerts.where(F.col("alert_type").isin("volume_anomaly", "warehouse_volume_anomaly"))
            .orderBy(F.desc("snapshot_date"), F.desc_nulls_last("triggered_at"), "table_name").limit(limit))


def panel_ml_health(freshness: DataFrame, missing: DataFrame, versions: DataFrame) -> DataFrame:
    f = freshness.select(F.lit("freshness").alias("check"), "model_name",
                         F.col("severity"), F.col("lag_hours").cast("string").alias("detail"))
    m = missing.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("completeness").alias("check"), F.lit(None).cast("string").alias("model_name"),
        F.when(F.col("n") > 0, "critical").alias("severity"), F.col("n").cast("string").alias("detail"))
    v = versions.where("is_most_recent").select(
        F.lit("model_version").alias("check"), "model_name", F.lit(None).cast("string").alias("severity"),
        F.col("model_version").alias("detail"))
    return f.unionByName(m).unionByName(v)


def panel_swap_top(sync_log: DataFrame, limit: int = 30) -> DataFrame:
    return sync_log.orderBy(F.desc_nulls_last("swap_duration_ms"), "table_name").limit(limit)


def panel_storage_per_schema(storage: DataFrame) -> DataFrame:
    return storage.groupBy("schema_name").agg(F.sum("total_size_bytes").alias("total_size_bytes"),
                                              F.count(F.lit(1)).alias("tables"),
                                              F.count_if(F.col("is_orphan")).alias("orphans"))


def panel_latency_24h(log: DataFrame, now: dt.datetime) -> DataFrame:
    since = F.lit(now - dt.timedelta(hours=24)).cast("timestamp_ntz")
    recent = log.where(F.col("requested_at") >= since).select(F.lit(0).alias("all"), "duration_ms")
    found = X.exact_percentiles(recent, ["all"], "duration_ms", [0.5, 0.95, 0.99])
    # one row also when nothing was asked
    return found.agg(F.coalesce(F.max("n"), F.lit(0)).alias("requests"), F.max("percentiles").alias("p50_p95_p99"))


# ---------------------------------------------------------------------------
# H13 warehouse volume over the layers, table list taken from the registry
# ---------------------------------------------------------------------------
def _layer_tables():
    from innspark.operators.clean import CLEANED_TABLES
    from innspark.sources.fixtures import SOURCE_TABLES
    from innspark.plans.registry import models
    marts = [n for layer in ("dim", "fact") for n in models(layer)]
    return {"raw_production": [f"src_{t}" for t in SOURCE_TABLES], "mart_cleaned": list(CLEANED_TABLES),
            "mart_aggregated": marts}


@model("monitor_warehouse_volume", "ops", lambda: "\nUNION ALL\n".join(
    f"SELECT '{layer}' AS dataset_name, '{t}' AS table_name, DATE '{_AS_OF}' AS snapshot_date, "
    f"count(*) AS row_count, cast(dayofweek(DATE '{_AS_OF}') AS bigint) AS day_of_week FROM {t}"
    for layer, ts in _layer_tables().items() for t in ts), tags=("monitor",))
def monitor_warehouse_volume(m):
    """Row counts of every raw and cleaned table."""
    return X.finish(layer_volume(m, _layer_tables(), m.as_of))


# ---------------------------------------------------------------------------
# H13/H19-H21 detectors over the monitoring logs (thin, keyed rolling_z)
# ---------------------------------------------------------------------------
def warehouse_volume_anomaly(history: DataFrame) -> DataFrame:
    """Layer table counts against the previous 8 same-weekday snapshots."""
    return rolling_z(history, ["dataset_name", "table_name", "day_of_week"], "snapshot_date", "row_count",
                     VOLUME_WINDOW)


def sensor_duration_anomaly(run_log: DataFrame, stage: int = 5) -> DataFrame:
    """The ML sensor stage's run duration against its previous 8 runs."""
    runs = run_log.where(F.col("titik_id") == stage).withColumn("duration_seconds",
                                                               F.col("duration_seconds").cast("double"))
    return rolling_z_blocks(runs, ["titik_id"], "started_at", "duration_seconds", VOLUME_WINDOW)


def swap_duration_anomaly(sync_log: DataFrame) -> DataFrame:
    """Swap duration per (dataset, table) against its previous 8 swaps."""
    s = sync_log.where(F.col("swap_duration_ms").isNotNull())
    return rolling_z_blocks(s, ["dataset_name", "table_name"], "synced_at", "swap_duration_ms", VOLUME_WINDOW,
                            digits=2, scale=100)


def connection_spike(snapshots: DataFrame) -> DataFrame:
    """Concurrent connections against the previous 8 samples."""
    return rolling_z(snapshots.withColumn("__series", F.lit("serving")), ["__series"], "snapshot_time",
                     "active_connection_count", VOLUME_WINDOW).drop("__series")
