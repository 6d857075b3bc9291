"""Facility, housekeeping and maintenance facts D18-D26."""

from __future__ import annotations

from pyspark.sql import functions as F

from innspark.functions import exprs as X
from innspark.plans.registry import DEFAULT_AS_OF, model

AS_OF_SQL = f"date '{DEFAULT_AS_OF.isoformat()}'"
# minute-of-day of an HH:mm:ss text, DuckDB side of exprs.minute_of_day
MOD_SQL = "(cast(substr({c}, 1, 2) AS int) * 60 + cast(substr({c}, 4, 2) AS int))"


def _mdiff_sql(end, start):
    return f"({MOD_SQL.format(c=end)} - {MOD_SQL.format(c=start)})"


@model("fact_facility_room_status_daily", "fact", f"""SELECT room_id, {AS_OF_SQL} AS period_date, status,
  status = 'out-of-order' AS is_out_of_order FROM rooms""", tags=("facility", "snapshot"))
def fact_facility_room_status_daily(m):
    return m["rooms"].select("room_id", F.lit(m.as_of).alias("period_date"), "status",
                             (F.col("status") == "out-of-order").alias("is_out_of_order"))


def _hk_with_rooms(m):
    rooms = m["rooms"].select("room_id", "property_id", "room_type")
    return m["housekeeping_log"].join(rooms, "room_id", "left")


@model("fact_housekeeping_property_daily", "fact", """WITH of_room AS (
  SELECT room_id, date, avg(cast(status = 'delayed' AS int)) AS late, count(*) AS n FROM housekeeping_log GROUP BY ALL),
cleaned AS (SELECT rooms.property_id, w.date, sum(w.late * w.n) / sum(w.n) AS late FROM of_room w
  LEFT JOIN rooms USING (room_id) GROUP BY ALL),
nights AS (SELECT property_id, date, sum(rooms_sold) AS sold, sum(total_rooms_available) AS offered
  FROM daily_occupancy GROUP BY ALL)
SELECT c.date AS period_date, c.property_id, round(n.sold / nullif(n.offered, 0), 6) AS occupancy_rate,
  round(c.late, 6) AS delayed_rate
FROM cleaned c LEFT JOIN nights n ON n.property_id = c.property_id AND n.date = c.date""", tags=("facility",))
def fact_housekeeping_property_daily(m):
    d = (_hk_with_rooms(m).groupBy("property_id", F.col("date").alias("period_date"))
         .agg(F.count(F.lit(1)).alias("total_count"), F.count_if(F.col("status") == "delayed").alias("delayed_count")))
    o = (m["daily_occupancy"].groupBy("property_id", F.col("date").alias("period_date"))
         .agg(X.safe_div(F.sum("rooms_sold"), F.sum("total_rooms_available")).alias("occupancy_rate")))
    out = d.join(o, ["property_id", "period_date"], "left")
    return X.finish(out.select("property_id", "period_date",
                               X.safe_div("delayed_count", "total_count").alias("delayed_rate"), "occupancy_rate"))


@model("fact_housekeeping_room_type_daily", "fact", f"""WITH c AS (
  SELECT r.property_id, rt.room_type_id, h.date AS period_date,
    {_mdiff_sql('h.cleaning_end_time', 'h.cleaning_start_time')} AS duration_minutes
  FROM housekeeping_log h LEFT JOIN rooms r ON h.room_id = r.room_id
  LEFT JOIN dim_room_type rt ON r.room_type = rt.room_type_name WHERE h.status = 'completed'),
a AS (SELECT property_id, room_type_id, period_date, avg(duration_minutes) AS v FROM c GROUP BY 1, 2, 3)
SELECT property_id, room_type_id, period_date, round(v, 6) AS avg_cleaning_duration_minutes,
  round(avg(v) OVER (PARTITION BY room_type_id), 6) AS baseline_duration_minutes FROM a""", tags=("facility",))
def fact_housekeeping_room_type_daily(m):
    h = _hk_with_rooms(m).where(F.col("status") == "completed")
    h = X.lookup(h, m["dim_room_type"], "room_type", "room_type_name", "room_type_id")
    a = (h.groupBy("property_id", "room_type_id", F.col("date").alias("period_date"))
         .agg(F.avg(X.minute_diff("cleaning_end_time", "cleaning_start_time")).alias("avg_cleaning_duration_minutes")))
    # baseline = mean of the daily means per room type over all dates/properties: a
    # window over a handful of room types would be as many tasks for all history
    base = a.groupBy(F.col("room_type_id").alias("__type")).agg(
        F.avg("avg_cleaning_duration_minutes").alias("baseline_duration_minutes"))
    out = a.join(base, F.col("room_type_id").eqNullSafe(F.col("__type")), "left")
    return X.finish(out.drop("__type"))


@model("fact_housekeeping_staff_daily", "fact", f"""WITH a AS (
  SELECT staff_id, date AS period_date,
    avg({_mdiff_sql('cleaning_end_time', 'cleaning_start_time')}) AS v
  FROM housekeeping_log WHERE status = 'completed' GROUP BY 1, 2)
SELECT staff_id, period_date, round(v, 6) AS avg_cleaning_duration_minutes,
  round(avg(v) OVER (PARTITION BY period_date), 6) AS team_avg_duration_minutes FROM a""", tags=("facility",))
def fact_housekeeping_staff_daily(m):
    a = (m["housekeeping_log"].where(F.col("status") == "completed")
         .groupBy("staff_id", F.col("date").alias("period_date"))
         .agg(F.avg(X.minute_diff("cleaning_end_time", "cleaning_start_time")).alias("avg_cleaning_duration_minutes")))
    a = X.group_total(a, ["period_date"], "avg_cleaning_duration_minutes", "team_avg_duration_minutes", fn=F.avg)
    return X.finish(a)


@model("fact_maintenance_cost_daily", "fact", """WITH a AS (
  SELECT t.property_id, it.issue_type_id, t.resolved_date AS period_date, sum(t.cost) AS total_cost,
    sum(CASE WHEN t.parts_replaced IS NOT NULL THEN t.cost ELSE 0 END) AS cost_with_parts,
    sum(CASE WHEN t.parts_replaced IS NULL THEN t.cost ELSE 0 END) AS cost_without_parts
  FROM maintenance_tickets t LEFT JOIN dim_issue_type it ON t.issue_type = it.issue_type_name
  WHERE t.status = 'resolved' AND t.resolved_date IS NOT NULL GROUP BY 1, 2, 3)
SELECT cur.property_id, cur.issue_type_id, cur.period_date, cast(cur.total_cost AS bigint) AS total_cost,
  cast(cur.cost_with_parts AS bigint) AS cost_with_parts, cast(cur.cost_without_parts AS bigint) AS cost_without_parts,
  cast(cur.total_cost - mom.total_cost AS bigint) AS mom_cost_growth,
  cast(cur.total_cost - yoy.total_cost AS bigint) AS yoy_cost_growth
FROM a cur
LEFT JOIN a mom ON cur.property_id = mom.property_id AND cur.issue_type_id = mom.issue_type_id
  AND mom.period_date = cast(cur.period_date - INTERVAL 1 MONTH AS date)
LEFT JOIN a yoy ON cur.property_id = yoy.property_id AND cur.issue_type_id = yoy.issue_type_id
  AND yoy.period_date = cast(cur.period_date - INTERVAL 1 YEAR AS date)""", tags=("facility",))
def fact_maintenance_cost_daily(m):
    t = m["maintenance_tickets"].where((F.col("status") == "resolved") & F.col("resolved_date").isNotNull())
    t = X.lookup(t, m["dim_issue_type"], "issue_type", "issue_type_name", "issue_type_id")
    has_parts = F.col("parts_replaced").isNotNull()
    a = t.groupBy("property_id", "issue_type_id", F.col("resolved_date").alias("period_date")).agg(
        F.sum("cost").alias("total_cost"),
        F.sum(F.when(has_parts, F.col("cost")).otherwise(0)).alias("cost_with_parts"),
        F.sum(F.when(~has_parts, F.col("cost")).otherwise(0)).alias("cost_without_parts"))
    keys = ["property_id", "issue_type_id"]
    g = X.shift_values(a, keys, "period_date", ["total_cost"], {"mom_": 1, "yoy_": 12})
    return X.finish(g.select("property_id", "issue_type_id", "period_date", "total_cost", "cost_with_parts",
                             "cost_without_parts",
                             (F.col("total_cost") - F.col("mom_total_cost")).alias("mom_cost_growth"),
                             (F.col("total_cost") - F.col("yoy_total_cost")).alias("yoy_cost_growth")))


@model("fact_maintenance_property_benchmark_yearly", "fact", """WITH t AS (
  SELECT property_id, cast(extract(year FROM reported_date) AS bigint) AS year, count(*) AS ticket_count
  FROM maintenance_tickets GROUP BY 1, 2),
rc AS (SELECT property_id, count(*) AS room_count FROM rooms GROUP BY 1),
x AS (SELECT t.property_id, t.year, t.ticket_count / nullif(r.room_count, 0) AS tpr,
  cast(date_diff('day', p.opening_date, make_date(cast(t.year AS int), 12, 31)) AS double) / 365.25 AS age
  FROM t LEFT JOIN rc r ON t.property_id = r.property_id LEFT JOIN dim_property p ON t.property_id = p.property_id)
SELECT property_id, year, round(tpr, 6) AS tickets_per_room, round(age, 6) AS building_age_years,
  round(tpr / nullif(age, 0), 6) AS tickets_per_room_normalized FROM x""", tags=("facility",))
def fact_maintenance_property_benchmark_yearly(m):
    t = (m["maintenance_tickets"].groupBy("property_id", F.year("reported_date").alias("year"))
         .agg(F.count(F.lit(1)).alias("ticket_count")))
    rc = m["rooms"].groupBy("property_id").agg(F.count(F.lit(1)).alias("room_count"))
    p = m["dim_property"].select("property_id", "opening_date")
    x = t.join(rc, "property_id", "left").join(p, "property_id", "left")
    tpr = X.safe_div("ticket_count", "room_count")
    age = F.datediff(F.make_date(F.col("year"), F.lit(12), F.lit(31)), F.col("opening_date")).cast("double") / 365.25
    return X.finish(x.select("property_id", "year", tpr.alias("tickets_per_room"), age.alias("building_age_years"),
                             X.safe_div(tpr, age).alias("tickets_per_room_normalized")))


@model("fact_maintenance_room_recurrence_yearly", "fact", """WITH c AS (
  SELECT room_id, cast(extract(year FROM reported_date) AS bigint) AS year, count(*) AS ticket_count
  FROM maintenance_tickets WHERE room_id IS NOT NULL GROUP BY 1, 2),
ym AS (SELECT year, quantile_disc(ticket_count, 0.5) AS med FROM c GROUP BY 1)
SELECT c.room_id, c.year, c.ticket_count, round(c.ticket_count / nullif(ym.med, 0), 6) AS vs_median_ratio
FROM c LEFT JOIN ym ON c.year = ym.year""", tags=("facility",))
def fact_maintenance_room_recurrence_yearly(m):
    c = (m["maintenance_tickets"].where(F.col("room_id").isNotNull())
         .groupBy("room_id", F.year("reported_date").alias("year")).agg(F.count(F.lit(1)).alias("ticket_count")))
    ym = c.groupBy("year").agg(X.median("ticket_count").alias("__median"))
    out = c.join(ym, "year", "left")
    return X.finish(out.select("room_id", "year", "ticket_count",
                               X.safe_div("ticket_count", "__median").alias("vs_median_ratio")))


@model("fact_maintenance_technician_daily", "fact", """SELECT reported_date AS period_date, assigned_staff_id,
  round(list_sum(list(labor_hours)), 6) AS labor_hours, count(ticket_id) AS ticket_count
FROM maintenance_tickets GROUP BY ALL HAVING assigned_staff_id IS NOT NULL""", tags=("facility",))
def fact_maintenance_technician_daily(m):
    return X.finish(m["maintenance_tickets"].where(F.col("assigned_staff_id").isNotNull())
                    .groupBy("assigned_staff_id", F.col("reported_date").alias("period_date"))
                    .agg(F.count(F.lit(1)).alias("ticket_count"), F.sum("labor_hours").alias("labor_hours")))


@model("fact_maintenance_ticket_daily", "fact", """SELECT t.property_id, fa.facility_area_id, it.issue_type_id,
  pr.priority_id, t.reported_date AS period_date, count(*) AS new_ticket_count,
  round(avg(CASE WHEN t.status = 'resolved' THEN date_diff('hour', cast(t.reported_date AS timestamp),
    cast(t.resolved_date AS timestamp)) END), 6) AS avg_sla_duration_hours,
  cast(count_if(t.status IN ('open', 'in-progress')) AS bigint) AS pending_count
FROM maintenance_tickets t
LEFT JOIN dim_facility_area fa ON t.facility_area = fa.facility_area_name
LEFT JOIN dim_issue_type it ON t.issue_type = it.issue_type_name
LEFT JOIN dim_priority pr ON t.priority = pr.priority_name
GROUP BY 1, 2, 3, 4, 5""", tags=("facility",))
def fact_maintenance_ticket_daily(m):
    t = m["maintenance_tickets"]
    t = X.lookup(t, m["dim_facility_area"], "facility_area", "facility_area_name", "facility_area_id")
    t = X.lookup(t, m["dim_issue_type"], "issue_type", "issue_type_name", "issue_type_id")
    t = X.lookup(t, m["dim_priority"], "priority", "priority_name", "priority_id")
    hours = F.datediff("resolved_date", "reported_date") * 24   # midnight-to-midnight timestamps
    return X.finish(t.groupBy("property_id", "facility_area_id", "issue_type_id", "priority_id",
                              F.col("reported_date").alias("period_date")).agg(
        F.count(F.lit(1)).alias("new_ticket_count"),
        F.avg(F.when(F.col("status") == "resolved", hours)).alias("avg_sla_duration_hours"),
        F.count_if(F.col("status").isin("open", "in-progress")).alias("pending_count")))
