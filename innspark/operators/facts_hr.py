"""HR facts D42-D49."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from innspark.functions import exprs as X
from innspark.plans.registry import DEFAULT_AS_OF, model

AS_OF_SQL = f"date '{DEFAULT_AS_OF.isoformat()}'"
_MOD = "(cast(substr({c}, 1, 2) AS int) * 60 + cast(substr({c}, 4, 2) AS int))"
_MD = f"({_MOD.format(c='s.clock_out')} - {_MOD.format(c='s.clock_in')})"
OVERTIME_SQL = (f"CASE WHEN s.clock_in IS NOT NULL AND s.clock_out IS NOT NULL THEN greatest(cast(CASE WHEN "
                f"s.clock_out < s.clock_in THEN {_MD} + 1440 ELSE {_MD} END AS double) / 60.0 - 8.0, 0.0) END")


def _shifts_with_employee(m, cols):
    e = m["employees"].select("employee_id", *cols)
    return m["staff_shifts"].join(e, "employee_id", "left")


@model("fact_hr_attendance_daily", "fact", f"""WITH s AS (
  SELECT e.property_id, d.department_id, s.date AS period_date, s.status, {OVERTIME_SQL} AS overtime_hours
  FROM staff_shifts s LEFT JOIN employees e ON s.employee_id = e.employee_id
  LEFT JOIN dim_department d ON e.department = d.department_name)
SELECT property_id, department_id, period_date, cast(count_if(status = 'present') AS bigint) AS present_count,
  cast(count_if(status = 'late') AS bigint) AS late_count, cast(count_if(status = 'leave') AS bigint) AS leave_count,
  cast(count_if(status = 'absent') AS bigint) AS absent_count, round(sum(overtime_hours), 6) AS overtime_hours_total
FROM s GROUP BY 1, 2, 3""", tags=("hr",))
def fact_hr_attendance_daily(m):
    s = _shifts_with_employee(m, ["property_id", "department"])
    s = X.lookup(s, m["dim_department"], "department", "department_name", "department_id")
    st = F.col("status")
    return X.finish(s.groupBy("property_id", "department_id", F.col("date").alias("period_date")).agg(
        F.count_if(st == "present").alias("present_count"), F.count_if(st == "late").alias("late_count"),
        F.count_if(st == "leave").alias("leave_count"), F.count_if(st == "absent").alias("absent_count"),
        F.sum(X.overtime_hours("clock_in", "clock_out")).alias("overtime_hours_total")))


@model("fact_hr_employee_monthly", "fact", f"""WITH s AS (
  SELECT s.employee_id, e.department, cast(date_trunc('month', s.date) AS date) AS period_date, s.status,
    {OVERTIME_SQL} AS overtime_hours
  FROM staff_shifts s LEFT JOIN employees e ON s.employee_id = e.employee_id),
a AS (SELECT employee_id, department, period_date, sum(overtime_hours) AS overtime_hours,
  count_if(status = 'late') / count(*) AS late_rate FROM s GROUP BY 1, 2, 3),
d AS (SELECT department, period_date, {X.exact_avg_sql('overtime_hours')} AS ot, {X.exact_avg_sql('late_rate')} AS lr
  FROM a GROUP BY 1, 2)
SELECT a.employee_id, a.period_date, round(a.overtime_hours, 6) AS overtime_hours,
  round(a.overtime_hours - d.ot, 6) AS overtime_vs_dept_avg, round(a.late_rate, 6) AS late_rate,
  round(a.late_rate - d.lr, 6) AS late_vs_dept_avg
FROM a LEFT JOIN d ON a.department = d.department AND a.period_date = d.period_date""", tags=("hr",))
def fact_hr_employee_monthly(m):
    s = _shifts_with_employee(m, ["department"])
    a = s.groupBy("employee_id", "department", X.month_start("date").alias("period_date")).agg(
        F.sum(X.overtime_hours("clock_in", "clock_out")).alias("overtime_hours"),
        X.safe_div(F.count_if(F.col("status") == "late"), F.count(F.lit(1))).alias("late_rate"))
    d = a.groupBy("department", "period_date").agg(X.exact_avg("overtime_hours").alias("__ot"),
                                                   X.exact_avg("late_rate").alias("__lr"))
    # a null-safe join asks nothing of the keys, so both sides share one roll-up's shuffle
    out = X.null_safe_join(a, d, ["department", "period_date"])
    against = lambda c, mean: F.when(F.col("department").isNotNull(), F.col(c) - F.col(mean))
    return X.finish(out.select("employee_id", "period_date", "overtime_hours",
                               against("overtime_hours", "__ot").alias("overtime_vs_dept_avg"),
                               "late_rate", against("late_rate", "__lr").alias("late_vs_dept_avg")))


@model("fact_hr_employee_performance_semester", "fact", """SELECT employee_id, review_period,
  round(score, 6) AS score, notes FROM employee_performance""", tags=("hr",))
def fact_hr_employee_performance_semester(m):
    return X.finish(m["employee_performance"].select("employee_id", "review_period", "score", "notes"))


@model("fact_hr_headcount_status_daily", "fact", f"""WITH heads AS (
  SELECT property_id, department, status, count(employee_id) AS employee_count FROM employees GROUP BY ALL)
SELECT {AS_OF_SQL} AS period_date, h.property_id, (SELECT department_id FROM dim_department WHERE department_name = h.department)
    AS department_id, (SELECT status_id FROM dim_employee_status WHERE status_name = h.status) AS status_id,
  h.employee_count FROM heads h""", tags=("hr", "snapshot"))
def fact_hr_headcount_status_daily(m):
    e = X.lookup(m["employees"], m["dim_department"], "department", "department_name", "department_id")
    e = X.lookup(e, m["dim_employee_status"], "status", "status_name", "status_id")
    return X.finish(e.groupBy("property_id", "department_id", "status_id", F.lit(m.as_of).alias("period_date"))
                    .agg(F.count(F.lit(1)).alias("employee_count")))


def _perf_with_employee(m, cols):
    e = m["employees"].select("employee_id", *cols)
    return m["employee_performance"].join(e, "employee_id", "left")


@model("fact_hr_performance_by_status_semester", "fact", """WITH scored AS (
  SELECT who.property_id, who.status, r.review_period, list(r.score ORDER BY r.score) AS scores
  FROM employees who RIGHT JOIN employee_performance r USING (employee_id) GROUP BY ALL)
SELECT s.review_period, s.property_id, d.status_id, round(list_avg(s.scores), 6) AS avg_performance_score
FROM dim_employee_status d RIGHT JOIN scored s ON s.status = d.status_name""", tags=("hr",))
def fact_hr_performance_by_status_semester(m):
    p = X.lookup(_perf_with_employee(m, ["property_id", "status"]), m["dim_employee_status"], "status",
                 "status_name", "status_id")
    return X.finish(p.groupBy("property_id", "status_id", "review_period")
                    .agg(F.avg("score").alias("avg_performance_score")))


@model("fact_hr_performance_department_semester", "fact", """WITH scored AS (
  SELECT who.property_id, who.department, r.review_period, list(r.score ORDER BY r.score) AS scores
  FROM employees who RIGHT JOIN employee_performance r USING (employee_id) GROUP BY ALL)
SELECT s.review_period, s.property_id, d.department_id, round(list_avg(s.scores), 6) AS avg_performance_score
FROM dim_department d RIGHT JOIN scored s ON s.department = d.department_name""", tags=("hr",))
def fact_hr_performance_department_semester(m):
    p = X.lookup(_perf_with_employee(m, ["property_id", "department"]), m["dim_department"], "department",
                 "department_name", "department_id")
    return X.finish(p.groupBy("property_id", "department_id", "review_period")
                    .agg(F.avg("score").alias("avg_performance_score")))


@model("fact_hr_turnover_snapshot", "fact", f"""SELECT e.property_id, d.department_id, {AS_OF_SQL} AS period_date,
  round(count_if(e.status != 'active') / count(*), 6) AS turnover_rate
FROM employees e LEFT JOIN dim_department d ON e.department = d.department_name GROUP BY 1, 2, 3""",
       tags=("hr", "snapshot"))
def fact_hr_turnover_snapshot(m):
    e = X.lookup(m["employees"], m["dim_department"], "department", "department_name", "department_id")
    return X.finish(e.groupBy("property_id", "department_id", F.lit(m.as_of).alias("period_date")).agg(
        X.safe_div(F.count_if(F.col("status") != "active"), F.count(F.lit(1))).alias("turnover_rate")))


def _expanding_mean(c: str, w):
    """Mean of the previous months' rates, summed in 1e-12 fixed point so the
    result does not depend on summation order (engine, partitioning)."""
    fixed = F.round(F.col(c) * 1e12).cast("bigint")
    return F.try_divide(F.sum(fixed).over(w), F.count(fixed).over(w)) / 1e12


def _share_before(rate: str) -> str:
    """Mean of a rate over the employee's earlier months, in fixed point."""
    return (f"(SELECT sum(cast(round(past.{rate} * 1e12) AS bigint)) / count(*) / 1e12 FROM months past "
            "WHERE past.employee_id = now.employee_id AND past.month < now.month)")


@model("fact_hr_watchlist_monthly", "fact", f"""WITH months AS (
  SELECT employee_id, cast(date_trunc('month', date) AS date) AS month, avg(cast(status = 'absent' AS int)) AS absent,
    avg(cast(status = 'late' AS int)) AS late FROM staff_shifts GROUP BY ALL),
compared AS (
  SELECT employee_id, month, absent, {_share_before('absent')} AS absent_before, late, {_share_before('late')} AS late_before
  FROM months now)
SELECT employee_id, month AS period_date, round(absent, 6) AS current_absence_rate,
  round(absent_before, 6) AS baseline_absence_rate, round(late, 6) AS current_late_rate,
  round(late_before, 6) AS baseline_late_rate, round(absent / nullif(absent_before, 0), 6) AS absence_deviation_ratio,
  round(late / nullif(late_before, 0), 6) AS late_deviation_ratio,
  coalesce(greatest(absent / nullif(absent_before, 0), late / nullif(late_before, 0)) > 5, false) AS in_watchlist
FROM compared""", tags=("hr",))
def fact_hr_watchlist_monthly(m):
    n = F.count(F.lit(1))
    mo = m["staff_shifts"].groupBy("employee_id", X.month_start("date").alias("period_date")).agg(
        X.safe_div(F.count_if(F.col("status") == "absent"), n).alias("current_absence_rate"),
        X.safe_div(F.count_if(F.col("status") == "late"), n).alias("current_late_rate"))
    # expanding mean of the previous months; one employee's partition holds one
    # row per month, however many shift rows fed it
    prior = Window.partitionBy("employee_id").orderBy("period_date").rowsBetween(Window.unboundedPreceding, -1)
    b = mo.select("*", *[_expanding_mean(c, prior).alias(o) for c, o in
                         (("current_absence_rate", "baseline_absence_rate"),
                          ("current_late_rate", "baseline_late_rate"))])
    ar = X.safe_div("current_absence_rate", "baseline_absence_rate")
    lr = X.safe_div("current_late_rate", "baseline_late_rate")
    return X.finish(b.select(
        "employee_id", "period_date", "current_absence_rate", "baseline_absence_rate", "current_late_rate",
        "baseline_late_rate", ar.alias("absence_deviation_ratio"), lr.alias("late_deviation_ratio"),
        (F.coalesce(ar > 5, F.lit(False)) | F.coalesce(lr > 5, F.lit(False))).alias("in_watchlist")))
