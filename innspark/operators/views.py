"""Serving views (2.E): facts joined to their dimensions for readable names.

A view is data — source, left joins, projected columns — and one engine turns
a spec into a lazily evaluated DataFrame (filters applied later push through
the joins down to the fact scan) and into the oracle SQL.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import functions as F

from innspark.plans.registry import register

# standard dimension joins: alias -> (dimension, key on fact, key on dim)
DIM_JOINS = {
    "p": ("dim_property", "property_id", "property_id"),
    "rt": ("dim_room_type", "room_type_id", "room_type_id"),
    "c": ("dim_channel", "channel_id", "channel_id"),
    "r": ("dim_pricing_reason", "reason_id", "reason_id"),
    "lt": ("dim_loyalty_tier", "loyalty_tier_id", "loyalty_tier_id"),
    "ng": ("dim_nationality_group", "nationality_group_id", "nationality_group_id"),
    "o": ("dim_outlet", "outlet_id", "outlet_id"),
    "ot": ("dim_outlet_type", "outlet_type_id", "outlet_type_id"),
    "cat": ("dim_fnb_category", "category_id", "category_id"),
    "ct": ("dim_customer_type", "customer_type_id", "customer_type_id"),
    "wr": ("dim_waste_reason", "reason_id", "reason_id"),
    "rm": ("dim_room", "room_id", "room_id"),
    "e": ("dim_employee", "staff_id", "employee_id"),
    "fa": ("dim_facility_area", "facility_area_id", "facility_area_id"),
    "it": ("dim_issue_type", "issue_type_id", "issue_type_id"),
    "pr": ("dim_priority", "priority_id", "priority_id"),
    "sv": ("dim_spa_service", "service_id", "service_id"),
    "v": ("dim_venue", "venue_id", "venue_id"),
    "vt": ("dim_venue_type", "venue_type_id", "venue_type_id"),
    "et": ("dim_event_type", "event_type_id", "event_type_id"),
    "d": ("dim_department", "department_id", "department_id"),
    "st": ("dim_employee_status", "status_id", "status_id"),
    "bl": ("dim_business_line", "business_line_id", "business_line_id"),
    "al": ("dim_access_level", "access_level_id", "access_level_id"),
}


@dataclass
class Join:
    alias: str
    table: str
    on: list[tuple[str, str]]  # (left "alias.col", right col)


@dataclass
class ViewSpec:
    name: str
    source: str
    cols: list[str]                      # "alias.col" or "alias.col AS name" or "<sql expr> AS name"
    joins: list[Join] = field(default_factory=list)
    where: str | None = None             # SQL predicate valid in Spark and DuckDB
    layer: str = "view"


def std_join(alias: str, left_alias: str = "f", left_key: str | None = None) -> Join:
    table, fkey, dkey = DIM_JOINS[alias]
    return Join(alias, table, [(f"{left_alias}.{left_key or fkey}", dkey)])


_COL = re.compile(r"^(\w+)\.(\w+)(?:\s+AS\s+(\w+))?$", re.I)


def build_view(m, spec: ViewSpec):
    df = m[spec.source].alias("f")
    for j in spec.joins:
        right = m[j.table].alias(j.alias)
        cond = None
        for left, rcol in j.on:
            c = F.col(left) == F.col(f"{j.alias}.{rcol}")
            cond = c if cond is None else cond & c
        df = df.join(right, cond, "left")
    if spec.where:
        df = df.where(spec.where)
    out = []
    for c in spec.cols:
        mm = _COL.match(c)
        if mm:
            out.append(F.col(f"{mm.group(1)}.{mm.group(2)}").alias(mm.group(3) or mm.group(2)))
        else:
            expr, name = c.rsplit(" AS ", 1)
            out.append(F.expr(expr).alias(name))
    return df.select(*out)


def view_sql(spec: ViewSpec) -> str:
    sql = f"SELECT {', '.join(spec.cols)}\nFROM {spec.source} f"
    for j in spec.joins:
        on = " AND ".join(f"{left} = {j.alias}.{rcol}" for left, rcol in j.on)
        sql += f"\nLEFT JOIN {j.table} {j.alias} ON {on}"
    if spec.where:
        sql += f"\nWHERE {spec.where}"
    return sql


VIEWS: dict[str, ViewSpec] = {}


def add(spec: ViewSpec):
    VIEWS[spec.name] = spec
    register(spec.name, spec.layer, lambda m, s=spec: build_view(m, s), view_sql(spec))


def J(alias: str, table: str, left: str, right: str) -> Join:
    return Join(alias, table, [(left, right)])


def V(name: str, source: str, joins: list[Join], cols: list[tuple[str, ...]], extra: tuple[str, ...] = (),
      where: str | None = None, layer: str = "view") -> ViewSpec:
    """``cols``: (alias, column), or (alias, column, name) under another name;
    ``extra``: SQL expressions valid in Spark and DuckDB (``<expr> AS name``)."""
    toks = [f"{c[0]}.{c[1]}" + (f" AS {c[2]}" if len(c) == 3 else "") for c in cols]
    spec = ViewSpec(name, source, [*toks, *extra], joins, where=where, layer=layer)
    add(spec)
    return spec


def governed(name: str, spec: ViewSpec) -> ViewSpec:
    """Register the governed (role-scoped) twin of an analyst view."""
    twin = ViewSpec(name, spec.source, list(spec.cols), spec.joins, where=spec.where, layer="governed")
    add(twin)
    return twin


P = J("p", "dim_property", "f.property_id", "property_id")
OUTLET = [J("o", "dim_outlet", "f.outlet_id", "outlet_id"), J("p", "dim_property", "o.property_id", "property_id")]
ROOM = [J("r", "dim_room", "f.room_id", "room_id"), J("p", "dim_property", "r.property_id", "property_id"),
        J("rt", "dim_room_type", "r.room_type_id", "room_type_id")]
EMP = [J("e", "dim_employee", "f.employee_id", "employee_id"), J("p", "dim_property", "e.property_id", "property_id"),
       J("d", "dim_department", "e.department_id", "department_id")]
VENUE = [J("v", "dim_venue", "f.venue_id", "venue_id"), J("p", "dim_property", "v.property_id", "property_id"),
         J("vt", "dim_venue_type", "v.venue_type_id", "venue_type_id")]


def dj(alias):
    return std_join(alias)


# SLA hours per ticket priority.
SLA_HOURS = {"critical": 8, "high": 24, "medium": 48, "low": 72}
_SLA = "CASE pr.priority_name " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in SLA_HOURS.items()) + " END"
SLA_COLS = (f"cast({_SLA} AS bigint) AS sla_threshold_hours",
            f"CASE WHEN f.avg_sla_duration_hours IS NULL THEN NULL ELSE f.avg_sla_duration_hours > {_SLA} END "
            f"AS avg_exceeds_sla_threshold")
NOT_PL_ROWS = "bl.line_name NOT IN ('Overall', 'Corporate Overhead')"

# ---------------------------------------------------------------------------
# Analyst views EA1-EA48 (reservation, fnb, facility, spa/event, hr, finance)
# ---------------------------------------------------------------------------
EA = {}
EA["v_revenue_room_type_daily"] = V(
    "v_revenue_room_type_daily", "fact_revenue_room_type_daily", [P, dj("rt")],
    [("f", "property_id"), ("p", "property_name"), ("p", "region"), ("rt", "room_type_name"), ("f", "period_date"),
     ("f", "rooms_sold"), ("f", "total_rooms_available"), ("f", "occupancy_rate"), ("f", "adr"), ("f", "revpar"),
     ("f", "revenue"), ("f", "room_type_revenue_share_pct")])
EA["v_revenue_channel_daily"] = V(
    "v_revenue_channel_daily", "fact_revenue_channel_daily", [P, dj("c")],
    [("f", "property_id"), ("p", "property_name"), ("p", "region"), ("c", "channel_name"), ("f", "period_date"),
     ("f", "revenue"), ("f", "bookings_count"), ("f", "cancellations_count"), ("f", "no_shows_count")])
EA["v_revenue_los_daily"] = V(
    "v_revenue_los_daily", "fact_revenue_los_daily", [P, dj("rt"), dj("c")],
    [("f", "property_id"), ("p", "property_name"), ("rt", "room_type_name"), ("c", "channel_name"),
     ("f", "period_date"), ("f", "avg_los_nights"), ("f", "median_los_nights")])
EA["v_revenue_property_daily"] = V(
    "v_revenue_property_daily", "fact_revenue_property_daily", [P],
    [("f", "property_id"), ("p", "property_name"), ("p", "region"), ("f", "period_date"),
     ("f", "avg_lead_time_days"), ("f", "median_lead_time_days"), ("f", "mom_occupancy_growth"),
     ("f", "yoy_occupancy_growth"), ("f", "mom_adr_growth"), ("f", "yoy_adr_growth"), ("f", "mom_revpar_growth"),
     ("f", "yoy_revpar_growth"), ("f", "repeat_guest_rate"), ("f", "revpar_rank_group"), ("f", "adr_rank_group"),
     ("f", "occupancy_rank_group")])
EA["v_revenue_gop_impact_monthly"] = V(
    "v_revenue_gop_impact_monthly", "fact_revenue_gop_impact_monthly", [P],
    [("f", "property_id"), ("p", "property_name"), ("f", "period_date"), ("f", "avg_pricing_deviation"),
     ("f", "gop_margin")])
EA["v_revenue_pricing_deviation"] = V(
    "v_revenue_pricing_deviation", "fact_revenue_pricing_deviation", [P, dj("r")],
    [("f", "property_id"), ("p", "property_name"), ("r", "reason_name"), ("f", "period_date"),
     ("f", "avg_applied_rate"), ("f", "avg_base_rate"), ("f", "avg_deviation_pct"), ("f", "day_share_pct")])
EA["v_revenue_loyalty_daily"] = V(
    "v_revenue_loyalty_daily", "fact_revenue_loyalty_daily", [P, dj("lt")],
    [("f", "property_id"), ("p", "property_name"), ("lt", "loyalty_tier_name"), ("f", "period_date"),
     ("f", "bookings_count"), ("f", "revenue")])
EA["v_revenue_nationality_daily"] = V(
    "v_revenue_nationality_daily", "fact_revenue_nationality_daily", [P, dj("ng")],
    [("f", "property_id"), ("p", "property_name"), ("ng", "group_name", "nationality_group_name"),
     ("f", "period_date"), ("f", "bookings_count"), ("f", "revenue")])

EA["v_fnb_outlet_daily"] = V(
    "v_fnb_outlet_daily", "fact_fnb_outlet_daily", OUTLET + [J("ot", "dim_outlet_type", "o.outlet_type_id",
                                                               "outlet_type_id")],
    [("o", "property_id"), ("p", "property_name"), ("f", "outlet_id"), ("o", "outlet_name"),
     ("ot", "outlet_type_name"), ("f", "period_date"), ("f", "revenue"), ("f", "transaction_count"),
     ("f", "avg_check"), ("f", "mom_revenue_growth"), ("f", "yoy_revenue_growth"), ("f", "capture_rate"),
     ("f", "walk_in_ratio"), ("f", "revenue_rank_vs_outlet_type_avg")])
EA["v_fnb_category_daily"] = V(
    "v_fnb_category_daily", "fact_fnb_category_daily", OUTLET + [dj("cat")],
    [("o", "property_id"), ("p", "property_name"), ("f", "outlet_id"), ("o", "outlet_name"),
     ("cat", "category_name"), ("f", "period_date"), ("f", "revenue")])
EA["v_fnb_hourly"] = V(
    "v_fnb_hourly", "fact_fnb_hourly", OUTLET,
    [("o", "property_id"), ("p", "property_name"), ("f", "outlet_id"), ("o", "outlet_name"), ("f", "period_date"),
     ("f", "hour_of_day"), ("f", "transaction_count")])
EA["v_fnb_customer_type_daily"] = V(
    "v_fnb_customer_type_daily", "fact_fnb_customer_type_daily", OUTLET + [dj("ct")],
    [("o", "property_id"), ("p", "property_name"), ("f", "outlet_id"), ("o", "outlet_name"),
     ("ct", "customer_type_name"), ("f", "period_date"), ("f", "revenue"), ("f", "visit_count"),
     ("f", "revenue_per_visit")])
EA["v_fnb_menu_item_daily"] = V(
    "v_fnb_menu_item_daily", "fact_fnb_menu_item_daily", OUTLET,
    [("o", "property_id"), ("p", "property_name"), ("f", "outlet_id"), ("o", "outlet_name"), ("f", "item_name"),
     ("f", "period_date"), ("f", "revenue"), ("f", "quantity_sold"), ("f", "food_cost_ratio_actual"),
     ("f", "food_cost_ratio_target"), ("f", "food_cost_deviation")])
EA["v_fnb_waste_daily"] = V(
    "v_fnb_waste_daily", "fact_fnb_waste_daily", OUTLET + [dj("wr")],
    [("o", "property_id"), ("p", "property_name"), ("f", "outlet_id"), ("o", "outlet_name"), ("wr", "reason_name"),
     ("f", "period_date"), ("f", "waste_value"), ("f", "waste_quantity"), ("f", "waste_ratio")])
EA["v_fnb_inventory_status"] = V(
    "v_fnb_inventory_status", "fact_fnb_inventory_status", OUTLET,
    [("o", "property_id"), ("p", "property_name"), ("f", "outlet_id"), ("o", "outlet_name"), ("f", "period_date"),
     ("f", "low_stock_item_count")])
EA["v_fnb_ingredient_price_daily"] = V(
    "v_fnb_ingredient_price_daily", "fact_fnb_ingredient_price_daily", [],
    [("f", "ingredient_id"), ("f", "period_date"), ("f", "avg_unit_cost")])

EA["v_facility_room_status_daily"] = V(
    "v_facility_room_status_daily", "fact_facility_room_status_daily", ROOM,
    [("r", "property_id"), ("p", "property_name"), ("f", "room_id"), ("rt", "room_type_name"), ("f", "period_date"),
     ("f", "status"), ("f", "is_out_of_order")])
EA["v_housekeeping_room_type_daily"] = V(
    "v_housekeeping_room_type_daily", "fact_housekeeping_room_type_daily", [P, dj("rt")],
    [("f", "property_id"), ("p", "property_name"), ("rt", "room_type_name"), ("f", "period_date"),
     ("f", "avg_cleaning_duration_minutes"), ("f", "baseline_duration_minutes")])
EA["v_housekeeping_property_daily"] = V(
    "v_housekeeping_property_daily", "fact_housekeeping_property_daily", [P],
    [("f", "property_id"), ("p", "property_name"), ("f", "period_date"), ("f", "delayed_rate"),
     ("f", "occupancy_rate")])
EA["v_housekeeping_staff_daily"] = V(
    "v_housekeeping_staff_daily", "fact_housekeeping_staff_daily", [dj("e")],
    [("f", "staff_id"), ("e", "full_name", "staff_name"), ("f", "period_date"),
     ("f", "avg_cleaning_duration_minutes"), ("f", "team_avg_duration_minutes")])
EA["v_maintenance_ticket_daily"] = V(
    "v_maintenance_ticket_daily", "fact_maintenance_ticket_daily", [P, dj("fa"), dj("it"), dj("pr")],
    [("f", "property_id"), ("p", "property_name"), ("fa", "facility_area_name"), ("it", "issue_type_name"),
     ("pr", "priority_name"), ("f", "period_date"), ("f", "new_ticket_count"), ("f", "avg_sla_duration_hours"),
     ("f", "pending_count")], extra=SLA_COLS)
EA["v_maintenance_cost_daily"] = V(
    "v_maintenance_cost_daily", "fact_maintenance_cost_daily", [P, dj("it")],
    [("f", "property_id"), ("p", "property_name"), ("it", "issue_type_name"), ("f", "period_date"),
     ("f", "total_cost"), ("f", "cost_with_parts"), ("f", "cost_without_parts"), ("f", "mom_cost_growth"),
     ("f", "yoy_cost_growth")])
EA["v_maintenance_room_recurrence_yearly"] = V(
    "v_maintenance_room_recurrence_yearly", "fact_maintenance_room_recurrence_yearly", ROOM,
    [("r", "property_id"), ("p", "property_name"), ("f", "room_id"), ("rt", "room_type_name"), ("f", "year"),
     ("f", "ticket_count"), ("f", "vs_median_ratio")])
EA["v_maintenance_property_benchmark_yearly"] = V(
    "v_maintenance_property_benchmark_yearly", "fact_maintenance_property_benchmark_yearly", [P],
    [("f", "property_id"), ("p", "property_name"), ("f", "year"), ("f", "tickets_per_room"),
     ("f", "building_age_years"), ("f", "tickets_per_room_normalized")])
EA["v_maintenance_technician_daily"] = V(
    "v_maintenance_technician_daily", "fact_maintenance_technician_daily",
    [J("e", "dim_employee", "f.assigned_staff_id", "employee_id")],
    [("f", "assigned_staff_id"), ("e", "full_name", "technician_name"), ("f", "period_date"), ("f", "ticket_count"),
     ("f", "labor_hours")])

EA["v_spa_daily"] = V(
    "v_spa_daily", "fact_spa_daily", [P],
    [("f", "property_id"), ("p", "property_name"), ("f", "period_date"), ("f", "revenue"), ("f", "booking_count"),
     ("f", "walk_in_ratio"), ("f", "avg_lead_time_days"), ("f", "median_lead_time_days"),
     ("f", "cancellation_rate")])
EA["v_spa_customer_type_daily"] = V(
    "v_spa_customer_type_daily", "fact_spa_customer_type_daily", [P, dj("ct")],
    [("f", "property_id"), ("p", "property_name"), ("ct", "customer_type_name"), ("f", "period_date"),
     ("f", "revenue"), ("f", "visit_count"), ("f", "revenue_per_visit")])
EA["v_spa_service_daily"] = V(
    "v_spa_service_daily", "fact_spa_service_daily", [P, dj("sv")],
    [("f", "property_id"), ("p", "property_name"), ("sv", "service_name"), ("f", "period_date"),
     ("f", "booking_count"), ("f", "revenue"), ("f", "revenue_share_pct")])
EA["v_event_venue_daily"] = V(
    "v_event_venue_daily", "fact_event_venue_daily", VENUE,
    [("v", "property_id"), ("p", "property_name"), ("f", "venue_id"), ("v", "venue_name"),
     ("vt", "venue_type_name"), ("v", "max_capacity"), ("f", "period_date"), ("f", "bookings_pipeline_count"),
     ("f", "revenue_pipeline"), ("f", "utilization_rate"), ("f", "mom_revenue_growth"), ("f", "yoy_revenue_growth"),
     ("f", "low_utilization_days_last_30")])
EA["v_event_property_daily"] = V(
    "v_event_property_daily", "fact_event_property_daily", [P],
    [("f", "property_id"), ("p", "property_name"), ("f", "period_date"), ("f", "cancellation_rate")])
EA["v_event_type_daily"] = V(
    "v_event_type_daily", "fact_event_type_daily", [P, dj("et")],
    [("f", "property_id"), ("p", "property_name"), ("et", "event_type_name"), ("f", "period_date"),
     ("f", "event_count"), ("f", "revenue")])

EA["v_hr_attendance_daily"] = V(
    "v_hr_attendance_daily", "fact_hr_attendance_daily", [P, dj("d")],
    [("f", "property_id"), ("p", "property_name"), ("d", "department_name"), ("f", "period_date"),
     ("f", "present_count"), ("f", "late_count"), ("f", "leave_count"), ("f", "absent_count"),
     ("f", "overtime_hours_total")])
EA["v_hr_employee_monthly"] = V(
    "v_hr_employee_monthly", "fact_hr_employee_monthly", EMP,
    [("f", "employee_id"), ("e", "full_name"), ("d", "department_name"), ("f", "period_date"),
     ("f", "overtime_hours"), ("f", "overtime_vs_dept_avg"), ("f", "late_rate"), ("f", "late_vs_dept_avg"),
     ("e", "property_id"), ("p", "property_name")])
EA["v_hr_employee_performance_semester"] = V(
    "v_hr_employee_performance_semester", "fact_hr_employee_performance_semester", EMP,
    [("f", "employee_id"), ("e", "full_name"), ("d", "department_name"), ("f", "review_period"), ("f", "score"),
     ("f", "notes"), ("e", "property_id"), ("p", "property_name")])
EA["v_hr_turnover_snapshot"] = V(
    "v_hr_turnover_snapshot", "fact_hr_turnover_snapshot", [P, dj("d")],
    [("f", "property_id"), ("p", "property_name"), ("d", "department_name"), ("f", "period_date"),
     ("f", "turnover_rate")])
EA["v_hr_headcount_status_daily"] = V(
    "v_hr_headcount_status_daily", "fact_hr_headcount_status_daily", [P, dj("d"), dj("st")],
    [("f", "property_id"), ("p", "property_name"), ("d", "department_name"), ("st", "status_name"),
     ("f", "period_date"), ("f", "employee_count")])
EA["v_hr_performance_department_semester"] = V(
    "v_hr_performance_department_semester", "fact_hr_performance_department_semester", [P, dj("d")],
    [("f", "property_id"), ("p", "property_name"), ("d", "department_name"), ("f", "review_period"),
     ("f", "avg_performance_score")])
EA["v_hr_performance_by_status_semester"] = V(
    "v_hr_performance_by_status_semester", "fact_hr_performance_by_status_semester", [P, dj("st")],
    [("f", "property_id"), ("p", "property_name"), ("st", "status_name"), ("f", "review_period"),
     ("f", "avg_performance_score")])
EA["v_hr_watchlist_monthly"] = V(
    "v_hr_watchlist_monthly", "fact_hr_watchlist_monthly", EMP,
    [("f", "employee_id"), ("e", "full_name"), ("d", "department_name"), ("f", "period_date"),
     ("f", "current_absence_rate"), ("f", "baseline_absence_rate"), ("f", "current_late_rate"),
     ("f", "baseline_late_rate"), ("f", "absence_deviation_ratio"), ("f", "late_deviation_ratio"),
     ("f", "in_watchlist"), ("e", "property_id"), ("p", "property_name")])

EA["v_financial_departmental_margin"] = V(
    "v_financial_departmental_margin", "fact_financial_business_line_monthly", [P, dj("bl")],
    [("f", "property_id"), ("p", "property_name"), ("bl", "line_name", "business_line_name"), ("f", "period_date"),
     ("f", "revenue"), ("f", "expense"), ("f", "profit"), ("f", "margin_pct")], where=NOT_PL_ROWS)
EA["v_financial_gop_overhead"] = V(
    "v_financial_gop_overhead", "fact_financial_overall_monthly", [P],
    [("f", "property_id"), ("p", "property_name"), ("f", "period_date"), ("f", "gop"), ("f", "gop_margin_pct"),
     ("f", "mom_gop_growth"), ("f", "yoy_gop_growth"), ("f", "undistributed_expense_total"),
     ("f", "overhead_ratio")])
EA["v_financial_revenue_runrate_daily"] = V(
    "v_financial_revenue_runrate_daily", "fact_financial_revenue_runrate_daily", [P],
    [("f", "property_id"), ("p", "property_name"), ("f", "period_date"), ("f", "revenue_runrate")])
EA["v_payroll_department_monthly"] = V(
    "v_payroll_department_monthly", "fact_payroll_department_monthly", [P, dj("d")],
    [("f", "property_id"), ("p", "property_name"), ("d", "department_name"), ("f", "period_date"),
     ("f", "base_salary_total"), ("f", "service_charge_total"), ("f", "overtime_pay_total"), ("f", "thr_total"),
     ("f", "deduction_total"), ("f", "net_salary_total"), ("f", "mom_growth")])
EA["v_financial_service_charge_monthly"] = V(
    "v_financial_service_charge_monthly", "fact_financial_service_charge_monthly", [P],
    [("f", "property_id"), ("p", "property_name"), ("f", "period_date"), ("f", "service_charge_pool"),
     ("f", "occupancy_rate")])
EA["v_financial_labor_cost_monthly"] = V(
    "v_financial_labor_cost_monthly", "fact_financial_labor_cost_monthly", [P],
    [("f", "property_id"), ("p", "property_name"), ("f", "period_date"), ("f", "labor_cost_pct_revenue")])
EA["v_payroll_access_level_monthly"] = V(
    "v_payroll_access_level_monthly", "fact_payroll_access_level_monthly", [P, dj("al")],
    [("f", "property_id"), ("p", "property_name"), ("al", "access_level_name"), ("f", "period_date"),
     ("f", "service_charge_total"), ("f", "base_salary_total"), ("f", "service_charge_to_base_ratio")])
EA["v_financial_business_line_group_monthly"] = V(
    "v_financial_business_line_group_monthly", "fact_financial_business_line_group_monthly", [dj("bl")],
    [("bl", "line_name", "business_line_name"), ("f", "period_date"), ("f", "group_revenue"),
     ("f", "revenue_share_pct")])
EA["v_financial_property_benchmark_monthly"] = V(
    "v_financial_property_benchmark_monthly", "fact_financial_property_benchmark_monthly", [P],
    [("f", "property_id"), ("p", "property_name"), ("f", "period_date"), ("f", "gop_margin_rank")])

# ---------------------------------------------------------------------------
# Governed views EG1-EG67: aggregate twins, row-level lookups, directories
# ---------------------------------------------------------------------------
_RES_TWINS = {"room_type_daily": "room_type_daily", "channel_daily": "channel_daily", "los_daily": "los_daily",
              "property_daily": "property_daily", "gop_impact_monthly": "gop_impact_monthly",
              "pricing_deviation": "pricing_deviation", "loyalty_daily": "loyalty_daily",
              "nationality_daily": "nationality_daily"}
for _k in _RES_TWINS:
    governed(f"gov_v_reservation_{_k}", EA[f"v_revenue_{_k}"])
for _n in ("v_fnb_outlet_daily", "v_fnb_category_daily", "v_fnb_hourly", "v_fnb_customer_type_daily",
           "v_fnb_menu_item_daily", "v_fnb_waste_daily", "v_fnb_inventory_status", "v_fnb_ingredient_price_daily",
           "v_facility_room_status_daily", "v_housekeeping_room_type_daily", "v_housekeeping_property_daily",
           "v_maintenance_ticket_daily", "v_maintenance_cost_daily", "v_maintenance_room_recurrence_yearly",
           "v_maintenance_property_benchmark_yearly", "v_spa_daily", "v_spa_customer_type_daily",
           "v_spa_service_daily", "v_event_venue_daily", "v_event_property_daily", "v_event_type_daily",
           "v_hr_attendance_daily", "v_hr_employee_monthly", "v_hr_employee_performance_semester",
           "v_hr_turnover_snapshot", "v_hr_headcount_status_daily", "v_hr_performance_department_semester",
           "v_hr_performance_by_status_semester", "v_hr_watchlist_monthly", "v_financial_departmental_margin",
           "v_financial_gop_overhead", "v_financial_revenue_runrate_daily", "v_payroll_department_monthly",
           "v_financial_service_charge_monthly", "v_financial_labor_cost_monthly", "v_payroll_access_level_monthly",
           "v_financial_business_line_group_monthly", "v_financial_property_benchmark_monthly"):
    governed(f"gov_{_n}", EA[_n])

# staff-level facility views also expose the employee's property for scoping
V("gov_v_housekeeping_staff_daily", "fact_housekeeping_staff_daily", [dj("e")],
  [("f", "staff_id"), ("e", "full_name", "staff_name"), ("f", "period_date"),
     ("f", "avg_cleaning_duration_minutes"), ("f", "team_avg_duration_minutes"), ("e", "property_id")], layer="governed")
V("gov_v_maintenance_technician_daily", "fact_maintenance_technician_daily",
  [J("e", "dim_employee", "f.assigned_staff_id", "employee_id")],
  [("f", "assigned_staff_id"), ("e", "full_name", "technician_name"), ("f", "period_date"), ("f", "ticket_count"),
     ("f", "labor_hours"), ("e", "property_id")],
  layer="governed")

# row-level lookups over cleaned tables
V("gov_v_lookup_bookings", "bookings", [],
  [("f", "booking_id"), ("f", "property_id"), ("f", "guest_id"), ("f", "room_type"), ("f", "booking_channel"),
     ("f", "check_in_date"), ("f", "check_out_date"), ("f", "booking_date"), ("f", "nights"), ("f", "room_rate"),
     ("f", "total_amount"), ("f", "status")], layer="governed")
V("gov_v_lookup_daily_occupancy", "daily_occupancy", [],
  [("f", "property_id"), ("f", "room_type"), ("f", "date"), ("f", "rooms_sold"), ("f", "adr"),
     ("f", "total_rooms_available"), ("f", "occupancy_rate"), ("f", "revpar")],
  layer="governed")
V("gov_v_lookup_fnb_inventory", "fnb_inventory", [J("o", "fnb_outlets", "f.outlet_id", "outlet_id")],
  [("f", "outlet_id"), ("f", "ingredient_id"), ("f", "ingredient_name"), ("f", "unit"), ("f", "stock_current"),
     ("f", "stock_min_threshold"), ("f", "unit_cost"), ("o", "property_id")], layer="governed")
V("gov_v_lookup_fnb_transactions", "fnb_transactions", [J("o", "fnb_outlets", "f.outlet_id", "outlet_id")],
  [("f", "transaction_id"), ("f", "outlet_id"), ("f", "guest_id"), ("f", "customer_type"),
     ("f", "transaction_datetime"), ("f", "item_name"), ("f", "category"), ("f", "quantity"), ("f", "unit_price"),
     ("f", "total_price"), ("o", "property_id")], layer="governed")
V("gov_v_lookup_recipe_bom", "recipe_bom", [], [("f", "item_name"), ("f", "ingredient_id"), ("f", "qty_per_portion")], layer="governed")
V("gov_v_lookup_rooms", "rooms", [], [("f", "room_id"), ("f", "property_id"), ("f", "room_number"), ("f", "room_type"), ("f", "floor"),
     ("f", "status")],
  layer="governed")
V("gov_v_lookup_housekeeping_log", "housekeeping_log", [J("r", "rooms", "f.room_id", "room_id")],
  [("f", "log_id"), ("f", "room_id"), ("f", "date"), ("f", "cleaning_start_time"), ("f", "cleaning_end_time"),
     ("f", "staff_id"), ("f", "status"), ("r", "property_id")],
  layer="governed")
V("gov_v_lookup_maintenance_tickets", "maintenance_tickets", [],
  [("f", "ticket_id"), ("f", "property_id"), ("f", "room_id"), ("f", "facility_area"), ("f", "issue_type"),
     ("f", "reported_date"), ("f", "resolved_date"), ("f", "status"), ("f", "priority"), ("f", "assigned_staff_id"),
     ("f", "labor_hours"), ("f", "parts_replaced"), ("f", "cost")], layer="governed")
V("gov_v_lookup_spa_bookings", "spa_bookings", [],
  [("f", "spa_booking_id"), ("f", "property_id"), ("f", "guest_id"), ("f", "customer_type"),
     ("f", "service_name"), ("f", "booking_date"), ("f", "service_date"), ("f", "duration_minutes"), ("f", "price"),
     ("f", "status")], layer="governed")
V("gov_v_lookup_event_bookings", "event_bookings", [],
  [("f", "event_id"), ("f", "property_id"), ("f", "venue_id"), ("f", "client_name"), ("f", "event_type"),
     ("f", "event_date"), ("f", "venue_name"), ("f", "capacity_booked"), ("f", "total_revenue"), ("f", "status")], layer="governed")
V("gov_v_lookup_venues", "venues", [], [("f", "venue_id"), ("f", "property_id"), ("f", "venue_name"), ("f", "venue_type"), ("f", "max_capacity")],
  layer="governed")
V("gov_v_lookup_staff_shifts", "staff_shifts", [J("e", "employees", "f.employee_id", "employee_id")],
  [("f", "shift_id"), ("f", "employee_id"), ("e", "property_id"), ("f", "date"), ("f", "shift_type"),
     ("f", "clock_in"), ("f", "clock_out"), ("f", "status")], layer="governed")
V("gov_v_lookup_employee_performance", "employee_performance", [J("e", "employees", "f.employee_id", "employee_id")],
  [("f", "review_id"), ("f", "employee_id"), ("e", "property_id"), ("f", "review_period"), ("f", "score"),
     ("f", "notes")], layer="governed")
V("gov_v_lookup_financial_summary", "financial_summary", [],
  [("f", "property_id"), ("f", "period"), ("f", "department"), ("f", "departmental_revenue"),
     ("f", "departmental_expense"), ("f", "departmental_profit"), ("f", "undistributed_expense"), ("f", "gop")], layer="governed")
V("gov_v_lookup_payroll", "payroll", [J("e", "employees", "f.employee_id", "employee_id")],
  [("f", "payroll_id"), ("f", "employee_id"), ("f", "period"), ("f", "base_salary"), ("f", "service_charge"),
     ("f", "overtime_pay"), ("f", "thr"), ("f", "deduction"), ("f", "net_salary"), ("e", "property_id")], layer="governed")
V("gov_v_properties_ref", "dim_property", [], [("f", "property_id"), ("f", "property_name"), ("f", "region"), ("f", "opening_date")],
  layer="governed")
V("gov_v_employees_directory", "dim_employee",
  [J("p", "dim_property", "f.property_id", "property_id"), J("d", "dim_department", "f.department_id", "department_id"),
   J("al", "dim_access_level", "f.access_level_id", "access_level_id")],
  [("f", "employee_id"), ("f", "full_name"), ("f", "property_id"), ("p", "property_name"),
     ("d", "department_name"), ("al", "access_level_name")],
  layer="governed")


# guests split into contact (PII) and profile views, both carrying the
# property of the guest's most recent activity
_LAP_SQL = """WITH c AS (
  SELECT guest_id, property_id, booking_date AS activity_date FROM bookings WHERE guest_id IS NOT NULL
  UNION ALL SELECT guest_id, property_id, booking_date FROM spa_bookings WHERE guest_id IS NOT NULL),
l AS (SELECT guest_id, property_id AS last_active_property_id FROM (
  SELECT *, row_number() OVER (PARTITION BY guest_id ORDER BY activity_date DESC, property_id DESC) AS rn FROM c) x
  WHERE rn = 1)
SELECT {cols}, l.last_active_property_id FROM guests g LEFT JOIN l ON l.guest_id = g.guest_id"""


def last_active_property(m):
    """Latest activity per guest over bookings and spa visits (S16: on equal
    dates the larger property id wins). A max over a (date, property) struct is
    a partial aggregation, so a guest with a huge history costs one row per
    task, not a sorted window partition."""
    acts = [m[t].where(F.col("guest_id").isNotNull())
            .select("guest_id", "property_id", F.col("booking_date").alias("activity_date"))
            for t in ("bookings", "spa_bookings")]
    u = acts[0].unionByName(acts[1])
    return (u.groupBy("guest_id").agg(F.max(F.struct("activity_date", "property_id")).alias("__last"))
            .select("guest_id", F.col("__last.property_id").alias("last_active_property_id")))


def _guest_view(cols):
    def build(m):
        return (m["guests"].select(*cols)
                .join(last_active_property(m), "guest_id", "left")
                .select(*cols, "last_active_property_id"))
    return build


_CONTACT = ["guest_id", "full_name", "email", "phone"]
_PROFILE = ["guest_id", "loyalty_tier", "nationality", "registered_date"]
register("gov_guests_contact_view", "governed", _guest_view(_CONTACT),
         _LAP_SQL.format(cols=", ".join(f"g.{c}" for c in _CONTACT)))
register("gov_guests_profile_view", "governed", _guest_view(_PROFILE),
         _LAP_SQL.format(cols=", ".join(f"g.{c}" for c in _PROFILE)))
