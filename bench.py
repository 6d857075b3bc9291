"""Benchmark: headline mart builds, operator queries and serving lookups.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Each query is fully computed into Spark's ``noop`` sink (no driver collect);
serving lookups read a table written once in the A13 layout (range-partitioned
and sorted by entity/date) with a pushed-down entity + period filter.
Timings are steady-state: every query runs once untimed first (JVM JIT,
generated-code cache, Parquet footers), then once timed; the first (cold)
pass total is reported as ``cold_total``.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "fact_revenue_room_type_daily", "fact_revenue_property_daily", "fact_revenue_loyalty_daily",
    "fact_fnb_outlet_daily", "fact_fnb_menu_item_daily", "fact_fnb_waste_daily", "fact_fnb_hourly",
    "fact_maintenance_ticket_daily", "fact_event_venue_daily", "fact_spa_daily",
    "fact_financial_revenue_runrate_daily", "fact_financial_labor_cost_monthly",
    "fact_hr_attendance_daily", "fact_hr_employee_monthly", "fact_hr_watchlist_monthly",
    "v_fnb_outlet_daily", "gov_guests_contact_view", "access_fnb_outlet_daily_own_property",
    "dq_results", "monitor_volume_anomaly", "monitor_value_anomaly", "ml_predictions",
]

# Serving lookups, one per access path of the serving store (one per lookup
# of the reference's published serving timings). A period is a month
# "YYYY-MM" (date columns), a year (int), or an exact text value.
LOOKUP_PERIODS = {"year": 1998, "review_period": "2024-S1"}
LOOKUP_ENTITIES = {"property_id": "P01", "outlet_id": "OUT001", "ingredient_id": "ING002", "staff_id": "E000007",
                   "assigned_staff_id": "E000007", "room_id": "RM0007", "venue_id": "VN001",
                   "employee_id": "E000007", "business_line_id": 1}


def _lookups():
    """(table, entity col, entity value, period col, period) for every serving
    access path of the library (publish.SERVING_LAYOUTS)."""
    from innspark.plans.publish import SERVING_LAYOUTS
    out = []
    for tbl, (ent, dcol) in SERVING_LAYOUTS.items():
        ent = ent if isinstance(ent, str) else ent[0]  # a lookup names the leading entity
        if dcol in LOOKUP_PERIODS:
            period = LOOKUP_PERIODS[dcol]
        elif dcol == "period":
            period = "1996-07" if tbl == "payroll" else "1997-07"
        elif tbl.startswith(("fact_financial_", "fact_payroll_")) and tbl != "fact_financial_revenue_runrate_daily":
            period = "1996-07" if tbl in ("fact_payroll_department_monthly", "fact_financial_service_charge_monthly",
                                          "fact_financial_labor_cost_monthly",
                                          "fact_payroll_access_level_monthly") else "1997-07"
        else:
            period = "1998-07"
        out.append((tbl, ent, LOOKUP_ENTITIES[ent], dcol, period))
    return out


def _period_filter(F, col, period):
    if col is None:
        return F.lit(True)
    if isinstance(period, int):
        return F.col(col) == period
    if re.fullmatch(r"\d{4}-\d{2}", period) and col not in ("period",):
        y, mth = map(int, period.split("-"))
        lo = dt.date(y, mth, 1)
        hi = dt.date(y + (mth == 12), mth % 12 + 1, 1)
        if col == "transaction_datetime":
            lo, hi = dt.datetime.combine(lo, dt.time()), dt.datetime.combine(hi, dt.time())
        return (F.col(col) >= F.lit(lo)) & (F.col(col) < F.lit(hi))
    return F.col(col) == period


def main():
    from pyspark.sql import functions as F

    from innspark.plans.publish import SERVING_LAYOUTS, serving_layout
    from innspark.plans.registry import Mart
    from innspark.session import get_spark, scratch_dir

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app_name="innspark-bench")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    def run(q):
        t0 = time.perf_counter()
        Mart(spark, sf_dir)[q].write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t0, 3)

    cold = {q: run(q) for q in HEADLINE}
    times = {q: run(q) for q in HEADLINE}

    # serving lookups over tables written once in the serving layout
    base = scratch_dir(spark, f"bench-{uuid.uuid4().hex[:8]}")
    mart = Mart(spark, sf_dir)
    lookups = {}
    for tbl, ent, val, dcol, period in _lookups():
        path = f"{base}/{tbl}"
        serving_layout(mart[tbl], SERVING_LAYOUTS[tbl][0], dcol or ent).write.mode("overwrite").parquet(path)
        pred = (F.col(ent) == val) & _period_filter(F, dcol, period)
        spark.read.parquet(path).where(pred).write.format("noop").mode("overwrite").save()  # warm
        t0 = time.perf_counter()
        spark.read.parquet(path).where(pred).write.format("noop").mode("overwrite").save()
        lookups[f"lookup_{tbl}"] = round(time.perf_counter() - t0, 3)
    times.update(lookups)

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": times,
                      "sf": sf, "cpus": cpus, "cold_total": round(sum(cold.values()), 3),
                      "lookups_total": round(sum(lookups.values()), 3),
                      "lookup_median_ms": round(sorted(lookups.values())[len(lookups) // 2] * 1000, 1)}))


if __name__ == "__main__":
    main()
