"""Dimensions C1-C27.

Surrogate ids are ``row_number`` over the sorted distinct values (S3: ids are
stable within one build only). The distinct runs distributed (hash aggregate
with map-side combine); only the distinct value list — bounded by the
category's domain, not by the data volume — is numbered in one ordered pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from innspark.plans.registry import model, register


def surrogate_dim(values: DataFrame, column: str, id_name: str, name_col: str) -> DataFrame:
    distinct = values.select(column).where(F.col(column).isNotNull()).distinct()
    return distinct.select(
        F.row_number().over(Window.orderBy(F.col(column).asc())).cast("bigint").alias(id_name),
        F.col(column).alias(name_col))


def surrogate_sql(source_sql: str, column: str, id_name: str, name_col: str) -> str:
    return (f"SELECT cast(row_number() OVER (ORDER BY {column}) AS bigint) AS {id_name}, "
            f"{column} AS {name_col} FROM (SELECT DISTINCT {column} FROM ({source_sql}) s "
            f"WHERE {column} IS NOT NULL) d")


# (dimension, source table, column, id column, name column)
SURROGATE_DIMS = [
    ("dim_department", "employees", "department", "department_id", "department_name"),
    ("dim_facility_area", "maintenance_tickets", "facility_area", "facility_area_id", "facility_area_name"),
    ("dim_issue_type", "maintenance_tickets", "issue_type", "issue_type_id", "issue_type_name"),
    ("dim_priority", "maintenance_tickets", "priority", "priority_id", "priority_name"),
    ("dim_fnb_category", "fnb_transactions", "category", "category_id", "category_name"),
    ("dim_outlet_type", "fnb_outlets", "outlet_type", "outlet_type_id", "outlet_type_name"),
    ("dim_waste_reason", "fnb_waste_log", "reason", "reason_id", "reason_name"),
    ("dim_access_level", "employees", "access_level", "access_level_id", "access_level_name"),
    ("dim_business_line", "financial_summary", "department", "business_line_id", "line_name"),
    ("dim_employee_status", "employees", "status", "status_id", "status_name"),
    ("dim_shift_type", "staff_shifts", "shift_type", "shift_type_id", "shift_type_name"),
    ("dim_channel", "bookings", "booking_channel", "channel_id", "channel_name"),
    ("dim_loyalty_tier", "guests", "loyalty_tier", "loyalty_tier_id", "loyalty_tier_name"),
    ("dim_pricing_reason", "pricing_history", "reason", "reason_id", "reason_name"),
    ("dim_room_type", "bookings", "room_type", "room_type_id", "room_type_name"),
    ("dim_event_type", "event_bookings", "event_type", "event_type_id", "event_type_name"),
    ("dim_spa_service", "spa_bookings", "service_name", "service_id", "service_name"),
    ("dim_venue_type", "venues", "venue_type", "venue_type_id", "venue_type_name"),
]


def _surrogate_builder(src, column, id_name, name_col):
    return lambda m: surrogate_dim(m[src], column, id_name, name_col)


for _d, _src, _c, _id, _nm in SURROGATE_DIMS:
    register(_d, "dim", _surrogate_builder(_src, _c, _id, _nm),
             surrogate_sql(f"SELECT {_c} FROM {_src}", _c, _id, _nm))


_CT_SQL = surrogate_sql("SELECT customer_type FROM fnb_transactions UNION SELECT customer_type FROM spa_bookings",
                        "customer_type", "customer_type_id", "customer_type_name")


@model("dim_customer_type", "dim", _CT_SQL)
def dim_customer_type(m):
    # UNION DISTINCT of both sources: each side is de-duplicated before the union
    vals = (m["fnb_transactions"].select("customer_type").distinct()
            .unionByName(m["spa_bookings"].select("customer_type").distinct()))
    return surrogate_dim(vals, "customer_type", "customer_type_id", "customer_type_name")


@model("dim_property", "dim", "SELECT property_id, property_name, region, opening_date FROM properties")
def dim_property(m):
    return m["properties"].select("property_id", "property_name", "region", "opening_date")


@model("dim_employee", "dim", """SELECT e.employee_id, e.property_id, trim(e.full_name) AS full_name,
  d.department_id, a.access_level_id
FROM employees e
LEFT JOIN dim_department d ON e.department = d.department_name
LEFT JOIN dim_access_level a ON e.access_level = a.access_level_name""")
def dim_employee(m):
    e, d, a = m["employees"], m["dim_department"], m["dim_access_level"]
    return (e.join(d, e.department == d.department_name, "left")
            .join(a, e.access_level == a.access_level_name, "left")
            .select(e.employee_id, e.property_id, F.trim(e.full_name).alias("full_name"),
                    d.department_id, a.access_level_id))


@model("dim_ingredient", "dim",
       "SELECT DISTINCT ingredient_id FROM ingredient_price_history WHERE ingredient_id IS NOT NULL")
def dim_ingredient(m):
    return m["ingredient_price_history"].select("ingredient_id").where("ingredient_id is not null").distinct()


@model("dim_menu_item", "dim", "SELECT DISTINCT item_name FROM fnb_transactions WHERE item_name IS NOT NULL")
def dim_menu_item(m):
    return m["fnb_transactions"].select("item_name").where("item_name is not null").distinct()


@model("dim_outlet", "dim", """SELECT o.outlet_id, o.outlet_name, o.property_id, ot.outlet_type_id
FROM fnb_outlets o LEFT JOIN dim_outlet_type ot ON o.outlet_type = ot.outlet_type_name""")
def dim_outlet(m):
    o, t = m["fnb_outlets"], m["dim_outlet_type"]
    return (o.join(t, o.outlet_type == t.outlet_type_name, "left")
            .select(o.outlet_id, o.outlet_name, o.property_id, t.outlet_type_id))


# The two nationality groups (1 domestic, 2 foreign).
NATIONALITY_GROUPS = [(1, "Domestik"), (2, "Mancanegara")]


@model("dim_nationality_group", "dim",
       "SELECT * FROM (VALUES (cast(1 AS bigint), 'Domestik'), (cast(2 AS bigint), 'Mancanegara')) "
       "AS t(nationality_group_id, group_name)")
def dim_nationality_group(m):
    return m.spark.createDataFrame(NATIONALITY_GROUPS, "nationality_group_id bigint, group_name string")


@model("dim_room", "dim", """SELECT r.room_id, r.property_id, rt.room_type_id
FROM rooms r LEFT JOIN dim_room_type rt ON r.room_type = rt.room_type_name""")
def dim_room(m):
    r, t = m["rooms"], m["dim_room_type"]
    return r.join(t, r.room_type == t.room_type_name, "left").select(r.room_id, r.property_id, t.room_type_id)


@model("dim_venue", "dim", """SELECT v.venue_id, v.venue_name, v.property_id, vt.venue_type_id, v.max_capacity
FROM venues v LEFT JOIN dim_venue_type vt ON v.venue_type = vt.venue_type_name""")
def dim_venue(m):
    v, t = m["venues"], m["dim_venue_type"]
    return (v.join(t, v.venue_type == t.venue_type_name, "left")
            .select(v.venue_id, v.venue_name, v.property_id, t.venue_type_id, v.max_capacity))
