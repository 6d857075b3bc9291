"""Declared tests of the published dimensions and facts."""

from __future__ import annotations

# Dimension -> its key, which is unique and not null.
DIMENSION_KEYS = {
    "dim_property": "property_id",
    "dim_department": "department_id",
    "dim_access_level": "access_level_id",
    "dim_employee": "employee_id",
    "dim_customer_type": "customer_type_id",
    "dim_room_type": "room_type_id",
    "dim_room": "room_id",
    "dim_channel": "channel_id",
    "dim_loyalty_tier": "loyalty_tier_id",
    "dim_nationality_group": "nationality_group_id",
    "dim_pricing_reason": "reason_id",
    "dim_outlet_type": "outlet_type_id",
    "dim_outlet": "outlet_id",
    "dim_fnb_category": "category_id",
    "dim_menu_item": "item_name",
    "dim_waste_reason": "reason_id",
    "dim_ingredient": "ingredient_id",
    "dim_facility_area": "facility_area_id",
    "dim_issue_type": "issue_type_id",
    "dim_priority": "priority_id",
    "dim_spa_service": "service_id",
    "dim_venue_type": "venue_type_id",
    "dim_venue": "venue_id",
    "dim_event_type": "event_type_id",
    "dim_shift_type": "shift_type_id",
    "dim_employee_status": "status_id",
    "dim_business_line": "business_line_id",
}

# Fact -> columns that are never null.
NOT_NULL = {
    "fact_facility_room_status_daily": ("room_id", "period_date"),
    "fact_housekeeping_room_type_daily": ("property_id", "period_date"),
    "fact_housekeeping_property_daily": ("property_id", "period_date"),
    "fact_housekeeping_staff_daily": ("staff_id", "period_date"),
    "fact_maintenance_ticket_daily": ("property_id", "period_date"),
    "fact_maintenance_cost_daily": ("property_id", "period_date"),
    "fact_maintenance_room_recurrence_yearly": ("room_id", "year"),
    "fact_maintenance_property_benchmark_yearly": ("property_id", "year"),
    "fact_maintenance_technician_daily": ("assigned_staff_id", "period_date"),
    "fact_fnb_outlet_daily": ("outlet_id", "period_date"),
    "fact_fnb_category_daily": ("outlet_id", "period_date"),
    "fact_fnb_hourly": ("outlet_id", "period_date"),
    "fact_fnb_customer_type_daily": ("outlet_id", "period_date"),
    "fact_fnb_menu_item_daily": ("outlet_id", "period_date"),
    "fact_fnb_waste_daily": ("outlet_id", "period_date"),
    "fact_fnb_inventory_status": ("outlet_id", "period_date"),
    "fact_fnb_ingredient_price_daily": ("ingredient_id", "period_date"),
    "fact_financial_business_line_monthly": ("property_id", "period_date"),
    "fact_financial_overall_monthly": ("property_id", "period_date"),
    "fact_financial_revenue_runrate_daily": ("property_id", "period_date"),
    "fact_payroll_department_monthly": ("property_id", "period_date"),
    "fact_financial_service_charge_monthly": ("property_id", "period_date"),
    "fact_financial_labor_cost_monthly": ("property_id", "period_date"),
    "fact_payroll_access_level_monthly": ("property_id", "period_date"),
    "fact_financial_business_line_group_monthly": ("business_line_id", "period_date"),
    "fact_financial_property_benchmark_monthly": ("property_id", "period_date"),
    "fact_hr_attendance_daily": ("property_id", "period_date"),
    "fact_hr_employee_monthly": ("employee_id", "period_date"),
    "fact_hr_employee_performance_semester": ("employee_id", "review_period"),
    "fact_hr_turnover_snapshot": ("property_id", "period_date"),
    "fact_hr_headcount_status_daily": ("property_id", "period_date"),
    "fact_hr_performance_department_semester": ("property_id", "review_period"),
    "fact_hr_performance_by_status_semester": ("property_id", "review_period"),
    "fact_hr_watchlist_monthly": ("employee_id", "period_date", "in_watchlist"),
    "fact_ml_occupancy_forecast_property_room_type": (
        "prediction_id", "property_id", "room_type_id", "target_date", "model_name", "model_version",
        "feature_snapshot_at", "predicted_occupancy_rate"),
    "fact_revenue_room_type_daily": ("property_id", "period_date"),
    "fact_revenue_channel_daily": ("property_id", "period_date"),
    "fact_revenue_los_daily": ("property_id", "period_date"),
    "fact_revenue_property_daily": ("property_id", "period_date"),
    "fact_revenue_gop_impact_monthly": ("property_id", "period_date"),
    "fact_revenue_pricing_deviation": ("property_id", "period_date"),
    "fact_revenue_loyalty_daily": ("property_id", "period_date"),
    "fact_revenue_nationality_daily": ("property_id", "period_date"),
    "fact_revenue_pace_booking_snapshot": ("property_id", "stay_date", "snapshot_date"),
    "fact_spa_daily": ("property_id", "period_date"),
    "fact_spa_customer_type_daily": ("property_id", "period_date"),
    "fact_spa_service_daily": ("property_id", "period_date"),
    "fact_event_venue_daily": ("venue_id", "period_date"),
    "fact_event_property_daily": ("property_id", "period_date"),
    "fact_event_type_daily": ("property_id", "period_date"),
}

# Further unique columns.
UNIQUE = {"fact_ml_occupancy_forecast_property_room_type": ("prediction_id",)}

# Fixed values: (model, column, dimension whose column of that name has every value).
RELATIONSHIPS = (
    ("dim_employee", "property_id", "dim_property"),
    ("dim_employee", "department_id", "dim_department"),
    ("dim_employee", "access_level_id", "dim_access_level"),
    ("dim_room", "property_id", "dim_property"),
    ("dim_room", "room_type_id", "dim_room_type"),
    ("dim_outlet", "property_id", "dim_property"),
    ("dim_venue", "property_id", "dim_property"),
    ("fact_facility_room_status_daily", "room_id", "dim_room"),
    ("fact_maintenance_room_recurrence_yearly", "room_id", "dim_room"),
    ("fact_fnb_outlet_daily", "outlet_id", "dim_outlet"),
    ("fact_fnb_menu_item_daily", "item_name", "dim_menu_item"),
    ("fact_fnb_ingredient_price_daily", "ingredient_id", "dim_ingredient"),
    ("fact_financial_business_line_group_monthly", "business_line_id", "dim_business_line"),
    ("fact_hr_employee_monthly", "employee_id", "dim_employee"),
    ("fact_hr_watchlist_monthly", "employee_id", "dim_employee"),
    ("fact_ml_occupancy_forecast_property_room_type", "property_id", "dim_property"),
    ("fact_ml_occupancy_forecast_property_room_type", "room_type_id", "dim_room_type"),
    ("fact_revenue_room_type_daily", "property_id", "dim_property"),
    ("fact_revenue_nationality_daily", "nationality_group_id", "dim_nationality_group"),
    ("fact_event_venue_daily", "venue_id", "dim_venue"),
)

# Fixed values: (model, column, accepted values).
ACCEPTED = (
    ("dim_department", "department_name",
     ["Corporate", "F&B", "Facility", "Finance", "Housekeeping", "HR", "Revenue", "Spa&Event"]),
    ("dim_customer_type", "customer_type_name", ["inhouse", "walk-in"]),
    ("dim_nationality_group", "group_name", ["Domestik", "Mancanegara"]),
    ("dim_fnb_category", "category_name", ["Food", "Beverage", "Dessert"]),
    ("dim_employee_status", "status_name", ["active", "resigned", "terminated"]),
    ("fact_ml_occupancy_forecast_property_room_type", "model_name", ["occupancy_forecast"]),
)
