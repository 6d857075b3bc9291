"""Source-table adapter: hotel source tables derived from the test tables.

The test data ships TPC-H-like tables (``region nation customer supplier part
orders lineitem events``); the mart's 23 operational source tables are derived
from them by the column expressions fixed in FIXTURES.md §3. Every expression
is plain SQL that Spark and DuckDB both accept, so the same text builds the
Spark DataFrame (``selectExpr``) and the DuckDB oracle CTE.

The adapter only shapes rows into the source schemas; all mart work happens
in the operators on top of it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MART_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
BASE_TABLES = MART_TABLES + ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


_BASE_CACHE: dict[tuple, DataFrame] = {}


def read_base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. The DataFrame (file listing + footer schema) is reused per
    session and folder; plans built on it stay lazy."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _BASE_CACHE:
        path = f"{sf_dir.rstrip('/')}/{name}.parquet"
        _BASE_CACHE[key] = spark.read.parquet(path)
    return _BASE_CACHE[key]


@dataclass(frozen=True)
class Derived:
    """One source table = projection (+ filter) of one test table."""
    name: str
    base: str
    cols: tuple[tuple[str, str], ...]
    where: str | None = None
    join: tuple[str, str] | None = None  # (test table, equi-join condition)

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = read_base(spark, sf_dir, self.base)
        if self.join:
            df = df.join(read_base(spark, sf_dir, self.join[0]), F.expr(self.join[1]))
        if self.where:
            df = df.filter(self.where)
        return df.selectExpr(*[f"{e} AS {c}" for c, e in self.cols])

    def sql(self) -> str:
        sel = ",\n  ".join(f"{e} AS {c}" for c, e in self.cols)
        where = f"\nWHERE {self.where}" if self.where else ""
        join = f" JOIN {self.join[0]} ON {self.join[1]}" if self.join else ""
        return f"SELECT\n  {sel}\nFROM {self.base}{join}{where}"


def _lp(expr: str, n: int) -> str:
    """Zero-padded to ``n`` digits; a longer number keeps all of its digits
    (``lpad`` would cut it, and different keys would become one)."""
    text = f"cast({expr} as string)"
    return f"repeat('0', cast(greatest({n} - length({text}), 0) as int)) || {text}"


def _per(key: str, n: int) -> str:
    """A key of a smaller table: ``n`` neighbouring values of ``key`` share one, so
    its range grows with the data."""
    return f"cast(floor({key} / {n}) as bigint)"


# ---------------------------------------------------------------------------
# Fixed values from FIXTURES.md §3 (derivation rules of the test adapter).
# ---------------------------------------------------------------------------
_DEPT = ("case c_custkey % 8 when 0 then 'Corporate' when 1 then 'F&B' when 2 then 'Facility' "
         "when 3 then 'Finance' when 4 then 'Housekeeping' when 5 then 'HR' when 6 then 'Revenue' "
         "else 'Spa&Event' end")
_HD = "cast(cast(date '2015-01-01' + cast(c_custkey * 7 % 2500 as int) as date) as string)"
_M = "l_orderkey % 20"

DERIVED: dict[str, Derived] = {d.name: d for d in [
    Derived("properties", "region", (
        ("property_id", "'P0' || cast((r_regionkey + 1) as string)"),
        ("property_name", "r_name || ' Hotel'"),
        ("city", "r_name"),
        ("region", "case r_regionkey % 3 when 0 then 'Bali' when 1 then 'Jawa' else 'Nusa Tenggara' end"),
        ("total_rooms", "cast(100 + r_regionkey * 10 as int)"),
        ("star_rating", "cast(4 + r_regionkey % 2 as int)"),
        ("opening_date", "cast(date '1988-01-01' + cast(r_regionkey * 300 as int) as date)"),
    )),
    Derived("employees", "customer", (
        ("employee_id", "'E' || " + _lp("c_custkey", 6)),
        ("property_id", "'P0' || cast((c_custkey % 6 + 1) as string)"),
        ("full_name", "case when c_custkey % 50 = 0 then '  ' || c_name || ' ' else c_name end"),
        ("role_title", "case when c_custkey % 47 = 0 then null else case c_custkey % 3 "
                       "when 0 then 'F&B Staff' when 1 then 'HR Staff' else 'Revenue Manager' end end"),
        ("department", f"case when c_custkey % 31 = 0 then upper({_DEPT}) || ' ' "
                       f"when c_custkey % 37 = 0 then lower({_DEPT}) else {_DEPT} end"),
        ("access_level", "case c_custkey % 10 when 0 then 'manager' when 1 then 'corporate' else 'staff' end"),
        ("hire_date", f"case when c_custkey % 43 = 0 then substr({_HD}, 9, 2) || '/' || substr({_HD}, 6, 2) "
                      f"|| '/' || substr({_HD}, 1, 4) else {_HD} end"),
        ("status", "case when c_custkey % 11 = 0 then 'resigned' when c_custkey % 17 = 0 then 'terminated' "
                   "else 'active' end"),
    )),
    Derived("bookings", "orders", (
        ("booking_id", "'BK' || " + _lp("o_orderkey", 7)),
        ("property_id", "'P0' || cast((o_orderkey % 5 + 1) as string)"),
        ("guest_id", "case when o_orderkey % 29 = 0 then null else 'G' || " + _lp("o_custkey", 6) + " end"),
        ("room_type", "case o_custkey % 4 when 0 then 'Standard' when 1 then 'Deluxe' when 2 then 'Suite' "
                      "else 'Villa' end"),
        ("booking_channel", "case substr(o_orderpriority, 1, 1) when '1' then 'Direct' when '2' then "
                            "'OTA-Booking.com' when '3' then 'OTA-Agoda' when '4' then 'Travel Agent' "
                            "else 'Corporate' end"),
        ("check_in_date", "cast(o_orderdate as date)"),
        ("check_out_date", "cast(cast(o_orderdate as date) + cast(o_orderkey % 7 + 1 as int) as date)"),
        ("booking_date", "cast(cast(o_orderdate as date) - cast(o_orderkey % 30 as int) as date)"),
        ("nights", "cast(o_orderkey % 7 + 1 as bigint)"),
        ("room_rate", "cast(floor(o_totalprice) as bigint)"),
        ("total_amount", "cast(floor(o_totalprice) as bigint) * (o_orderkey % 7 + 1)"),
        ("status", "case when o_orderstatus = 'F' then 'completed' when o_orderstatus = 'O' then 'confirmed' "
                   "when o_orderkey % 2 = 0 then 'cancelled' else 'no-show' end"),
    )),
    Derived("guests", "customer", (
        ("guest_id", "'G' || " + _lp("c_custkey", 6)),
        ("full_name", "c_name"),
        ("email", "case when c_custkey % 25 = 0 then null else 'c' || cast(c_custkey as string) "
                  "|| '@example.com' end"),
        ("phone", "case c_custkey % 7 when 0 then null "
                  "when 1 then '+62 812-3456-' || " + _lp("c_custkey % 10000", 4) + " "
                  "when 2 then '08123456' || " + _lp("c_custkey % 10000", 4) + " "
                  "when 3 then '628123456' || " + _lp("c_custkey % 10000", 4) + " "
                  "when 4 then '0812-3456-' || " + _lp("c_custkey % 10000", 4) + " "
                  "when 5 then '(021) 555.1234' else '+1 202-555-0100' end"),
        ("nationality", "case c_custkey % 10 when 0 then 'Indonesia' when 1 then 'INDONESIA ' "
                        "when 2 then 'indonesia' when 3 then 'guinea-bissau' else n_name end"),
        ("loyalty_tier", "case c_mktsegment when 'AUTOMOBILE' then 'Silver' when 'BUILDING' then 'Gold' "
                         "when 'MACHINERY' then 'Platinum' else 'none' end"),
        ("registered_date", "cast(date '1994-01-01' + cast(c_custkey % 400 as int) as date)"),
    ), join=("nation", "c_nationkey = n_nationkey")),
    Derived("fnb_outlets", "supplier", (
        ("outlet_id", "'OUT' || " + _lp("s_suppkey", 3)),
        ("property_id", "'P0' || cast((s_suppkey % 5 + 1) as string)"),
        ("outlet_name", "s_name"),
        ("outlet_type", "case s_suppkey % 3 when 0 then 'Restaurant' when 1 then 'Bar' else 'Room Service' end"),
    )),
    Derived("fnb_transactions", "lineitem", (
        ("transaction_id", "'TX' || " + _lp("l_orderkey", 7) + " || '-' || cast(l_suppkey as string)"),
        ("outlet_id", "'OUT' || " + _lp("l_suppkey", 3)),
        ("guest_id", "case when l_orderkey % 3 = 0 then null else 'G' || " + _lp(_per("l_orderkey", 10), 6) + " end"),
        ("customer_type", "case when l_orderkey % 3 = 0 then 'walk-in' else 'inhouse' end"),
        ("transaction_datetime", "l_shipdate + cast((l_orderkey + l_linenumber) % 24 as int) * interval '1' hour"),
        ("item_name", "'Item ' || cast(l_partkey as string)"),
        ("category", "case l_partkey % 3 when 0 then 'Food' when 1 then 'Beverage' else 'Dessert' end"),
        ("quantity", "cast(l_quantity as bigint)"),
        ("unit_price", "cast(floor(l_extendedprice) as bigint)"),
        ("total_price", "cast(floor(l_extendedprice) as bigint) * cast(l_quantity as bigint)"),
    )),
    Derived("fnb_waste_log", "lineitem", (
        ("waste_id", "'WS' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' "
                     "|| cast(l_partkey as string) || '-' || cast(l_suppkey as string)"),
        ("outlet_id", "'OUT' || " + _lp("l_suppkey", 3)),
        ("date", "cast(l_shipdate as date)"),
        ("ingredient_id", "'ING' || " + _lp("l_partkey + 1", 3)),
        ("quantity_wasted", "l_quantity / 8"),
        ("reason", "case l_linenumber % 3 when 0 then 'overproduction' when 1 then 'expired' else 'spillage' end"),
    ), where="l_returnflag = 'R'"),
    Derived("rooms", "part", (
        ("room_id", "'RM' || " + _lp("p_partkey", 4)),
        ("property_id", "'P0' || cast((p_partkey % 5 + 1) as string)"),
        ("room_number", "cast(100 + p_partkey as string)"),
        ("room_type", "case p_size % 4 when 0 then 'Standard' when 1 then 'Deluxe' when 2 then 'Suite' "
                      "else 'Villa' end"),
        ("floor", "cast(p_size % 10 + 1 as bigint)"),
        ("status", "case p_size % 5 when 0 then 'available' when 1 then 'occupied' when 2 then 'cleaning' "
                   "when 3 then 'maintenance' else 'out-of-order' end"),
    )),
    Derived("housekeeping_log", "lineitem", (
        ("log_id", "'HK' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' "
                   "|| cast(l_partkey as string) || '-' || cast(l_suppkey as string)"),
        ("room_id", "'RM' || " + _lp("l_partkey", 4)),
        ("date", "cast(l_shipdate as date)"),
        ("cleaning_start_time", _lp("8 + l_orderkey % 8", 2) + " || ':' || " + _lp("l_orderkey % 60", 2)
         + " || ':' || " + _lp("l_orderkey * 7 % 60", 2)),
        ("cleaning_end_time", _lp("9 + l_orderkey % 8", 2) + " || ':' || " + _lp("l_partkey % 60", 2)
         + " || ':' || " + _lp("l_partkey * 7 % 60", 2)),
        ("staff_id", "'E' || " + _lp(_per("l_orderkey", 10), 6)),
        ("status", "case when l_orderkey % 9 = 0 then 'delayed' else 'completed' end"),
    )),
    Derived("maintenance_tickets", "orders", (
        ("ticket_id", "'MT' || " + _lp("o_orderkey", 7)),
        ("property_id", "'P0' || cast((o_orderkey % 5 + 1) as string)"),
        ("room_id", "case when o_orderkey % 4 = 0 then null else 'RM' || " + _lp(_per("o_orderkey", 8), 4) + " end"),
        ("facility_area", "case when o_orderkey % 4 <> 0 then 'Room' when o_custkey % 2 = 0 then 'Pool' "
                          "else 'Lobby' end"),
        ("issue_type", "case o_custkey % 5 when 0 then 'AC' when 1 then 'Plumbing' when 2 then 'Electrical' "
                       "when 3 then 'Furniture' else 'Lainnya' end"),
        ("reported_date", "cast(o_orderdate as date)"),
        ("resolved_date", "case when o_orderkey % 20 < 2 then null else cast(cast(o_orderdate as date) "
                          "+ cast(o_orderkey % 5 as int) as date) end"),
        ("status", "case o_orderkey % 20 when 0 then 'open' when 1 then 'in-progress' else 'resolved' end"),
        ("priority", "case substr(o_orderpriority, 1, 1) when '1' then 'critical' when '2' then 'high' "
                     "when '3' then 'medium' else 'low' end"),
        ("assigned_staff_id", "case when o_orderkey % 50 = 0 then null else 'E' || " + _lp("o_custkey", 6) + " end"),
        ("labor_hours", "cast(o_orderkey % 8 + 1 as double) / 2"),
        ("parts_replaced", "case when o_orderkey % 2 = 0 then null else 'part' end"),
        ("cost", "cast(floor(o_totalprice) as bigint)"),
    )),
    Derived("venues", "supplier", (
        ("venue_id", "'VN' || " + _lp("s_suppkey", 3)),
        ("property_id", "'P0' || cast((s_suppkey % 5 + 1) as string)"),
        ("venue_name", "s_name"),
        ("venue_type", "case s_suppkey % 3 when 0 then 'Ballroom' when 1 then 'Meeting Room' else 'Outdoor' end"),
        ("max_capacity", "cast(100 + s_suppkey * 10 as bigint)"),
    )),
    Derived("spa_bookings", "orders", (
        ("spa_booking_id", "'SP' || " + _lp("o_orderkey", 7)),
        ("property_id", "'P0' || cast((o_custkey % 5 + 1) as string)"),
        ("guest_id", "case when o_orderkey % 2 = 0 then null else 'G' || " + _lp("o_custkey", 6) + " end"),
        ("customer_type", "case when o_orderkey % 2 = 0 then 'walk-in' else 'inhouse' end"),
        ("service_name", "case o_custkey % 4 when 0 then 'Massage' when 1 then 'Facial' when 2 then 'Sauna' "
                         "else 'Body Scrub' end"),
        ("booking_date", "cast(cast(o_orderdate as date) - cast(o_orderkey % 6 as int) as date)"),
        ("service_date", "cast(o_orderdate as date)"),
        ("duration_minutes", "cast(case o_custkey % 4 when 0 then 45 when 1 then 60 when 2 then 90 "
                             "else 120 end as bigint)"),
        ("price", "cast(floor(o_totalprice) as bigint)"),
        ("status", "case o_orderstatus when 'F' then 'completed' when 'O' then 'confirmed' else 'cancelled' end"),
    )),
    Derived("event_bookings", "orders", (
        ("event_id", "'EV' || " + _lp("o_orderkey", 7)),
        ("property_id", "'P0' || cast((" + _per("o_orderkey", 150) + " % 5 + 1) as string)"),
        ("venue_id", "'VN' || " + _lp(_per("o_orderkey", 150), 3)),
        ("client_name", "'Client ' || cast(o_custkey as string)"),
        ("event_type", "case o_orderkey % 6 when 0 then 'Wedding' when 1 then 'Corporate Meeting' "
                       "when 2 then 'Conference' when 3 then 'Gala Dinner' when 4 then 'Product Launch' "
                       "else 'Training/Workshop' end"),
        ("event_date", "cast(o_orderdate as date)"),
        ("venue_name", "'Venue ' || cast(" + _per("o_orderkey", 150) + " as string)"),
        ("capacity_booked", "cast(o_orderkey % 100 + 1 as bigint)"),
        ("total_revenue", "cast(floor(o_totalprice) as bigint)"),
        ("status", "case o_orderstatus when 'F' then 'completed' when 'O' then 'confirmed' else 'cancelled' end"),
    )),
    Derived("staff_shifts", "lineitem", (
        ("shift_id", "'SH' || cast(l_orderkey as string) || '-' || cast(l_linenumber as string) || '-' "
                     "|| cast(l_partkey as string) || '-' || cast(l_suppkey as string)"),
        ("employee_id", "'E' || " + _lp(_per("l_orderkey", 10), 6)),
        ("date", "cast(l_shipdate as date)"),
        ("shift_type", "case l_linenumber % 3 when 0 then 'Night' when 1 then 'Morning' else 'Afternoon' end"),
        ("clock_in", f"case when {_M} < 2 then null else case l_linenumber % 3 when 0 then '23' "
                     f"when 1 then '07' else '15' end || ':' || " + _lp("l_partkey % 30", 2) + " || ':00' end"),
        ("clock_out", f"case when {_M} < 2 then null else case l_linenumber % 3 when 0 then '07' "
                      f"when 1 then '15' else case when l_partkey % 4 = 0 then '00' else '23' end end "
                      f"|| ':' || " + _lp("l_partkey % 60", 2) + " || ':00' end"),
        ("status", f"case {_M} when 0 then 'absent' when 1 then 'leave' when 2 then 'late' when 3 then 'late' "
                   f"else 'present' end"),
    )),
    Derived("chatbot_query_log", "events", (
        ("role_title", "case user_id % 3 when 0 then 'CEO' when 1 then 'F&B Staff' else 'HR Staff' end"),
        ("domain", "case event_id % 4 when 0 then 'reservation' when 1 then 'fnb' when 2 then 'hr' "
                   "else 'financial' end"),
        ("view_name", "event_type"),
        ("status", "case when event_type = 'error' then 'denied' else 'success' end"),
        ("duration_ms", "case when event_id % 13 = 0 then null else value end"),
        ("requested_at", "ts"),
    )),
]}


# ---------------------------------------------------------------------------
# Tables that need more than a projection (grouping or a small fixed fan-out).
# Each has a Spark builder and the DuckDB text of the same derivation.
# ---------------------------------------------------------------------------

_P06 = ("'P06' AS property_id", "'Head Office' AS property_name", "'JAKARTA' AS city",
        "'Jawa' AS region", "cast(0 AS int) AS total_rooms", "cast(NULL AS int) AS star_rating",
        "cast(date '1988-01-01' AS date) AS opening_date")


def _spark_properties(spark, sf_dir, get):
    hotels = DERIVED["properties"].spark(spark, sf_dir)
    # the head-office row (P06) rides on region 0 so the table stays data-derived
    office = read_base(spark, sf_dir, "region").filter("r_regionkey = 0").selectExpr(*_P06)
    return hotels.unionByName(office)


def _sql_properties():
    return (DERIVED["properties"].sql() + "\nUNION ALL SELECT " + ", ".join(_P06)
            + " FROM region WHERE r_regionkey = 0")


_OCC_COLS = ("g.property_id", "g.room_type", "check_in_date AS date",
             "n AS rooms_sold",
             "cast(coalesce(capacity, 0) as bigint) AS total_rooms_available",
             "cast(n as double) / nullif(capacity, 0) AS occupancy_rate",
             "adr",
             "adr * (cast(n as double) / nullif(capacity, 0)) AS revpar")


def _spark_daily_occupancy(spark, sf_dir, get):
    b = get("src_bookings").filter("status in ('completed', 'confirmed')")
    g = b.groupBy("property_id", "room_type", "check_in_date").agg(
        F.count(F.lit(1)).alias("n"), F.avg("room_rate").alias("adr")).alias("g")
    rooms = get("src_rooms").groupBy("property_id", "room_type").agg(
        F.count(F.lit(1)).alias("capacity")).alias("c")
    return g.join(rooms, F.expr("g.property_id = c.property_id and g.room_type = c.room_type"), "left"
                  ).selectExpr(*_OCC_COLS)


def _sql_daily_occupancy():
    return ("SELECT " + ", ".join(_OCC_COLS) + " FROM (SELECT property_id, room_type, check_in_date, "
            "count(*) AS n, avg(room_rate) AS adr FROM src_bookings WHERE status in ('completed', 'confirmed') "
            "GROUP BY property_id, room_type, check_in_date) g LEFT JOIN (SELECT property_id, room_type, "
            "count(*) AS capacity FROM src_rooms GROUP BY 1, 2) c "
            "ON g.property_id = c.property_id AND g.room_type = c.room_type")


_PRICE_COLS = ("property_id", "room_type", "check_in_date AS date", "b AS base_rate", "a AS applied_rate",
               "case extract(day from check_in_date) % 3 when 0 then 'manual' when 1 then 'promo' "
               "else 'dynamic-pricing-AI' end AS reason")


def _spark_pricing_history(spark, sf_dir, get):
    g = get("src_bookings").groupBy("property_id", "room_type", "check_in_date").agg(
        F.max("room_rate").alias("b"), F.min("room_rate").alias("a"))
    return g.selectExpr(*_PRICE_COLS)


def _sql_pricing_history():
    return ("SELECT " + ", ".join(_PRICE_COLS) + " FROM (SELECT property_id, room_type, check_in_date, "
            "max(room_rate) AS b, min(room_rate) AS a FROM src_bookings "
            "GROUP BY property_id, room_type, check_in_date) g")


_IPH_COLS = ("'ING' || " + _lp("l_partkey + 1", 3) + " AS ingredient_id", "d AS date",
             "cast(1000 + l_partkey * 100 + extract(day from d) as double) AS unit_cost")


def _spark_ingredient_price_history(spark, sf_dir, get):
    # an ingredient has a price on the days on which it is delivered
    days = read_base(spark, sf_dir, "lineitem").select("l_partkey", F.to_date("l_shipdate").alias("d"))
    return days.distinct().selectExpr(*_IPH_COLS)


def _sql_ingredient_price_history():
    return ("SELECT " + ", ".join(_IPH_COLS)
            + " FROM (SELECT DISTINCT l_partkey, cast(l_shipdate as date) AS d FROM lineitem) dd")


_RB_COLS = ("'Item ' || cast(p_partkey as string) AS item_name",
            "'ING' || " + _lp("p_partkey + i * 7 + 1", 3) + " AS ingredient_id",
            "cast(i + 1 as double) / 8 AS qty_per_portion")


def _spark_recipe_bom(spark, sf_dir, get):
    p = read_base(spark, sf_dir, "part").select("p_partkey")
    return p.withColumn("i", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)))).selectExpr(*_RB_COLS)


def _sql_recipe_bom():
    return ("SELECT " + ", ".join(_RB_COLS) + " FROM part "
            "CROSS JOIN (SELECT unnest([0, 1, 2]) AS i) ii")


_INV_COLS = ("'ING' || " + _lp("l_partkey + 1", 3) + " AS ingredient_id",
             "'OUT' || " + _lp("l_suppkey", 3) + " AS outlet_id",
             "p_name AS ingredient_name",
             "case l_partkey % 3 when 0 then 'kg' when 1 then 'liter' else 'pcs' end AS unit",
             "cast((l_partkey * 7 + l_suppkey) % 50 as double) AS stock_current",
             "cast(p_size % 30 as double) AS stock_min_threshold",
             "p_retailprice AS unit_cost")


def _spark_fnb_inventory(spark, sf_dir, get):
    # an outlet stocks what it has been supplied with
    stock = read_base(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
    parts = read_base(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    return stock.join(parts, stock.l_partkey == parts.p_partkey).selectExpr(*_INV_COLS)


def _sql_fnb_inventory():
    return ("SELECT " + ", ".join(_INV_COLS) + " FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) s "
            "JOIN part ON l_partkey = p_partkey")


_PERIODS = ("2024-S1", "2024-S2", "2025-S1", "2025-S2")
_EP_COLS = ("'PR' || " + _lp("c_custkey * 10 + i", 7) + " AS review_id",
            "'E' || " + _lp("c_custkey", 6) + " AS employee_id",
            "rp AS review_period",
            "1 + cast((c_custkey * 3 + i) % 17 as double) / 4.25 AS score",
            "'note ' || cast(c_custkey % 5 as string) AS notes")


def _spark_employee_performance(spark, sf_dir, get):
    c = read_base(spark, sf_dir, "customer").select("c_custkey")
    c = c.select("c_custkey", F.posexplode(F.array(*[F.lit(p) for p in _PERIODS])).alias("i", "rp"))
    return c.selectExpr(*_EP_COLS)


def _sql_employee_performance():
    vals = ", ".join(f"({i}, '{p}')" for i, p in enumerate(_PERIODS))
    return ("SELECT " + ", ".join(_EP_COLS) + f" FROM customer CROSS JOIN (VALUES {vals}) AS v(i, rp)")


_PY_B = "cast(3000000 + c_custkey % 100 * 10000 as bigint)"
_PY_SC = "cast(c_custkey * 37 % 1000 * 1000 + i * 500 as bigint)"
_PY_OT = "cast(c_custkey % 9 * 20000 as bigint)"
_PY_COLS = ("'PY' || " + _lp("c_custkey * 100 + i", 9) + " AS payroll_id",
            "'E' || " + _lp("c_custkey", 6) + " AS employee_id",
            "'1996-' || " + _lp("i + 1", 2) + " AS period",
            f"{_PY_B} AS base_salary",
            f"{_PY_SC} AS service_charge",
            f"{_PY_OT} AS overtime_pay",
            f"case when i = 2 then {_PY_B} else cast(0 as bigint) end AS thr",
            f"cast(floor({_PY_B} * 9 / 100) as bigint) AS deduction",
            f"{_PY_B} + {_PY_SC} + {_PY_OT} + case when i = 2 then {_PY_B} else cast(0 as bigint) end "
            f"- cast(floor({_PY_B} * 9 / 100) as bigint) AS net_salary")


def _spark_payroll(spark, sf_dir, get):
    # dealt out by key: twelve rows each come from a file that may be one split
    c = read_base(spark, sf_dir, "customer").select("c_custkey").repartition("c_custkey")
    c = c.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(11))))
    return c.selectExpr(*_PY_COLS)


def _sql_payroll():
    return ("SELECT " + ", ".join(_PY_COLS) + " FROM customer CROSS JOIN "
            "(SELECT cast(range AS int) AS i FROM range(12)) ii")


# one row for each booking, sale and treatment: property, month, department, revenue
_FS_PARTS = (
    ("src_bookings", "status in ('completed', 'confirmed')", "check_in_date", "0", "total_amount"),
    ("src_fnb_transactions JOIN src_fnb_outlets USING (outlet_id)", "true",
     "cast(transaction_datetime as date)", "1", "total_price"),
    ("src_spa_bookings", "status in ('completed', 'confirmed')", "service_date", "2", "price"),
    ("src_event_bookings", "status in ('completed', 'confirmed')", "event_date", "2", "total_revenue"),
)
_FS_EXP = "cast(floor(rev * 6 / 10) as bigint)"
_FS_UND = "cast(400000 + cast(substr(period, 6, 2) as int) * 1000 as bigint)"
_FS_COLS = ("property_id", "period",
            "case j when 0 then 'Room' when 1 then 'F&B' when 2 then 'Spa&Event' when 3 then 'Overall' "
            "else 'Corporate Overhead' end AS department",
            "rev AS departmental_revenue",
            f"{_FS_EXP} AS departmental_expense",
            f"rev - {_FS_EXP} AS departmental_profit",
            f"case when j < 3 then cast(0 as bigint) else {_FS_UND} end AS undistributed_expense",
            f"case when j < 3 then cast(0 as bigint) else rev - {_FS_EXP} - {_FS_UND} end AS gop")


def _spark_financial_summary(spark, sf_dir, get):
    fnb = get("src_fnb_transactions").join(get("src_fnb_outlets"), "outlet_id")
    frames = (get("src_bookings"), fnb, get("src_spa_bookings"), get("src_event_bookings"))
    parts = [df.where(keep).selectExpr("property_id", f"substr(cast({day} as string), 1, 7) AS period",
                                       f"{j} AS j", f"{rev} AS rev").groupBy("property_id", "period", "j")
             .agg(F.sum("rev").alias("rev"))
             for df, (_, keep, day, j, rev) in zip(frames, _FS_PARTS)]
    lines = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    lines = lines.groupBy("property_id", "period", "j").agg(F.sum("rev").alias("rev"))
    overall = lines.groupBy("property_id", "period").agg(F.sum("rev").alias("rev")).select(
        "property_id", "period", F.lit(3).alias("j"), "rev")
    # head office (P06): one 'Corporate Overhead' line for each month
    office = lines.select("period").distinct().select(
        F.lit("P06").alias("property_id"), "period", F.lit(4).alias("j"), F.lit(0).cast("bigint").alias("rev"))
    return lines.unionByName(overall).unionByName(office).selectExpr(*_FS_COLS)


def _sql_financial_summary():
    parts = " UNION ALL ".join(
        f"SELECT property_id, substr(cast({day} as string), 1, 7) AS period, {j} AS j, {rev} AS rev "
        f"FROM {source} WHERE {keep}" for source, keep, day, j, rev in _FS_PARTS)
    return (f"SELECT {', '.join(_FS_COLS)} FROM (WITH lines AS (SELECT property_id, period, j, "
            f"cast(sum(rev) as bigint) AS rev FROM ({parts}) x GROUP BY 1, 2, 3) "
            "SELECT * FROM lines UNION ALL SELECT property_id, period, 3 AS j, cast(sum(rev) as bigint) AS rev "
            "FROM lines GROUP BY 1, 2 UNION ALL SELECT DISTINCT 'P06' AS property_id, period, 4 AS j, "
            "cast(0 as bigint) AS rev FROM lines) l")


@dataclass(frozen=True)
class Special:
    name: str
    spark_fn: object
    sql_fn: object
    deps: tuple[str, ...] = field(default_factory=tuple)


SPECIAL: dict[str, Special] = {s.name: s for s in [
    Special("properties", _spark_properties, _sql_properties),
    Special("daily_occupancy", _spark_daily_occupancy, _sql_daily_occupancy, ("src_bookings", "src_rooms")),
    Special("pricing_history", _spark_pricing_history, _sql_pricing_history, ("src_bookings",)),
    Special("ingredient_price_history", _spark_ingredient_price_history, _sql_ingredient_price_history),
    Special("recipe_bom", _spark_recipe_bom, _sql_recipe_bom),
    Special("fnb_inventory", _spark_fnb_inventory, _sql_fnb_inventory),
    Special("employee_performance", _spark_employee_performance, _sql_employee_performance),
    Special("payroll", _spark_payroll, _sql_payroll),
    Special("financial_summary", _spark_financial_summary, _sql_financial_summary,
            ("src_bookings", "src_fnb_transactions", "src_fnb_outlets", "src_spa_bookings",
             "src_event_bookings")),
]}

# the 22 derived source tables + the request log (role_permissions is a seed)
SOURCE_TABLES = tuple(sorted(set(DERIVED) | set(SPECIAL)))


def source_sql(name: str) -> str:
    """DuckDB/Spark SQL text deriving source table ``name``."""
    if name in SPECIAL:
        return SPECIAL[name].sql_fn()
    return DERIVED[name].sql()


def source_spark(spark: SparkSession, sf_dir: str, name: str, get) -> DataFrame:
    if name in SPECIAL:
        return SPECIAL[name].spark_fn(spark, sf_dir, get)
    return DERIVED[name].spark(spark, sf_dir)
