"""Reservation & revenue facts D1-D9."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from innspark.functions import exprs as X
from innspark.plans.registry import DEFAULT_AS_OF, model

SOLD = "status in ('completed', 'confirmed')"


def sold_bookings(m):
    return m["bookings"].where(SOLD)


# the amounts of each type and of the whole day come from one grouping
D1_SQL = f"""WITH sold AS (
  SELECT property_id, check_in_date AS day, room_type, sum(total_amount) AS amount, grouping(room_type) = 1 AS all_types
  FROM bookings WHERE {SOLD}
  GROUP BY GROUPING SETS ((property_id, check_in_date, room_type), (property_id, check_in_date)))
SELECT occ.property_id, (SELECT k.room_type_id FROM dim_room_type k WHERE k.room_type_name = occ.room_type) AS room_type_id,
  occ.date AS period_date, occ.rooms_sold, occ.total_rooms_available, round(occ.occupancy_rate, 6) AS occupancy_rate,
  round(occ.adr, 6) AS adr, round(occ.revpar, 6) AS revpar, cast(own.amount AS bigint) AS revenue,
  round(own.amount / nullif(whole.amount, 0), 6) AS room_type_revenue_share_pct
FROM daily_occupancy occ
LEFT JOIN sold own ON NOT own.all_types AND (own.property_id, own.day, own.room_type) = (occ.property_id, occ.date, occ.room_type)
LEFT JOIN sold whole ON whole.all_types AND (whole.property_id, whole.day) = (occ.property_id, occ.date)"""


@model("fact_revenue_room_type_daily", "fact", D1_SQL, tags=("reservation",))
def fact_revenue_room_type_daily(m):
    occ = m["daily_occupancy"].withColumnRenamed("date", "period_date")
    rev = (sold_bookings(m).groupBy("property_id", "room_type", F.col("check_in_date").alias("period_date"))
           .agg(F.sum("total_amount").alias("revenue")))
    rev = X.group_total(rev, ["property_id", "period_date"], "revenue", "__day_revenue")
    rev = rev.select("property_id", "room_type", "period_date", "revenue",
                     X.safe_div("revenue", "__day_revenue").alias("room_type_revenue_share_pct"))
    out = occ.join(rev, ["property_id", "room_type", "period_date"], "left")
    out = X.lookup(out, m["dim_room_type"], "room_type", "room_type_name", "room_type_id")
    return X.finish(out.select("property_id", "room_type_id", "period_date", "rooms_sold",
                               "total_rooms_available", "occupancy_rate", "adr", "revpar", "revenue",
                               "room_type_revenue_share_pct"))


def _growth_sql() -> str:
    """Differences to the row one month and one year before, looked up by date."""
    names = {"occupancy": "occupancy_rate", "adr": "adr", "revpar": "revpar"}
    return ",\n  ".join(
        f"round(x.{column} - (SELECT before.{column} FROM daily before WHERE before.property_id = x.property_id "
        f"AND before.period_date = cast(x.period_date - INTERVAL 1 {step} AS date)), 6) AS {prefix}_{name}_growth"
        for name, column in names.items() for prefix, step in (("mom", "MONTH"), ("yoy", "YEAR")))


# a guest's first stay is the least (booking date, id); lead times and repeats
# are counted in the same grouping of the stays
D2_SQL = f"""WITH daily AS (
  SELECT property_id, period_date, n_sold / nullif(n_rooms, 0) AS occupancy_rate, amount / nullif(n_sold, 0) AS adr,
    amount / nullif(n_rooms, 0) AS revpar
  FROM (SELECT property_id, period_date, sum(rooms_sold) AS n_sold, sum(total_rooms_available) AS n_rooms,
          sum(revenue) AS amount FROM fact_revenue_room_type_daily GROUP BY ALL) sums),
stays AS (
  SELECT property_id, check_in_date, guest_id, date_diff('day', booking_date, check_in_date) AS lead_days,
    (booking_date, booking_id) <> min((booking_date, booking_id)) OVER (PARTITION BY guest_id) AS came_before
  FROM bookings WHERE {SOLD}),
habits AS (
  SELECT property_id, check_in_date, avg(lead_days) AS mean_lead, quantile_disc(lead_days, 0.5) AS mid_lead,
    avg(CASE WHEN guest_id IS NOT NULL THEN cast(came_before AS int) END) AS repeat_share
  FROM stays GROUP BY ALL)
SELECT x.property_id, x.period_date, round(h.mean_lead, 6) AS avg_lead_time_days,
  cast(h.mid_lead AS bigint) AS median_lead_time_days, {_growth_sql()},
  round(h.repeat_share, 6) AS repeat_guest_rate,
  1 + (SELECT count(*) FROM daily o WHERE o.period_date = x.period_date AND (o.revpar > x.revpar
       OR x.revpar IS NULL AND o.revpar IS NOT NULL)) AS revpar_rank_group,
  1 + (SELECT count(*) FROM daily o WHERE o.period_date = x.period_date AND (o.adr > x.adr
       OR x.adr IS NULL AND o.adr IS NOT NULL)) AS adr_rank_group,
  1 + (SELECT count(*) FROM daily o WHERE o.period_date = x.period_date AND (o.occupancy_rate > x.occupancy_rate
       OR x.occupancy_rate IS NULL AND o.occupancy_rate IS NOT NULL)) AS occupancy_rank_group
FROM daily x LEFT JOIN habits h ON h.property_id = x.property_id AND h.check_in_date = x.period_date"""


def booking_day_stats(bookings):
    """Per (property, check-in day): repeat-guest share and lead times, in one
    pass over the bookings.

    "Repeat" = not the guest's first booking in (booking_date, booking_id)
    order, i.e. ``row_number() over (partition by guest ...) > 1`` — computed
    skew-proof: each guest's first booking is a partial aggregation (min of a
    struct) joined back by guest id, so a guest with millions of bookings is
    never one window partition. Bookings without a guest stay out of the
    repeat share but count for lead times."""
    g = bookings.where(F.col("guest_id").isNotNull())
    first = g.groupBy("guest_id").agg(F.min(F.struct("booking_date", "booking_id")).alias("__first"))
    b = X.left_join_skip_null_keys(bookings, first, "guest_id")
    has_guest = F.col("guest_id").isNotNull()
    is_repeat = has_guest & (F.struct("booking_date", "booking_id") != F.col("__first"))
    lead = F.datediff("check_in_date", "booking_date")
    return (b.groupBy("property_id", F.col("check_in_date").alias("period_date"))
            .agg(X.safe_div(F.count_if(is_repeat), F.count_if(has_guest)).alias("repeat_guest_rate"),
                 F.avg(lead).alias("avg_lead_time_days"), X.median(lead).alias("median_lead_time_days")))


@model("fact_revenue_property_daily", "fact", D2_SQL, tags=("reservation",))
def fact_revenue_property_daily(m):
    f1 = m["fact_revenue_room_type_daily"]
    pd = f1.groupBy("property_id", "period_date").agg(
        X.safe_div(F.sum("rooms_sold"), F.sum("total_rooms_available")).alias("occupancy_rate"),
        X.safe_div(F.sum("revenue"), F.sum("rooms_sold")).alias("adr"),
        X.safe_div(F.sum("revenue"), F.sum("total_rooms_available")).alias("revpar"))
    vals = ["occupancy_rate", "adr", "revpar"]
    g = X.shift_values(pd, ["property_id"], "period_date", vals, {"mom_": 1, "yoy_": 12})
    for v, short in (("occupancy_rate", "occupancy"), ("adr", "adr"), ("revpar", "revpar")):
        g = (g.withColumn(f"mom_{short}_growth", F.col(v) - F.col(f"mom_{v}"))
              .withColumn(f"yoy_{short}_growth", F.col(v) - F.col(f"yoy_{v}")))
    day = Window.partitionBy("period_date")  # a handful of properties per day
    g = (g.withColumn("revpar_rank_group", F.rank().over(day.orderBy(F.desc_nulls_last("revpar"))))
          .withColumn("adr_rank_group", F.rank().over(day.orderBy(F.desc_nulls_last("adr"))))
          .withColumn("occupancy_rank_group", F.rank().over(day.orderBy(F.desc_nulls_last("occupancy_rate")))))
    stats = booking_day_stats(sold_bookings(m))
    out = g.join(stats, ["property_id", "period_date"], "left")
    return X.finish(out.select(
        "property_id", "period_date", "avg_lead_time_days", "median_lead_time_days",
        "mom_occupancy_growth", "yoy_occupancy_growth", "mom_adr_growth", "yoy_adr_growth",
        "mom_revpar_growth", "yoy_revpar_growth", "repeat_guest_rate",
        "revpar_rank_group", "adr_rank_group", "occupancy_rank_group"))


@model("fact_revenue_channel_daily", "fact", """WITH by_status AS (
  SELECT property_id, check_in_date, booking_channel, status, count(*) AS n, sum(total_amount) AS amount
  FROM bookings GROUP BY ALL)
SELECT s.check_in_date AS period_date, s.property_id, d.channel_id, cast(sum(s.n) AS bigint) AS bookings_count,
  cast(coalesce(sum(s.n) FILTER (WHERE s.status = 'no-show'), 0) AS bigint) AS no_shows_count,
  cast(coalesce(sum(s.n) FILTER (WHERE s.status = 'cancelled'), 0) AS bigint) AS cancellations_count,
  cast(coalesce(sum(s.amount) FILTER (WHERE s.status IN ('completed', 'confirmed')), 0) AS bigint) AS revenue
FROM dim_channel d RIGHT JOIN by_status s ON s.booking_channel = d.channel_name GROUP BY ALL""",
       tags=("reservation",))
def fact_revenue_channel_daily(m):
    b = X.lookup(m["bookings"], m["dim_channel"], "booking_channel", "channel_name", "channel_id")
    return X.finish(b.groupBy("property_id", "channel_id", F.col("check_in_date").alias("period_date")).agg(
        F.sum(F.when(F.expr(SOLD), F.col("total_amount")).otherwise(0)).alias("revenue"),
        F.count(F.lit(1)).alias("bookings_count"),
        F.count_if(F.col("status") == "cancelled").alias("cancellations_count"),
        F.count_if(F.col("status") == "no-show").alias("no_shows_count")))


@model("fact_revenue_los_daily", "fact", """WITH stays AS (
  SELECT property_id, check_in_date, room_type, booking_channel, list(nights ORDER BY nights) AS n FROM bookings
  WHERE status IN ('completed', 'confirmed') GROUP BY ALL)
SELECT s.check_in_date AS period_date, s.property_id, c.channel_id, t.room_type_id,
  cast(s.n[(len(s.n) + 1) // 2] AS bigint) AS median_los_nights, round(list_avg(s.n), 6) AS avg_los_nights
FROM stays s LEFT JOIN dim_channel c ON c.channel_name = s.booking_channel
LEFT JOIN dim_room_type t ON t.room_type_name = s.room_type""", tags=("reservation",))
def fact_revenue_los_daily(m):
    b = X.lookup(sold_bookings(m), m["dim_room_type"], "room_type", "room_type_name", "room_type_id")
    b = X.lookup(b, m["dim_channel"], "booking_channel", "channel_name", "channel_id")
    return X.finish(b.groupBy("property_id", "room_type_id", "channel_id",
                              F.col("check_in_date").alias("period_date"))
                    .agg(F.avg("nights").alias("avg_los_nights"), X.median("nights").alias("median_los_nights")))


@model("fact_revenue_gop_impact_monthly", "fact", """WITH mp AS (
  SELECT property_id, cast(date_trunc('month', date) AS date) AS period_date, avg(applied_rate - base_rate) AS dev
  FROM pricing_history GROUP BY 1, 2),
mg AS (
  SELECT property_id, cast(strptime(period, '%Y-%m') AS date) AS period_date,
    gop / nullif(departmental_revenue, 0) AS gop_margin
  FROM financial_summary WHERE department = 'Overall')
SELECT g.property_id, g.period_date, round(p.dev, 6) AS avg_pricing_deviation, round(g.gop_margin, 6) AS gop_margin
FROM mg g LEFT JOIN mp p ON g.property_id = p.property_id AND g.period_date = p.period_date""",
       tags=("reservation",))
def fact_revenue_gop_impact_monthly(m):
    mp = (m["pricing_history"].groupBy("property_id", X.month_start("date").alias("period_date"))
          .agg(F.avg(F.col("applied_rate") - F.col("base_rate")).alias("avg_pricing_deviation")))
    mg = (m["financial_summary"].where(F.col("department") == "Overall")
          .select("property_id", X.period_to_date("period").alias("period_date"),
                  X.safe_div("gop", "departmental_revenue").alias("gop_margin")))
    out = mg.join(mp, ["property_id", "period_date"], "left")
    return X.finish(out.select("property_id", "period_date", "avg_pricing_deviation", "gop_margin"))


def _bookings_with_guest(m, cols):
    g = m["guests"].select("guest_id", *cols)
    return X.left_join_skip_null_keys(sold_bookings(m), g, "guest_id")


@model("fact_revenue_loyalty_daily", "fact", """WITH stays AS (
  SELECT property_id, check_in_date, guest_id, count(*) AS n, sum(total_amount) AS amount FROM bookings
  WHERE status IN ('completed', 'confirmed') GROUP BY ALL),
tier_of AS (SELECT guests.guest_id, t.loyalty_tier_id FROM guests JOIN dim_loyalty_tier t
  ON t.loyalty_tier_name = guests.loyalty_tier)
SELECT s.check_in_date AS period_date, s.property_id, tier_of.loyalty_tier_id, cast(sum(s.amount) AS bigint) AS revenue,
  cast(sum(s.n) AS bigint) AS bookings_count FROM stays s LEFT JOIN tier_of USING (guest_id) GROUP BY ALL""", tags=("reservation",))
def fact_revenue_loyalty_daily(m):
    b = _bookings_with_guest(m, ["loyalty_tier"])
    b = X.lookup(b, m["dim_loyalty_tier"], "loyalty_tier", "loyalty_tier_name", "loyalty_tier_id")
    return X.finish(b.groupBy("property_id", "loyalty_tier_id", F.col("check_in_date").alias("period_date"))
                    .agg(F.count(F.lit(1)).alias("bookings_count"), F.sum("total_amount").alias("revenue")))


@model("fact_revenue_nationality_daily", "fact", """WITH stays AS (
  SELECT property_id, check_in_date, guest_id, count(*) AS n, sum(total_amount) AS amount FROM bookings
  WHERE status IN ('completed', 'confirmed') GROUP BY ALL),
domestic AS (SELECT DISTINCT guest_id FROM guests WHERE nationality = 'Indonesia')
SELECT check_in_date AS period_date, property_id, cast(2 - cast(guest_id IN (SELECT guest_id FROM domestic) AS int) AS bigint)
    AS nationality_group_id, cast(sum(amount) AS bigint) AS revenue, cast(sum(n) AS bigint) AS bookings_count
FROM (SELECT property_id, check_in_date, coalesce(guest_id, '') AS guest_id, n, amount FROM stays) s GROUP BY ALL""", tags=("reservation",))
def fact_revenue_nationality_daily(m):
    b = _bookings_with_guest(m, ["nationality"])
    grp = F.when(F.col("nationality") == "Indonesia", 1).otherwise(2).alias("nationality_group_id")
    return X.finish(b.groupBy("property_id", grp, F.col("check_in_date").alias("period_date"))
                    .agg(F.count(F.lit(1)).alias("bookings_count"), F.sum("total_amount").alias("revenue")))


def _pace_sql(as_of: str) -> str:
    return f"""WITH rc AS (SELECT property_id, room_type_id, count(*) AS total_rooms_available FROM dim_room GROUP BY 1, 2)
SELECT b.property_id, rt.room_type_id, b.check_in_date AS stay_date, {as_of} AS snapshot_date,
  count(*) AS rooms_sold_asof, max(rc.total_rooms_available) AS rooms_available_asof
FROM bookings b
LEFT JOIN dim_room_type rt ON b.room_type = rt.room_type_name
LEFT JOIN rc ON b.property_id = rc.property_id AND rt.room_type_id = rc.room_type_id
WHERE b.{SOLD} AND b.check_in_date > {as_of} AND b.check_in_date <= cast({as_of} + INTERVAL 14 DAY AS date)
GROUP BY 1, 2, 3, 4"""


@model("fact_revenue_pace_booking_snapshot", "fact", _pace_sql(f"date '{DEFAULT_AS_OF.isoformat()}'"), tags=("reservation", "snapshot"))
def fact_revenue_pace_booking_snapshot(m):
    """Bookings staying in (as_of, as_of + 14 days], counted as of ``as_of``.
    Appending to the history idempotently is ``publish.append_snapshot``."""
    as_of = F.lit(m.as_of)
    rc = m["dim_room"].groupBy("property_id", "room_type_id").agg(F.count(F.lit(1)).alias("total_rooms_available"))
    b = sold_bookings(m).where((F.col("check_in_date") > as_of) & (F.col("check_in_date") <= F.date_add(as_of, 14)))
    b = X.lookup(b, m["dim_room_type"], "room_type", "room_type_name", "room_type_id")
    b = b.join(rc, ["property_id", "room_type_id"], "left")
    return X.finish(b.groupBy("property_id", "room_type_id", F.col("check_in_date").alias("stay_date"),
                              as_of.alias("snapshot_date"))
                    .agg(F.count(F.lit(1)).alias("rooms_sold_asof"),
                         F.max("total_rooms_available").alias("rooms_available_asof")))


@model("fact_revenue_pricing_deviation", "fact", """WITH agg AS (
  SELECT p.property_id, r.reason_id, p.date AS period_date, avg(p.applied_rate) AS avg_applied_rate,
    avg(p.base_rate) AS avg_base_rate,
    avg(p.applied_rate - p.base_rate) / nullif(avg(p.base_rate), 0) AS avg_deviation_pct,
    count(*) AS reason_count
  FROM pricing_history p LEFT JOIN dim_pricing_reason r ON p.reason = r.reason_name GROUP BY 1, 2, 3)
SELECT property_id, reason_id, period_date, round(avg_applied_rate, 6) AS avg_applied_rate,
  round(avg_base_rate, 6) AS avg_base_rate, round(avg_deviation_pct, 6) AS avg_deviation_pct,
  round(reason_count / nullif(sum(reason_count) OVER (PARTITION BY property_id, period_date), 0), 6) AS day_share_pct
FROM agg""", tags=("reservation",))
def fact_revenue_pricing_deviation(m):
    p = X.lookup(m["pricing_history"], m["dim_pricing_reason"], "reason", "reason_name", "reason_id")
    agg = p.groupBy("property_id", "reason_id", F.col("date").alias("period_date")).agg(
        F.avg("applied_rate").alias("avg_applied_rate"), F.avg("base_rate").alias("avg_base_rate"),
        X.safe_div(F.avg(F.col("applied_rate") - F.col("base_rate")), F.avg("base_rate")).alias("avg_deviation_pct"),
        F.count(F.lit(1)).alias("reason_count"))
    agg = X.group_total(agg, ["property_id", "period_date"], "reason_count", "__day_count")
    return X.finish(agg.select("property_id", "reason_id", "period_date", "avg_applied_rate", "avg_base_rate",
                               "avg_deviation_pct", X.safe_div("reason_count", "__day_count").alias("day_share_pct")))
