"""Edge cases the reference never exercised: empty inputs, single-row
series, ties, null dimension keys."""
import datetime as dt

from pyspark.sql import functions as F

from innspark.operators import monitor as M
from innspark.plans.registry import Mart

SF = "/root/testdata/sf0.001"


def test_facts_on_empty_sources(spark):
    base = Mart(spark, SF)
    empty = {n: base[n].limit(0) for n in ("src_bookings", "src_fnb_transactions", "src_staff_shifts")}
    m = Mart(spark, SF, overrides=empty)
    for fact in ("fact_revenue_room_type_daily", "fact_revenue_property_daily", "fact_revenue_channel_daily",
                 "fact_fnb_outlet_daily", "fact_fnb_waste_daily", "fact_hr_attendance_daily",
                 "fact_hr_watchlist_monthly", "fact_financial_revenue_runrate_daily"):
        assert m[fact].count() >= 0
    assert m["fact_revenue_channel_daily"].count() == 0
    assert m["fact_hr_watchlist_monthly"].count() == 0


def test_single_point_series_is_insufficient(spark):
    df = spark.createDataFrame([("s", "t", dt.date(2024, 1, 1), 10, 1)],
                               "schema_name string, table_name string, snapshot_date date, row_count long, "
                               "day_of_week int")
    r = M.rolling_z(df, ["schema_name", "table_name"], "snapshot_date", "row_count", 8).first()
    assert r.status == "insufficient_history" and r.z_score is None and r.severity is None


def test_rank_ties_share_a_rank(mart):
    f = mart["fact_financial_property_benchmark_monthly"]
    # every month ranks each property once; equal margins would share a rank
    per_month = f.groupBy("period_date").agg(F.min("gop_margin_rank").alias("lo"))
    assert per_month.where(F.col("lo") != 1).count() == 0


def test_null_dimension_keys_never_match_growth(mart):
    f = mart["fact_fnb_outlet_daily"]
    assert f.where(F.col("outlet_id").isNull() & F.col("mom_revenue_growth").isNotNull()).count() == 0


def test_size_for_scales_partitions(spark):
    from innspark.session import size_for
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert size_for(spark, 100 * (1 << 40)) == 100 * (1 << 40) // (256 << 20)   # 100 TB -> 409600
        assert size_for(spark, 1 << 20) == spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(128 << 20))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(64 << 20))
