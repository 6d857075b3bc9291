"""Detectors over raw logs whose one series holds half of the rows."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from innspark.functions import exprs as X
from innspark.operators import monitor as M

T0 = dt.datetime(2024, 1, 1)


def log(spark, n=4000):
    """Series 0 has half of the rows, a null series some, the others few each."""
    rows = [(0 if k % 2 else (None if k % 10 == 0 else k % 97 + 1), T0 + dt.timedelta(seconds=k), float((k * 7919) % 311))
            for k in range(n)]
    return spark.createDataFrame(rows, "series int, at timestamp, value double").repartition(8)


@pytest.mark.parametrize("block", (8, 50, 100_000))
def test_blocks_score_like_one_window(spark, block):
    df = log(spark)
    want = M.rolling_z(df, ["series"], "at", "value", 8)
    got = M.rolling_z_blocks(df, ["series"], "at", "value", 8, block_rows=block)
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_no_task_holds_the_hot_series(spark):
    df = log(spark, 8000)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one range
    try:
        ranges = [r["count"] for r in X.ranged_rows(df, ["series"], "at").groupBy("__part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(ranges) > 1 and max(ranges) < 4000  # series 0 has 4000 rows
    rows = X.numbered_rows(df, ["series"], "at")
    places = rows.where("series = 0").agg(F.count("*"), F.countDistinct("__pos"), F.max("__pos")).first()
    assert tuple(places) == (4000, 4000, 3999)
    assert rows.where("series is null").agg(F.max("__pos")).first()[0] == df.where("series is null").count() - 1


def test_equal_times_and_an_empty_log(spark):
    same = spark.createDataFrame([(1, T0, float(k)) for k in range(40)], "series int, at timestamp, value double")
    got = M.rolling_z_blocks(same, ["series"], "at", "value", 8, block_rows=10)
    assert got.count() == 40 and got.where("history_points = 8").count() == 32
    assert M.rolling_z_blocks(same.limit(0), ["series"], "at", "value", 8).count() == 0


def test_each_day_climbs_on_its_own(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2), (4, 3)], "titik_id int, depends_on_titik_id int")
    days = {"2024-01-01": (1, 2, 3), "2024-01-02": (2, 3, 4), "2024-01-03": (1, 4), None: (2, 3)}
    events = spark.createDataFrame([(d, s) for d, ss in days.items() for s in ss for _ in range(3)],
                                   "event_date string, titik_id int")
    got = {(r.event_date, r.titik_id): (r.root_titik_id, r.depth)
           for r in M.root_cause(events, edges, by=("event_date",)).collect()}
    assert got == {("2024-01-01", 1): (1, 0), ("2024-01-01", 2): (1, 1), ("2024-01-01", 3): (1, 2),
                   ("2024-01-02", 2): (2, 0), ("2024-01-02", 3): (2, 1), ("2024-01-02", 4): (2, 2),
                   ("2024-01-03", 1): (1, 0), ("2024-01-03", 4): (4, 0), (None, 2): (2, 0), (None, 3): (2, 1)}
    ring = spark.createDataFrame([(1, 2), (2, 1)], "titik_id int, depends_on_titik_id int")
    with pytest.raises(ValueError, match="2024-01-01"):
        M.root_cause(events, ring, by=("event_date",))


def test_averages_do_not_depend_on_order(spark):
    rows = [(k % 3, x) for k, x in enumerate([1e6 + 1 / 3, 1 / 7, 1e-5, 2 / 3, 0.1, 1e5 / 7] * 50)]
    one = spark.createDataFrame(rows, "g int, x double")
    got = {tuple(sorted(map(tuple, df.groupBy("g").agg(X.exact_avg("x", 9)).collect())))
           for df in (one.coalesce(1), one.repartition(7), one.orderBy(F.desc("x")), one.unionByName(
               spark.createDataFrame([(0, None)], "g int, x double")))}
    assert len(got) == 1
    assert spark.createDataFrame([(1, None)], "g int, x double").agg(X.exact_avg("x")).first()[0] is None
