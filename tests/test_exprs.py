import datetime as dt

from pyspark.sql import functions as F

from innspark.functions import exprs as X


def _one(spark, col, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col).collect()]


def test_normalize_phone(spark):
    rows = [("+62 812-3456-0001",), ("08123456 0002",), ("6281234560003",), ("0812-3456-0004",),
            ("(021) 555.1234",), ("+1 202-555-0100",), (None,)]
    got = _one(spark, X.normalize_phone("p"), rows, "p string")
    assert got == ["081234560001", "081234560002", "081234560003", "081234560004",
                   "(021) 555.1234", "+1 202-555-0100", None]


def test_initcap_words_capitalises_after_punctuation(spark):
    got = _one(spark, X.initcap_words("s"), [("guinea-bissau",), ("INDONESIA",), ("saint kitts & nevis",),
                                             ("",), (None,)], "s string")
    assert got == ["Guinea-Bissau", "Indonesia", "Saint Kitts & Nevis", "", None]


def test_parse_mixed_date(spark):
    got = _one(spark, X.parse_mixed_date("d"), [("2020-03-01",), ("01/03/2020",)], "d string")
    assert got == [dt.date(2020, 3, 1), dt.date(2020, 3, 1)]


def test_minute_diff_and_overtime_midnight_wrap(spark):
    df = spark.createDataFrame([("23:10:00", "07:40:00"), ("07:00:00", "16:30:59"), (None, "15:00:00")],
                               "ci string, co string")
    mins = [r[0] for r in df.select(X.minute_diff("co", "ci")).collect()]
    assert mins == [-(23 * 60 + 10 - 7 * 60 - 40), 9 * 60 + 30, None]
    ot = [r[0] for r in df.select(X.overtime_hours("ci", "co")).collect()]
    assert ot[0] == 0.5 and ot[1] == 1.5 and ot[2] is None


def test_shift_values_month_end_clamps_and_gaps(spark):
    df = spark.createDataFrame([("A", dt.date(2024, 2, 29), 10), ("A", dt.date(2024, 3, 31), 15),
                                ("A", dt.date(2024, 3, 30), 12), (None, dt.date(2024, 3, 31), 1),
                                (None, dt.date(2024, 2, 29), 2)], "k string, d date, v int")
    out = {(r.k, r.d): r.mom_v for r in X.shift_values(df, ["k"], "d", ["v"], {"mom_": 1}).collect()}
    assert out[("A", dt.date(2024, 3, 31))] == 10     # 31 Mar -> 29 Feb
    assert out[("A", dt.date(2024, 3, 30))] == 10     # 30 Mar -> 29 Feb as well
    assert out[("A", dt.date(2024, 2, 29))] is None   # no January row
    assert out[(None, dt.date(2024, 3, 31))] is None  # null keys never match


def test_group_total_matches_window_with_null_keys(spark):
    from pyspark.sql import Window
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5), (None, 7), ("b", 3)], "k string, v int")
    got = sorted((r.k or "", r.v, r.t) for r in X.group_total(df, ["k"], "v", "t").collect())
    want = sorted((r.k or "", r.v, r.t) for r in df.withColumn("t", F.sum("v").over(Window.partitionBy("k")))
                  .collect())
    assert got == want


def test_safe_div(spark):
    got = _one(spark, X.safe_div("a", "b"), [(1, 0), (1, 4), (None, 2)], "a int, b int")
    assert got == [None, 0.25, None]


def test_left_join_skip_null_keys(spark):
    left = spark.createDataFrame([("g1", 1), (None, 2), ("g9", 3)], "guest_id string, x int")
    right = spark.createDataFrame([("g1", "Gold")], "guest_id string, tier string")
    got = sorted((r.x, r.tier) for r in X.left_join_skip_null_keys(left, right, "guest_id").collect())
    assert got == [(1, "Gold"), (2, None), (3, None)]


def test_shift_values_keeps_rows_with_null_keys(spark):
    rows = [(None, dt.date(2024, 1, 1), 1)] * 3 + [("a", None, 2)] * 2 + [("a", dt.date(2024, 1, 1), 3),
                                                                         ("a", dt.date(2024, 2, 1), 4)]
    df = spark.createDataFrame(rows, "k string, d date, v int").repartition(3)
    out = sorted(((r.k, r.d, r.v, r.mom_v) for r in X.shift_values(df, ["k"], "d", ["v"], {"mom_": 1}).collect()), key=str)
    assert out == sorted([(*r, 3 if r[2] == 4 else None) for r in rows], key=str)
