"""Shuffle files stay on the disk until a query ends: queries over many tables take one after another."""
import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from innspark.functions import exprs as X
from innspark.operators import dq, profiles
from innspark.operators import monitor as M
from innspark.session import DROP_SHUFFLES, shuffles_dropped


def shuffle_files(spark) -> set:
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, files in os.walk(d.getPath()) for f in files if f.startswith("shuffle_")}


def grouped(spark, n, name):
    return spark.range(n).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n")).agg(
        F.sum("n").alias("n"), F.lit(name).alias("name"))


@pytest.fixture()
def parts(monkeypatch):
    """The frames that are evaluated by themselves."""
    seen, write = [], X.write_part
    monkeypatch.setattr(X, "write_part", lambda df, path: seen.append(df) or write(df, path))
    return seen



def test_union_apart_leaves_no_shuffle_files(spark):
    before, old = shuffle_files(spark), spark.conf.get(DROP_SHUFFLES)
    out = X.union_apart(grouped(spark, n, f"t{n}") for n in (10, 20))
    for _ in range(50):  # they go in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(DROP_SHUFFLES) == old
    assert sorted((r.name, r.n) for r in out.collect()) == [("t10", 10), ("t20", 20)]


def test_setting_is_put_back(spark):
    old = spark.conf.get(DROP_SHUFFLES)
    with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
        assert spark.conf.get(DROP_SHUFFLES) == "true"
        raise ZeroDivisionError
    assert spark.conf.get(DROP_SHUFFLES) == old
    with pytest.raises(ValueError):
        X.union_apart([])


def test_mart_tests_take_one_model_after_another(spark, parts):
    child = spark.createDataFrame([("a", "x"), ("a", None), ("b", "y"), (None, "x"), ("zz", "q"), ("zz", "q")],
                                  "outlet_id string, kind string")
    frames = {"child": child, "dim": spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "outlet_id string"),
              "other": spark.createDataFrame([], "outlet_id string")}
    tests = [dq.MartTest("child", "not_null", "outlet_id"), dq.MartTest("child", "accepted", "kind", ["x", "y"]),
             dq.MartTest("child", dq.RELATIONSHIP, "outlet_id", ("dim", "outlet_id")),
             dq.MartTest("child", "unique", "outlet_id"), dq.MartTest("other", "not_null", "outlet_id"),
             dq.MartTest("other", dq.RELATIONSHIP, "outlet_id", ("dim", "outlet_id"))]
    got = {(r.model, r.test): (r.success, r.failures) for r in dq.run_mart_tests(frames, tests).collect()}
    assert got == {("child", "not_null"): (False, 1), ("child", "accepted"): (False, 2),
                   ("child", dq.RELATIONSHIP): (False, 2), ("child", "unique"): (False, 4),
                   ("other", "not_null"): (True, 0), ("other", dq.RELATIONSHIP): (True, 0)}
    assert len(parts) == 2


def test_mart_tests_evaluate_a_fact_once(spark):
    frames = {"fact": spark.range(9).selectExpr("id as room_id", "id % 2 as period_date"),
              "dim": spark.range(5).withColumnRenamed("id", "room_id")}
    tests = [dq.MartTest("fact", "not_null", c) for c in ("room_id", "period_date")]
    tests.append(dq.MartTest("fact", dq.RELATIONSHIP, "room_id", ("dim", "room_id")))
    out = dq._model_tests(frames, "fact", tests)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Range (0, 9") == 1
    assert {(r.test, r.failures) for r in out.collect()} == {("not_null", 0), (dq.RELATIONSHIP, 4)}


def test_volume_takes_one_table_after_another(spark, parts):
    a = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    out = M.layer_volume({"src_a": a, "a": a, "b": a.where("k > 5")}, {"raw": ["src_a"], "clean": ["a"], "mart": ["b"]},
                         dt.date(2026, 8, 2))
    assert sorted((r.dataset_name, r.table_name, r.row_count) for r in out.collect()) == [
        ("clean", "a", 3), ("mart", "b", 0), ("raw", "src_a", 3)]
    assert len(parts) == 2  # a's two layers at once


def test_profile_takes_one_table_after_another(spark, parts):
    a = spark.createDataFrame([("x", 1), ("x", 1), (" X", None), (None, None)], "name string, n int")
    frames = {"a": a, "b": a.select("n", "name").distinct(), "e": a.where("false")}
    apart = sorted(map(repr, profiles.profile_tables(frames, X.union_apart).collect()))
    assert len(parts) == 6 and all(p.count() <= 2 for p in parts)  # a table's columns, and its rows
    assert apart == sorted(map(repr, profiles.profile_tables(frames).collect()))
    assert [r for r in apart if "table_name='a'" in r and "duplicate_rows=1" not in r] == []


def test_profile_shuffles_no_text_of_rows(spark):
    df = spark.createDataFrame([("x", 1)], "name string, n int")
    assert "base64" not in profiles.profile_tables({"a": df})._jdf.queryExecution().optimizedPlan().toString()


def test_shifted_rows_are_not_shuffled_for_their_keys(spark):
    day = dt.date
    rows = [("a", day(2024, 2, 29), 1, "p"), ("a", day(2024, 3, 31), 2, None), ("a", day(2025, 3, 31), 3, "q"),
            (None, day(2024, 2, 29), 4, "r"), (None, day(2024, 2, 29), 4, "r"), ("b", None, 5, "s")]
    df = spark.createDataFrame(rows, "k string, d date, v int, w string")
    out = X.shift_values(df, ["k"], "d", ["v"], {"mom_": 1, "yoy_": 12})
    assert out.columns == ["k", "d", "v", "w", "mom_v", "yoy_v"]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([
        ("a", day(2024, 2, 29), 1, "p", None, None), ("a", day(2024, 3, 31), 2, None, 1, None),
        ("a", day(2025, 3, 31), 3, "q", None, 2), (None, day(2024, 2, 29), 4, "r", None, None),
        (None, day(2024, 2, 29), 4, "r", None, None), ("b", None, 5, "s", None, None)], key=repr)
    plan = lambda x: x._jdf.queryExecution().optimizedPlan().toString()
    assert "first(__row" in plan(out) and "first(__row" not in plan(out.select("k", "d"))
