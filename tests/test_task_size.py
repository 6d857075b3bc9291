"""What one task holds is bounded by a split or a partition, not by a name or a table."""
from contextlib import contextmanager

from pyspark.sql import functions as F

from innspark.functions import exprs as X
from innspark.session import configure


@contextmanager
def settings(spark, **values):
    old = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


SHUFFLED = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}


def test_lookup_spreads_a_name(spark):
    rows = spark.range(2000).selectExpr("id", "case when id % 5 = 0 then null else 'Food' end AS category")
    dim = spark.createDataFrame([(1, "Food"), (2, "Bar")], "category_id long, category_name string")
    with settings(spark, **SHUFFLED):
        out = X.lookup(rows, dim, "category", "category_name", "category_id")
        assert out.columns == ["id", "category", "category_id"]
        held = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
        got = {r.id: r.category_id for r in out.collect()}
    assert got == {i: None if i % 5 == 0 else 1 for i in range(2000)}
    assert max(r["count"] for r in held) < 1000  # one name and the nulls: all in two tasks before


def test_lookup_keeps_repeated_names(spark):
    rows = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "name string")
    dim = spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "id long, of string")
    got = sorted((tuple(r) for r in X.lookup(rows, dim, "name", "of", "id").collect()), key=repr)
    assert got == sorted([("a", 1), ("a", 2), ("a", 1), ("a", 2), ("b", None), (None, None)], key=repr)


def test_configure_bounds_splits_and_partitions(spark):
    with settings(spark, **{"spark.sql.files.maxPartitionBytes": "128m",
                            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m"}):
        configure(spark)
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "16m"
        assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_counted_key_carries_no_flags(spark, mart):
    from innspark.operators import dq
    lines = [x for x in plan(dq.fused_checks(mart, dq.SUITES)).splitlines() if "Aggregate [of_table" in x and "key" in x]
    assert lines and not any("sum(f" in x for x in lines)


def test_profile_of_a_table_groups_narrow_rows(spark):
    from innspark.operators.monitor import profile
    df = spark.createDataFrame([("a", 1.5), ("A ", -0.0), ("a", 0.0), (None, None), (None, None), ("a", 1.5)],
                               "name string, v double")
    out = profile(df, "t")
    assert "Expand" not in plan(out)
    got = {r.column_name: (r.row_count, r.distinct_count, r.case_variant_groups, r.duplicate_rows) for r in out.collect()}
    assert got == {"name": (6, 2, 1, 2), "v": (6, 2, None, 2)}


def test_payroll_is_dealt_out(spark, mart):
    assert "RepartitionByExpression" in plan(mart["src_payroll"])


def test_folds_carry_text_only(spark):
    from innspark.operators.profiles import profile_tables
    df = spark.createDataFrame([("Ab", 1, 2.0), (" ab", 1, -2.0), (None, 7, None), (None, 7, None)],
                               "name string, n int, v double")
    out = profile_tables({"t": df, "u": df.where("n = 1")})
    folds = [x for x in plan(out).splitlines() if "Aggregate [place" in x and "_groupingexpression" in x]
    assert folds and not any("min(" in x for x in folds)
    got = {(r.table_name, r.column_name): tuple(r)[1:2] + tuple(r)[3:] for r in out.collect()}
    assert got == {
        ("t", "name"): (4, 50.0, 2, 1, " ab", "Ab", None, 1, 1), ("t", "n"): (4, 0.0, 2, None, "1.0000", "7.0000", 0, None, 1),
        ("t", "v"): (4, 50.0, 2, None, "-2.0000", "2.0000", 1, None, 1),
        ("u", "name"): (2, 0.0, 2, 1, " ab", "Ab", None, 1, 0), ("u", "n"): (2, 0.0, 1, None, "1.0000", "1.0000", 0, None, 0),
        ("u", "v"): (2, 0.0, 2, None, "-2.0000", "2.0000", 1, None, 0)}


def test_outlier_series_are_numbers(spark, mart, monkeypatch):
    from innspark.operators import profiles
    seen = []
    counted = X.counted_values
    monkeypatch.setattr(X, "counted_values", lambda df, keys, v: seen.append(dict(df.dtypes)) or counted(df, keys, v))
    assert profiles.outlier_history(mart).columns[:4] == [*profiles.SERIES, "snapshot_date"]
    assert "string" not in seen[0].values()


def test_partitions_grow_with_the_tables(spark, monkeypatch):
    from innspark import session
    from innspark.plans.catalog import query_callables
    monkeypatch.setattr(session, "SHUFFLED_BYTES", 2048)
    with settings(spark, **{"spark.sql.shuffle.partitions": "8", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}):
        for name in ("fact_fnb_menu_item_daily", "fact_fnb_waste_daily", "v_fnb_waste_daily"):
            spark.conf.set("spark.sql.shuffle.partitions", "8")
            query_callables()[name](spark, "/root/testdata/sf0.001")
            assert int(spark.conf.get("spark.sql.shuffle.partitions")) > 50  # 8 before, whatever the size
            assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "2048"


def test_spread_shuffles_never_lowers(spark, tmp_base):
    from innspark.session import SHUFFLED_BYTES, spread_shuffles
    spark.range(1000).write.parquet(f"{tmp_base}/some.parquet")
    with settings(spark, **{"spark.sql.shuffle.partitions": "211", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}):
        assert spread_shuffles(spark, [f"{tmp_base}/some.parquet", f"{tmp_base}/none.parquet"]) == 211
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        assert spread_shuffles(spark, [f"{tmp_base}/some.parquet"]) == 1 and SHUFFLED_BYTES > 1 << 20
