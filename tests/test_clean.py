import datetime as dt

from pyspark.sql import functions as F

from innspark.operators.clean import incremental_append, map_values
from innspark.sources.seeds import department_mapping


def test_map_values_unmapped_becomes_null(spark):
    df = spark.createDataFrame([(" f&b ",), ("HR",), ("Kitchen",), (None,)], "department string")
    got = [r.department for r in map_values(df, "department", department_mapping(spark), "department_key",
                                            "department_canonical").orderBy(F.col("department").asc_nulls_last())
           .collect()]
    assert sorted(got, key=lambda x: (x is None, x)) == ["F&B", "HR", None, None]


def test_cleaned_employees_keep_meaningful_nulls(mart):
    e = mart["employees"]
    raw = mart["src_employees"]
    assert e.count() == raw.count()                       # no dedup, no drops
    assert e.where(F.col("role_title").isNull()).count() == raw.where(F.col("role_title").isNull()).count()
    assert e.where(F.col("hire_date").isNull()).count() == 0
    assert set(r.department for r in e.select("department").distinct().collect()) <= {
        "Corporate", "F&B", "Facility", "Finance", "Housekeeping", "HR", "Revenue", "Spa&Event"}


def test_incremental_append_takes_only_newer_rows(spark):
    old = spark.createDataFrame([("b1", dt.date(2024, 1, 1)), ("b2", dt.date(2024, 1, 5))], "id string, d date")
    new = spark.createDataFrame([("b2", dt.date(2024, 1, 5)), ("b3", dt.date(2024, 1, 6))], "id string, d date")
    assert [r.id for r in incremental_append(new, old, "d").collect()] == ["b3"]
    assert incremental_append(new, None, "d").count() == 2
