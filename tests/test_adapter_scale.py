"""The adapter keeps keys apart and grows with the data."""
import re

import duckdb
import pytest

from innspark.sources.fixtures import DERIVED, _lp, source_sql

KEYS = [0, 7, 99, 12_345, 999_999, 1_000_000, 12_345_678, 12_345_679, 123_456_789, 9_876_543_210]


@pytest.mark.parametrize("width", [2, 3, 4, 6, 7, 9])
def test_padding_keeps_all_digits(spark, width):
    got = [r[0] for r in spark.createDataFrame([(k,) for k in KEYS], "k long").selectExpr(_lp("k", width)).collect()]
    assert got == [str(k).zfill(width) for k in KEYS]
    assert [r[0] for r in duckdb.sql(
        f"SELECT {_lp('k', width)} FROM (SELECT unnest({KEYS}) AS k)").fetchall()] == got


def test_no_prefix_or_subset_is_read():
    kept = {name: d.where for name, d in DERIVED.items() if d.where}
    assert kept == {"fnb_waste_log": "l_returnflag = 'R'"}


@pytest.mark.parametrize("table", ["rooms", "fnb_outlets", "fnb_inventory", "ingredient_price_history",
                                   "recipe_bom", "venues", "financial_summary", "housekeeping_log"])
def test_tables_grow(table):
    rows = []
    for sf in ("sf0.001", "sf0.01"):
        con = duckdb.connect()
        for base in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
            con.execute(f"CREATE VIEW {base} AS SELECT * FROM '/root/testdata/{sf}/{base}.parquet'")
        for name in ("rooms", "bookings", "fnb_outlets", "fnb_transactions", "spa_bookings", "event_bookings"):
            con.execute(f"CREATE VIEW src_{name} AS {source_sql(name)}")
        sql = source_sql(table)
        if table == "financial_summary":  # its rows are months; their sums grow
            rows.append(con.execute(f"SELECT sum(departmental_revenue) FROM ({sql})").fetchone()[0])
        else:
            rows.append(con.execute(f"SELECT count(*) FROM ({sql})").fetchone()[0])
    assert rows[1] >= 5 * rows[0], rows


def test_modulo_gives_attributes_only():
    # ids, the columns that others join with, don't come from a remainder
    for name, d in DERIVED.items():
        for expr, col in ((e, c) for c, e in d.cols):
            if re.search(r"(room|outlet|guest|employee|staff|venue|ingredient|booking|ticket|transaction)_id$", col) \
                    and col != "property_id":
                assert not re.search(r"'(RM|OUT|G|E|VN|ING|BK|MT|TX)' \|\|[^|]*%", expr), (name, col)
