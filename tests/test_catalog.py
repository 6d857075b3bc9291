"""Inventory checks against the SURVEY §2 counts."""
from innspark.plans.registry import models


def test_model_inventory_counts():
    layer = lambda name: {n for n, m in models().items() if m.layer == name}
    assert len(layer("dim")) == 27
    assert len(layer("fact")) == 50            # 49 facts + the ML feedback fact
    assert len(layer("view")) == 48
    assert len(layer("governed")) == 67
    assert len([n for n in layer("raw") if n.startswith("src_")]) == 24   # 22 tables, request log, permissions


def test_every_model_has_oracle_sql_except_seeds_and_literals():
    missing = sorted(n for n, m in models().items() if m.sql is None)
    assert missing == []


def test_declared_tests_cover_every_dimension_and_fact(mart):
    from innspark.operators import dq
    from innspark.operators import mart_tests as D
    assert set(D.DIMENSION_KEYS) == {n for n, m in models().items() if m.layer == "dim"}
    assert set(D.NOT_NULL) == {n for n, m in models().items() if m.layer == "fact"}
    for t in dq.mart_tests([*D.DIMENSION_KEYS, *D.NOT_NULL]):
        assert t.column in mart[t.model].columns, t
