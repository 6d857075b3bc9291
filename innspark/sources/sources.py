"""Registers the raw source tables (``src_<table>``) and seeds as models."""

from __future__ import annotations

from innspark.plans.registry import register
from innspark.sources import fixtures, seeds


def _src_builder(name):
    def build(m):
        return fixtures.source_spark(m.spark, m.sf_dir, name, m.get)
    return build


for _name in fixtures.SOURCE_TABLES:
    register(f"src_{_name}", "raw", _src_builder(_name), fixtures.source_sql(_name))

register("src_role_permissions", "raw", lambda m: seeds.role_permissions(m.spark),
         seeds.role_permissions_sql())
register("department_mapping", "seed", lambda m: seeds.department_mapping(m.spark),
         seeds.department_mapping_sql())
