"""The query catalog handed to the driver: every registered model of the
published layers plus the operator queries (data quality, monitoring,
governance, ML), each with its DuckDB oracle when SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from innspark.plans.registry import Mart, models, oracle_for, oracle_for_sql

# layers whose models are published tables/views and therefore checked
QUERY_LAYERS = ("cleaned", "dim", "fact", "view", "governed", "ops")
# pass-through copies and fixed literal tables are not queries of their own
SKIP = {"dim_nationality_group"}


def _model_query(name: str):
    def run(spark, sf_dir):
        from innspark.session import configure, spread_shuffles
        from innspark.sources.fixtures import MART_TABLES
        configure(spark)
        spread_shuffles(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in MART_TABLES])
        return Mart(spark, sf_dir)[name]
    run.__name__ = f"q_{name}"
    return run


def _names():
    out = []
    for n, mdl in models().items():
        if mdl.layer not in QUERY_LAYERS or n in SKIP:
            continue
        if mdl.layer == "cleaned" and n not in ("employees", "guests"):
            continue
        out.append(n)
    return out


def query_callables() -> dict[str, Callable]:
    return {n: _model_query(n) for n in _names()}


def oracle_sqls() -> dict[str, str]:
    out = {}
    for n in _names():
        mdl = models()[n]
        if mdl.sql is not None and "no_oracle" not in mdl.tags:
            out[n] = oracle_for(n)
    return out


__all__ = ["query_callables", "oracle_sqls", "oracle_for_sql"]
