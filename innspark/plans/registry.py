"""Model registry: every source, cleaned table, dimension, fact and view is a
named builder ``fn(mart) -> DataFrame`` plus (optionally) the DuckDB SQL of the
same model used as the correctness oracle.

``Mart`` resolves names lazily and memoises the DataFrames of one build, so a
model read by several consumers (e.g. fact_revenue_room_type_daily) is planned
once; ``persist_shared`` marks such inputs for reuse during a full build.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# Snapshot models read "today" in the reference; here it is a parameter.
DEFAULT_AS_OF = dt.date(1998, 8, 2)


@dataclass
class Model:
    name: str
    build: Callable[["Mart"], DataFrame]
    sql: str | None
    layer: str
    tags: tuple[str, ...] = field(default_factory=tuple)


MODELS: dict[str, Model] = {}


def model(name: str, layer: str, sql: str | Callable[[], str] | None = None,
          tags: tuple[str, ...] = ()):
    """Register ``fn(mart)`` as model ``name``; ``sql`` is its DuckDB oracle body."""
    def deco(fn):
        MODELS[name] = Model(name, fn, sql() if callable(sql) else sql, layer, tags)
        return fn
    return deco


def register(name: str, layer: str, fn, sql: str | None, tags: tuple[str, ...] = ()):
    MODELS[name] = Model(name, fn, sql, layer, tags)


class Mart:
    """One build of the warehouse over one source folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: dt.date = DEFAULT_AS_OF,
                 overrides: dict[str, DataFrame] | None = None, published: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self.published = published.rstrip("/") if published else None
        self._version: dict | None = None  # the published version that this build reads
        self._cache: dict[str, DataFrame] = dict(overrides or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            _load_all()
            if name not in MODELS:
                raise KeyError(f"unknown model {name!r}")
            self._cache[name] = self._published(name) or MODELS[name].build(self)
        return self._cache[name]

    def _published(self, name: str) -> DataFrame | None:
        """With ``published`` set, models already published in the store there are
        read from it instead of rebuilt — the serving path: views and governed queries
        start at the published fact scan, with their filters pushed into it. One build
        reads one version, whatever is published meanwhile."""
        if not self.published or MODELS[name].layer not in ("dim", "fact", "cleaned"):
            return None
        from innspark.plans.storage import Store
        store = Store(self.spark, self.published)
        if self._version is None:
            self._version = store.manifest()
        return store.read(name, self._version)

    def get(self, name: str) -> DataFrame:
        return self[name]

    def with_frame(self, name: str, frame: DataFrame) -> Mart:
        """A build in which ``name`` is ``frame`` and what derives from it is built
        on that; the rest that was resolved before is kept."""
        out = Mart(self.spark, self.sf_dir, self.as_of, published=self.published)
        out._version = self._version
        kept = getattr(self, "_fixed", {}) | {name: frame}
        out._fixed = kept
        out._cache = {k: v for k, v in self._cache.items()
                      if k not in MODELS or MODELS[k].layer in ("raw", "cleaned")} | kept
        return out

    def persist_shared(self, names=("bookings", "fnb_transactions", "fact_revenue_room_type_daily"),
                       reliable: bool = False):
        """Reuse inputs with several consumers during a full build.

        ``reliable=False`` caches them (lost blocks are recomputed from
        lineage); ``reliable=True`` checkpoints them to the cluster's shared
        ``spark.checkpoint.dir``, cutting the lineage so a lost executor only
        re-reads the checkpoint instead of replaying the sources."""
        from innspark.session import ensure_checkpoint_dir
        if reliable:
            ensure_checkpoint_dir(self.spark)
        for n in names:
            self._cache[n] = self[n].checkpoint(eager=True) if reliable else self[n].persist()
        return self


_LOADED = False


def _load_all():
    global _LOADED
    if _LOADED:
        return
    _LOADED = True
    # importing the operator modules registers their models
    from innspark.operators import (access, audits, clean, dims, dq, facts_facility, facts_finance,  # noqa: F401
                                    facts_fnb, facts_hr, facts_reservation, facts_spa_event,
                                    ml, monitor, observability, profiles, published, views)
    from innspark.sources import extract, sources  # noqa: F401
    from innspark.streaming import streams  # noqa: F401


def models(layer: str | None = None) -> dict[str, Model]:
    _load_all()
    return {k: m for k, m in MODELS.items() if layer is None or m.layer == layer}


# ---------------------------------------------------------------------------
# Oracle composition: WITH <every model the query needs> <query>
# ---------------------------------------------------------------------------
_IDENT = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _deps(sql: str, own: str | None = None) -> list[str]:
    seen = []
    for tok in _IDENT.findall(sql):
        if tok != own and tok in MODELS and MODELS[tok].sql is not None and tok not in seen:
            seen.append(tok)
    return seen


def oracle_for_sql(sql: str) -> str:
    """Prefix ``sql`` with CTEs for every registered model it (transitively) reads."""
    _load_all()
    order: list[str] = []
    visiting: set[str] = set()

    def visit(n: str):
        if n in order:
            return
        if n in visiting:
            raise ValueError(f"cycle at {n}")
        visiting.add(n)
        for d in _deps(MODELS[n].sql, n):
            visit(d)
        visiting.discard(n)
        order.append(n)

    for d in _deps(sql):
        visit(d)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS (\n{MODELS[n].sql}\n)" for n in order)
    return f"WITH {ctes}\n{sql}"


def oracle_for(name: str) -> str:
    _load_all()
    return oracle_for_sql(f"SELECT * FROM {name}")
