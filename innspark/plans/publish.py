"""Publishing (A6, A8-A14): gated builds, parity-checked exports, idempotent
snapshot appends and the serving layout.

Every write goes to a fresh folder of a ``storage.Store``; a commit makes it live after
its gate passed. All tables of a publish become live in one commit, readers never
meet a missing or half-new table, and a failure at any point leaves live as it was.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from innspark.functions import exprs as X
from innspark.plans import storage
from innspark.plans.registry import Mart, models


# ---------------------------------------------------------------------------
# A6 date-partitioned rewrite, A13 serving layout
# ---------------------------------------------------------------------------
def partition_table(df: DataFrame, column: str, path: str, part_col: str = "partition_date") -> dict:
    """Rewrite the table at ``path`` (a store's folder and the table's name)
    partitioned by the day of ``column`` (timestamps are truncated to their date),
    enabling static and dynamic partition pruning."""
    base, name = storage.split(path)
    day = df.withColumn(part_col, F.to_date(column))
    # a day's rows go to few tasks, so that a partition has few files
    return storage.Store(df.sparkSession, base).replace(
        day.repartitionByRange(part_col, F.xxhash64(*df.columns)), name, partition_by=[part_col])


# Serving access paths, table -> (entity column or columns, period column); the
# lookups the serving store answers (one entity, one period).
SERVING_LAYOUTS = {
    "fact_revenue_room_type_daily": ("property_id", "period_date"),
    "fact_revenue_channel_daily": ("property_id", "period_date"),
    "fact_revenue_los_daily": ("property_id", "period_date"),
    "fact_revenue_property_daily": ("property_id", "period_date"),
    "fact_revenue_pricing_deviation": ("property_id", "period_date"),
    "fact_revenue_loyalty_daily": ("property_id", "period_date"),
    "fact_revenue_nationality_daily": ("property_id", "period_date"),
    "bookings": ("property_id", "check_in_date"),
    "pricing_history": ("property_id", "date"),
    "fact_fnb_outlet_daily": ("outlet_id", "period_date"),
    "fact_fnb_category_daily": ("outlet_id", "period_date"),
    "fact_fnb_hourly": ("outlet_id", "period_date"),
    "fact_fnb_customer_type_daily": ("outlet_id", "period_date"),
    "fact_fnb_menu_item_daily": ("outlet_id", "period_date"),
    "fact_fnb_waste_daily": ("outlet_id", "period_date"),
    "fact_fnb_ingredient_price_daily": ("ingredient_id", "period_date"),
    "fnb_transactions": ("outlet_id", "transaction_datetime"),
    "fact_housekeeping_room_type_daily": ("property_id", "period_date"),
    "fact_housekeeping_property_daily": ("property_id", "period_date"),
    "fact_housekeeping_staff_daily": ("staff_id", "period_date"),
    "fact_maintenance_ticket_daily": ("property_id", "period_date"),
    "fact_maintenance_cost_daily": ("property_id", "period_date"),
    "fact_maintenance_technician_daily": ("assigned_staff_id", "period_date"),
    "fact_maintenance_room_recurrence_yearly": ("room_id", "year"),
    "maintenance_tickets": ("property_id", "reported_date"),
    "fact_spa_daily": ("property_id", "period_date"),
    "fact_spa_customer_type_daily": ("property_id", "period_date"),
    "fact_spa_service_daily": ("property_id", "period_date"),
    "fact_event_venue_daily": ("venue_id", "period_date"),
    "fact_event_property_daily": ("property_id", "period_date"),
    "fact_event_type_daily": ("property_id", "period_date"),
    "event_bookings": ("property_id", "event_date"),
    "fact_hr_attendance_daily": (("property_id", "department_id"), "period_date"),
    "fact_hr_employee_monthly": ("employee_id", "period_date"),
    "fact_hr_employee_performance_semester": ("employee_id", "review_period"),
    "fact_hr_watchlist_monthly": ("employee_id", "period_date"),
    "dim_employee": ("property_id", None),
    "staff_shifts": ("employee_id", "date"),
    "employee_performance": ("employee_id", "review_period"),
    "fact_financial_business_line_monthly": ("property_id", "period_date"),
    "fact_financial_overall_monthly": ("property_id", "period_date"),
    "fact_financial_revenue_runrate_daily": ("property_id", "period_date"),
    "fact_payroll_department_monthly": ("property_id", "period_date"),
    "fact_financial_service_charge_monthly": ("property_id", "period_date"),
    "fact_financial_labor_cost_monthly": ("property_id", "period_date"),
    "fact_payroll_access_level_monthly": ("property_id", "period_date"),
    "fact_financial_business_line_group_monthly": ("business_line_id", "period_date"),
    "fact_financial_property_benchmark_monthly": ("property_id", "period_date"),
    "financial_summary": ("property_id", "period"),
    "payroll": ("employee_id", "period"),
}


def serving_layout(df: DataFrame, entity: str | tuple[str, ...], date_col: str,
                   partitions: int | None = None) -> DataFrame:
    """Range-partition by (entity, date) and sort within partitions, so
    Parquet row-group min/max stats skip everything but the requested
    entity-period (the role the serving indexes play)."""
    columns = list(dict.fromkeys([*([entity] if isinstance(entity, str) else entity), date_col]))
    ranged = (df.repartitionByRange(partitions, *columns) if partitions
              else df.repartitionByRange(*columns))  # as many files as the data's size asks for
    return ranged.sortWithinPartitions(*columns)


# ---------------------------------------------------------------------------
# A9 scope selection, A8 gated publish
# ---------------------------------------------------------------------------
def select_models(select: list[str] | None = None, exclude: list[str] | None = None,
                  layers=("dim", "fact")) -> list[str]:
    """Model names by name glob or ``tag:<tag>`` (ML stays isolated unless
    selected explicitly)."""
    def match(name, mdl, pats):
        for p in pats:
            if p.startswith("tag:"):
                if p[4:] in mdl.tags:
                    return True
            elif fnmatch.fnmatch(name, p):
                return True
        return False
    out = []
    for name, mdl in models().items():
        if mdl.layer not in layers:
            continue
        if select and not match(name, mdl, select):
            continue
        if exclude and match(name, mdl, exclude):
            continue
        if not select and "ml" in mdl.tags:
            continue
        out.append(name)
    return out


def publish(mart: Mart, names: list[str], base: str, gate=None) -> dict:
    """Stage ``names``, run the gate over the staged tables, and only if every
    check passes make all of them live in one commit of the store at ``base``. Each
    table is built once, from the staged tables before it and the live ones that
    aren't built. If one of them was published by somebody else meanwhile, nothing
    changes and ``storage.Conflict`` is raised. Returns the gate outcome.

    ``gate(staged: dict[name, DataFrame]) -> DataFrame`` returns check rows
    with a boolean ``success`` column (e.g. the DQ suites)."""
    store = storage.Store(mart.spark, base)
    live = store.manifest()
    layers = models()
    # what isn't published now stays as it is live: facts take the ids of live dimensions
    for n in layers:
        if n not in names and layers[n].layer in ("dim", "fact"):
            frame = store.read(n, live)
            if frame is not None:
                mart = mart.with_frame(n, frame)
    folders, staged = {}, {}
    for n in sorted(names, key=lambda n: layers[n].layer != "dim"):
        folders[n] = store.stage(mart[n], n)
        staged[n] = store.staged(folders[n])
        mart = mart.with_frame(n, staged[n])  # its children read what is staged
    failures = 0
    if gate is not None:
        checks = gate(staged, mart) if gate is mart_tests_gate else gate(staged)
        failures = checks.where(~F.coalesce(F.col("success"), F.lit(False))).count()
    if failures:
        for folder in folders.values():
            store.discard(folder)
        return {"published": [], "failed_checks": failures, "version": live["version"]}
    new = store.commit({n: storage.Change([folders[n]]) for n in names}, based=live)
    return {"published": names, "failed_checks": 0, "version": new["version"]}


def not_null_gate(columns: dict[str, list[str]]):
    """A simple gate: grain columns of each staged table must be non-null."""
    def gate(staged: dict[str, DataFrame]) -> DataFrame:
        parts = []
        for n, df in staged.items():
            cols = columns.get(n, [])
            if not cols:
                continue
            agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
            parts.append(agg.select(F.lit(n).alias("model"), F.inline(F.array(*[
                F.struct(F.lit(c).alias("column"), (F.col(c) == 0).alias("success")) for c in cols]))))
        if not parts:
            return next(iter(staged.values())).sparkSession.createDataFrame(
                [], "model string, column string, success boolean")
        return X.union_all(parts)
    return gate


# ---------------------------------------------------------------------------
# A10/A11 export with row-count parity, sync log
# ---------------------------------------------------------------------------
SYNC_LOG_SCHEMA = ("dataset_name string, table_name string, status string, source_row_count long, "
                   "target_row_count long, old_table_status string, swap_duration_ms double, "
                   "is_simulated boolean, synced_at timestamp")


def export_with_parity(df: DataFrame, live_path: str, dataset: str, table: str, now: dt.datetime,
                       write=None) -> dict:
    """A10: copy ``df`` beside the table at ``live_path`` (a store's folder and the
    table's name), compare row counts of source and copy BEFORE the commit that makes it
    live; on mismatch drop the copy and keep live. ``write`` (path -> None) can replace
    the plain Parquet writer, e.g. with a JDBC writer for a serving database."""
    spark = df.sparkSession
    base, name = storage.split(live_path)
    store = storage.Store(spark, base)
    live = store.manifest()
    if write:
        folder = f"{name}/{uuid.uuid4().hex}"
        write(f"{base}/data/{folder}")
        src_n = df.count()
    else:  # the rows are counted as they are written: one evaluation
        seen = Observation()
        folder = store.stage(df.observe(seen, F.count(F.lit(1)).alias("n")), name)
        src_n = seen.get["n"]
    dst_n = spark.read.schema(df.schema).parquet(f"{base}/data/{folder}").count()
    row = {"dataset_name": dataset, "table_name": table, "source_row_count": src_n, "target_row_count": dst_n,
           "is_simulated": False, "synced_at": now}
    if src_n != dst_n:
        store.discard(folder)
        row.update(status="mismatch_aborted", old_table_status=None, swap_duration_ms=None)
        return row
    t0 = time.monotonic()
    store.commit({name: storage.Change([folder])}, based=live)
    row.update(status="synced", old_table_status="kept" if name in live["tables"] else "n/a",
               swap_duration_ms=round((time.monotonic() - t0) * 1000, 2))
    return row


def export_tables(table: str | None = None, domain: str | None = None) -> dict[str, str]:
    """Table -> dataset of what can be exported: the cleaned tables, dimensions and
    facts; one of them by name, those of a domain (tag), or all."""
    layers = {"cleaned": "mart_cleaned", "dim": "mart_aggregated", "fact": "mart_aggregated"}
    out = {n: layers[mdl.layer] for n, mdl in models().items() if mdl.layer in layers
           and table in (None, n) and (domain is None or domain in mdl.tags)}
    if not out:
        raise KeyError(f"nothing to export for table {table!r}, domain {domain!r}")
    return out


def export_serving(mart: Mart, base: str, now: dt.datetime, tables=None, domain: str | None = None) -> DataFrame:
    """A10 + A13: export tables to the serving store, each behind the row-count
    parity gate, in its (entity, period) layout if it has one; returns the sync
    log. ``tables`` are names; without them a domain's, or all."""
    chosen = export_tables(domain=domain) if tables is None else {
        k: v for n in tables for k, v in export_tables(n).items()}
    rows = []
    for name, dataset in chosen.items():
        df = mart[name]
        if name in SERVING_LAYOUTS:
            entity, period = SERVING_LAYOUTS[name]
            df = serving_layout(df, entity, period or (entity if isinstance(entity, str) else entity[0]))
        rows.append(export_with_parity(df, f"{base}/{name}", dataset, name, now))
    return sync_log_rows(mart.spark, rows)


def sync_log_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Sync outcomes as rows of the sync log (append to the log table)."""
    cols = [c.split()[0] for c in SYNC_LOG_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], SYNC_LOG_SCHEMA)


# ---------------------------------------------------------------------------
# A12 idempotent snapshot append
# ---------------------------------------------------------------------------
def append_snapshot(new: DataFrame, path: str, date_col: str = "snapshot_date") -> None:
    """Add one day's snapshot to a history partitioned by ``date_col``.
    Dynamic partition overwrite replaces only the days present in ``new``, so a
    re-run on the same day replaces that day instead of duplicating it."""
    (new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col).parquet(path))


# ---------------------------------------------------------------------------
# A14 test-run results ingestion
# ---------------------------------------------------------------------------
def read_run_results(spark: SparkSession, path: str, layer: str, captured_at: dt.datetime) -> DataFrame:
    """One row per test of a run-results JSON document."""
    doc = spark.read.option("multiLine", True).json(path)
    r = doc.select(F.explode("results").alias("r"))
    parts = F.split(F.col("r.unique_id"), r"\.")
    return r.select(F.lit(layer).alias("layer"), F.col("r.unique_id").alias("unique_id"),
                    F.element_at(parts, 3).alias("test_name"), F.element_at(parts, 1).alias("resource_type"),
                    F.col("r.status").alias("status"), F.col("r.execution_time").cast("double").alias("execution_time"),
                    F.col("r.failures").cast("int").alias("failures"),
                    F.lit(captured_at).cast("timestamp").alias("captured_at"))


# ---------------------------------------------------------------------------
# Build and publish the mart in one call
# ---------------------------------------------------------------------------
def mart_tests_gate(staged: dict[str, DataFrame], mart: Mart | None = None) -> DataFrame:
    """The declared mart tests (G12) of the staged tables. Relationships are
    checked against the parent that will be live: the staged one, or the
    published one that this publish leaves."""
    from innspark.operators import dq
    frames = staged if mart is None else mart
    tests = [t for t in dq.mart_tests(staged)
             if t.kind != dq.RELATIONSHIP or t.arg[0] in staged or mart is not None]
    return dq.run_mart_tests(frames, tests)


def publish_mart(mart: Mart, base: str, select: list[str] | None = None, exclude: list[str] | None = None,
                 reliable: bool = True, gate=mart_tests_gate) -> dict:
    """Build the selected dimensions and facts (default: all but ML), stage
    them, gate them with the mart tests and publish only if every test passed.
    Inputs shared by many models are checkpointed once (``reliable``) so a lost
    executor replays from the checkpoint, not from the sources."""
    mart.persist_shared(reliable=reliable)
    names = select_models(select, exclude)
    return publish(mart, names, base, gate=gate)


def register_published(spark: SparkSession, base: str, names: list[str], database: str = "mart",
                       analyze: bool = True) -> list[str]:
    """Expose the newest published tables in the catalog as external Parquet tables
    and compute their statistics, so the cost-based optimiser and the
    broadcast threshold work from measured sizes and row counts (the checked
    size a broadcast decision needs) instead of file-size guesses."""
    store = storage.Store(spark, base)
    live = store.manifest()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    out = []
    for n in names:
        folder, = store.folders(n, live)
        table = f"{database}.{n}"
        if spark.catalog.tableExists(table) and spark.table(table).schema == spark.read.parquet(folder).schema:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")  # the name never goes missing
            spark.catalog.refreshTable(table)
        else:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{folder}'")
        if analyze:
            spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
        out.append(table)
    return out
