"""Incremental extract (A1-A5).

``extract`` reads only rows past the stored cursor (a filter Catalyst pushes
into the source scan), stamps the lineage column and returns the new cursor
as a typed ``max`` (S2: never a string comparison). A cycle reads the source once,
into a staged folder, and counts its rows and finds its cursor as it writes them; rows
that arrive meanwhile wait for the next cycle. One commit of the store makes rows, cursor
(A5) and batch id visible together: a cycle that dies before it has no effect, and a
batch that is delivered again is known by its id, so every row is loaded exactly once.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from innspark.plans.registry import model
from innspark.plans.storage import Change, Store


@dataclass(frozen=True)
class ExtractSpec:
    schema: str
    table: str
    cursor_column: str | None       # None -> full refresh
    strategy: str = "cursor"        # 'cursor' | 'full_refresh'
    key: str | None = None          # primary key, used by the overlap mode


def fetch(src: DataFrame, spec: ExtractSpec, last_cursor, synced_at: dt.datetime,
          overlap: bool = False, already_loaded: DataFrame | None = None) -> DataFrame:
    """A1/A2/A3: the rows past the cursor, stamped.

    By default strictly past it (S1). With ``overlap`` the boundary value is read
    again (``>=``) and rows whose key is already loaded are dropped, so late rows
    with an equal cursor are not lost."""
    df = src
    if spec.strategy != "full_refresh" and last_cursor is not None:
        c = F.col(spec.cursor_column)
        if overlap:
            df = df.where(c >= F.lit(last_cursor))
            if already_loaded is not None and spec.key:
                seen = already_loaded.where(F.col(spec.cursor_column) >= F.lit(last_cursor)).select(spec.key)
                df = df.join(seen, spec.key, "left_anti")
        else:
            df = df.where(c > F.lit(last_cursor))
    return df.withColumn("_synced_at", F.lit(synced_at).cast("timestamp"))


def extract(src: DataFrame, spec: ExtractSpec, last_cursor, synced_at: dt.datetime,
            overlap: bool = False, already_loaded: DataFrame | None = None) -> tuple[DataFrame, object]:
    """``fetch`` and the cursor after it, for sources that don't change meanwhile."""
    df = fetch(src, spec, last_cursor, synced_at, overlap, already_loaded)
    if spec.strategy == "full_refresh":
        return df, None
    top = df.agg(F.max(spec.cursor_column)).first()[0]
    return df, (top if top is not None else last_cursor)


def write_mode(spec: ExtractSpec, last_cursor) -> str:
    """A4: truncate on full refresh or first run, append otherwise."""
    return "overwrite" if spec.strategy == "full_refresh" or last_cursor is None else "append"


CURSOR_SCHEMA = "schema_name string, table_name string, last_cursor string, updated_at timestamp"
MOST_FOLDERS = 32  # of a table, before its batches are written together


def _cursor_key(spec: ExtractSpec) -> str:
    return f"cursor:{spec.schema}.{spec.table}"


def read_cursor(manifest: dict, spec: ExtractSpec) -> str | None:
    """The stored cursor as text."""
    stored = manifest["state"].get(_cursor_key(spec))
    return json.loads(stored)["last_cursor"] if stored else None


def cursors(store: Store) -> DataFrame:
    """A5: the cursor state, one row per source table."""
    rows = []
    for key, stored in store.manifest()["state"].items():
        if key.startswith("cursor:"):
            schema, _, table = key[len("cursor:"):].partition(".")
            row = json.loads(stored)
            rows.append((schema, table, row["last_cursor"], dt.datetime.fromisoformat(row["updated_at"])))
    return store.spark.createDataFrame(rows, CURSOR_SCHEMA)


def run_extract(store: Store, src: DataFrame, spec: ExtractSpec, synced_at: dt.datetime, overlap: bool = False,
                batch: str | None = None) -> dict:
    """One extract cycle into ``store``: read past the cursor, then one commit of rows
    and cursor. Nothing is committed when there are no new rows, or when the table has
    the ``batch`` already. Another extract of the same table that commits first makes this
    one raise ``storage.Conflict`` without effect."""
    live = store.manifest()
    if batch is not None and batch in live["tables"].get(spec.table, {}).get("batches", []):
        return {"table": spec.table, "rows": 0, "mode": "skipped", "cursor": read_cursor(live, spec)}
    whole = spec.strategy == "full_refresh" or not spec.cursor_column
    text = None if whole else read_cursor(live, spec)
    last = None if text is None else F.lit(text).cast(src.schema[spec.cursor_column].dataType)
    loaded = store.read(spec.table, live) if overlap and last is not None else None
    rows = fetch(src, spec, last, synced_at, overlap, loaded)
    seen = Observation()
    top = F.lit(None).cast("string") if whole else F.max(spec.cursor_column).cast("string")
    folder = store.stage(rows.observe(seen, F.count(F.lit(1)).alias("n"), top.alias("top")), spec.table)
    n, cursor = seen.get["n"], seen.get.get("top") or text
    mode = write_mode(spec, last)
    if not n:
        store.discard(folder)
        return {"table": spec.table, "rows": 0, "mode": mode, "cursor": text}
    state = None if whole else {_cursor_key(spec): json.dumps(
        {"last_cursor": cursor, "updated_at": synced_at.isoformat()})}
    store.commit({spec.table: Change([folder], "replace" if mode == "overwrite" else "append", batch)}, state, live)
    if len(store.folders(spec.table)) > MOST_FOLDERS:
        store.compact(spec.table)
    return {"table": spec.table, "rows": n, "mode": mode, "cursor": cursor}


_BOOKINGS = ExtractSpec("reservation_revenue", "bookings", "booking_id", key="booking_id")


@model("extract_replayed_bookings", "ops", "SELECT * FROM src_bookings", tags=("extract",))
def extract_replayed_bookings(m):
    """A1-A5 end to end on the bookings: a first load of the older half, a cycle that dies
    after it has written its rows, the cycle again, and its batch delivered once more.
    The loaded table is the source, each row once."""
    import uuid

    from innspark.session import scratch_dir
    store = Store(m.spark, scratch_dir(m.spark, f"extract-{uuid.uuid4().hex}"))
    src = m["src_bookings"]
    half = src.agg(F.percentile_approx(F.regexp_extract("booking_id", r"(\d+)$", 1).cast("long"), 0.5)).first()[0]
    older = F.regexp_extract("booking_id", r"(\d+)$", 1).cast("long") <= F.lit(half)
    at = dt.datetime.combine(m.as_of, dt.time(6, 0))
    run_extract(store, src.where(older), _BOOKINGS, at, batch="day-1")
    last = F.lit(read_cursor(store.manifest(), _BOOKINGS))
    store.stage(fetch(src, _BOOKINGS, last, at), "bookings")  # written, never committed
    for _ in range(2):
        run_extract(store, src, _BOOKINGS, at + dt.timedelta(days=1), batch="day-2")
    return store.read("bookings").drop("_synced_at")
