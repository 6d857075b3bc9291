"""Structured Streaming re-aims.

The reference has no stream; these are the streaming forms of its batch
operators over logs it keeps: J1 the incremental extract as a file stream
(exactly-once via the checkpoint), J2 the daily request-volume report and J3
five-minute request counts, both event-time windows with a watermark.
Queries run with ``Trigger.AvailableNow`` so a scheduled run drains what has
arrived and stops; the checkpoint lives under the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innspark.functions import exprs as X
from innspark.session import scratch_dir
from innspark.plans.registry import model
from innspark.plans.storage import Change, Store
from innspark.sources import fixtures

WATERMARK = "1 hour"


def request_log_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The governed-request log as a stream: new ``events`` files as they land,
    shaped into log rows, event time as a timestamp.

    The files of one run form one micro-batch unless a number is given: the
    watermark moves between batches only, so files without time order lose no
    row to it. A number is right where files arrive in the order of their events."""
    schema = fixtures.read_base(spark, sf_dir, "events").schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.parquet(f"{sf_dir.rstrip('/')}/events*.parquet")
    spec = fixtures.DERIVED["chatbot_query_log"]
    return raw.selectExpr(*[f"{e} AS {c}" for c, e in spec.cols]).withColumn(
        "event_time", F.col("requested_at").cast("timestamp"))


def daily_requests(stream: DataFrame) -> DataFrame:
    """Requests and denied share per day; state for a day is dropped once
    the watermark passes its end."""
    w = stream.withWatermark("event_time", WATERMARK).groupBy(F.window("event_time", "1 day"))
    return w.agg(F.count(F.lit(1)).alias("request_count"),
                 F.count_if(F.col("status") == "denied").alias("denied_count"))


def five_minute_counts(stream: DataFrame) -> DataFrame:
    """Request counts per domain in 5-minute tumbling windows."""
    return (stream.withWatermark("event_time", WATERMARK)
            .groupBy(F.window("event_time", "5 minutes"), "domain")
            .agg(F.count(F.lit(1)).alias("request_count")))


def run_available_now(df: DataFrame, sink: str, checkpoint: str, mode: str = "append",
                      timeout_s: int | None = None) -> None:
    """Drain the available input into a Parquet sink and stop. A run that isn't done
    after ``timeout_s`` is stopped and raises: its sink isn't a result."""
    q = (df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
         .outputMode(mode).trigger(availableNow=True).start())
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"the stream to {sink} wasn't drained within {timeout_s} s")


def incremental_extract_stream(spark: SparkSession, src_glob: str, schema, sink: str, checkpoint: str) -> None:
    """The cursor-based extract as a file stream — every file is loaded once
    (tracked by the checkpoint), stamped with the load time."""
    s = spark.readStream.schema(schema).parquet(src_glob).withColumn("_synced_at", F.current_timestamp())
    run_available_now(s, sink, checkpoint)


def closed_windows(result: DataFrame) -> DataFrame:
    return result.select(F.col("window.start").cast("timestamp_ntz").alias("window_start"),
                         F.col("window.end").cast("timestamp_ntz").alias("window_end"),
                         *[c for c in result.columns if c != "window"])


def run_daily_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 end to end in a fresh sink/checkpoint; returns the emitted windows."""
    base = scratch_dir(spark, f"stream-daily-requests-{uuid.uuid4().hex[:8]}")
    run_available_now(daily_requests(request_log_stream(spark, sf_dir)), f"{base}/out", f"{base}/ckpt")
    return closed_windows(spark.read.parquet(f"{base}/out"))


def run_five_minute_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_dir(spark, f"stream-5min-{uuid.uuid4().hex[:8]}")
    run_available_now(five_minute_counts(request_log_stream(spark, sf_dir)), f"{base}/out", f"{base}/ckpt")
    return closed_windows(spark.read.parquet(f"{base}/out"))


# -- late rows ------------------------------------------------------------
# A watermark drops what comes after it. Counts add up, so here each micro-batch appends
# its partial counts by window to a store, under its batch id, in one commit: a row that
# comes however late corrects its window, and a batch that runs again counts once.
MOST_FOLDERS = 32


def merge_partials(store: Store, name: str, keys: list[str], sums: list[str], partials: DataFrame, batch: str) -> None:
    """Adds a batch's partial ``sums`` by ``keys`` to the table; known batches change nothing."""
    live = store.manifest()
    entry = live["tables"].get(name, {"folders": [], "batches": []})
    if batch in entry["batches"]:
        return
    folder = store.stage(partials.select(*keys, *sums), name)
    if len(entry["folders"]) < MOST_FOLDERS:
        store.commit({name: Change([folder], "append", batch)}, based=live)
        return
    whole = X.union_all([store.read(name, live), store.staged(folder)])
    one = store.stage(whole.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]), name)
    store.commit({name: Change([one], "replace", batch, of=entry["batches"])}, based=live)
    store.discard(folder)


def merged_counts(store: Store, name: str, keys: list[str], sums: list[str]) -> DataFrame:
    """The windows with all that has come so far."""
    return store.read(name).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def run_merged(stream: DataFrame, partials, store: Store, name: str, keys: list[str], sums: list[str],
               checkpoint: str, timeout_s: int | None = None) -> None:
    """Drains ``stream`` into the store: ``partials(batch)`` gives a micro-batch's counts."""
    def merge(batch: DataFrame, batch_id: int) -> None:
        merge_partials(store, name, keys, sums, partials(batch), f"{name}-{batch_id}")

    q = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"the stream to {name} wasn't drained within {timeout_s} s")


def daily_partials(batch: DataFrame) -> DataFrame:
    return batch.groupBy(F.to_date("requested_at").alias("request_date")).agg(
        F.count(F.lit(1)).alias("request_count"), F.count_if(F.col("status") == "denied").alias("denied_count"))


def five_minute_partials(batch: DataFrame) -> DataFrame:
    start = F.window("event_time", "5 minutes").start.cast("timestamp_ntz")
    return batch.groupBy(start.alias("window_start"), "domain").agg(F.count(F.lit(1)).alias("request_count"))


def unordered_log_files(spark: SparkSession, sf_dir: str, path: str, files: int = 6) -> DataFrame:
    """The request log's events dealt over ``files`` files without regard to time, as a
    stream of one file a batch: all but the first bring rows later than any watermark."""
    events = fixtures.read_base(spark, sf_dir, "events")
    events.repartition(files, F.xxhash64("event_id")).write.parquet(path)
    spec = fixtures.DERIVED["chatbot_query_log"]
    raw = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return raw.selectExpr(*[f"{e} AS {c}" for c, e in spec.cols]).withColumn(
        "event_time", F.col("requested_at").cast("timestamp"))


def _run_late(spark: SparkSession, sf_dir: str, name: str, partials, keys: list[str], sums: list[str]) -> DataFrame:
    base = scratch_dir(spark, f"{name}-{uuid.uuid4().hex[:8]}")
    store = Store(spark, f"{base}/store")
    run_merged(unordered_log_files(spark, sf_dir, f"{base}/in"), partials, store, name, keys, sums, f"{base}/ckpt")
    return merged_counts(store, name, keys, sums)


model("stream_daily_requests_with_late_rows", "ops", """SELECT cast(requested_at AS date) AS request_date,
  count(*) AS request_count, cast(count_if(status = 'denied') AS bigint) AS denied_count
FROM src_chatbot_query_log GROUP BY ALL""", tags=("stream",))(
    lambda m: _run_late(m.spark, m.sf_dir, "daily", daily_partials, ["request_date"], ["request_count", "denied_count"]))

model("stream_five_minute_counts_with_late_rows", "ops", """SELECT time_bucket(INTERVAL 5 MINUTE, requested_at)
  AS window_start, domain, count(*) AS request_count FROM src_chatbot_query_log GROUP BY ALL""", tags=("stream",))(
    lambda m: _run_late(m.spark, m.sf_dir, "five_minutes", five_minute_partials, ["window_start", "domain"],
                        ["request_count"]))


# Append-mode windows are emitted once closed: window end <= max event time - watermark.
_CLOSED = "window_end <= (SELECT max(requested_at) - INTERVAL 1 HOUR FROM src_chatbot_query_log)"

model("stream_daily_requests", "ops", f"""SELECT * FROM (
  SELECT date_trunc('day', requested_at) AS window_start, date_trunc('day', requested_at) + INTERVAL 1 DAY AS window_end,
    count(*) AS request_count, cast(count_if(status = 'denied') AS bigint) AS denied_count
  FROM src_chatbot_query_log GROUP BY 1, 2) x WHERE {_CLOSED}""", tags=("stream",))(
    lambda m: run_daily_requests(m.spark, m.sf_dir))

model("stream_five_minute_counts", "ops", f"""SELECT * FROM (
  SELECT time_bucket(INTERVAL 5 MINUTE, requested_at) AS window_start,
    time_bucket(INTERVAL 5 MINUTE, requested_at) + INTERVAL 5 MINUTE AS window_end, domain, count(*) AS request_count
  FROM src_chatbot_query_log GROUP BY 1, 2, 3) x WHERE {_CLOSED}""", tags=("stream",))(
    lambda m: run_five_minute_counts(m.spark, m.sf_dir))
