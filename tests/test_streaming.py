import uuid

from innspark.session import scratch_dir
from innspark.streaming import streams as S

SF = "/root/testdata/sf0.001"


def test_daily_requests_stream_emits_closed_windows(spark):
    out = S.run_daily_requests(spark, SF)
    log = spark.read.parquet(f"{SF}/events.parquet")
    import pyspark.sql.functions as F
    mx = log.agg(F.max("ts")).first()[0]
    rows = out.collect()
    assert rows and all(r.window_end <= mx for r in rows)
    total = sum(r.request_count for r in rows)
    closed = log.where(F.to_date("ts") < F.to_date(F.lit(mx))).count()
    assert total == closed


def test_incremental_file_stream_loads_each_file_once(spark):
    base = scratch_dir(spark, f"test-j1-{uuid.uuid4().hex[:8]}")
    schema = spark.read.parquet(f"{SF}/region.parquet").schema
    S.incremental_extract_stream(spark, f"{SF}/region*.parquet", schema, f"{base}/out", f"{base}/ckpt")
    n1 = spark.read.parquet(f"{base}/out").count()
    S.incremental_extract_stream(spark, f"{SF}/region*.parquet", schema, f"{base}/out", f"{base}/ckpt")
    assert n1 == 5 and spark.read.parquet(f"{base}/out").count() == 5
