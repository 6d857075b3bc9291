"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import gc
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from innspark.session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint location."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends there."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; every other letter keeps its case."""
    return F.translate(col, UPPER, LOWER)


HUBS = 1000  # a key with more than its share of this many of all rows is a hub
HUB_ROWS = 512  # a key with fewer rows never is


def join_hubs(rows: DataFrame, per_key: DataFrame, key: str, n: str, total: int, spread: str
              ) -> DataFrame:
    """``rows`` with the other columns of ``per_key``, which has one row for each value
    of ``key``, and in ``n`` how many of the ``total`` rows have it. ``key`` isn't null.

    Hubs can't be more than HUBS: their values are broadcast, and their rows are spread
    by ``spread``. All other keys meet in a shuffle, none with over total / HUBS rows."""
    few = max(HUB_ROWS, total // HUBS)
    values = [c for c in per_key.columns if c not in (key, n)]
    hubs = per_key.where(F.col(n) > few).select(
        key, *[F.col(c).alias(f"hub_{c}") for c in values], F.lit(True).alias("is_hub"))
    others = per_key.where(F.col(n) <= few).select(key, F.lit(0).alias("salt"), *values)
    salt = F.when(F.col("is_hub"), F.pmod(F.xxhash64(spread), F.lit(65_536)).cast("int") + 1).otherwise(0)
    met = (rows.join(F.broadcast(hubs), key, "left").withColumn("salt", salt)
           .join(others, [key, "salt"], "left"))
    return met.select(*rows.columns, *[
        F.when(F.col("is_hub"), F.col(f"hub_{c}")).otherwise(F.col(c)).alias(c) for c in values])


EDGES_A_FILE = 250_000
_CACHE: dict = {}


def worker_cache(key, make):
    """What a Python worker keeps between tasks: one operator's cache at a time, as
    the workers of an executor live on and their memory adds up."""
    if key not in _CACHE:
        release_cache()
        _CACHE[key] = make()
    return _CACHE[key]


def release_cache() -> None:
    _CACHE.clear()
    trim_memory()


def trim_memory() -> None:
    """Give the system back what a Python worker has freed: idle workers live on beside the
    executor, and the allocators keep the most that any of their tasks took."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a long, b long; any direction).

    Returns (node, component): one row for every node that has an edge to
    another node; ``component`` is the smallest node reachable. Large-star and
    small-star steps alternate until the edges are stars; each step is one
    grouped minimum (combined before its shuffle) and one join back that spreads a
    hub's neighbours, and the result of each round is written, so a lost executor
    costs one round.
    """
    def stars(e: DataFrame, large: bool, n: int) -> DataFrame:
        both = e.union(e.select(F.col("b"), F.col("a"))).toDF("u", "v")
        if not large:
            both = both.where("v < u")
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select(
            "u", F.least("u", "m").alias("m"), "n")
        out = join_hubs(both, low, "u", "n", 2 * n, "v")
        if large:
            return out.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return out.select(F.col("v").alias("a"), F.col("m").alias("b")).where("a != b").union(
            low.select(F.col("u").alias("a"), F.col("m").alias("b")))

    edges = edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = written(edges, "edges")
    # there are never more edges than now; files for few rows only cost time
    many = edges.count()
    files = 1 + many // EDGES_A_FILE
    state = None
    while True:
        # each step reads its edges several times: the first one's are written, too
        edges = written(stars(edges, True, many).coalesce(files), "edges")
        edges = written(stars(edges, False, many).distinct().coalesce(files), "edges")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")
                                                       ).alias("h")).first()
        if state == now:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        state = now


ARROW_ROWS = 2000  # rows of a batch that a Python worker holds; texts are long


def ship(spark: SparkSession) -> None:
    """Let the executors' Python workers import this package, once per session.

    What ``spark-submit --py-files`` does: Spark copies the archive to each
    executor, also to those that join later.
    """
    context = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    if getattr(context, "_innspark_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    # Spark's file server reads the archive from the driver as long as the session lasts
    folder = tempfile.mkdtemp(prefix="innspark-py-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/innspark.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(path)
    context._innspark_shipped = True
