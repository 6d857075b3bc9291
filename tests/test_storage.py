"""Versioned storage: readers, writers that meet, crashes, upkeep."""
import datetime as dt
import threading

import pytest
from pyspark.sql import functions as F

from innspark.plans import storage
from innspark.plans.storage import Change, Conflict, Store
from innspark.sources import extract as E
from innspark.streaming import streams as S

NOW = dt.datetime(2026, 8, 3, 6, 0)


def test_readers_see_whole_versions_during_swaps(spark, tmp_base):
    store = Store(spark, tmp_base)
    make = lambda k: {n: Change([store.stage(spark.range(50).withColumn("v", F.lit(k)), n)]) for n in ("a", "b")}
    store.commit(make(0))
    stop, reads, wrong = threading.Event(), [], []

    def reader():
        while not stop.is_set():
            try:
                seen = store.manifest()
                got = {n: {tuple(r) for r in store.read(n, seen).groupBy("v").count().collect()} for n in ("a", "b")}
                reads.append(seen["version"])
                if got["a"] != got["b"] or len(got["a"]) != 1 or {c for _, c in got["a"]} != {50}:
                    wrong.append(got)
            except Exception as e:  # any failure of a read counts
                wrong.append(e)

    thread = threading.Thread(target=reader)
    thread.start()
    for k in range(1, 21):
        store.commit(make(k))
    stop.set()
    thread.join()
    assert not wrong and len(reads) >= 3 and len(set(reads)) >= 2
    assert store.manifest()["version"] == 21 and store.read("a").first()["v"] == 20


def test_two_writers(spark, tmp_base):
    store = Store(spark, tmp_base)
    store.replace(spark.range(3), "a")
    based = store.manifest()
    one, two = store.stage(spark.range(4), "a"), store.stage(spark.range(5), "b")
    store.commit({"a": Change([one])}, based=based)
    store.commit({"b": Change([two])}, based=based)  # another table: both hold
    assert store.read("a").count() == 4 and store.read("b").count() == 5
    with pytest.raises(Conflict, match="a"):
        store.commit({"a": Change([store.stage(spark.range(9), "a")])}, based=based)
    assert store.read("a").count() == 4
    # the version is taken between a writer's look and its rename: it looks again
    real, lost = storage._write_new, []

    def late(s, path, text):
        if not lost:
            lost.append(path)
            assert real(s, path, text.replace(two, one))
        return real(s, path, text)

    storage._write_new = late
    try:
        store.commit({"c": Change([two])})
    finally:
        storage._write_new = real
    assert lost and store.read("c").count() == 5 and store.read("b").count() == 4
    assert store.versions() == [1, 2, 3, 4, 5]


def test_append_batches_compact_rollback_vacuum(spark, tmp_base):
    store = Store(spark, tmp_base)
    for k in (0, 1, 1, 2):
        store.commit({"t": Change([store.stage(spark.range(10 * k, 10 * k + 10), "t")], "append", f"b{k}")})
    assert store.read("t").count() == 30 and len(store.folders("t")) == 3
    store.compact("t")
    assert store.read("t").distinct().count() == 30 and len(store.folders("t")) == 1
    before = store.manifest()["version"]
    store.commit({"t": Change([store.stage(spark.range(5), "t")], "append", "b1")})
    assert store.manifest()["version"] == before  # the compacted table knows its batches
    store.replace(store.read("t").where("id < 4"), "t")  # a plan over the table itself
    assert store.read("t").count() == 4
    store.rollback(before)
    assert store.read("t").count() == 30
    store.commit({"t": Change(mode="drop")})
    assert store.read("t") is None and store.read("never") is None
    store.rollback(before)
    assert store.vacuum(grace_s=3600) == []  # all younger than the grace
    assert len(store.vacuum(keep=1, grace_s=0)) == 6 and store.unused() == []
    assert store.read("t").count() == 30 and store.versions() == [before + 4]


@pytest.mark.parametrize("dies", ("staged", "committing"))
def test_a_crashed_extract_loads_each_row_once(spark, tmp_base, monkeypatch, dies):
    store, spec = Store(spark, tmp_base), E.ExtractSpec("s", "t", "id")
    src = lambda n: spark.range(1, n + 1)
    E.run_extract(store, src(10), spec, NOW)
    real = storage._write_new

    def crash(s, path, text):
        if dies == "committing":
            real(s, path + ".aside", text)
        raise OSError("planted")

    monkeypatch.setattr(storage, "_write_new", crash)
    with pytest.raises(OSError):
        E.run_extract(store, src(25), spec, NOW)
    monkeypatch.setattr(storage, "_write_new", real)
    assert store.read("t").count() == 10 and E.read_cursor(store.manifest(), spec) == "10"
    assert E.run_extract(store, src(25), spec, NOW, batch="x")["rows"] == 15
    assert E.run_extract(store, src(40), spec, NOW, batch="x")["mode"] == "skipped"
    assert store.read("t").count() == store.read("t").select("id").distinct().count() == 25


def test_many_extracts_stay_few_folders(spark, tmp_base, monkeypatch):
    monkeypatch.setattr(E, "MOST_FOLDERS", 3)
    store, spec = Store(spark, tmp_base), E.ExtractSpec("s", "t", "id")
    for n in range(1, 8):
        E.run_extract(store, spark.range(n * 10), spec, NOW, batch=str(n))
    assert len(store.folders("t")) <= 3 and store.read("t").distinct().count() == 70
    assert E.run_extract(store, spark.range(500), spec, NOW, batch="2")["mode"] == "skipped"


def test_late_rows_correct_their_windows(spark, tmp_base, monkeypatch):
    monkeypatch.setattr(S, "MOST_FOLDERS", 2)
    store = Store(spark, tmp_base)
    rows = [(dt.datetime(2024, 1, 1 + k % 5, k % 24), "denied" if k % 3 else "ok") for k in range(60)]
    frame = lambda r: spark.createDataFrame(r, "requested_at timestamp, status string")
    for batch in (0, 1, 2, 1, 3, 0, 4):  # some are delivered again
        S.merge_partials(store, "daily", ["request_date"], ["request_count", "denied_count"],
                         S.daily_partials(frame(rows[batch * 12:batch * 12 + 12])), f"daily-{batch}")
    got = S.merged_counts(store, "daily", ["request_date"], ["request_count", "denied_count"])
    want = S.daily_partials(frame(rows))
    assert sorted(got.collect()) == sorted(want.collect()) and len(store.folders("daily")) <= 3
