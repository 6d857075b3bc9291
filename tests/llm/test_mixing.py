import random
import re
from collections import defaultdict

import numpy as np
import pytest

from innspark.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """The level at which capped sources and the others add up, by bisection."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, low, high = share * sum(sizes.values()), 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        if sum(min(most * sizes[s], mid * w[s]) for s in names) < total:
            low = mid
        else:
            high = mid
    return {s: min(most * sizes[s], high * w[s]) for s in names}


def targets_of(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, size long")
    return {r.source: r.target for r in mixing.targets(rows).collect()}


def test_targets(spark):
    for seed in range(6):
        rng = random.Random(seed)
        sizes = {s: rng.randrange(0, 5000) for s in ["b", "a", "é", "Z", "z1", "\U0001f600", "\uffee", None]
                 [:rng.randrange(1, 9)]}
        assert targets_of(spark, sizes) == pytest.approx(brute_targets(sizes), abs=1e-3)
    assert targets_of(spark, {}) == {} and targets_of(spark, {"a": 0}) == {"a": 0.0}


def test_targets_of_many_sources(spark):
    rng = random.Random(9)
    sizes = {f"host{k}": int(rng.paretovariate(0.8)) for k in range(20_000)}
    got, want = targets_of(spark, sizes), brute_targets(sizes)
    assert got.keys() == want.keys()
    assert max(abs(got[s] - want[s]) / max(1, want[s]) for s in want) < 1e-6


def test_equal_rows_spread_over_blocks(docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 50)
    rows = [(7, "same words here", "en", "a")] * 900 + [(k, "w " * (k % 9), "en", "b") for k in range(300)]
    got = mixing.mix(docs_of(rows), block=32)
    again = mixing.mix(docs_of(rows).repartition(5), block=32)
    order = lambda f: sorted((r.doc_id, r.size, r.taken) for r in f.collect())
    assert order(got) == order(again) and got.count() == len(rows)
    of_a = [r for r in got.collect() if r.doc_id == 7 and r.size == 3]
    assert len(of_a) >= 900 and abs(sum(r.taken for r in of_a) - of_a[0].target) <= 30
    numbered = mixing._numbered(docs_of(rows).select("doc_id", "text"))
    assert numbered.where("doc_id = 7 and text = 'same words here'").select("nth").distinct().count() == 900


def test_take_keeps_columns_with_its_own_names(spark):
    docs = spark.createDataFrame(
        [(1, "a b c", "s", 7, 8, 9, 10), (1, "a b c", "s", 7, 8, 9, 10), (2, "d e", "t", 7, 8, 9, 10)],
        "doc_id long, text string, source string, doc int, row int, nth int, copy int")
    mixed = mixing.mix(docs)
    out = mixing.take(docs, mixed)
    assert out.columns == docs.columns
    assert {tuple(r)[3:] for r in out.collect()} <= {(7, 8, 9, 10)}
    assert out.count() == sum(r.copies for r in mixed.collect()) > 0


def test_flight_keeps_totals():
    rng = random.Random(1)
    for _ in range(50):
        n = rng.randrange(1, 60)
        p, size = [rng.random() for _ in range(n)], [float(rng.randrange(0, 500)) for _ in range(n)]
        out = mixing.flight(p, size, rng, False)
        assert sum(0 < x < 1 for x in out) <= 2 and all(0 <= x <= 1 for x in out)
        assert sum(out) == pytest.approx(sum(p), abs=1e-6)
        assert np.dot(out, size) == pytest.approx(np.dot(p, size), abs=1e-3)
        assert set(mixing.flight(p, size, rng, True)) <= {0.0, 1.0}


def test_mean_is_the_probability():
    rng, p = random.Random(3), [0.1, 0.7, 0.4, 0.5, 0.9, 0.2]
    size = [3.0, 9.0, 4.0, 1.0, 7.0, 5.0]
    mean = np.mean([mixing.flight(p, size, rng, False) for _ in range(8000)], axis=0)
    assert np.abs(mean - p).max() < 0.03


@pytest.mark.parametrize("block", [mixing.BLOCK, 16])
def test_mix(docs_of, block):
    rng = random.Random(5)
    rows = [(k, "w " * rng.randrange(0, 60), "en", rng.choice(["big"] * 6 + ["a", "b", "é", None]))
            for k in range(700)]
    first = mixing.mix(docs_of(rows), block=block).collect()
    again = mixing.mix(docs_of(rows).repartition(3), block=block).collect()
    assert sorted(first, key=lambda r: r.doc_id) == sorted(again, key=lambda r: r.doc_id)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    of = {r[0]: r[3] for r in rows}
    text = {r[0]: r[1] for r in rows}
    for r in first:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text[r.doc_id]))
        assert r.taken == r.size * r.copies and 0 <= r.copies <= 2
        sizes[of[r.doc_id]] += r.size
        taken[of[r.doc_id]] += r.taken
        target[of[r.doc_id]] = r.target
    assert target == pytest.approx(brute_targets(sizes), abs=1e-3)
    assert all(abs(taken[s] - target[s]) <= 30 for s in target)


def test_odd_rows_and_take(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    mixed = mixing.mix(docs)
    rows = mixed.collect()
    assert len(rows) == len(odd_rows)
    out = mixing.take(docs, mixed)
    assert out.columns == docs.columns
    assert out.count() == sum(r.copies for r in rows)
    assert mixing.mix(docs_of([])).count() == 0
