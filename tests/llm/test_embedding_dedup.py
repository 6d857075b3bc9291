import numpy as np
import pytest

from innspark.llm.common import table
from innspark.llm.embedding_dedup import near_vectors, op9_embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, block string, rep string, unit string"


def brute(rows, cosine=0.98):
    units = []
    for vec, e, label in rows:
        x = np.array([np.nan if c is None else c for c in e or []], dtype=np.float64)
        ok = vec is not None and label is not None and len(x) and np.isfinite(x).all() and x.any()
        units.append(x / np.linalg.norm(x) if ok else None)
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2] \
                    and a @ b >= cosine:
                links[i] += 1
                links[j] += 1
                x, y = sorted((find(i), find(j)), key=lambda k: rows[k][0])
                root[y] = x
    return sorted(((r[0], links[i], rows[find(i)][0]) for i, r in enumerate(rows)), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def clusters(n, dims=32):
    rng, rows = np.random.default_rng(n), []
    for k in range(n):
        if k % 3 or k < 9:
            v = rng.normal(size=dims)
        else:  # a near copy, an exact copy or a chain
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.normal(size=dims) * rng.choice([0, 0.1, 0.2])
        rows.append((k, np.float32(v).tolist(), int(rng.integers(3))))
    return [(r[0], r[1], 1 if i % 3 else r[2]) for i, r in enumerate(rows)]


def recall(got, want):
    return sum(min(a[1], b[1]) for a, b in zip(got, want)) / max(1, sum(b[1] for b in want))


@pytest.mark.parametrize("block", [1024, 16])
def test_recall(spark, block):
    rows = clusters(400)
    got = sorted((tuple(r) for r in near_vectors(frame(spark, rows), block=block).collect()), key=str)
    want = brute(rows)
    assert recall(got, want) >= 0.9
    assert all(a[1] <= b[1] for a, b in zip(got, want))


@pytest.mark.parametrize("block", [1024, 8])
def test_exact_when_all_pivots_are_shared(spark, block):
    rows = clusters(150)
    got = near_vectors(frame(spark, rows), nearest=5, shared=1, pivots=5, block=block).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_recall_on_sample(spark):
    vectors = table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in op9_embeddings(vectors).collect()), key=str)
    assert recall(got, brute(rows)) >= 0.9 or not sum(b[1] for b in brute(rows))


def test_odd_rows(spark):
    v, w = [1.0, 2.0, 3.0], [1.0, 2.0, 3.01]
    rows = [(1, v, 1), (2, w, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1),
            (8, [1.0, None, 3.0], 1), (9, [1.0, float("nan"), 3.0], 1), (10, [1.0, float("inf"), 3.0], 1),
            (None, v, 1), (11, v, 1), (11, v, 1), (12, [1.0, 2.0], 1), (13, [-1.0, -2.0, -3.0], 1)]
    got = op9_embeddings(frame(spark, rows)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert op9_embeddings(frame(spark, [])).count() == 0


def test_extreme_norms_link(spark):
    base = np.array([3.0, -1.0, 2.0, 0.5])
    rows = [(k, [float(c) for c in np.ldexp(base, e)], 1) for k, e in enumerate((0, 900, -900, 1020, -1070))]
    rows += [(9, [5e-324, 0.0, 0.0, 0.0], 1), (10, [1e300, 0.0, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in op9_embeddings(df).collect()}
    assert got[0] == got[1] == got[2] == got[3] == (4, 0)
    assert got[9] == got[10] == (1, 9)
